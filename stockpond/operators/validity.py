"""Lookup of the version that was valid at a moment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def valid_version(
    rows: DataFrame, history: DataFrame, key: str, moment: str, columns: Sequence[str], starts: str = "effective_from",
) -> DataFrame:
    """``rows`` with the ``columns`` of the version of their ``key`` that was valid at ``moment``.

    A version is valid from its ``starts`` to the start of the next one, the
    first version also before that, so the versions of a key neither overlap nor
    leave gaps and each row finds exactly one. Of versions with equal starts the
    one greatest in ``columns`` counts. Rows without a moment take the last
    version; rows whose key has no version drop out.

    The join is an equality on (key, year): a version is repeated for each year
    that it covers, between the first and the last year of the rows. So a row
    meets only the versions of its year, however long the history of a key is,
    and the rows of a hot key spread over the years.
    Versions repeated per year are many times what the planner takes from the
    size of the stored history, so they are never broadcast.
    """
    at, year = F.col(moment).cast("timestamp"), F.year(moment)
    bounds = rows.agg(F.min(year).alias("first"), F.max(year).alias("last"))
    # Both stay part of the plan: no job runs here. Rows without a moment have a year of their own after the last.
    first, undated = bounds.select("first").scalar(), bounds.select(F.col("last") + 1).scalar()
    first, undated = F.coalesce(first, F.lit(0)), F.coalesce(undated, F.lit(0))

    order = [F.col(starts).cast("timestamp").asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in columns]]
    by_key = Window.partitionBy(key).orderBy(*order)
    versions = history.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.struct(*columns).alias("_version"),
        F.when(F.row_number().over(by_key) > 1, F.col(starts).cast("timestamp")).alias("_from"),
        F.lead(F.col(starts).cast("timestamp")).over(by_key).alias("_to"),
        F.lead(F.lit(True)).over(by_key).isNull().alias("_open"))
    begin = F.greatest(F.coalesce(F.year("_from"), first), first)
    begin = F.when(F.col("_open"), F.least(begin, undated)).otherwise(begin)
    end = F.when(F.col("_open"), undated).otherwise(F.least(F.year("_to"), undated))
    covered = F.when(begin <= end, F.sequence(begin, end)).otherwise(F.array().cast("array<int>"))
    yearly = versions.where(F.col("_open") | F.col("_from").isNull() | (F.col("_from") < F.col("_to"))).withColumn(
        "_year", F.explode(covered))

    dated = rows.withColumns({"_at": at, "_row_year": F.coalesce(year, undated)})
    valid = F.when(F.col("_at").isNull(), F.col("_open")).otherwise(
        (F.col("_from").isNull() | (F.col("_at") >= F.col("_from"))) & (F.col("_open") | (F.col("_at") < F.col("_to"))))
    found = dated.join(yearly.hint("merge"), (F.col(key) == F.col("_key")) & (F.col("_row_year") == F.col("_year")) & valid)
    return found.select(*[F.col(f"`{c}`") for c in rows.columns], *[F.col("_version")[c].alias(c) for c in columns])
