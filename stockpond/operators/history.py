"""Type 2 history of a dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpond.operators.numbering import number_rows


def _unless(wrong: Column, message: str, value: Column) -> Column:
    return F.when(wrong, F.raise_error(F.lit(message))).otherwise(value)


def merge_history(
    dimension: DataFrame,
    incoming: DataFrame,
    natural_key: str,
    surrogate_key: str,
    tracked: Sequence[str],
    effective: str,
) -> DataFrame:
    """New state of a dimension after a delivery.

    ``dimension`` has the surrogate key, the natural key, the tracked columns,
    ``effective_from``, ``effective_to`` and ``is_current``; ``incoming`` has
    one row per natural key. A changed row closes its current version at
    ``effective`` and opens a new one with a fresh surrogate key. Unchanged
    rows, rows absent from the delivery and closed versions stay as they are.
    Attributes are compared themselves, not their hashes. A null natural key is
    a member like any other. Two rows of one member in a delivery, and a change
    from before the version that it would close, are errors. The joins sort and
    merge: stored attributes compress too well for their file size to tell
    whether a side may be broadcast.
    """
    moment = dimension.schema["effective_from"].dataType
    when = F.lit(effective).cast(moment)
    columns = [surrogate_key, natural_key, *tracked, "effective_from", "effective_to", "is_current"]
    current = dimension.where("is_current").select(F.col(natural_key).alias("_key"), F.struct(*tracked).alias("_old"))
    offered = incoming.groupBy(natural_key).agg(
        F.count(F.lit(1)).alias("_rows"), F.first(F.struct(*tracked)).alias("_new")).select(
        natural_key, _unless(F.col("_rows") > 1, "a delivery holds two rows of one member", F.col("_new")).alias("_new"))

    fresh = (
        offered.join(current.hint("merge"), F.col(natural_key).eqNullSafe(F.col("_key")), "left")
        .where(F.col("_old").isNull() | ~F.col("_old").eqNullSafe(F.col("_new")))
        .select(natural_key, "_new.*")
    )
    last_key = dimension.agg(F.coalesce(F.max(surrogate_key), F.lit(0))).first()[0]
    opened = number_rows(fresh, surrogate_key, [natural_key], after=last_key).withColumns({
        "effective_from": when,
        "effective_to": F.lit(None).cast(moment),
        "is_current": F.lit(True),
    })

    replaced = opened.select(F.col(natural_key).alias("_key"), F.lit(True).alias("_replaced"))
    ends = F.col("is_current") & F.col("_replaced").isNotNull()
    kept = dimension.join(replaced.hint("merge"), F.col(natural_key).eqNullSafe(F.col("_key")), "left").withColumns({
        "effective_to": F.when(ends, _unless(
            F.col("effective_from") > when, "a change is older than the version it closes", when,
        )).otherwise(F.col("effective_to")),
        "is_current": F.col("is_current") & ~ends,
    })
    return kept.select(columns).unionByName(opened.select(columns))

