"""Positions of rows inside groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockpond.operators.numbering import number_rows
from stockpond.session import stage


def rank_within(
    df: DataFrame, group: Sequence[str], order_by: Sequence[Column], name: str, ties: bool = False
) -> DataFrame:
    """Number the rows of each group 1..m in the given total order, for every row.

    A group can hold most of the table, so it is not gathered in one task:
    rows are numbered over (group, order) across the table and the first
    number of the row's group is subtracted. The table of group starts is
    staged; its file size tells the planner whether it may be broadcast.
    ``ties=True`` is for orders in which many rows may be equal.
    """
    numbered = number_rows(df, "_position", [*[F.col(c) for c in group], *order_by], ties=ties)
    starts = stage(
        numbered.groupBy(*[F.col(c).alias(f"_g_{c}") for c in group]).agg(F.min("_position").alias("_first")),
        "group-starts",
    )
    same_group = [numbered[c].eqNullSafe(starts[f"_g_{c}"]) for c in group]
    rank = (F.col("_position") - F.col("_first") + 1).cast("bigint").alias(name)
    return numbered.join(starts, same_group).select(*[numbered[c] for c in df.columns], rank)


def top_per_group(df: DataFrame, group: Sequence[str], order_by: Sequence[Column], k: int, name: str) -> DataFrame:
    """The first ``k`` rows of each group with their rank.

    The rank filter is pushed in front of the shuffle as a group limit, so a
    large group sends at most ``k`` rows per task.
    """
    window = Window.partitionBy(*group).orderBy(*order_by)
    ranked = df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= k)
    return ranked.withColumn(name, F.col(name).cast("bigint"))
