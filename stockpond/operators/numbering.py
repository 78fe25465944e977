"""Integer keys for rows.

A window over the whole table would number rows 1..n in a single task. Here
the rows are range-partitioned by the order columns and each partition is
sorted on its own; ``monotonically_increasing_id`` then holds (partition,
position). One row per partition is enough to turn that into a dense number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockpond.session import stage

_POSITION_BITS = 33  # layout of monotonically_increasing_id


def _split(slot: str) -> tuple[Column, Column]:
    partition = F.shiftright(slot, _POSITION_BITS)
    return partition, F.col(slot) - F.shiftleft(partition, _POSITION_BITS)


def number_rows(
    df: DataFrame, name: str, order_by: Sequence[str | Column] = (), after: int = 0, ties: bool = False
) -> DataFrame:
    """Add ``name`` = ``after`` + 1 .. ``after`` + n in the given order (``name`` comes first).

    Without an order rows are numbered as they arrive. The ordered rows are
    staged, because range bounds come from sampling and a second run of the
    same plan may cut elsewhere.

    The order is taken to be total. Where many rows may be equal in it, say
    ``ties=True``: rows then get an arrival number first, which decides among
    equal rows and lets a range of equal rows be cut into several tasks. That
    number is staged too, so that a repeated task sends every row to the same
    place.
    """
    columns, order = df.columns, list(order_by)
    if order and ties:
        df = stage(df.withColumn("_arrival", F.monotonically_increasing_id()), f"arrivals-{name}")
        order.append(F.col("_arrival"))
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    staged = stage(df.select(*[F.col(f"`{c}`") for c in columns], F.monotonically_increasing_id().alias("_slot")),
                   f"numbered-{name}")
    partition, position = _split("_slot")
    # One row per written partition: bounded by the number of tasks, not by the data.
    sizes = staged.groupBy(partition.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    number = (F.col("_offset") + position + F.lit(after + 1)).cast("bigint").alias(name)
    return (
        staged.withColumn("_part", partition)
        .join(F.broadcast(offsets), "_part")
        .select(number, *[F.col(f"`{c}`") for c in columns])
    )


def number_rows_sparse(df: DataFrame, name: str) -> DataFrame:
    """Add a unique, increasing, not dense number without a shuffle.

    The table is staged so that the numbers stay the same for every reader.
    """
    return stage(df.withColumn(name, F.monotonically_increasing_id() + 1), f"sparse-{name}")
