"""One row per key.

``row_number() = 1`` lets Spark place a group limit in front of the shuffle:
each task sends at most one row per key, so a key with a large share of all
rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ORDERABLE_EXCEPT = ("map", "variant")


def _first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], used: set[str]) -> DataFrame:
    tie_break = [
        F.col(f"`{f.name}`").desc_nulls_last()
        for f in df.schema.fields
        if f.name not in used and f.dataType.typeName() not in _ORDERABLE_EXCEPT
    ]
    window = Window.partitionBy(*keys).orderBy(*order, *tie_break)
    return df.withColumn("_row", F.row_number().over(window)).where("_row = 1").drop("_row")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], by: Sequence[str], then: Sequence[Column] = ()
) -> DataFrame:
    """Keep the row with the greatest ``by`` values of each key.

    Rows equal in ``by`` are decided by ``then`` and after that by all
    remaining columns, so the choice never depends on arrival order.
    """
    order = [F.col(c).desc_nulls_last() for c in by] + list(then)
    return _first_per_key(df, keys, order, {*keys, *by})


def earliest_per_key(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Keep the row with the smallest ``by`` values of each key; missing values come last."""
    return _first_per_key(df, keys, [F.col(c).asc_nulls_last() for c in by], {*keys, *by})
