"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def drop_incomplete(
    df: DataFrame, columns: Sequence[str], observation: Observation | None = None
) -> DataFrame:
    """Keep rows in which none of ``columns`` is null.

    With an ``Observation`` the numbers of rows read and dropped come out of
    the job that consumes the result, without a second pass.
    """
    if observation is not None:
        incomplete = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in columns))
        df = df.observe(
            observation,
            F.count(F.lit(1)).alias("rows_read"),
            F.count_if(incomplete).alias("rows_dropped"),
        )
    return df.dropna(subset=list(columns))
