"""Helpers that the operators share: reading tables, Arrow batches of rows, staged tables, small numpy kernels."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Characters of ``[\x20\x09-\x0D]``.
BLANKS = " \t\n\x0b\f\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; read by Spark, so the folder may be on any storage."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _values(column: pa.Array) -> list:
    """The values of a column; an array of bigint without nulls is a view of the batch."""
    if not pa.types.is_list(column.type) or column.type.value_type != pa.int64() or column.null_count:
        return column.to_pylist()
    ends = column.offsets.to_numpy()
    flat = column.flatten()
    if flat.null_count:
        return column.to_pylist()
    flat, ends = flat.to_numpy(), ends - ends[0]
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def map_rows(
    df: DataFrame, make: Callable[[], Callable[[dict[str, list]], dict[str, Sequence]]], ddl: str, rows: int = 512
) -> DataFrame:
    """Map slices of at most ``rows`` rows: columns as lists in, columns of ``ddl`` out.

    Arrays of bigint come in as numpy arrays. ``make`` runs once per task and
    may build what all slices of the task share.
    """
    schema = to_arrow_schema(T.StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                out = step({name: _values(part.column(name)) for name in part.schema.names})
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)

    return df.mapInArrow(run, ddl)


def free_name(columns: Sequence[str], stem: str) -> str:
    """``stem``, or ``stem`` with underscores after it, whichever no given column has in any case."""
    taken = {c.lower() for c in columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character kept."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers (the finaliser of SplitMix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def ranges(lengths: np.ndarray) -> np.ndarray:
    """0..n-1 for each length in turn, joined."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)
