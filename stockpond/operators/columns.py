"""Column-wise operators; each is one projection, whatever the number of columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns; unreadable values become null, absent columns are skipped."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns})


def trim_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Strip blanks around the named text columns; absent columns are skipped."""
    return df.withColumns({c: F.trim(c) for c in columns if c in df.columns})


def stamp_lineage(
    df: DataFrame,
    source: str | Column,
    at: Column | None = None,
    date_column: str = "_ingestion_date",
) -> DataFrame:
    """Add when, from where and on which day rows came in.

    ``source`` is a literal location or a column such as ``_metadata.file_path``.
    """
    at = F.current_timestamp() if at is None else at
    source = F.lit(source) if isinstance(source, str) else source
    return df.withColumns({"_ingested_at": at, "_source_file": source, date_column: at.cast("date")})
