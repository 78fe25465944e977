"""Bronze layer: raw records as they came, plus lineage."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpond.operators.columns import stamp_lineage
from stockpond.sources.files import is_empty_source, path_exists, read_raw
from stockpond.sources.sinks import WriteReport, write_table

log = logging.getLogger(__name__)


def with_file_lineage(raw: DataFrame) -> DataFrame:
    """Lineage with the path of the very file each row was read from."""
    return stamp_lineage(raw, F.col("_metadata.file_path"))


def ingest_table(
    spark: SparkSession,
    table: str,
    raw_path: str,
    bronze_path: str,
    file_format: str = "csv",
    replace_day: bool = False,
    match_pattern: bool = False,
) -> WriteReport | None:
    """Copy the raw files of a table into its ingestion-date partition.

    Appends by default; ``replace_day`` overwrites just today's partition, so
    a repeated run does not duplicate rows. ``match_pattern`` reads only files
    named like the table. A missing or empty source is skipped with a warning.
    """
    if not path_exists(spark, raw_path):
        log.warning("%s: no raw files at %s, skipped", table, raw_path)
        return None
    raw = read_raw(spark, table, raw_path, file_format, match_pattern=match_pattern)
    if is_empty_source(raw):
        log.warning("%s: raw files at %s hold no records, skipped", table, raw_path)
        return None
    written = write_table(
        with_file_lineage(raw),
        bronze_path,
        mode="overwrite" if replace_day else "append",
        partition_by=["_ingestion_date"],
        replace_only_written=replace_day,
        gather=False,  # one run writes one day
    )
    log.info("%s: %d records to bronze", table, written.rows)
    return written
