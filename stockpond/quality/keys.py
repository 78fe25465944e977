"""Key quality of bronze, before deduplication hides repeated and missing keys.

Counters are kept per ingestion day, where a key may come once: the same key on
another day is an update, not a fault. They add up over days, so a day is
counted once and a gate over many days reads a few rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpond.contracts import QualityLimits
from stockpond.quality.checks import Severity


def key_counters(bronze: DataFrame, table_name: str, key: str) -> DataFrame:
    """(table_name, key, _ingestion_date, rows, null_keys, repeated): one row per ingestion day.

    Blank keys count as missing, and blanks around a key do not tell keys apart.
    ``repeated`` counts the rows beyond the first of each key. Rows are counted
    per key in their tasks first, so a key that holds many rows costs one row per task.
    """
    cleaned = F.trim(key)
    keys = bronze.select("_ingestion_date", F.when(cleaned != "", cleaned).alias("_key"))
    counted = keys.groupBy("_ingestion_date", "_key").agg(F.count(F.lit(1)).alias("n"))
    missing = F.col("_key").isNull()
    return counted.groupBy("_ingestion_date").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("null_keys"),
        F.coalesce(F.sum(F.when(~missing, F.col("n") - 1)), F.lit(0)).alias("repeated"),
    ).select(F.lit(table_name).alias("table_name"), F.lit(key).alias("key"), "_ingestion_date", "rows", "null_keys", "repeated")


def check_keys(counters: DataFrame, limits: QualityLimits, days: Sequence[str] | None = None) -> DataFrame:
    """Results, in the form of ``evaluate``, of the counters of all or the given days."""
    if days is not None:
        counters = counters.where(F.col("_ingestion_date").isin([F.lit(day).cast("date") for day in days]))
    sums = counters.groupBy("table_name", "key").agg(*(F.sum(c).alias(c) for c in ("rows", "null_keys", "repeated")))

    def result(kind: str, failed: str, limit: float, message: str):
        percentage = F.coalesce(F.try_divide(F.col(failed), F.col("rows")) * 100, F.lit(0.0))
        return F.struct(
            F.concat(F.lit(f"bronze_{kind}_"), "key").alias("check_name"), F.lit(Severity.ERROR.value).alias("severity"),
            (percentage <= limit).alias("passed"), F.col(failed).alias("failed_count"), F.col("rows").alias("total_count"),
            percentage.alias("failed_percentage"), F.concat("key", F.lit(message)).alias("message"))

    checks = F.array(
        result("not_null", "null_keys", limits.max_null_percentage, " must not be null"),
        result("unique", "repeated", limits.max_duplicate_percentage, " must be unique within a day"))
    return sums.select("table_name", F.inline(checks))
