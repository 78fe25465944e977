"""Evaluation of check lists.

All row-level checks of a table are computed by one aggregation over one scan;
each foreign key adds one anti-join of distinct values. Results are a
DataFrame with one row per check, never larger than the check list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpond.operators.joins import missing_keys
from stockpond.quality.checks import Fresh, References, RowCount, Severity


class DataQualityError(RuntimeError):
    """Raised when a gate is closed."""


def evaluate(df: DataFrame, table_name: str, checks: Sequence, as_of: str | Column | None = None) -> DataFrame:
    """Run ``checks`` on ``df``; one result row per check.

    Columns: table_name, check_name, severity, passed, failed_count,
    total_count, failed_percentage, message. A check on a column that does not
    exist fails as an error. ``as_of`` is the moment freshness is measured at.
    """
    moment = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    total = F.count(F.lit(1))
    known = [i for i, check in enumerate(checks) if set(check.needs) <= set(df.columns)]

    row_level = [total.alias("total")]
    parts = []
    for i in known:
        check = checks[i]
        if isinstance(check, References):
            orphans = missing_keys(df, check.column, check.reference, check.reference_column)
            parts.append(orphans.agg(F.count(F.lit(1)).alias(f"m{i}")))
        elif isinstance(check, Fresh):
            row_level.append(check.age_hours(moment).alias(f"m{i}"))
        else:
            row_level.append(check.failures(total).cast("bigint").alias(f"m{i}"))

    measured = df.agg(*row_level)
    if parts:  # one row each; max() puts them side by side
        for part in parts:
            measured = measured.unionByName(part, allowMissingColumns=True)
        measured = measured.agg(*[F.max(c).alias(c) for c in measured.columns])
    rows = [_result(check, i in known, F.col(f"m{i}")) for i, check in enumerate(checks)]
    return measured.select(F.inline(F.array(*rows))).select(F.lit(table_name).alias("table_name"), "*")


def _result(check, known: bool, measure: Column) -> Column:
    total, zero = F.col("total"), F.lit(0).cast("bigint")
    percentage, severity, message = F.lit(0.0), check.severity, check.message
    if not known:
        failed, total, passed, severity = zero, zero, F.lit(False), Severity.ERROR
        message = f"{', '.join(check.needs)} does not exist"
    elif isinstance(check, Fresh):
        failed, passed = zero, F.coalesce(measure <= check.max_age_hours, F.lit(False))
    elif isinstance(check, RowCount):
        failed, passed = measure, measure == 0
    else:
        failed = measure
        percentage = F.coalesce(F.try_divide(measure, total) * 100, F.lit(0.0))
        passed = percentage <= check.limit
    return F.struct(
        F.lit(check.name).alias("check_name"),
        F.lit(severity.value).alias("severity"),
        passed.alias("passed"),
        failed.alias("failed_count"),
        total.alias("total_count"),
        percentage.alias("failed_percentage"),
        F.lit(message).alias("message"),
    )


def _blocking(include_warnings: bool) -> Column:
    levels = [Severity.ERROR.value] + ([Severity.WARNING.value] if include_warnings else [])
    return ~F.col("passed") & F.col("severity").isin(*levels)


def gate(results: DataFrame, include_warnings: bool = False) -> DataFrame:
    """Per table, whether the data may move on."""
    return results.groupBy("table_name").agg(
        F.bool_and(~_blocking(include_warnings)).alias("passed"),
        F.count_if(_blocking(include_warnings)).alias("blocking_checks"),
    )


def enforce(results: DataFrame, include_warnings: bool = False) -> None:
    """Raise if any blocking check failed. Reads at most one row per declared check."""
    failed = results.where(_blocking(include_warnings)).select("table_name", "check_name").collect()
    if failed:
        raise DataQualityError("failed checks: " + ", ".join(f"{r.table_name}.{r.check_name}" for r in failed))


def summarize(results: DataFrame) -> DataFrame:
    """Per table, how many checks ran, passed and failed."""
    return results.groupBy("table_name").agg(
        F.max("total_count").alias("total_rows"),
        F.count(F.lit(1)).alias("checks"),
        F.count_if("passed").alias("checks_passed"),
        F.count_if(~F.col("passed")).alias("checks_failed"),
        F.when(F.bool_and("passed"), "passed").otherwise("failed").alias("status"),
    )


def report(results: DataFrame) -> DataFrame:
    """Results with a one-line text per check, for logs and files."""
    line = F.format_string(
        "%s [%s] %s: %s (%d/%d = %.2f%%)",
        F.when(F.col("passed"), "PASSED").otherwise("FAILED"),
        F.upper("severity"), "check_name", "message", "failed_count", "total_count", "failed_percentage",
    )
    return results.withColumn("line", line)
