"""Parquet sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stockpond.session import hadoop_path


@dataclass(frozen=True)
class WriteReport:
    """What a write measured while it ran."""

    path: str
    rows: int
    metrics: Mapping[str, object]


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    replace_only_written: bool = False,
    gather: bool = True,
    metrics: Mapping[str, Column] | None = None,
) -> WriteReport:
    """Write a table and count its rows in the same job.

    Partitioned writes are rebalanced on the partition columns: rows of small
    partitions share a task, those of a large one are split over several, so
    there are neither thousands of tiny files nor one task with a hot day.
    ``gather=False`` leaves out that shuffle where rows are in place already,
    for instance when all of them belong to one partition.
    ``replace_only_written`` overwrites just the partitions that occur in ``df``.
    """
    if partition_by and gather:
        df = df.hint("rebalance", *partition_by)
    observed = Observation()
    extra = [expr.alias(name) for name, expr in (metrics or {}).items()]
    writer = df.observe(observed, F.count(F.lit(1)).alias("rows"), *extra).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic" if replace_only_written else "static")
    writer.parquet(path)
    found = dict(observed.get)
    return WriteReport(path, found.pop("rows"), found)


def move_days(spark: SparkSession, folder: str, path: str) -> None:
    """Move the files of a partitioned folder into the same partitions of the table at ``path``, one rename each.

    Files that an earlier call moved are not there to be moved again, so a call
    that was cut short may be repeated. Both have to be on one file system.
    """
    source, fs = hadoop_path(spark, folder)
    for day in fs.listStatus(source):
        if not day.isDirectory():
            continue
        target, _ = hadoop_path(spark, f"{path.rstrip('/')}/{day.getPath().getName()}")
        fs.mkdirs(target)
        for part in fs.listStatus(day.getPath()):
            name = part.getPath().getName()
            if not name.startswith((".", "_")) and not fs.rename(part.getPath(), hadoop_path(spark, f"{target.toString()}/{name}")[0]):
                raise OSError(f"{name} could not be moved to {target}")
