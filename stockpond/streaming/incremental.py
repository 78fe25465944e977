"""Incremental ingestion: each raw file is taken in exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpond.contracts import source_table
from stockpond.operators.columns import stamp_lineage
from stockpond.session import hadoop_path
from stockpond.sources.sinks import move_days, write_table


def ingest_new_files(
    spark: SparkSession,
    table: str,
    raw_path: str,
    bronze_path: str,
    checkpoint_path: str,
    file_format: str = "csv",
    files_per_batch: int | None = None,
    timeout_seconds: int | None = None,
    match_pattern: bool = False,
) -> int:
    """Append the files not seen by earlier calls to bronze; returns how many rows came in.

    The stream's checkpoint remembers the files; ``publish_epoch`` makes a
    repeated batch harmless. Bronze stays a plain table of day folders, which
    batch runs may append to as well. The call ends when all present files are
    done; ``files_per_batch`` bounds how many go into one batch, and
    ``match_pattern`` takes only files named like the table.
    """
    old_log, fs = hadoop_path(spark, f"{bronze_path.rstrip('/')}/_spark_metadata")
    if fs.exists(old_log):
        raise RuntimeError(f"{old_log} hides rows that were not written by a stream sink; remove it to go on")
    contract = source_table(table)
    reader = spark.readStream.format(file_format).schema(contract.schema)
    if file_format == "csv":
        reader = reader.option("header", True).option("enforceSchema", False).option("escape", '"')
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if match_pattern:
        reader = reader.option("pathGlobFilter", contract.file_pattern)
    arrivals = stamp_lineage(reader.load(raw_path), F.col("_metadata.file_path"))
    taken: list[int] = []

    def publish(batch: DataFrame, epoch: int) -> None:
        taken.append(publish_epoch(batch, epoch, bronze_path, f"{checkpoint_path.rstrip('/')}/epochs"))

    query = (
        arrivals.writeStream.foreachBatch(publish)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    if not query.awaitTermination(timeout_seconds) and timeout_seconds is not None:
        query.stop()
        raise TimeoutError(f"ingesting {table} took longer than {timeout_seconds} s")
    return sum(taken)


def publish_epoch(batch: DataFrame, epoch: int, bronze_path: str, ledger: str) -> int:
    """Add the rows of one epoch to bronze once, however often it is asked for; returns how many were added.

    The rows are first written beside the ledger. Their files then move, one
    rename each, into the day folders of bronze, and the ledger notes the epoch.
    A call that was cut short is taken up where it ended: files that moved are
    not there to be moved again, and what was written completely is not written
    anew. The ledger and bronze have to be on one file system.
    """
    spark = batch.sparkSession
    done, fs = hadoop_path(spark, f"{ledger}/{epoch}")
    if fs.exists(done):
        return 0
    work, complete = (hadoop_path(spark, f"{ledger}/_work-{epoch}{end}")[0] for end in ("", "/_SUCCESS"))
    rows = 0
    if not fs.exists(complete):
        fs.delete(work, True)
        rows = write_table(batch, work.toString(), partition_by=["_ingestion_date"], gather=False).rows
    move_days(spark, work.toString(), bronze_path)
    fs.create(done, True).close()
    fs.delete(work, True)
    return rows
