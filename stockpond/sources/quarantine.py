"""Ingestion that keeps malformed records apart, and refuses a delivery with too many of them."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpond.contracts import source_table
from stockpond.operators.columns import stamp_lineage
from stockpond.session import hadoop_path
from stockpond.sources.files import CORRUPT_COLUMN, path_exists, read_raw
from stockpond.sources.sinks import move_days, write_table

log = logging.getLogger(__name__)

_GOOD, _BAD, _HEADER = "good", "bad", "header"


class BadRecordsError(RuntimeError):
    """A delivery has more malformed records than its budget allows, or a file without the header of its table."""


@dataclass(frozen=True)
class FailureBudget:
    """How many records of a delivery may be malformed: a share of all, and a number (``None``: any)."""

    max_share: float = 0.01
    max_records: int | None = None

    def allows(self, accepted: int, quarantined: int) -> bool:
        if self.max_records is not None and quarantined > self.max_records:
            return False
        return quarantined <= self.max_share * (accepted + quarantined)


@dataclass(frozen=True)
class QuarantineReport:
    """What became of the records of a delivery."""

    accepted: int
    quarantined: int


def sort_records(
    spark: SparkSession,
    table: str,
    raw_path: str,
    file_format: str = "csv",
    multi_line: bool = False,
    match_pattern: bool = False,
) -> DataFrame:
    """All records of the raw files with ``_kind`` (good, bad, header), their text where they are bad, and lineage.

    A record is bad if the reader cannot cut it into the columns of the
    contract. CSV headers are read as records, so that each file's header can be
    checked; a record that equals the header is one wherever it stands.
    ``_block_start`` is the offset of the piece of the file that a record was read in.
    """
    columns = source_table(table).columns
    raw = read_raw(spark, table, raw_path, file_format, multi_line=multi_line, keep_corrupt=True,
                   match_pattern=match_pattern, header=False)
    kind = F.when(F.col(CORRUPT_COLUMN).isNotNull(), _BAD)
    if file_format == "csv":
        titles = [F.col(c).eqNullSafe(F.lit(c)) for c in columns]
        is_header = titles[0]
        for title in titles[1:]:
            is_header = is_header & title
        kind = kind.when(is_header, _HEADER)
    return stamp_lineage(raw, F.col("_metadata.file_path")).withColumns({
        "_block_start": F.col("_metadata.file_block_start"), "_kind": kind.otherwise(_GOOD)})


def ingest_with_quarantine(
    spark: SparkSession,
    table: str,
    raw_path: str,
    bronze_path: str,
    quarantine_path: str,
    run_id: str,
    budget: FailureBudget = FailureBudget(),
    file_format: str = "csv",
    multi_line: bool = False,
    match_pattern: bool = False,
) -> QuarantineReport | None:
    """Add the good records of a delivery to bronze and the bad ones, with text and place, to the quarantine.

    The files are parsed once: all records are written beside the quarantine,
    in a folder of ``run_id``, and counted there. If the budget holds, the good rows
    are copied to files with the columns of bronze, and the files of both move into
    the day folders of their tables by renames. Otherwise both tables stay as they
    are, the folder is left for a look, and ``BadRecordsError`` is raised. A
    run that was cut short is taken up by a call with the same ``run_id``, and
    a finished one does nothing and reports what it did; a refused one goes
    through with a larger budget. A run that is to read mended files needs a new ``run_id``.
    A missing source gives ``None``. Bronze and quarantine have to be on one file system.
    """
    runs = f"{quarantine_path.rstrip('/')}/_runs"
    done, fs = hadoop_path(spark, f"{runs}/{run_id}.done")
    if fs.exists(done):
        return _noted(fs, done)
    work = f"{runs}/{run_id}"
    if not fs.exists(hadoop_path(spark, f"{work}/_SUCCESS")[0]):
        if not path_exists(spark, raw_path):
            log.warning("%s: no raw files at %s, skipped", table, raw_path)
            return None
        records = sort_records(spark, table, raw_path, file_format, multi_line, match_pattern)
        write_table(records, work, partition_by=["_kind", "_ingestion_date"], gather=False)
    allowed, _ = hadoop_path(spark, f"{work}/_allowed")
    if fs.exists(allowed):
        report = _noted(fs, allowed)
    else:
        report = _counted(spark, table, work, file_format)
        if not budget.allows(report.accepted, report.quarantined):
            raise BadRecordsError(
                f"{table}: {report.quarantined} of {report.accepted + report.quarantined} records are malformed, see {work}")
        _note(fs, allowed, report)
    good, bad = f"{work}-good", f"{work}/_kind={_BAD}"
    if report.accepted:
        # Bronze has none of the columns that only bad records need.
        if not fs.exists(hadoop_path(spark, f"{good}/_SUCCESS")[0]):
            rows = _written(spark, table, work).where(F.col("_kind") == _GOOD)
            write_table(rows.drop(CORRUPT_COLUMN, "_block_start", "_kind"), good, partition_by=["_ingestion_date"], gather=False)
        move_days(spark, good, bronze_path)
    if fs.exists(hadoop_path(spark, bad)[0]):
        move_days(spark, bad, quarantine_path)
    _note(fs, done, report)
    for folder in (work, good):
        fs.delete(hadoop_path(spark, folder)[0], True)
    log.info("%s: %d records to bronze, %d to quarantine", table, report.accepted, report.quarantined)
    return report


def _written(spark: SparkSession, table: str, work: str) -> DataFrame:
    """The records of a written run, whatever kinds there are."""
    columns = ", ".join(f"{c} string" for c in (*source_table(table).columns, CORRUPT_COLUMN))
    return spark.read.schema(
        f"{columns}, _ingested_at timestamp, _source_file string, _block_start bigint, _kind string, _ingestion_date date"
    ).parquet(work)


def _counted(spark: SparkSession, table: str, work: str, file_format: str) -> QuarantineReport:
    """Counts of a written run; a CSV file with records but without its header is an error."""
    files = _written(spark, table, work).groupBy("_source_file").agg(
        *(F.count_if(F.col("_kind") == k).alias(k) for k in (_GOOD, _BAD, _HEADER)))
    totals = files.agg(
        F.sum(_GOOD).alias(_GOOD), F.sum(_BAD).alias(_BAD),
        F.min(F.when(F.col(_HEADER) == 0, F.col("_source_file"))).alias("untitled")).first()
    if file_format == "csv" and totals["untitled"]:
        raise BadRecordsError(f"{table}: {totals['untitled']} has no header with the columns of the table")
    return QuarantineReport(totals[_GOOD] or 0, totals[_BAD] or 0)


def _note(fs, path, report: QuarantineReport) -> None:
    out = fs.create(path, True)
    try:
        out.writeBytes(f"{report.accepted} {report.quarantined}")
    finally:
        out.close()


def _noted(fs, path) -> QuarantineReport:
    stream = fs.open(path)
    try:
        text = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    return QuarantineReport(*map(int, text.split()))
