from stockpond.sources.catalog import refresh_partitions, register_table
from stockpond.sources.files import is_empty_source, path_exists, read_files, read_layer, read_raw, spread_rows
from stockpond.sources.quarantine import BadRecordsError, FailureBudget, QuarantineReport, ingest_with_quarantine
from stockpond.sources.sinks import WriteReport, write_table
from stockpond.sources.versions import (
    ConcurrentWriteError,
    current_version,
    merge_buckets,
    read_version,
    remove_old_versions,
    replace_buckets,
    replace_table,
)

__all__ = [
    "BadRecordsError", "ConcurrentWriteError", "FailureBudget", "QuarantineReport", "WriteReport", "current_version", "ingest_with_quarantine", "is_empty_source", "merge_buckets", "path_exists", "read_files", "read_layer", "read_raw",
    "read_version", "refresh_partitions", "register_table", "remove_old_versions", "replace_buckets", "replace_table",
    "spread_rows", "write_table",
]
