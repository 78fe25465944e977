from stockpond.operators.columns import cast_columns, stamp_lineage, trim_columns
from stockpond.operators.dedup import earliest_per_key, latest_per_key
from stockpond.operators.filters import drop_incomplete
from stockpond.operators.history import merge_history
from stockpond.operators.joins import hot_keys, missing_keys, salted_join, skew_join
from stockpond.operators.numbering import number_rows, number_rows_sparse
from stockpond.operators.ranking import rank_within, top_per_group
from stockpond.operators.validity import valid_version

__all__ = [
    "cast_columns", "drop_incomplete", "earliest_per_key", "latest_per_key", "merge_history",
    "hot_keys", "missing_keys", "number_rows", "number_rows_sparse", "rank_within", "salted_join", "skew_join",
    "stamp_lineage", "top_per_group", "trim_columns", "valid_version",
]
