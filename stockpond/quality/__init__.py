from stockpond.quality.checks import (
    Fresh,
    InRange,
    InSet,
    NotNull,
    References,
    RowCount,
    Severity,
    Unique,
    not_null,
)
from stockpond.quality.contract import RECORD_RULES, count_violations, with_violations
from stockpond.quality.engine import DataQualityError, enforce, evaluate, gate, report, summarize
from stockpond.quality.keys import check_keys, key_counters
from stockpond.quality.suites import check_customers, check_order_items, check_orders, check_products

__all__ = [
    "DataQualityError", "Fresh", "InRange", "InSet", "NotNull", "RECORD_RULES", "References", "RowCount",
    "Severity", "Unique", "check_customers", "check_keys", "check_order_items", "check_orders", "check_products",
    "count_violations", "enforce", "evaluate", "gate", "key_counters", "not_null", "report", "summarize", "with_violations",
]
