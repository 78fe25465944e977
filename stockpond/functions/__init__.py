from stockpond.functions.bands import (
    customer_segment,
    customer_status,
    price_tier,
    stock_status,
    value_tier,
)
from stockpond.functions.money import (
    add_amounts,
    differ_by,
    from_micros,
    mean_exact,
    micros,
    money,
    percent_of,
    sum_cents,
    sum_exact,
    within_cent,
)
from stockpond.functions.temporal import calendar_columns, date_key, parse_timestamp
from stockpond.functions.text import clean_code, email_domain, is_valid_email, parse_flag, person_name

__all__ = [
    "add_amounts", "calendar_columns", "clean_code", "customer_segment", "customer_status", "date_key",
    "differ_by", "email_domain", "from_micros", "is_valid_email", "mean_exact", "micros", "money", "parse_flag",
    "parse_timestamp", "percent_of", "person_name", "price_tier", "stock_status",
    "sum_cents", "sum_exact", "value_tier", "within_cent",
]
