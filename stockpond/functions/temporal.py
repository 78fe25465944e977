"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_timestamp(value: Column | str) -> Column:
    """Timestamp from ISO text; unreadable text gives null."""
    return F.try_to_timestamp(value)


def month_of_key(key: Column | str) -> Column:
    """``yyyy-MM`` of a date key."""
    key = F.col(key) if isinstance(key, str) else key
    return F.concat(F.substring(key.cast("string"), 1, 4), F.lit("-"), F.substring(key.cast("string"), 5, 2))


def date_key(value: Column | str) -> Column:
    """Integer yyyymmdd."""
    return (F.year(value) * 10000 + F.month(value) * 100 + F.dayofmonth(value)).cast("int")


def as_of_date(as_of: str | Column | None) -> Column:
    """The reference day of a run: given, or today."""
    if as_of is None:
        return F.current_date()
    return F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of


def calendar_columns(day: Column | str = "date") -> list[Column]:
    """Attributes of a calendar day, in the order of the date dimension.

    ``day_of_week`` counts from Sunday = 1; ``year_week`` joins the calendar
    year with the ISO week number. Fiscal periods equal calendar periods.
    """
    day = F.col(day) if isinstance(day, str) else day
    year, quarter, month = F.year(day), F.quarter(day), F.month(day)
    dom, dow, week = F.dayofmonth(day), F.dayofweek(day), F.weekofyear(day)
    weekend = dow.isin(1, 7)
    first_of_month, last_of_month = dom == 1, day == F.last_day(day)
    plain = {
        "date_key": date_key(day),
        "day_of_month": dom,
        "day_of_week": dow,
        "day_of_year": F.dayofyear(day),
        "week_of_year": week,
        "month": month,
        "quarter": quarter,
        "year": year,
    }
    names = {
        "day_name": "EEEE",
        "day_name_short": "EEE",
        "month_name": "MMMM",
        "month_name_short": "MMM",
        "year_month": "yyyy-MM",
    }
    labels = {
        "year_quarter": F.format_string("%d-Q%d", year, quarter),
        "year_week": F.format_string("%d-W%02d", year, week),
    }
    flags = {
        "is_weekend": weekend,
        "is_weekday": ~weekend,
        "is_month_start": first_of_month,
        "is_month_end": last_of_month,
        "is_quarter_start": first_of_month & (month % 3 == 1),
        "is_quarter_end": last_of_month & (month % 3 == 0),
        "is_year_start": first_of_month & (month == 1),
        "is_year_end": last_of_month & (month == 12),
    }
    fiscal = {"fiscal_year": year, "fiscal_quarter": quarter}
    named = {name: F.date_format(day, pattern) for name, pattern in names.items()}
    return [expr.alias(name) for name, expr in {**plain, **named, **labels, **flags, **fiscal}.items()]
