"""Text cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that decide the results.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
DOMAIN_PATTERN = r"@(.+)$"
TRUE_WORDS = ("true", "1", "yes")


def clean_code(value: Column | str, case: str = "lower") -> Column:
    """Trimmed text in one letter case."""
    trimmed = F.trim(value)
    return F.upper(trimmed) if case == "upper" else F.lower(trimmed)


def email_domain(email: Column) -> Column:
    """Text after the at sign; empty when there is none."""
    return F.regexp_extract(email, DOMAIN_PATTERN, 1)


def is_valid_email(email: Column) -> Column:
    return email.rlike(EMAIL_PATTERN)


def person_name(*parts: Column | str) -> Column:
    """Capitalised parts joined by a blank, leaving out missing ones."""
    return F.concat_ws(" ", *[F.initcap(F.trim(part)) for part in parts])


def parse_flag(value: Column | str) -> Column:
    """Boolean from text; anything that is not a known true word is false."""
    return F.coalesce(F.lower(value).isin(*TRUE_WORDS), F.lit(False))
