"""Declarations of data-quality checks.

A check says which aggregate it needs; the engine computes the aggregates of
all checks of a table together. ``limit`` is the tolerated percentage of
failing rows (0 = none).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from enum import Enum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Severity(Enum):
    """How a failure is treated: errors stop a run, warnings on request, infos never."""

    WARNING = "warning"
    ERROR = "error"
    INFO = "info"


@dataclass(frozen=True)
class NotNull:
    """No null in ``column``."""

    column: str
    severity: Severity = Severity.ERROR
    limit: float = 0.0

    @property
    def name(self) -> str:
        return f"not_null_{self.column}"

    @property
    def needs(self) -> tuple[str, ...]:
        return (self.column,)

    @property
    def message(self) -> str:
        return f"{self.column} must not be null"

    def failures(self, total: Column) -> Column:
        return F.count_if(F.col(self.column).isNull())


def not_null(*columns: str, severity: Severity = Severity.ERROR, limit: float = 0.0) -> list[NotNull]:
    """One not-null check per column."""
    return [NotNull(column, severity, limit) for column in columns]


@dataclass(frozen=True)
class Unique:
    """``columns`` together identify a row; null counts as a value."""

    columns: Sequence[str]
    severity: Severity = Severity.ERROR
    limit: float = 0.0

    @property
    def name(self) -> str:
        return f"unique_{'+'.join(self.columns)}"

    @property
    def needs(self) -> tuple[str, ...]:
        return tuple(self.columns)

    @property
    def message(self) -> str:
        return f"{', '.join(self.columns)} must be unique"

    def failures(self, total: Column) -> Column:
        return total - F.count_distinct(F.struct(*self.columns))


@dataclass(frozen=True)
class InSet:
    """``column`` holds one of ``values``; null passes."""

    column: str
    values: Sequence
    severity: Severity = Severity.ERROR
    limit: float = 0.0

    @property
    def name(self) -> str:
        return f"valid_values_{self.column}"

    @property
    def needs(self) -> tuple[str, ...]:
        return (self.column,)

    @property
    def message(self) -> str:
        return f"{self.column} must be one of {', '.join(map(str, self.values))}"

    def failures(self, total: Column) -> Column:
        return F.count_if(~F.col(self.column).isin(*self.values))


@dataclass(frozen=True)
class InRange:
    """``column`` lies between the given inclusive bounds; null passes, no bound passes all."""

    column: str
    low: float | None = None
    high: float | None = None
    severity: Severity = Severity.ERROR
    limit: float = 0.0

    @property
    def name(self) -> str:
        return f"range_{self.column}"

    @property
    def needs(self) -> tuple[str, ...]:
        return (self.column,)

    @property
    def message(self) -> str:
        low = "any" if self.low is None else self.low
        high = "any" if self.high is None else self.high
        return f"{self.column} must be between {low} and {high}"

    def failures(self, total: Column) -> Column:
        outside = F.lit(False)
        if self.low is not None:
            outside = outside | (F.col(self.column) < self.low)
        if self.high is not None:
            outside = outside | (F.col(self.column) > self.high)
        return F.count_if(outside)


@dataclass(frozen=True)
class RowCount:
    """The table has at least ``low`` and, if given, at most ``high`` rows."""

    low: int = 1
    high: int | None = None
    severity: Severity = Severity.ERROR
    name: str = "row_count"
    needs: tuple[str, ...] = ()

    @property
    def message(self) -> str:
        bound = f"at least {self.low}" if self.high is None else f"between {self.low} and {self.high}"
        return f"row count must be {bound}"

    def failures(self, total: Column) -> Column:
        within = total >= self.low
        if self.high is not None:
            within = within & (total <= self.high)
        return F.when(within, 0).otherwise(1)


@dataclass(frozen=True)
class Fresh:
    """The newest value of ``column`` is at most ``max_age_hours`` old; no value fails."""

    column: str
    max_age_hours: float = 24
    severity: Severity = Severity.WARNING

    @property
    def name(self) -> str:
        return f"freshness_{self.column}"

    @property
    def needs(self) -> tuple[str, ...]:
        return (self.column,)

    @property
    def message(self) -> str:
        return f"newest {self.column} must be at most {self.max_age_hours} hours old"

    def age_hours(self, as_of: Column) -> Column:
        newest = F.max(F.col(self.column).cast("timestamp"))
        return (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(newest)) / F.lit(3_600_000_000)


@dataclass(frozen=True)
class References:
    """Every value of ``column`` occurs in ``reference``.

    Counts distinct values without a match, with null as one of them.
    """

    column: str
    reference: DataFrame
    reference_column: str
    severity: Severity = Severity.ERROR
    limit: float = 0.0

    @property
    def name(self) -> str:
        return f"ref_integrity_{self.column}"

    @property
    def needs(self) -> tuple[str, ...]:
        return (self.column,)

    @property
    def message(self) -> str:
        return f"{self.column} must exist in the referenced table"
