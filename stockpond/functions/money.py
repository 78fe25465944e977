"""Money arithmetic.

Amounts are stored as doubles, but every rounding and comparison goes through
whole parts of a unit and every sum through whole cents or decimals, so results
depend neither on binary noise (0.335 * 3) nor on the order in which
partitions are added up. Whole numbers stay in generated code, where a
decimal per value would allocate objects.

An amount is rounded once: what is within the noise of a few operations of half
a cent counts as half a cent, and no other digit moves it to another cent. From
a billion on a double leaves little room for noise, and decimals do the
rounding. Sums are kept in two whole limbs. No amount below 9e27 is lost; NaN,
infinities and what is larger count as no number.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

PER_UNIT = 1_000_000  # millionths in one currency unit
PER_CENT = 10_000  # millionths in one cent
_BILLION, _WHOLE_BELOW, _LIMBS_BELOW = 1e9, 9e12, 9e27
_AWAY = 1 + 4e-15  # eighteen times the relative step of a double


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def micros(value: Column | str) -> Column:
    """The amount in whole millionths; null if it is no number or beyond nine trillion."""
    return F.rint(_col(value) * PER_UNIT).try_cast("bigint")


def from_micros(value: Column) -> Column:
    return value / F.lit(float(PER_UNIT))


def money(value: Column | str) -> Column:
    """The amount rounded to cents, half a cent away from zero."""
    value = _col(value)
    # One rounding to an even cent; the factor takes halves, and what noise made of halves, away from zero first.
    near = (F.rint(value * F.lit(100 * _AWAY)) + F.lit(0.0)) / F.lit(100.0)  # + 0.0: no negative zero
    return F.when(F.abs(value) < _BILLION, near).when(F.abs(value) < _LIMBS_BELOW, F.round(value, 2))


def add_amounts(plus: Sequence[Column | str], minus: Sequence[Column | str] = ()) -> Column:
    """The exact sum of amounts with up to six places; null if one of them is null."""
    plus, minus = [_col(c) for c in plus], [_col(c) for c in minus]

    def total(of: Callable[[Column], Column]) -> Column:
        return reduce(Column.__sub__, map(of, minus), reduce(Column.__add__, map(of, plus)))

    whole = reduce(Column.__and__, [F.abs(c) < _WHOLE_BELOW / (len(plus) + len(minus)) for c in (*plus, *minus)])
    wide = total(lambda c: c.try_cast("decimal(37,5)")).cast("double")
    return F.when(whole, from_micros(total(micros))).otherwise(wide)


def percent_of(part: Column | str, whole: Column | str) -> Column:
    """``part / whole * 100`` to two places; 0.0 unless ``whole`` is positive."""
    part, whole = _col(part), _col(whole)
    return F.when(whole > 0, money(F.try_divide(part, whole) * 100)).otherwise(F.lit(0.0))


def differ_by(left: Column, right: Column) -> Column:
    """Distance of two amounts in millionths."""
    whole = (F.abs(left) < _WHOLE_BELOW) & (F.abs(right) < _WHOLE_BELOW)
    wide = F.abs(left.try_cast("decimal(37,5)") - right.try_cast("decimal(37,5)")).cast("double") * PER_UNIT
    return F.when(whole, F.abs(micros(left) - micros(right))).otherwise(wide)


def within_cent(left: Column | str, right: Column | str) -> Column:
    """True when two amounts differ by less than one cent; null if either is null."""
    return differ_by(_col(left), _col(right)) < PER_CENT


def _sum(value: Column, low: Callable[[Column], Column], per_unit: int) -> Column:
    """The sum of amounts in two limbs: whole billions, and the rest in small whole parts."""
    size, rest = F.abs(value), value % _BILLION
    large = (size >= _BILLION) & (size < _LIMBS_BELOW)
    billions = F.sum(F.when(large, ((value - rest) / F.lit(_BILLION)).cast("bigint")))
    parts = F.sum(F.when(size < _BILLION, low(value)).when(large, low(rest)))
    both = billions.cast("decimal(27,0)") * F.lit(10**9) + parts.cast("decimal(38,0)") / F.lit(per_unit)
    return F.when(billions.isNull(), parts.cast("double") / F.lit(float(per_unit))).otherwise(both.cast("double"))


def sum_exact(value: Column | str) -> Column:
    """Order-independent sum of amounts with up to six places."""
    return _sum(_col(value), lambda rest: micros(rest).cast("decimal(19,0)"), PER_UNIT)


def mean_exact(value: Column | str) -> Column:
    """Order-independent mean; null when there is no value."""
    return F.try_divide(sum_exact(value), F.count(_col(value)))


def sum_cents(value: Column | str) -> Column:
    """Order-independent sum of amounts already rounded to cents.

    Adds whole cents as bigint, which is cheaper than a decimal buffer. Use it
    only on columns made by ``money``.
    """
    return _sum(_col(value), lambda rest: F.rint(rest * 100).cast("bigint"), 100)
