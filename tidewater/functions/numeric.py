"""Exact money arithmetic and rounding.

Money arrives as double.  Sums are taken over whole ten-thousandths (64-bit,
exact, and much cheaper to aggregate and shuffle than a wide decimal), so the
result does not depend on the order in which partitions are added up;
``units / 10000.0`` is the correctly rounded double of the exact sum.  Amounts
with up to four decimals are exact; a finer one counts as its nearest
ten-thousandth.  A sum beyond 9.2e14 raises (ANSI mode) instead of wrapping.
Rounding is half away from zero, like the source's ``round(x::numeric, n)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scale used when a double is turned into a decimal before rounding.
ROUND_SCALE = "decimal(38,10)"


def round_half_up(x: Column, digits: int) -> Column:
    """round(x::numeric, digits) as double: half away from zero, via decimal."""
    return F.round(x.cast(ROUND_SCALE), digits).cast("double")


def round2_double(x: Column) -> Column:
    return round_half_up(x, 2)


def round_half_even_float(x: Column, digits: int) -> Column:
    """Float rounding as done by pandas ``Series.round``: rint(x * 10^d) / 10^d."""
    scale = float(10**digits)
    return F.rint(x * F.lit(scale)) / F.lit(scale)


PER_ONE = 10_000


def units(x: Column) -> Column:
    """A money double as whole ten-thousandths, halves away from zero."""
    near = F.floor(F.abs(x) * F.lit(float(PER_ONE)) + F.lit(0.5)).cast("long")
    return F.when(x < 0, -near).otherwise(near)


def from_units(c: Column) -> Column:
    return c / F.lit(float(PER_ONE))


def units_sum(x: Column) -> Column:
    """Exact sum of a money column, as a long count of ten-thousandths."""
    return F.sum(units(x))


def money_sum(x: Column) -> Column:
    """Exact sum of a money column, as double."""
    return from_units(units_sum(x))


def money_avg(x: Column) -> Column:
    """Average of a money column: exact sum / count of non-null values, as double."""
    return money_sum(x) / F.count(x).cast("double")
