"""Exact mean and sample standard deviation from mergeable integer sums.

Amounts carry two decimals, so they are summed as whole cents: count, sum and
sum of squares are integers, exact in any order and safe to add, subtract and
merge. A small spread around a large mean keeps its true value, and equal
amounts give a standard deviation of exactly 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CENTS = 100
WIDE = "decimal(38,0)"
LONG = "decimal(19,0)"


def cents(x: Column) -> Column:
    return F.round(x * CENTS).cast("bigint")


def squared(c: Column) -> Column:
    """Square of a bigint, wide enough to be summed."""
    return c.cast(LONG) * c.cast(LONG)


def mean_of(n: Column, s: Column) -> Column:
    return F.when(n > 0, s / n / CENTS)


def std_of(n: Column, s: Column, ss: Column) -> Column:
    """Sample standard deviation; NULL below two values."""
    spread = n.cast(LONG) * ss - s.cast(LONG) * s.cast(LONG)
    return F.when(n >= 2, F.sqrt(spread.cast("double") / (n.cast("double") * (n - 1))) / CENTS)
