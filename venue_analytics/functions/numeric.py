"""Numeric column helpers: exact averages, rounding, clipping and safe division.

Sums of integers and decimals are exact in Spark, so averages are built as one exact sum and one
division. That makes a result independent of partitioning and of the order rows arrive in.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: str | Column, den: str | Column) -> Column:
    """Double quotient, null where the denominator is zero (ANSI mode raises on a plain division)."""
    return _col(num).cast("double") / F.nullif(_col(den).cast("double"), F.lit(0.0))


def exact_avg(c: str | Column) -> Column:
    """Mean of an integer or decimal column: exact sum, then one division. Null on no values."""
    c = _col(c)
    return safe_div(F.sum(c), F.count(c))


def half_up(c: str | Column, digits: int = 0) -> Column:
    """Round a double half away from zero, by plain arithmetic (same bits in any IEEE engine)."""
    c = _col(c)
    scale = F.lit(float(10**digits))
    return F.signum(c) * F.floor(F.abs(c) * scale + F.lit(0.5)) / scale + F.lit(0.0)


def half_even(c: str | Column, digits: int = 0) -> Column:
    """Round a double half to even, the convention of the data-frame jobs (the SQL jobs round half up)."""
    scale = F.lit(float(10**digits))
    return F.rint(_col(c).cast("double") * scale) / scale


def avg_r(c: str | Column, digits: int = 0) -> Column:
    """Exact mean rounded half up."""
    return half_up(exact_avg(c), digits)


def sum_r(c: str | Column, digits: int = 0) -> Column:
    """Exact decimal sum rounded half up, as a double."""
    return F.round(F.sum(_col(c)), digits).cast("double")


def sum_d(c: str | Column) -> Column:
    """Exact sum as a double."""
    return F.sum(_col(c)).cast("double")


def clip(c: str | Column, low: float | None = None, high: float | None = None) -> Column:
    """Clip to [low, high] keeping nulls null (``greatest`` and ``least`` alone would skip them)."""
    c = _col(c)
    bounded = c
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    return F.when(c.isNotNull(), bounded)


def int_div(num: Column, den: Column) -> Column:
    """Integer division of non-negative values; null where the denominator is zero."""
    return F.call_function("div", num.cast("bigint"), F.nullif(den.cast("bigint"), F.lit(0).cast("bigint")))


def unit_amount(amount_cents: Column, units: Column) -> Column:
    """Money per unit, rounded half up to cents by integer arithmetic: (2a + n) div 2n."""
    cents = int_div(amount_cents * 2 + units, units * 2)
    return (cents * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(12,2)")
