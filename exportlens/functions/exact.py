"""Exact decimal arithmetic.

KPIs are money, so every rounded number is the correctly rounded value of the exact quotient:
results do not depend on row order, partitioning or task retries, which a sum of doubles does.

Spark's decimal division keeps as few as six fraction digits once the operands are wide (sums
are), and rounding such a quotient again can move a value by one unit. Two helpers avoid that:

* ``round_mean`` divides by a count. It states operand widths that leave 17 or 18 fraction digits;
  a quotient by a count below 10^12 that is not a tie at four digits is further than that from one.
* ``round_ratio`` divides by any exact number. ``div`` gives twice the scaled quotient cut to an
  integer, and halving that decides the last digit, so no quotient is ever rounded twice.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

Number = Column | str


def _c(x: Number) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dec(x: Number, precision: int, scale: int) -> Column:
    """Cast to DECIMAL(precision, scale)."""
    return _c(x).cast(DecimalType(precision, scale))


def round_half_up(x: Number, digits: int) -> Column:
    """SQL NUMERIC rounding: ties away from zero. Feed it decimals, not doubles."""
    return F.round(_c(x), digits)


def round_half_even(x: Number, digits: int) -> Column:
    """Array-library rounding: ties to the even neighbour."""
    return F.bround(_c(x), digits)


def safe_div(a: Number, b: Number) -> Column:
    """``a / b``, NULL where ``b`` is zero (ANSI mode raises otherwise)."""
    return _c(a) / F.nullif(_c(b), F.lit(0))


def round_ratio(num: Number, den: Number, digits: int, *, scale: int = 2, even: bool = False) -> Column:
    """``num / den`` rounded once, at ``digits`` fraction digits; NULL for a zero denominator.

    ``scale`` is the number of fraction digits ``num`` carries. Ties go away from zero, or to the
    even neighbour with ``even=True``.
    """
    num, den = _c(num), F.nullif(_c(den), F.lit(0))
    doubled = num.cast(DecimalType(36 - digits, scale)) * F.lit(Decimal(2 * 10**digits))
    twice = F.call_function("div", doubled, den)
    # ``div`` cuts towards zero, so one step outwards before halving rounds half away from zero.
    step = F.signum(twice).cast("bigint")
    units = F.call_function("div", twice + step, F.lit(2))
    if even:
        tie = (twice % 2 != 0) & (units % 2 != 0) & (doubled % den == 0)
        units = F.when(tie, units - step).otherwise(units)
    exact = units.cast(DecimalType(19, 0))
    return exact * F.lit(Decimal(1).scaleb(-digits)) if digits else exact


def round_mean(total: Number, count: Number, digits: int, *, scale: int = 2, even: bool = False) -> Column:
    """``total / count`` rounded once; ``count`` is a whole number, 0 gives NULL.

    ``scale`` is the number of fraction digits ``total`` carries.
    """
    quotient = _c(total).cast(DecimalType(20 + scale, scale)) / F.nullif(_c(count), F.lit(0)).cast(
        DecimalType(16, 0)
    )
    return F.bround(quotient, digits) if even else F.round(quotient, digits)


def mean(x: Number, digits: int, *, scale: int = 2, even: bool = False) -> Column:
    """Aggregate: AVG(x) rounded exactly. NULLs are skipped, as in SQL."""
    return round_mean(F.sum(_c(x)), F.count(_c(x)), digits, scale=scale, even=even)


def as_double(x: Number) -> Column:
    return _c(x).cast("double")


def mean_double(x: Number) -> Column:
    """Aggregate: unrounded mean as a double, from an exact decimal sum (one division only)."""
    return as_double(F.sum(_c(x))) / as_double(F.nullif(F.count(_c(x)), F.lit(0)))


def money_sum(x: Number, digits: int = 2) -> Column:
    """Aggregate: SUM(x) as a decimal with ``digits`` fraction digits."""
    return F.sum(_c(x)).cast(DecimalType(26, digits))


def ratio_of_sums(a: Number, b: Number, digits: int, *, scale: int = 2) -> Column:
    """Aggregate: SUM(a) / SUM(b), rounded exactly."""
    return round_ratio(F.sum(_c(a)), F.sum(_c(b)), digits, scale=scale)


def avg_ratio(a: Number, b: Number, digits: int, *, scale: int) -> Column:
    """Aggregate: mean of the row ratios a/b (not the ratio of the sums).

    ``scale`` is the scale Spark gives the row quotient, see ``operators.aggregates.unit_ratio``.
    """
    return mean(safe_div(a, b), digits, scale=scale)


def pct(part: Number, whole: Number, digits: int = 2, *, scale: int = 2) -> Column:
    """``part / whole * 100`` of two amounts, rounded exactly. ``scale`` is that of ``part``."""
    hundredfold = _c(part).cast(DecimalType(30, scale)) * F.lit(Decimal(100))
    return round_ratio(hundredfold, whole, digits, scale=scale)


def rate_pct(part: Number, whole: Number, digits: int = 2) -> Column:
    """``part / whole * 100`` of two counts, rounded exactly."""
    return round_mean(_c(part).cast(DecimalType(18, 0)) * F.lit(100), whole, digits, scale=0)


def count_when(pred: Column) -> Column:
    """Aggregate: rows where ``pred`` holds (NULL counts as false)."""
    return F.count_if(pred)


def sum_when(pred: Column, x: Number) -> Column:
    """Aggregate: SUM(CASE WHEN pred THEN x ELSE 0 END)."""
    return F.sum(F.when(pred, _c(x)).otherwise(F.lit(0)))


def avg_when(pred: Column, x: Number, digits: int, *, scale: int = 0) -> Column:
    """Aggregate: mean of x over the rows where ``pred`` holds; NULL when none does."""
    return mean(F.when(pred, _c(x)), digits, scale=scale)


def clamp(x: Number, lo, hi) -> Column:
    """Limit ``x`` to [lo, hi]; a NULL stays NULL."""
    lo = lo if isinstance(lo, Column) else F.lit(lo)
    hi = hi if isinstance(hi, Column) else F.lit(hi)
    x = _c(x)
    return F.when(x.isNotNull(), F.least(F.greatest(x, lo), hi))


# Reporting units.
UNITS = {"crore": 10_000_000, "million": 1_000_000, "billion": 1_000_000_000}


def scale_units(x: Number, unit: str, digits: int = 2, *, scale: int = 2) -> Column:
    """Express an amount in crore, million or billion, rounded exactly."""
    return round_ratio(x, F.lit(Decimal(UNITS[unit])), digits, scale=scale)
