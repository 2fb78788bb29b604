"""Scalar helpers that never raise and never return NaN or infinity (missing is NULL)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(x) -> Column:
    """A column from a name, a literal from a number, anything else as it is."""
    if isinstance(x, str):
        return F.col(x)
    if isinstance(x, (int, float)):
        return F.lit(float(x))
    return x


def finite(x: Column) -> Column:
    # Spark sorts NaN above infinity, so one comparison drops NaN and both infinities
    return F.when(F.abs(x) < F.lit(float("inf")), x)


def div(a, b) -> Column:
    return F.try_divide(col(a), col(b))


def power(x, e) -> Column:
    return finite(F.pow(col(x), col(e)))


def ln(x) -> Column:
    return F.ln(col(x))


def log10(x) -> Column:
    return F.log10(col(x))


#: Values are alike if they agree to about this share of their size, which is far above the noise of sums.
ALIKE = 2.0 ** -39


def significant(x, bits: int = 39) -> Column:
    """Round to so many significant bits, whatever the size: noise in the order of sums makes no two values of one."""
    x, k = col(x), F.lit(2.0 ** (53 - bits) + 1)
    # the leading bits by a product that pushes the others out; huge values have no room for it and stay
    return F.when(F.abs(x) < 1e290, x * k - (x * k - x)).otherwise(x)


def sign(x) -> Column:
    return F.signum(col(x))


def _apart(a, b) -> Column:
    return F.greatest(F.abs(a), F.abs(b)) * ALIKE


def less(a, b) -> Column:
    """a < b by more than noise, measured by the larger of the two."""
    a, b = col(a), col(b)
    return b - a > _apart(a, b)


def not_more(a, b) -> Column:
    a, b = col(a), col(b)
    return a - b <= _apart(a, b)


def minus(a, b) -> Column:
    """a - b, with 0 where only noise is left of two values alike."""
    a, b = col(a), col(b)
    return F.when(F.abs(a - b) <= _apart(a, b), 0.0).otherwise(a - b)


def larger(a, b) -> Column:
    """Elementwise maximum; NULL if either side is missing."""
    a, b = col(a), col(b)
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))


def smaller(a, b) -> Column:
    """Elementwise minimum; NULL if either side is missing."""
    a, b = col(a), col(b)
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))


def pick(cond: Column, then, otherwise) -> Column:
    return F.when(cond, col(then)).otherwise(col(otherwise))


def nonzero(x, instead: float) -> Column:
    """x, with an exact zero replaced by a small constant."""
    x = col(x)
    return F.when(x == 0, F.lit(instead)).otherwise(x)


def flag(cond: Column) -> Column:
    """A condition as 1.0 / 0.0, NULL when it cannot be decided."""
    return cond.cast("double")
