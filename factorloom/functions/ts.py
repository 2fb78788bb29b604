"""Per-ticker primitives over the rows of a bar panel, in trade-date order.

The panel key (ticker, trade_date) is unique, so a window group never holds more rows than there are trade dates.
Rolling results are NULL until ``min_periods`` non-missing values (default: the whole window) are there.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from .scalar import ALIKE, col, div, finite, larger, smaller, significant

KEY, TIME = "ticker", "trade_date"


def history():
    return Window.partitionBy(KEY).orderBy(TIME)


def last(n: int):
    return history().rowsBetween(1 - n, 0)


def running():
    return history().rowsBetween(Window.unboundedPreceding, 0)


def _full(x: Column, n: int, value: Column, min_periods: int | None) -> Column:
    need = n if min_periods is None else min_periods
    return F.when(F.count(x).over(last(n)) >= need, value)


def total(x, n, min_periods=None):
    x = col(x)
    return _full(x, n, F.sum(x).over(last(n)), min_periods)


def mean(x, n, min_periods=None):
    x = col(x)
    return _full(x, n, F.avg(x).over(last(n)), min_periods)


def std(x, n, min_periods=None):
    x = col(x)
    return _full(x, n, F.stddev_samp(x).over(last(n)), min_periods)


def low(x, n, min_periods=None):
    x = col(x)
    return _full(x, n, F.min(x).over(last(n)), min_periods)


def high(x, n, min_periods=None):
    x = col(x)
    return _full(x, n, F.max(x).over(last(n)), min_periods)


def prod(x, n, min_periods=None):
    x = col(x)
    return _full(x, n, F.product(x).over(last(n)), min_periods)


def delay(x, n):
    return F.lag(col(x), n).over(history())


def ahead(x, n):
    """The value n rows later: look-ahead, never to be used in a tradable signal."""
    return F.lead(col(x), n).over(history())


def delta(x, n):
    return col(x) - delay(x, n)


def change(x, n):
    return div(x, delay(x, n)) - 1


def _both(x, y):
    x, y = col(x), col(y)
    return F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)


def cov(x, y, n):
    x, y = _both(x, y)
    return _full(x, n, F.covar_samp(x, y).over(last(n)), None)


def corr(x, y, n):
    """Rolling Pearson correlation; NULL when either side is constant up to rounding noise, 0 when only noise is left."""
    x, y = _both(x, y)
    w = last(n)
    sx, sy = F.stddev_samp(x).over(w), F.stddev_samp(y).over(w)
    mx, my = F.abs(F.avg(x).over(w)), F.abs(F.avg(y).over(w))
    varies = (sx > 1e-9 * mx) & (sy > 1e-9 * my)
    # what rounding takes from a linear relation grows with the means beside the deviations
    slack = (div(mx, sx) + div(my, sy) + 1) * 2.0 ** -48
    r = div(F.covar_samp(x, y).over(w), sx * sy)
    # a covariance that small beside both deviations is what rounding leaves of a sum of zero
    r = F.when(F.abs(r) <= ALIKE, 0.0).when(1 - F.abs(r) <= slack, F.signum(r)).otherwise(r)
    return _full(x, n, F.when(varies, r), None)


def _fold(x, n, start, step):
    """Fold the non-missing values of the last n rows; NULL unless all n are there."""
    x = col(x)
    return _full(x, n, F.aggregate(F.collect_list(x).over(last(n)), start, step), None)


def rank(x, n):
    """Average-tie rank (1..n) of the newest value within the last n rows."""
    x = significant(x)
    below = _fold(x, n, F.lit(0.5),
                  lambda acc, v: acc + F.when(v < x, 1.0).when(v == x, 0.5).otherwise(0.0))
    return below


def rank_pct(x, n):
    return rank(x, n) / n


def rank_of_top(x, n):
    """rank / highest average-tie rank in the window, which is below n when the maximum is tied."""
    x = significant(x)
    top = F.max(x).over(last(n))
    tied = _fold(x, n, F.lit(0.0), lambda acc, v: acc + F.when(v == top, 1.0).otherwise(0.0))
    return rank(x, n) / (n - (tied - 1) / 2)


def _position(x, n, best):
    x = significant(x)
    place = F.array_position(F.collect_list(x).over(last(n)), best(x).over(last(n)))
    return _full(x, n, place.cast("double"), None)


def argmax(x, n):
    """1-based position of the first maximum in the window."""
    return _position(x, n, F.max)


def argmin(x, n):
    return _position(x, n, F.min)


def highday(x, n):
    return n + 1 - argmax(x, n)


def lowday(x, n):
    return n + 1 - argmin(x, n)


def weighted(x, weights: list[float]):
    """Sum of weight * value over the window, oldest first."""
    x, n = col(x), len(weights)
    terms = F.zip_with(F.collect_list(x).over(last(n)), F.array(*[F.lit(float(w)) for w in weights]),
                       lambda v, w: v * w)
    return _full(x, n, F.aggregate(terms, F.lit(0.0), lambda acc, v: acc + v), None)


def decay(x, n):
    """Linearly weighted mean, newest value heaviest."""
    return weighted(x, [2 * i / (n * (n + 1)) for i in range(1, n + 1)])


def slope(x, n):
    """Regression slope of the window's values on 1..n."""
    mid, spread = (n + 1) / 2, n * (n * n - 1) / 12
    return weighted(x, [(i - mid) / spread for i in range(1, n + 1)])


def slope_of_index(x, n, critical_t=None):
    """Slope of 1..n regressed on the window's values, dropped below the critical \\|t\\| if one is given."""
    x = col(x)
    covar = slope(x, n) * (n * n - 1) / 12
    var = F.var_pop(x).over(last(n))
    result = F.when(var > 0, div(covar, var))
    if critical_t is None:
        return result
    r2 = div(covar * covar, var * (n * n - 1) / 12)
    return F.when(r2 >= critical_t ** 2 / (critical_t ** 2 + n - 2), result)


@dataclass(frozen=True)
class Carried:
    """A window column whose last value holds until there is a new one. Spark allows no window inside a window, so
    whoever adds the column carries it forward in a second one over the same sorted rows."""

    x: Column


def carry(name: str) -> Column:
    return F.last(name, ignorenulls=True).over(running())


def _ewm(x, alpha, adjust):
    # At a row with a value, the fold looks back so far that what lies before has less than 1e-15 of that row's weight.
    # In a gap, however long, the mean stays what it was.
    rows = 1 if alpha >= 1 else math.ceil(34.6 / -math.log(1 - alpha)) + 1
    x = col(x)
    new = 1.0 if adjust else alpha

    def step(acc, item):
        old, v = acc["weight"] * (1 - alpha), item["x"]
        seen = F.struct((((acc["mean"] * old) + v * new) / (old + new)).alias("mean"),
                        (old + new if adjust else F.lit(1.0)).alias("weight"))
        seed = F.struct(v.alias("mean"), F.lit(1.0).alias("weight"))
        aged = F.struct(acc["mean"].alias("mean"), old.alias("weight"))
        return F.when(v.isNull(), aged).when(acc["mean"].isNull(), seed).otherwise(seen)

    start = F.struct(F.lit(None).cast("double").alias("mean"), F.lit(1.0).alias("weight"))
    items = F.collect_list(F.struct(x.cast("double").alias("x"))).over(last(rows))
    return Carried(F.when(x.isNotNull(), F.aggregate(items, start, step, lambda acc: acc["mean"])))


def ewm(x, alpha=None, span=None) -> Carried:
    """Exponential mean with adjusted weights; a gap still ages the older weights."""
    return _ewm(x, alpha or 2 / (span + 1), True)


def ewm_recursive(x, alpha=None, span=None) -> Carried:
    """Exponential mean seeded with the first value."""
    return _ewm(x, alpha or 2 / (span + 1), False)


def count_if(cond, n):
    return total(F.when(cond, 1.0).otherwise(0.0), n)


def sum_if(cond, x, n):
    return total(F.when(cond, col(x)).otherwise(0.0), n)


def cumprod(x):
    return F.product(col(x)).over(running())


def cumsum(x):
    return F.sum(col(x)).over(running())


def cummax(x):
    return F.max(col(x)).over(running())


def true_range(h, l, c):
    prev = delay(c, 1)
    return larger(larger(col(h) - col(l), F.abs(col(h) - prev)), F.abs(col(l) - prev))


__all__ = [n for n in dir() if not n.startswith("_")]
