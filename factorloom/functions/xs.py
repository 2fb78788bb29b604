"""Cross-section primitives: one value per (ticker, trade_date), compared within a trade date.

A day's group holds at most one row per ticker, because the panel key (ticker, trade_date) is unique.
``by`` names more partition columns, e.g. a subset flag.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from .scalar import col, div, significant

TIME = "trade_date"


def day(*by):
    return Window.partitionBy(TIME, *by)


def _ordered(x: Column, ascending: bool, by):
    order = x.asc_nulls_last() if ascending else x.desc_nulls_last()
    return day(*by).orderBy(order)


def rank(x, ascending=True, by=()):
    """Average-tie rank. All three parts share one window, so a day is sorted once per operand."""
    x = significant(x)
    w = _ordered(x, ascending, by)
    up_to = F.count(x).over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return F.when(x.isNotNull(), (F.rank().over(w) + up_to) / 2)


def rank_max(x, ascending=True, by=()):
    """Rank where ties share the highest place."""
    x = significant(x)
    w = _ordered(x, ascending, by).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return F.when(x.isNotNull(), F.count(x).over(w).cast("double"))


def _share(x, place, ascending, by):
    w = _ordered(significant(x), ascending, by)
    n = F.count(significant(x)).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return place / n


def rank_pct(x, ascending=True, by=()):
    return _share(x, rank(x, ascending, by), ascending, by)


def rank_max_pct(x, ascending=True, by=()):
    return _share(x, rank_max(x, ascending, by), ascending, by)


def scale(x, k=1.0):
    x = col(x)
    return div(x * k, F.sum(F.abs(x)).over(day()))


def _complete(x, also=None):
    """True on days without any missing value."""
    ok = col(x).isNotNull() if also is None else col(x).isNotNull() & col(also).isNotNull()
    return F.count(F.when(ok, 1)).over(day()) == F.count(F.lit(1)).over(day())


def winsorize(df, x: str, out: str, market_value: str | None = None):
    """Clip at median +- 3 * 1.4826 * MAD per day; a day with a missing value becomes NULL.

    The median of deviations from the median needs two window levels, so this takes and returns a frame;
    both levels use the same partitioning and add no exchange to one another.
    """
    band = F.col("_mad") * (3 * 1.4826)
    return (
        df.withColumn("_med", F.when(_complete(x, market_value), F.median(x).over(day())))
        .withColumn("_mad", F.median(F.abs(F.col(x) - F.col("_med"))).over(day()))
        .withColumn(out, F.when(F.col("_med").isNotNull(),
                                F.greatest(F.least(F.col(x), F.col("_med") + band), F.col("_med") - band)))
        .drop("_med", "_mad")
    )


def zscore(x):
    x = col(x)
    return div(x - F.avg(x).over(day()), F.stddev_pop(x).over(day()))


def standardize(df, x: str, out: str, market_value: str | None = None):
    return winsorize(df, x, "_clip", market_value).withColumn(out, zscore("_clip")).drop("_clip")


def fitted(z: str, market_value: str) -> Column:
    """Least-squares fit of z on the market value within the day."""
    z, mv = col(z), col(market_value)
    beta = F.coalesce(div(F.covar_pop(mv, z).over(day()), F.var_pop(mv).over(day())), F.lit(0.0))
    return F.avg(z).over(day()) + beta * (mv - F.avg(mv).over(day()))


def predict(df, x: str, out: str, market_value: str = "neg_market_value"):
    """Size-explained part of the standardized column."""
    return (standardize(df, x, "_z", market_value)
            .withColumn(out, F.when(F.col("_z").isNotNull(), fitted("_z", market_value))).drop("_z"))


def neutralize(df, x: str, out: str, market_value: str = "neg_market_value"):
    """Size-neutral residual: winsorize, standardize, subtract the fit on market value."""
    return (standardize(df, x, "_z", market_value)
            .withColumn(out, F.col("_z") - fitted("_z", market_value)).drop("_z"))
