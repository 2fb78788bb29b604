"""Named metrics. Each takes the panel, the name of the new column and its arguments, and adds that column.

Metrics that look at suspended days too (``not_suspend_in``, ``n_chg_pct``, the float metrics) are computed on the
full panel; drop its suspended rows afterwards, which needs no join. ``LOOK_AHEAD`` marks those that read later rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ts, xs
from ..functions.scalar import div, log10

LOOK_AHEAD = {"float_value", "neg_share_incr", "float_rate"}


@dataclass(frozen=True, init=False)
class SelectMetric:
    """A metric to attach: column name, function and arguments."""

    name: str
    func: Callable
    args: tuple

    def __init__(self, name: str, func: Callable, *args):
        if name == "":
            raise ValueError("a metric needs a name")
        object.__setattr__(self, "name", name)
        object.__setattr__(self, "func", func)
        object.__setattr__(self, "args", args)


def append_metric(panel: DataFrame, metric: SelectMetric) -> DataFrame:
    return metric.func(panel, metric.name, *metric.args)


def append_metrics(panel: DataFrame, metrics: list[SelectMetric]) -> DataFrame:
    """All metrics on one frame; windows of the same order share one exchange and one sort."""
    for m in metrics:
        panel = append_metric(panel, m)
    return panel


def relaxed(n: int, min_periods=-1) -> int:
    """The library's minimum number of values in a window: n - 1 unless a smaller one is asked for."""
    return n - 1 if min_periods == -1 or min_periods >= n else min_periods


def back_adjust(bars: DataFrame) -> DataFrame:
    """Prices scaled by the compounded change since the ticker's first row."""
    w = ts.history()
    first = {c: F.first(f"{c}_price").over(w) for c in ("close", "open", "pre_close")}
    df = bars.withColumn("fq_factor", ts.cumprod(1 + F.col("chg_pct")))
    fq0 = F.first("fq_factor").over(w)
    return df.withColumns({f"hfq_{c}_price": div(x, fq0) * F.col("fq_factor") for c, x in first.items()})


def price_devi(df, name):
    return df.withColumn(name, log10(div("vwap", "close_price")))


def ep(df, name):
    return df.withColumn(name, div(1.0, "pe"))


def bp(df, name):
    return df.withColumn(name, div(1.0, "pb"))


def ntra_bp(df, name, source="bp"):
    return xs.neutralize(df, source, name)


def ma_any(df, name, n, column):
    if n <= 1:
        raise ValueError("a moving average needs more than one row")
    return df.withColumn(name, ts.mean(column, n, 1))


def sum_any(df, name, n, column):
    return df.withColumn(name, ts.total(column, n, relaxed(n, 1)))


def ps_pit(df, name, fundamentals):
    """Per-share figures on the day they were first published, as ``<name>_<figure>`` columns."""
    from .filters import first_per_key

    figures = ["basic_eps", "diluted_eps", "reser_ps", "c_reser_ps", "n_cin_cash_ps", "fcf_fps"]
    published = (
        fundamentals.select("ticker", "end_date", F.to_date("act_pubtime").alias("trade_date"), *figures)
        .na.drop("any"))
    first = first_per_key(published, ["ticker", "end_date"], ["trade_date"])
    newest = F.max(F.struct("end_date", *figures))  # two reports on one day: the later period
    per_day = first.groupBy("ticker", "trade_date").agg(newest.alias("_row"))
    columns = [F.col(f"_row.{f}").alias(f"{name}_{f}") for f in figures]
    return df.join(per_day.select("ticker", "trade_date", *columns), ["ticker", "trade_date"], "left")


def not_suspend_in(full, name, n):
    """1 if none of the last n rows was suspended."""
    return full.withColumn(name, F.when(F.min("open_price").over(ts.last(n)) == 0, 0).otherwise(1))


def roi_volat(df, name, n):
    return df.withColumn(name, ts.std("chg_pct", n))


def price_ampl(df, name):
    return df.withColumn(name, div(F.col("highest_price") - F.col("lowest_price"), "pre_close_price"))


def price_ampl_rate(df, name, ampl="price_ampl"):
    return df.withColumn(name, div(F.col(ampl) * 10000, "turnover_value"))


def neg_market_amount(df, name):
    return df.withColumn(name, div("neg_market_value", "close_price").cast("long"))


def momentum(df, name, n, column):
    if n < 1:
        raise ValueError("momentum looks back at least one row")
    return df.withColumn(name, ts.change(column, n))


def list_days(df, name, equity):
    from .joins import with_list_date

    return (with_list_date(df, equity)
            .withColumn(name, F.datediff("trade_date", "list_date") + 1).drop("list_date"))


def _ranked_covariance(df, name, price):
    r = df.withColumns({"_p": xs.rank(price), "_v": xs.rank("turnover_vol")})
    r = r.withColumn("_c", -ts.cov("_p", "_v", 5))
    return r.withColumn(name, xs.rank_max("_c")).drop("_p", "_v", "_c")


def wq_alpha16(df, name):
    return _ranked_covariance(df, name, "highest_price")


def wq_alpha13(df, name):
    return _ranked_covariance(df, name, "close_price")


def ntra_turnover_rate(df, name, n):
    df = df.withColumn("_m", F.coalesce(ts.mean("turnover_rate", n, relaxed(n)), F.lit(0.0)))
    return xs.neutralize(df, "_m", name).drop("_m")


def bias(df, name, n, column="hfq_close_price"):
    return df.withColumn(name, div(column, ts.mean(column, n, relaxed(n))) - 1)


def ntra_bias(df, name, n, column="hfq_close_price"):
    df = bias(df, "_b", n, column).withColumn("_b", F.coalesce("_b", F.lit(0.0)))
    return xs.neutralize(df, "_b", name).drop("_b")


def _share_increase(n):
    """Float shares n - 1 rows ahead minus those of the previous row; both offsets stay inside the ticker."""
    shares = div("neg_market_value", "close_price")
    return F.coalesce(ts.ahead(shares, n - 1) - ts.delay(shares, 1), F.lit(0.0))


def neg_share_incr(full, name, n):
    return full.withColumn(name, _share_increase(n) / 10000)


def float_value(full, name, n):
    """Value of the shares that become tradable; from ``float_rate_<n>`` if that column is there."""
    if f"float_rate_{n}" in full.columns:
        return full.withColumn(name, F.col(f"float_rate_{n}") * F.col("neg_market_value"))
    return full.withColumn(name, _share_increase(n) * F.col("close_price") / 10000)


def float_rate(full, name, n):
    """Share of the float that becomes tradable, cut to four decimals, never negative."""
    if f"float_value_{n}" in full.columns:
        return full.withColumn(name, div(f"float_value_{n}", "neg_market_value"))
    rate = div(_share_increase(n) * 10000 * F.col("close_price"), "neg_market_value").cast("long") / 10000
    return full.withColumn(name, F.greatest(rate, F.lit(0.0)))


def vol_nm_rate(df, name, n, m):
    return df.withColumn(name, div(ts.mean("turnover_vol", n, 1), ts.mean("turnover_vol", m, 1)))


def vol_rate(df, name, n):
    short = ts.total("turnover_vol", n, 1)
    return df.withColumn(name, div(short, ts.total("turnover_vol", 2 * n, 1) - short))


def revers_21(df, name, k60):
    """Product over 21 rows of the close against the intraday close (1 where that is missing)."""
    from .joins import with_intraday

    rate = F.coalesce(div("close_price", "close_60"), F.lit(1.0))
    df = with_intraday(df, k60).withColumn("_r", rate)
    return df.withColumn(name, ts.prod("_r", 21)).drop("_r", "close_60")


def n_chg_pct(full, name, n):
    return full.withColumn(name, ts.change("hfq_close_price", n))


def ma_turnover_rate(df, name, n):
    return df.withColumn(name, ts.mean("turnover_rate", n, relaxed(n, 1)))


def ma_vol(df, name, n):
    return df.withColumn(name, ts.mean("turnover_vol", n, relaxed(n, 1)))


def rank(df, name, column, ascending=True):
    return df.withColumn(name, xs.rank(column, ascending))


def rank_subset(df, name, column, ascending, subset: str):
    """Rank among the rows of a day that meet a condition, NULL for the others."""
    return df.withColumn(name, xs.rank(F.when(F.expr(subset), F.col(column)), ascending))


def per_group(df: DataFrame, key: str, func, schema) -> DataFrame:
    """User code on the pandas frame of one group: the escape hatch where no column expression will do."""
    return df.groupBy(key).applyInPandas(func, schema)


def post_hook(df: DataFrame, hook) -> DataFrame:
    return df.transform(hook)


METRICS: dict[str, Callable] = {
    f.__name__: f for f in (
        price_devi, ep, bp, ntra_bp, ma_any, ps_pit, not_suspend_in, roi_volat, price_ampl, price_ampl_rate, sum_any,
        neg_market_amount, momentum, list_days, wq_alpha16, wq_alpha13, ntra_turnover_rate, ntra_bias, bias,
        float_value, neg_share_incr, float_rate, vol_nm_rate, vol_rate, revers_21, n_chg_pct, ma_turnover_rate,
        ma_vol, rank, rank_subset)
}
