"""Set-based portfolio analytics: period returns, net value, drawdown, holding spells and closed trades.

A selection is one row per (period, ticker). Windows over periods run per ``strategy``, a column that keeps several
strategies apart; a strategy has one row per rebalance date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ts, xs
from ..functions.scalar import div, less
from .filters import month_key
from .joins import month_ends


def last_traded_price(bars: DataFrame, price="hfq_close_price", out="px") -> DataFrame:
    """The price, carried over suspended days."""
    traded = F.when(F.col("open_price") > 0, F.col(price))
    return bars.withColumn(out, F.last(traded, ignorenulls=True).over(ts.running()))


def period_prices(priced: DataFrame, periods: DataFrame) -> DataFrame:
    """Last price of every ticker in every period; map-side reduced to one row per (ticker, period)."""
    return (priced.join(periods, "trade_date").groupBy("ticker", "period")
            .agg(F.max_by("px", "trade_date").alias("end_px")))


def period_returns(holdings: DataFrame, prices: DataFrame) -> DataFrame:
    """end price / start price - 1; a ticker without a bar in the period keeps its price."""
    end = F.coalesce("end_px", "px")
    return (holdings.join(prices, ["ticker", "period"], "left")
            .withColumn("end_px", end).withColumn("ret", div(end, "px") - 1))


def portfolio_returns(held: DataFrame, sale_fee_rate: float, weight: str | None = None) -> DataFrame:
    """Weighted return per period (equal weights without ``weight``), less the fee on what is sold at its end.

    What the next period does not hold is sold; what the strategy's last period holds is still open and pays nothing.
    """
    w = Window.partitionBy("strategy", "ticker").orderBy("period")
    kept = F.coalesce(F.lead("period").over(w) == F.col("period") + 1, F.lit(False))
    still_open = F.col("period") == F.max("period").over(Window.partitionBy("strategy"))
    share = F.lit(1.0) if weight is None else F.col(weight)
    return (held.withColumn("_sold", ~(kept | still_open))
            .withColumn("net", F.col("ret") - F.when(F.col("_sold"), sale_fee_rate).otherwise(0.0) * (1 + F.col("ret")))
            .groupBy("strategy", "period")
            .agg((F.sum(F.col("net") * share) / F.sum(F.when(F.col("net").isNotNull(), share))).alias("ret"),
                 F.min("trade_date").alias("trade_date"),
                 F.max("end_date").alias("end_date"), F.count(F.lit(1)).alias("positions")))


def _periods():
    return Window.partitionBy("strategy").orderBy("period").rowsBetween(Window.unboundedPreceding, 0)


def net_value(returns: DataFrame) -> DataFrame:
    return returns.withColumn("net", F.product(1 + F.col("ret")).over(_periods()))


def drawdown(nav: DataFrame) -> DataFrame:
    return nav.withColumn("drawdown", div("net", F.max("net").over(_periods())) - 1)


def summary(curve: DataFrame) -> DataFrame:
    """Worst drawdown in percent (0 without positions), best and last net value, annualized return."""
    days = F.datediff(F.max("end_date"), F.min("trade_date"))
    last = F.max_by("net", "period")
    return curve.groupBy("strategy").agg(
        F.coalesce(F.min("drawdown") * 100, F.lit(0.0)).alias("max_drawdown"),
        F.max("net").alias("max_roi"),
        last.alias("roi"),
        (F.pow(last, div(365.0, days.cast("double"))) - 1).alias("annual_roi"))


def spells(held: DataFrame) -> DataFrame:
    """Runs of consecutive periods a ticker stays selected."""
    w = Window.partitionBy("strategy", "ticker").orderBy("period")
    breaks = F.when(F.col("period") - F.lag("period").over(w) == 1, 0).otherwise(1)
    return (
        held.withColumn("_new", breaks)
        .withColumn("spell", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("strategy", "ticker", "spell")
        .agg(F.min("period").alias("first_period"), F.max("period").alias("last_period"),
             F.min("trade_date").alias("buy_date"), F.min_by("px", "period").alias("buy_price"),
             F.max("end_date").alias("sale_date"), F.max_by("end_px", "period").alias("sale_price"))
        .withColumn("hold_days", F.datediff("sale_date", "buy_date"))
    )


def closed_trades(runs: DataFrame, last_period: int | None = None) -> DataFrame:
    """Finished spells with their change; a spell that reaches the strategy's last period is still open."""
    if last_period is None:
        runs = runs.withColumn("_last", F.max("last_period").over(Window.partitionBy("strategy")))
    else:
        runs = runs.withColumn("_last", F.lit(last_period))
    return (runs.where("last_period < _last")
            .withColumn("chg_pct", div("sale_price", "buy_price") - 1).drop("_last"))


def after_cooldown(candidates: DataFrame, sales: DataFrame, days: int) -> DataFrame:
    """Rows whose ticker was not sold within the last ``days`` days."""
    from .joins import with_sale_days

    return with_sale_days(candidates, sales).where(F.col("sale_days") >= days)


def small_cap_monthly(bars: DataFrame, calendar: DataFrame, starts: list[str], n: int,
                      min_open_days=10, max_change=0.097) -> DataFrame:
    """Monthly rotation into the n smallest tickers, against the whole universe, for several start dates.

    The start dates are a small dimension that every bar is expanded by (only those on or before the bar), not a loop.
    """
    begun = F.filter(F.array(*[F.lit(s).cast("date") for s in starts]), lambda s: s < F.col("trade_date"))
    df = (
        bars.select("ticker", "trade_date", "is_open", "market_value", "chg_pct")
        .withColumn("start_date", F.explode(begun))
        .withColumn("trade_month", month_key())
    )
    month = (Window.partitionBy("start_date", "ticker", "trade_month").orderBy("trade_date")
             .rowsBetween(Window.unboundedPreceding, 0))
    df = df.withColumns({
        "month_ret": F.product(1 + F.col("chg_pct")).over(month) - 1,
        "open_days": F.sum(F.col("is_open").cast("int")).over(month)})
    ends = month_ends(df.drop("trade_month"), calendar)
    months = Window.partitionBy("start_date", "ticker").orderBy("trade_date")
    ends = ends.withColumn("next_ret", F.coalesce(F.lead("month_ret").over(months), F.col("month_ret")))
    ok = ends.where(F.col("is_open") & (F.col("open_days") >= min_open_days) & (F.col("chg_pct") <= max_change))
    small = xs.rank("market_value", True, ["start_date"]) <= n
    ok = ok.withColumn("_small", small)
    line = (Window.partitionBy("start_date").orderBy("trade_date").rowsBetween(Window.unboundedPreceding, 0))
    return (
        ok.groupBy("start_date", "trade_date")
        .agg(F.avg("next_ret").alias("all_next"), F.avg(F.when(F.col("_small"), F.col("next_ret"))).alias("small_next"),
             F.array_join(F.array_sort(F.collect_list(F.when(F.col("_small"), F.col("ticker").cast("string")))), " ")
             .alias("tickers"))
        .withColumns({"line_all": F.product(1 + F.col("all_next")).over(line),
                      "line_small": F.product(1 + F.col("small_next")).over(line)})
    )


def export_ledger(trades: DataFrame, bars: DataFrame) -> DataFrame:
    """Listed trades with both bars joined on, and the change recomputed from their closes."""
    px = bars.select("ticker", "trade_date", F.col("close_price"))
    buy = px.select("ticker", F.col("trade_date").alias("buy_date"), F.col("close_price").alias("buy_close"))
    sale = px.select("ticker", F.col("trade_date").alias("sale_date"), F.col("close_price").alias("sale_close"))
    return (trades.join(buy, ["ticker", "buy_date"], "left").join(sale, ["ticker", "sale_date"], "left")
            .withColumn("chg_pct", div("sale_close", "buy_close") - 1)
            .withColumn("price_matches", ~(less("buy_price", "buy_close") | less("buy_close", "buy_price"))))
