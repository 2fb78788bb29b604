"""Projections, filters and predicates on a bar panel."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import div


def drop_suspended(bars: DataFrame) -> DataFrame:
    return bars.where("open_price > 0")


def in_pool(bars: DataFrame, pool: DataFrame) -> DataFrame:
    """Bars whose ticker is in the pool; whether the pool is broadcast is left to its measured size."""
    return bars.join(pool.select("ticker"), "ticker", "left_semi")


def date_range(bars: DataFrame, start, end=None) -> DataFrame:
    """Inclusive; open-ended without an end."""
    day = F.col("trade_date")
    return bars.where(day >= F.lit(start).cast("date") if end is None
                      else day.between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def all_of(*conditions: str) -> Column:
    """Conditions as SQL text, combined with AND; no condition is true."""
    return reduce(lambda a, b: a & b, map(F.expr, conditions), F.lit(True))


def any_of(*conditions: str) -> Column:
    """Conditions as SQL text, combined with OR; no condition is false."""
    return reduce(lambda a, b: a | b, map(F.expr, conditions), F.lit(False))


def select_where(bars: DataFrame, *conditions: str) -> DataFrame:
    return bars.where(all_of(*conditions))


def not_special(name="sec_short_name") -> Column:
    """Names of neither specially treated nor delisting companies."""
    n = F.col(name)
    return ~(n.startswith("退市") | n.endswith("退") | n.startswith("ST") | n.startswith("*ST"))


def instruments(equity: DataFrame, exchange: str | None = None, sectors: list[str] | None = None) -> DataFrame:
    if exchange is not None:
        equity = equity.where(F.col("exchange_cd") == exchange)
    return equity if sectors is None else equity.where(F.col("list_sector_cd").isin(sectors))


def trade_flags(ranked: DataFrame, buy: list[str], sale: list[str], notsale: list[str]) -> DataFrame:
    """Boolean columns: buy = AND, sale = OR, hold = OR of the conditions."""
    def decided(c):
        return F.coalesce(c, F.lit(False))

    return ranked.withColumns({"is_buy": decided(all_of(*buy)), "is_sale": decided(any_of(*sale)),
                               "is_hold": decided(any_of(*notsale))})


def one_day(bars: DataFrame, day) -> DataFrame:
    return bars.where(F.col("trade_date") == F.lit(day).cast("date"))


def complete_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=columns)


def fill_missing(x, value=0.0) -> Column:
    """NaN, infinity and NULL become ``value``."""
    x = F.col(x) if isinstance(x, str) else x
    return F.coalesce(F.when(F.abs(x) < F.lit(float("inf")), x), F.lit(value))


def percent_change(bars: DataFrame, out: str, price="close_price") -> DataFrame:
    """Change against the previous row in percent, two decimals half to even; the first row is 0."""
    prev = F.lag(price).over(Window.partitionBy("ticker").orderBy("trade_date"))
    p = F.col(price)
    return bars.withColumn(out, F.coalesce(F.bround(div(p - prev, prev) * 100, 2), F.lit(0.0)))


def existed_for(bars: DataFrame, days=90) -> DataFrame:
    """Bars of tickers whose history spans at least ``days`` days."""
    w = Window.partitionBy("ticker")
    span = F.datediff(F.max("trade_date").over(w), F.min("trade_date").over(w))
    return bars.withColumn("_span", span).where(F.col("_span") >= days).drop("_span")


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per key, the first in the given order (deterministic, unlike dropDuplicates).

    The rows are packed into one struct and reduced with a map-side minimum, so that a key with very many copies
    is pre-aggregated before the exchange. ``order`` must decide between any two different rows.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.min(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest if c not in order]))
    return (df.groupBy(*keys).agg(best.alias("_row"))
            .select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]))


def month_key(day="trade_date") -> Column:
    return F.year(day) * 100 + F.month(day)


# presentable order of a position manifest
MANIFEST_COLUMNS = ["ticker", "sec_short_name", "trade_date", "buy_date", "buy_price", "close_price", "chg_pct",
                    "hold_days"]


def manifest_view(df: DataFrame) -> DataFrame:
    """Known columns first and in order, the others after them."""
    known = [c for c in MANIFEST_COLUMNS if c in df.columns]
    return df.select(*known, *[c for c in df.columns if c not in known])
