"""Weighted multi-factor ranking and top-n selection per trade date."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import xs


@dataclass(frozen=True)
class RankFactor:
    name: str
    bigfirst: bool = True  # big values get a high subrank
    weight: float = 1


def check_columns(df: DataFrame, factors: list[RankFactor]) -> None:
    missing = [f.name for f in factors if f.name not in df.columns]
    if missing:
        raise ValueError(f"rank factors {missing} are not among the columns {df.columns}")


def append_rankfactor(df: DataFrame, factors: list[RankFactor], *new: RankFactor) -> list[RankFactor]:
    check_columns(df, list(new))
    return [*factors, *new]


def rank(df: DataFrame, factors: list[RankFactor], by=()) -> DataFrame:
    """Add ``<factor>_subrank``, ``xrank`` (both in percent) and ``rank`` (1 is best) per trade date.

    All windows partition by the date (and ``by``), so the whole chain needs one exchange.
    """
    check_columns(df, factors)
    weight = sum(f.weight for f in factors)
    df = df.withColumns({f"{f.name}_subrank": xs.rank_max_pct(f.name, f.bigfirst, by) * 100 for f in factors})
    blend = sum((F.col(f"{f.name}_subrank") * f.weight for f in factors), F.lit(0.0)) / weight
    return (df.withColumn("_blend", blend)
            .withColumn("xrank", xs.rank_max_pct("_blend", True, by) * 100)
            .withColumn("rank", xs.rank("xrank", False, by)).drop("_blend"))


def rank_subset(df: DataFrame, factors: list[RankFactor], condition: str) -> DataFrame:
    """Rank only the rows of a day that meet a condition."""
    return rank(df.where(condition), factors)


def daily_choice(pool: DataFrame, held: DataFrame, bars: DataFrame, factors: list[RankFactor]) -> DataFrame:
    """Each day's pool plus the held tickers that left it, ranked together.

    ``held`` names (ticker, trade_date); their rows are taken from ``bars``.
    """
    keys = ["ticker", "trade_date"]
    left_pool = (bars.join(held.select(*keys).distinct(), keys, "left_semi")
                 .join(pool.select(*keys), keys, "left_anti"))
    return rank(pool.unionByName(left_pool, allowMissingColumns=True), factors)


def buy_count(balance: float, ideal: float, minimum: float) -> int:
    """How many positions a balance buys: full ones, and one more if the remainder is large enough."""
    n = int(balance // ideal)
    return n + 1 if balance - n * ideal >= minimum else n


def affordable(ranked: DataFrame, balance: str, ideal: float, minimum: float, order=None) -> DataFrame:
    """First rows per date by rank, as many as the date's ``balance`` buys (see ``buy_count``)."""
    full = F.floor(F.col(balance) / ideal)
    n = full + F.when(F.col(balance) - full * ideal >= minimum, 1).otherwise(0)
    w = Window.partitionBy("trade_date").orderBy(*(order or ["rank", "ticker"]))
    return ranked.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def top_n(ranked: DataFrame, n: int, order=None) -> DataFrame:
    """First n rows per date by rank; Spark prunes to n per group before and after the exchange."""
    w = Window.partitionBy("trade_date").orderBy(*(order or ["rank", "ticker"]))
    return ranked.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")
