"""Choice lists: trades picked elsewhere, enriched with the metrics of their day."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .filters import first_per_key
from .joins import choice_with_bars, latest_per_ticker, pool_count

FIGURES = ["publish_date", "end_date", "act_pubtime", "basic_eps", "diluted_eps", "eps", "reser_ps", "c_reser_ps",
           "n_cin_cash_ps", "fcf_fps"]


def dedup(choice: DataFrame, order: list[str]) -> DataFrame:
    """One row per (ticker, trade_date), the first in the given order."""
    return first_per_key(choice, ["ticker", "trade_date"], order)


def enrich(choice: DataFrame, panel: DataFrame, fundamentals: DataFrame) -> DataFrame:
    """Bars and metrics of the day, the size of that day's pool, and the latest published figures.

    The latest figures ignore the date of the choice; use ``joins.fundamentals_as_of`` for what was known then.
    """
    return (
        choice_with_bars(choice, panel)
        .join(pool_count(panel), "trade_date", "left")
        .join(latest_per_ticker(fundamentals).select("ticker", *FIGURES), "ticker", "left")
    )
