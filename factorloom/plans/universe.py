"""The same operators on a panel with one ticker for each part: it grows with the tables in rows, tickers and days' width."""

from __future__ import annotations

from functools import partial

from ..factors import alpha101, gtja191
from ..factors.staging import attach
from ..functions import spread, xs
from ..operators import joins, ranking
from ..sources import driver_tables as d
from ..sources.scratch import written
from . import alpha101_sql, gtja191_sql
from .common import tidy
from .metrics import PS
from .primitives import PAIRS, neutral_ctes
from .sql import factor_sql, out, with_traded


def _every_part(sql: str) -> str:
    return sql.replace("l_partkey % 24 as ticker", "l_partkey as ticker")


def _factor(factor, spark, sf_dir):
    return tidy(attach(d.factor_panel(spark, sf_dir, None), {"value": factor}))


FACTORS = {
    **{name: PAIRS[name] for name in ("w02_mean", "w06_tsrank", "w10_delta", "x01_rank_pct", "x02_scale")},
    "f013": (alpha101.FACTORS["f013"], alpha101_sql.FORMULAS["f013"]),
    "g046": (gtja191.FACTORS["g046"], gtja191_sql.FORMULAS["g046"]),
    "g106": (gtja191.FACTORS["g106"], gtja191_sql.FORMULAS["g106"]),
}
QUERIES = {f"universe_{name}": partial(_factor, factor) for name, (factor, _) in FACTORS.items()}
ORACLES = {f"universe_{name}": _every_part(factor_sql({"value": formula})) for name, (_, formula) in FACTORS.items()}


def _bars(spark, sf_dir):
    return tidy(d.bars(spark, sf_dir, None).select("ticker", "trade_date", "open_price", "close_price", "turnover_vol"))


def _top(spark, sf_dir):
    ranked = d.traded(spark, sf_dir, None).withColumn("place", xs.rank("turnover_value", False))
    return tidy(ranking.top_n(ranked, 10, ["place", "ticker"]).select("ticker", "trade_date", "turnover_value", "place"))


def _neutral(spark, sf_dir):
    # what is written for several passes holds the columns in use alone
    panel = d.traded(spark, sf_dir, None).select("ticker", "trade_date", "turnover_rate", "neg_market_value")
    return tidy(spread.neutralize(panel, "turnover_rate", "value").select("ticker", "trade_date", "value"))


def _ranked(spark, sf_dir):
    panel = d.traded(spark, sf_dir, None).select("ticker", "trade_date", "turnover_vol")
    return tidy(spread.rank_pct(panel, "turnover_vol", "value").select("ticker", "trade_date", "value"))


def _as_of(spark, sf_dir):
    panel = written(d.traded(spark, sf_dir, None).select("ticker", "trade_date"), "traded")
    return tidy(joins.fundamentals_as_of(panel, d.ps_pit(spark, sf_dir, None), ["end_date", "basic_eps"]))


QUERIES |= {"universe_x01_rank_pct": _ranked, "universe_bars": _bars, "universe_top10": _top, "universe_neutralize": _neutral, "universe_as_of": _as_of}
ORACLES |= {name: _every_part(sql) for name, sql in {
    "universe_bars": with_traded(f"select ticker, trade_date, {out('open_price')} as open_price, {out('close_price')} as"
                                 f" close_price, {out('turnover_vol')} as turnover_vol from bars"),
    "universe_top10": with_traded(f"""select ticker, trade_date, {out('turnover_value')} as turnover_value, {out('r')} as place
      from (select *, row_number() over (partition by trade_date order by r, ticker) as n from (
        select *, rank() over (partition by trade_date order by turnover_value desc)
          + (count(*) over (partition by trade_date, turnover_value) - 1) / 2.0::double as r from traded)) where n <= 10"""),
    "universe_neutralize": with_traded(f", {neutral_ctes('traded', 'turnover_rate')}\n"
                                       f"select ticker, trade_date, {out('z - fit')} as value from fitted"),
    "universe_as_of": with_traded(PS + f"\nselect t.ticker, t.trade_date, p.end_date, {out('p.e')} as basic_eps from traded t"
                                  " left join lateral (select end_date, e from ps where ps.ticker = t.ticker and"
                                  " ps.pub <= t.trade_date order by pub desc, end_date desc limit 1) p on true"),
}.items()}
