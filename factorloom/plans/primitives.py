"""Queries for the window primitives: by ticker (w), by trade date (x) and elementwise (e)."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from ..factors.staging import attach, by_date, by_ticker
from ..functions import scalar, ts, xs
from ..sources.driver_tables import factor_panel, traded
from . import sql
from .common import tidy
from .sql import factor_sql, out, with_traded


def one(make):
    """A factor of a single by-ticker step."""
    def run(b):
        return (yield by_ticker(make(b)))
    return run


def _slope_sig(b):
    return (yield by_ticker(ts.slope_of_index(b.C, 6, critical_t=2.776)))


def _next_value(b):
    nxt = yield by_ticker(ts.ahead(b.C, 1))
    return (yield by_ticker(F.last(nxt, ignorenulls=True).over(ts.running())))


def _day(make):
    def run(b):
        return (yield by_date(make(b)))
    return run


def _gain(b):
    return scalar.div(b.C, b.O)


def history(e, x):
    return x.book.column(f"{e} over (partition by ticker order by trade_date rows unbounded preceding)", x.level)


PAIRS = {
    "w01_sum": (one(lambda b: ts.total(b.V, 5)), lambda b: sql.ssum(b.V, 5)),
    "w02_mean": (one(lambda b: ts.mean(b.V, 20)), lambda b: sql.mean(b.V, 20)),
    "w03_std": (one(lambda b: ts.std(b.C, 20)), lambda b: sql.std(b.C, 20)),
    "w04_corr": (one(lambda b: ts.corr(b.C, b.V, 10)), lambda b: sql.corr(b.C, b.V, 10)),
    "w05_cov": (one(lambda b: ts.cov(b.C, b.V, 5)), lambda b: sql.cov(b.C, b.V, 5)),
    "w06_tsrank": (one(lambda b: ts.rank(b.V, 10)), lambda b: sql.tsrank(b.V, 10)),
    "w06_tsrank_pct": (one(lambda b: ts.rank_pct(b.V, 10)), lambda b: sql.tsrank_pct(b.V, 10)),
    "w06_tsrank_top": (one(lambda b: ts.rank_of_top(b.V, 10)), lambda b: sql.tsrank_top(b.V, 10)),
    "w07_prod": (one(lambda b: ts.prod(_gain(b), 15)), lambda b: sql.prod(b.C / b.O, 15)),
    "w08_tsmin": (one(lambda b: ts.low(b.L, 12)), lambda b: sql.tsmin(b.L, 12)),
    "w09_tsmax": (one(lambda b: ts.high(b.H, 12)), lambda b: sql.tsmax(b.H, 12)),
    "w10_delta": (one(lambda b: ts.delta(b.C, 7)), lambda b: sql.delta(b.C, 7)),
    "w11_delay": (one(lambda b: ts.delay(b.C, 3)), lambda b: sql.delay(b.C, 3)),
    "w12_tsargmax": (one(lambda b: ts.argmax(b.V, 10)), lambda b: sql.argmax(b.V, 10)),
    "w13_tsargmin": (one(lambda b: ts.argmin(b.V, 10)), lambda b: sql.argmin(b.V, 10)),
    "w14_decay": (one(lambda b: ts.decay(b.C, 9)), lambda b: sql.decay(b.C, 9)),
    "w15_ewm": (one(lambda b: ts.ewm(F.when(b.V > 100, b.C), span=12)),
                lambda b: sql.ewm(sql.fn("(case when {0} > 100 then {1} end)", b.V, b.C), span=12)),
    "w16_ewmn": (one(lambda b: ts.ewm_recursive(F.when(b.V > 100, b.C), 1 / 6)),
                 lambda b: sql.ewmn(sql.fn("(case when {0} > 100 then {1} end)", b.V, b.C), 1 / 6)),
    "w17_highday": (one(lambda b: ts.highday(b.H, 20)), lambda b: sql.highday(b.H, 20)),
    "w18_lowday": (one(lambda b: ts.lowday(b.L, 20)), lambda b: sql.lowday(b.L, 20)),
    "w19_count": (one(lambda b: ts.count_if(scalar.less(b.O, b.C), 12)), lambda b: sql.count(b.C > b.O, 12)),
    "w19_sumif": (one(lambda b: ts.sum_if(scalar.less(b.O, b.C), b.V, 12)), lambda b: sql.sumif(b.V, 12, b.C > b.O)),
    "w20_regbeta": (one(lambda b: ts.slope(b.C, 20)), lambda b: sql.regbeta(b.C, 20)),
    "w20_regbeta_significant": (_slope_sig, lambda b: sql.regbeta_index(b.C, 6, 2.776)),
    "w21_cumprod": (one(lambda b: ts.cumprod(scalar.div(b.C, b.P))),
                    lambda b: history(f"product({(b.C / b.P).sql})", b.C)),
    "w22_cumsum": (one(lambda b: ts.cumsum(b.V)), lambda b: history("sum(V)", b.V)),
    "w23_cummax": (one(lambda b: ts.cummax(b.H)), lambda b: history("max(H)", b.H)),
    "w24_pct_change": (one(lambda b: ts.change(b.C, 5)), lambda b: b.C / sql.delay(b.C, 5) - 1),
    "w25_next_value": (_next_value, lambda b: b.book.column(
        "coalesce(lead(C) over (partition by ticker order by trade_date), C)", 0)),
    "x01_rank_pct": (_day(lambda b: xs.rank_pct(b.V)), lambda b: sql.rank(b.V)),
    "x02_scale": (_day(lambda b: xs.scale(b.C - b.O, 2.0)), lambda b: sql.scale(b.C - b.O, 2)),
    "x03_rank": (_day(lambda b: xs.rank(b.V, False)), lambda b: b.book.column(
        "(rank() over (partition by trade_date order by V desc)"
        " + (count(*) over (partition by trade_date, V) - 1) / 2.0::double)", 0)),
    "x04_rank_max": (_day(lambda b: xs.rank_max(b.V)), lambda b: b.book.column(
        "(rank() over (partition by trade_date order by V)"
        " + count(*) over (partition by trade_date, V) - 1)::double", 0)),
    "x05_rank_max_pct": (_day(lambda b: xs.rank_max_pct(b.V) * 100), lambda b: b.book.column(
        "100 * cume_dist() over (partition by trade_date order by V)", 0)),
}


def _factor(factor, spark, sf_dir):
    return tidy(attach(factor_panel(spark, sf_dir), {"value": factor}))


def _frame(change, spark, sf_dir):
    """A cross-section step on vol/value of one day, with one missing value in some days."""
    df = traded(spark, sf_dir).withColumn("x", F.expr("if(ticker = 5 and wk % 20 = 0, null, turnover_rate)"))
    return tidy(change(df).select("ticker", "trade_date", "value"))


#: One column for each scalar, so that a missing value hides no other.
SCALARS = {
    "sign": (lambda b: scalar.sign(b.C - b.O), lambda b: sql.sign(b.C - b.O)),
    "abs": (lambda b: F.abs(b.C - b.O), lambda b: sql.absolute(b.C - b.O)),
    "ln": (lambda b: scalar.ln(b.C - b.O), lambda b: sql.log(b.C - b.O)),
    "log10": (lambda b: scalar.log10(b.V), lambda b: sql.fn("log10({0})", b.V)),
    "root": (lambda b: scalar.power(b.C - b.O, 0.5), lambda b: sql.power(b.C - b.O, 0.5)),
    "smaller": (lambda b: scalar.smaller(b.C, b.O), lambda b: sql.small(b.C, b.O)),
    "larger": (lambda b: scalar.larger(b.H, b.V), lambda b: sql.big(b.H, b.V)),
    "pick": (lambda b: scalar.pick(scalar.less(b.O, b.C), b.V, -b.V), lambda b: sql.where(b.C > b.O, b.V, -b.V)),
}


def _scalars(spark, sf_dir):
    return tidy(attach(factor_panel(spark, sf_dir), {n: f for n, (f, _) in SCALARS.items()}))


QUERIES = {name: partial(_factor, factor) for name, (factor, _) in PAIRS.items()}
ORACLES = {name: factor_sql({"value": formula}) for name, (_, formula) in PAIRS.items()}

QUERIES["e01_scalars"] = _scalars
ORACLES["e01_scalars"] = factor_sql({n: formula for n, (_, formula) in SCALARS.items()})
QUERIES |= {
    "x06_winsorize": partial(_frame, lambda df: xs.winsorize(df, "x", "value")),
    "x07_zscore": partial(_frame, lambda df: df.withColumn("value", xs.zscore("turnover_rate"))),
    "x08_neutralize": partial(_frame, lambda df: xs.neutralize(df, "x", "value")),
    "x09_standardize": partial(_frame, lambda df: xs.standardize(df, "x", "value")),
    "x10_predict": partial(_frame, lambda df: xs.predict(df, "x", "value")),
}


def neutral_ctes(source: str, x: str, mv="neg_market_value") -> str:
    """CTEs med, clip, z, fit over a source CTE: winsorize, standardize, fit on market value."""
    return f"""
med as (select *, {x} as v, case when count({x}) over d = count(*) over d then median({x}) over d end as med
  from {source} window d as (partition by trade_date)),
mads as (select *, median(abs(v - med)) over (partition by trade_date) as mad from med),
clipped as (select *, case when med is not null then
    greatest(least(v, med + 3 * 1.4826::double * mad), med - 3 * 1.4826::double * mad) end as clip from mads),
scored as (select *, (clip - avg(clip) over (partition by trade_date))
    / nullif(stddev_pop(clip) over (partition by trade_date), 0) as z from clipped),
fitted as (select s.*, case when z is not null then f.a + f.b * {mv} end as fit from scored s
  join (select trade_date, coalesce(regr_slope(z, {mv}), 0) as b,
          avg(z) - coalesce(regr_slope(z, {mv}), 0) * avg({mv}) as a
        from scored group by trade_date) f using (trade_date))"""


_X = "px as (select *, case when ticker = 5 and wk % 20 = 0 then null else turnover_rate end as x from traded),"

for _name, _value in {"x06_winsorize": "clip", "x08_neutralize": "z - fit", "x09_standardize": "z",
                      "x10_predict": "fit"}.items():
    ORACLES[_name] = with_traded(f", {_X} {neutral_ctes('px', 'x')}\n"
                                 f"select ticker, trade_date, {out(_value)} as value from fitted")
ORACLES["x07_zscore"] = with_traded(
    "select ticker, trade_date, " + out(
        "(turnover_rate - avg(turnover_rate) over (partition by trade_date))"
        " / nullif(stddev_pop(turnover_rate) over (partition by trade_date), 0)") + " as value from traded")
