"""Queries for the named metrics."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from ..operators import metrics as m
from ..operators.filters import drop_suspended
from ..operators.joins import attach_metric, unmatched
from ..operators.metrics import SelectMetric, append_metrics
from ..sources import driver_tables as d
from .common import tidy
from .primitives import neutral_ctes
from .sql import TRADED, out, sig

QUERIES, ORACLES = {}, {}


def _on_traded(adjust, specs, spark, sf_dir):
    full = d.bars(spark, sf_dir)
    full = m.back_adjust(full) if adjust else full
    df = append_metrics(drop_suspended(full), [SelectMetric(*s) for s in specs])
    return tidy(df.select("ticker", "trade_date", *[s[0] for s in specs]))


def _on_full(adjust, specs, spark, sf_dir):
    """Computed with the suspended days, returned without them."""
    full = d.bars(spark, sf_dir)
    full = m.back_adjust(full) if adjust else full
    df = drop_suspended(append_metrics(full, [SelectMetric(*s) for s in specs]))
    return tidy(df.select("ticker", "trade_date", *[s[0] for s in specs]))


def w(n):
    return f"over (partition by ticker order by trade_date rows between {n - 1} preceding and current row)"


TSW = "over (partition by ticker order by trade_date)"
HFQ = """,
fq as (select *, product(1 + chg_pct) over (partition by ticker order by trade_date rows unbounded preceding) as fq
  from bars),
adj as (select *, close0 / fq0 * fq as hfq_close_price, open0 / fq0 * fq as hfq_open_price,
    pre0 / fq0 * fq as hfq_pre_close_price
  from (select *, first_value(fq) over p as fq0, first_value(close_price) over p as close0,
          first_value(open_price) over p as open0, first_value(pre_close_price) over p as pre0
        from fq window p as (partition by ticker order by trade_date rows unbounded preceding))),
adjt as (select * from adj where open_price > 0)"""


def add(name, run, source, columns: dict, ctes="", suffix=""):
    QUERIES[name] = run
    cols = ", ".join(f"{e if raw else out(e)} as {c}" for c, (e, raw) in
                     ((c, v if isinstance(v, tuple) else (v, False)) for c, v in columns.items()))
    ORACLES[name] = f"with {TRADED}{ctes}\nselect ticker, trade_date, {cols} from {source}{suffix}"


def simple(name, specs, columns, full=False, adjust=False, source=None, ctes="", suffix=""):
    run = partial(_on_full if full else _on_traded, adjust, specs)
    add(name, run, source or ("adjt" if adjust else "traded"), columns, (HFQ if adjust else "") + ctes, suffix)


simple("m01_price_devi", [("price_devi", m.price_devi)], {"price_devi": "log10(vwap / nullif(close_price, 0))"})
simple("m02_ep", [("ep", m.ep)], {"ep": "1 / nullif(pe, 0)"})
simple("m03_bp", [("bp", m.bp)], {"bp": "1 / nullif(pb, 0)"})
simple("m04_ntra_bp", [("bp", m.bp), ("ntra_bp", m.ntra_bp)], {"bp": "v", "ntra_bp": "z - fit"}, source="fitted",
       ctes=", src as (select *, 1 / nullif(pb, 0) as bp from traded)," + neutral_ctes("src", "bp"))
simple("m05_ma_any", [("ma5", m.ma_any, 5, "close_price"), ("ma20", m.ma_any, 20, "turnover_vol")],
       {"ma5": f"avg(close_price) {w(5)}", "ma20": f"avg(turnover_vol) {w(20)}"})
simple("m07_not_suspend_in", [("ns10", m.not_suspend_in, 10)], {"ns10": ("cast(clear as int)", True)}, full=True,
       source="(select *, (count(case when open_price = 0 then 1 end) "
              f"{w(10)}) = 0 as clear from bars) where open_price > 0")
simple("m08_roi_volat", [("v60", m.roi_volat, 60)],
       {"v60": f"case when count(chg_pct) {w(60)} >= 60 then stddev_samp(chg_pct) {w(60)} end"})
simple("m09_price_ampl", [("price_ampl", m.price_ampl)],
       {"price_ampl": "(highest_price - lowest_price) / nullif(pre_close_price, 0)"})
simple("m10_price_ampl_rate", [("price_ampl", m.price_ampl), ("price_ampl_rate", m.price_ampl_rate)],
       {"price_ampl": "(highest_price - lowest_price) / nullif(pre_close_price, 0)",
        "price_ampl_rate": "(highest_price - lowest_price) / nullif(pre_close_price, 0) * 10000 / turnover_value"})
simple("m11_sum_any", [("s5", m.sum_any, 5, "turnover_vol"), ("s1", m.sum_any, 1, "turnover_vol")],
       {"s5": f"sum(turnover_vol) {w(5)}", "s1": "turnover_vol"})
simple("m12_neg_market_amount", [("amount", m.neg_market_amount)],
       {"amount": ("trunc(neg_market_value / nullif(close_price, 0))::bigint", True)})
simple("m13_momentum", [("mom20", m.momentum, 20, "close_price")],
       {"mom20": f"close_price / nullif(lag(close_price, 20) {TSW}, 0) - 1"})


def _list_days(spark, sf_dir):
    return (m.list_days(d.traded(spark, sf_dir), "list_days", d.equity(spark, sf_dir))
            .select("ticker", "trade_date", F.col("list_days").cast("long").alias("list_days")))


EQUITY = """,
equity as (select l_partkey % 24 as ticker,
    cast(date_trunc('week', min(l_shipdate)) as date) - cast(7 * (l_partkey % 24) as integer) as list_date,
    cast(1 + (l_partkey % 24) % 3 as varchar) as list_sector_cd,
    case when (l_partkey % 24) % 2 = 0 then 'XSHG' else 'XSHE' end as exchange_cd
  from lineitem where l_partkey % 24 not in (22, 23) group by l_partkey % 24)"""

add("m14_list_days", _list_days, "traded left join equity using (ticker)",
    {"list_days": ("cast(date_diff('day', list_date, trade_date) + 1 as bigint)", True)}, EQUITY)
QUERIES["m14_unmatched"] = lambda spark, sf_dir: (
    unmatched(d.traded(spark, sf_dir), d.equity(spark, sf_dir)).select("ticker", "trade_date", "sec_short_name"))
ORACLES["m14_unmatched"] = (f"with {TRADED}{EQUITY}\nselect ticker, trade_date, sec_short_name from traded t"
                            " where not exists (select 1 from equity e where e.ticker = t.ticker)")


def _wq(price):
    def avg_rank(c):
        return (f"rank() over (partition by trade_date order by {c})"
                f" + (count(*) over (partition by trade_date, {c}) - 1) / 2.0::double")
    return f""",
wr as (select *, {avg_rank(price)} as pr, {avg_rank('turnover_vol')} as vr from traded),
wc as (select *, case when count(*) {w(5)} >= 5 then {sig(f"(-covar_samp(pr, vr) {w(5)})")} end as nc from wr),
wq as (select *, case when nc is not null then (rank() over (partition by trade_date, nc is null order by nc)
   + count(*) over (partition by trade_date, nc) - 1)::double end as wqr from wc)"""


simple("m15_wq_alpha16", [("wq16", m.wq_alpha16)], {"wq16": "wqr"}, source="wq", ctes=_wq("highest_price"))
simple("m16_wq_alpha13", [("wq13", m.wq_alpha13)], {"wq13": "wqr"}, source="wq", ctes=_wq("close_price"))


def _ma(col, n, need):
    return f"case when count({col}) {w(n)} >= {need} then avg({col}) {w(n)} end"


simple("m17_ntra_turnover_rate", [("nt", m.ntra_turnover_rate, 5)], {"nt": "z - fit"}, source="fitted",
       ctes=f", src as (select *, coalesce({_ma('turnover_rate', 5, 4)}, 0) as mt from traded),"
            + neutral_ctes("src", "mt"))
simple("m18_ntra_bias", [("nb", m.ntra_bias, 6)], {"nb": "z - fit"}, adjust=True, source="fitted",
       ctes=f", src as (select *, coalesce(hfq_close_price / ({_ma('hfq_close_price', 6, 5)}) - 1, 0) as bs"
            " from adjt)," + neutral_ctes("src", "bs"))
simple("m19_bias_6", [("bias6", m.bias, 6)],
       {"bias6": f"hfq_close_price / ({_ma('hfq_close_price', 6, 5)}) - 1"}, adjust=True)

SHARES = """,
sh as (select *, neg_market_value / nullif(close_price, 0) as shr from bars),
incr as (select *, coalesce(lead(shr, {k}) over p - lag(shr, 1) over p, 0) as inc from sh
  window p as (partition by ticker order by trade_date))"""

_incr = SHARES.format(k=29)
simple("m20_float_value", [("float_value_30", m.float_value, 30)], {"float_value_30": "inc * close_price / 10000"},
       full=True, source="incr where open_price > 0", ctes=_incr)
simple("m20_float_value_from_rate", [("float_rate_30", m.float_rate, 30), ("float_value_30", m.float_value, 30)],
       {"float_rate_30": "greatest(trunc(inc * 10000 * close_price / neg_market_value) / 10000, 0)",
        "float_value_30": "greatest(trunc(inc * 10000 * close_price / neg_market_value) / 10000, 0)"
                          " * neg_market_value"},
       full=True, source="incr where open_price > 0", ctes=_incr)
simple("m21_neg_share_incr", [("nsi", m.neg_share_incr, 30)], {"nsi": "inc / 10000"}, full=True,
       source="incr where open_price > 0", ctes=_incr)
simple("m22_float_rate", [("fr", m.float_rate, 30)],
       {"fr": "greatest(trunc(inc * 10000 * close_price / neg_market_value) / 10000, 0)"}, full=True,
       source="incr where open_price > 0", ctes=_incr)
simple("m23_vol_nm_rate", [("r", m.vol_nm_rate, 5, 20)],
       {"r": f"avg(turnover_vol) {w(5)} / nullif(avg(turnover_vol) {w(20)}, 0)"})
simple("m24_vol_rate", [("r", m.vol_rate, 5)],
       {"r": f"sum(turnover_vol) {w(5)} / nullif(sum(turnover_vol) {w(10)} - sum(turnover_vol) {w(5)}, 0)"})
QUERIES["m25_revers_21"] = lambda spark, sf_dir: tidy(
    m.revers_21(d.traded(spark, sf_dir), "revers_21", d.k60(spark, sf_dir))
    .select("ticker", "trade_date", "revers_21"))
K60 = """,
k60 as (select ticker, trade_date, (open_price + close_price) / 2 as kclose from bars
  where turnover_vol >= 100 and open_price > 0)"""
ORACLES["m25_revers_21"] = f"""with {TRADED}{K60},
r as (select ticker, trade_date, coalesce(close_price / nullif(kclose, 0), 1) as rate
  from traded left join k60 using (ticker, trade_date)),
p as (select *, case when count(*) {w(21)} >= 21 then product(rate) {w(21)} end as pr from r)
select ticker, trade_date, {out('pr')} as revers_21 from p"""
simple("m26_n_chg_pct", [("chg20", m.n_chg_pct, 20)], {"chg20": "c20"}, full=True, adjust=True,
       source=f"(select *, hfq_close_price / lag(hfq_close_price, 20) {TSW} - 1 as c20 from adj) where open_price > 0")
simple("m27_ma_turnover_rate", [("mt", m.ma_turnover_rate, 10)], {"mt": f"avg(turnover_rate) {w(10)}"})
simple("m28_ma_vol", [("mv", m.ma_vol, 10)], {"mv": f"avg(turnover_vol) {w(10)}"})
_avg_rank = ("rank() over (partition by trade_date order by deal_amount {dir})"
             " + (count(*) over (partition by trade_date, deal_amount) - 1) / 2.0::double")
simple("m29_rank", [("up", m.rank, "deal_amount", True), ("down", m.rank, "deal_amount", False)],
       {"up": _avg_rank.format(dir="asc"), "down": _avg_rank.format(dir="desc")})
simple("m30_rank_subset", [("r", m.rank_subset, "deal_amount", False, "exchange_cd = 'XSHG'")],
       {"r": "case when exchange_cd = 'XSHG' then rank() over (partition by trade_date, exchange_cd"
             " order by deal_amount desc) + (count(*) over (partition by trade_date, exchange_cd, deal_amount) - 1)"
             " / 2.0::double end"})
QUERIES["m31_back_adjust"] = lambda spark, sf_dir: tidy(
    m.back_adjust(d.bars(spark, sf_dir)).select("ticker", "trade_date", "fq_factor", "hfq_close_price",
                                                "hfq_open_price", "hfq_pre_close_price"))
ORACLES["m31_back_adjust"] = (
    f"with {TRADED}{HFQ}\nselect ticker, trade_date, {out('fq')} as fq_factor, "
    + ", ".join(f"{out(c)} as {c}" for c in ("hfq_close_price", "hfq_open_price", "hfq_pre_close_price"))
    + " from adj")

PS = """,
psv as (select l_partkey % 24 as ticker,
    cast(date_trunc('quarter', l_shipdate) + interval 3 month - interval 1 day as date) as end_date,
    sum(l_extendedprice) as val
  from lineitem group by all),
psq as (select ticker, end_date, val / (1000000 + 10000 * ticker) as eps0 from psv),
ps as (select ticker, end_date,
    end_date + cast(8 - isodow(end_date) + 28 + 14 * revision as integer) as pub,
    eps0 * case when revision = 1 then 1.1::double else 1.0::double end as e,
    case when (ticker + year(end_date) * 4 + quarter(end_date)) % 9 <> 0
      then eps0 * case when revision = 1 then 1.1::double else 1.0::double end * 0.6::double end as fcf
  from psq cross join (values (0), (1)) r(revision))"""
FIGURES = {"basic_eps": "e", "diluted_eps": "e * 0.95::double", "reser_ps": "e * 2.0::double",
           "c_reser_ps": "e * 1.5::double", "n_cin_cash_ps": "e * 0.8::double", "fcf_fps": "fcf"}

QUERIES["m06_ps_pit"] = lambda spark, sf_dir: tidy(
    m.ps_pit(d.traded(spark, sf_dir), "ps", d.ps_pit(spark, sf_dir))
    .select("ticker", "trade_date", *[f"ps_{f}" for f in FIGURES]))
ORACLES["m06_ps_pit"] = f"""with {TRADED}{PS},
firsts as (select *, row_number() over (partition by ticker, end_date order by pub) as n from ps
  where fcf is not null),
latest as (select *, row_number() over (partition by ticker, pub order by end_date desc) as k from firsts
  where n = 1)
select t.ticker, t.trade_date, {", ".join(f"{out(e)} as ps_{f}" for f, e in FIGURES.items())}
from traded t left join latest p on p.ticker = t.ticker and p.pub = t.trade_date and p.k = 1"""


def _batch(spark, sf_dir):
    """Several metrics in one pass, then attached by key to the panel."""
    specs = [SelectMetric("ma5", m.ma_any, 5, "close_price"), SelectMetric("vr", m.vol_rate, 5),
             SelectMetric("devi", m.price_devi), SelectMetric("vol_rank", m.rank, "turnover_vol", False)]
    df = append_metrics(d.traded(spark, sf_dir), specs)
    return tidy(df.select("ticker", "trade_date", *[s.name for s in specs]))


add("b21_append_metrics", _batch, "traded", {
    "ma5": f"avg(close_price) {w(5)}",
    "vr": f"sum(turnover_vol) {w(5)} / nullif(sum(turnover_vol) {w(10)} - sum(turnover_vol) {w(5)}, 0)",
    "devi": "log10(vwap / nullif(close_price, 0))",
    "vol_rank": "rank() over (partition by trade_date order by turnover_vol desc)"
                " + (count(*) over (partition by trade_date, turnover_vol) - 1) / 2.0::double"})
QUERIES["u01_registry"] = lambda spark, sf_dir: tidy(append_metrics(
    d.traded(spark, sf_dir), [SelectMetric(n, m.METRICS[n]) for n in ("ep", "bp", "price_devi")])
    .select("ticker", "trade_date", "ep", "bp", "price_devi"))
ORACLES["u01_registry"] = (f"with {TRADED}\nselect ticker, trade_date, {out('1 / nullif(pe, 0)')} as ep,"
                           f" {out('1 / nullif(pb, 0)')} as bp,"
                           f" {out('log10(vwap / nullif(close_price, 0))')} as price_devi from traded")


def _attach(spark, sf_dir):
    bars = d.bars_once(spark, sf_dir)
    stored = m.ma_any(bars.where("open_price > 0"), "ma5", 5, "close_price").select("ticker", "trade_date", "ma5")
    return tidy(attach_metric(bars, stored).select("ticker", "trade_date", "ma5"))


QUERIES["j01_metric_attach"] = _attach
ORACLES["j01_metric_attach"] = (
    f"with {TRADED}, ma as (select ticker, trade_date, avg(close_price) {w(5)} as ma5 from traded)\n"
    f"select ticker, trade_date, {out('ma5')} as ma5 from bars left join ma using (ticker, trade_date)")


def _user_function(spark, sf_dir):
    """A state that each row changes, which no window expresses: the peak, begun anew after a fall of a tenth."""
    def trailing_peak(pdf):
        pdf = pdf.sort_values("trade_date")
        peaks, peak = [], None
        for price in pdf["close_price"]:
            peak = price if peak is None or price < 0.9 * peak else max(peak, price)
            peaks.append(peak)
        return pdf.assign(value=peaks)[["ticker", "trade_date", "value"]]

    panel = d.traded(spark, sf_dir).select("ticker", "trade_date", "close_price")
    return tidy(m.per_group(panel, "ticker", trailing_peak, "ticker long, trade_date date, value double"))


QUERIES["u02_per_group"] = _user_function
ORACLES["u02_per_group"] = (
    f"with {TRADED}, h as (select ticker, trade_date, list(close_price) over (partition by ticker order by trade_date"
    " rows unbounded preceding) as c from traded)\nselect ticker, trade_date, "
    + out("list_reduce(c, lambda peak, price: case when price < 0.9::double * peak then price else greatest(peak, price) end)")
    + " as value from h")


def _rolling_user(spark, sf_dir):
    """A user-supplied rolling function, as an expression over the window's values."""
    from ..functions import ts

    df = d.traded(spark, sf_dir)
    spread = F.array_max(F.collect_list("close_price").over(ts.last(7))) - F.array_min(
        F.collect_list("close_price").over(ts.last(7)))
    return tidy(df.select("ticker", "trade_date", spread.alias("value")))


QUERIES["u03_rolling_function"] = _rolling_user
ORACLES["u03_rolling_function"] = (
    f"with {TRADED}\nselect ticker, trade_date, {out(f'max(close_price) {w(7)} - min(close_price) {w(7)}')} as value"
    " from traded")
QUERIES["u04_post_hook"] = lambda spark, sf_dir: tidy(m.post_hook(
    m.momentum(d.traded(spark, sf_dir), "mom", 5, "close_price"), lambda df: df.na.drop("any"))
    .select("ticker", "trade_date", "mom"))
ORACLES["u04_post_hook"] = (
    f"with {TRADED}, q as (select ticker, trade_date, close_price / lag(close_price, 5) {TSW} - 1 as mom from traded)\n"
    f"select ticker, trade_date, {out('mom')} as mom from q where mom is not null")
