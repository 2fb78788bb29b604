"""Queries for ranking, selection and portfolio analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import xs
from ..operators import calendar as cal
from ..operators import filters, portfolio, ranking
from ..operators import metrics as m
from ..operators.ranking import RankFactor
from ..sources import driver_tables as d
from ..sources.scratch import written
from .common import tidy
from .metrics import EQUITY, HFQ, w
from .relational import CALENDAR, CHOICE
from .sql import TRADED, alike, out, sig

QUERIES, ORACLES = {}, {}

FACTORS = [RankFactor("bias6", False, 1), RankFactor("turnover_rate", True, 2)]
START, END, EVERY, POSITIONS, FEE = "1995-06-05", "2001-10-29", 4, 5, 0.002


def add(name, sql, ctes=""):
    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: tidy(fn(spark, sf_dir))
        ORACLES[name] = f"with {TRADED}{ctes}\n{sql}"
        return fn
    return register


def _signals(spark, sf, prices=False):
    """Traded bars with back-adjusted prices and the 6-row bias."""
    full = m.back_adjust(d.bars(spark, sf))
    if prices:
        full = portfolio.last_traded_price(full)
    return _signals_of(full)


def _signals_of(full):
    return m.bias(filters.drop_suspended(full), "bias6", 6)


SIGNALS = HFQ + f""",
sig as (select *, case when count(*) {w(6)} >= 5 then
    hfq_close_price / avg(hfq_close_price) {w(6)} - 1 end as bias6 from adjt)"""


def _max_rank(x, part, desc=False):
    x = sig(x)
    return (f"case when {x} is not null then (rank() over (partition by {part} order by {x} {'desc' if desc else ''}"
            f" nulls last) + count(*) over (partition by {part}, {x}) - 1)::double end")


def ranked_ctes(source: str, out_name="ranked", part="trade_date") -> str:
    return f""",
{out_name}_a as (select *,
    100 * {_max_rank('bias6', part, True)} / count(bias6) over (partition by {part}) as s1,
    100 * {_max_rank('turnover_rate', part)} / count(turnover_rate) over (partition by {part}) as s2 from {source}),
{out_name}_b as (select *, (s1 + 2 * s2) / 3 as blend from {out_name}_a),
{out_name}_c as (select *, 100 * {_max_rank('blend', part)} / count(blend) over (partition by {part}) as xrank
  from {out_name}_b),
{out_name} as (select *, case when xrank is not null then
    rank() over (partition by {part} order by {sig("xrank")} desc nulls last)
    + (count(*) over (partition by {part}, {sig("xrank")}) - 1) / 2.0::double end as rnk from {out_name}_c)"""


RANKED = SIGNALS + ranked_ctes("sig")
RANK_COLUMNS = ["ticker", "trade_date", "bias6_subrank", "turnover_rate_subrank", "xrank", "rank"]
RANK_SQL = (f"select ticker, trade_date, {out('s1')} as bias6_subrank, {out('s2')} as turnover_rate_subrank,"
            f" {out('xrank')} as xrank, {out('rnk')} as rank")


@add("b01_rank", f"{RANK_SQL} from ranked", RANKED)
def _(spark, sf):
    return ranking.rank(_signals(spark, sf), FACTORS).select(*RANK_COLUMNS)


@add("b02_rank_subset", f"{RANK_SQL} from ranked",
     SIGNALS + ", part as (select * from sig where exchange_cd = 'XSHE' and chg_pct < 0.5)" + ranked_ctes("part"))
def _(spark, sf):
    return ranking.rank_subset(_signals(spark, sf), FACTORS, "exchange_cd = 'XSHE' and chg_pct < 0.5").select(
        *RANK_COLUMNS)


@add("b03_append_rankfactor", f"select ticker, trade_date, {out('xr')} as xrank from (select ticker, trade_date, "
     f"100 * {_max_rank('deal_amount', 'trade_date')} / count(*) over (partition by trade_date) as xr from traded)")
def _(spark, sf):
    df = d.traded(spark, sf)
    factors = ranking.append_rankfactor(df, [], RankFactor("deal_amount"))
    return ranking.rank(df, factors).select("ticker", "trade_date", "xrank")


@add("b04_daily_choice", f"{RANK_SQL} from ranked", EQUITY + CHOICE + SIGNALS + """,
part as (select s.* from sig s where ticker in (select ticker from equity where list_sector_cd in ('1', '2'))
    or exists (select 1 from choice c where c.ticker = s.ticker and c.sale_date = s.trade_date))"""
     + ranked_ctes("part"))
def _(spark, sf):
    panel = d.bars_once(spark, sf)
    bars = written(_signals_of(m.back_adjust(panel)), "signals")
    pool = filters.in_pool(bars, filters.instruments(d.equity(spark, sf), sectors=["1", "2"]))
    held = d.choice_of(panel).select("ticker", F.col("sale_date").alias("trade_date"))
    return ranking.daily_choice(pool, held, bars, FACTORS).select(*RANK_COLUMNS)


@add("b05_trade_flags", "select ticker, trade_date, coalesce(rnk <= 8 and chg_pct > -0.098, false) as is_buy,"
     " coalesce((starts_with(sec_short_name, '*ST') or rnk >= 20) and not chg_pct > 0.098, false) as sells"
     " from ranked", RANKED)
def _(spark, sf):
    flags = filters.trade_flags(ranking.rank(_signals(spark, sf), FACTORS), ["rank <= 8", "chg_pct > -0.098"],
                                ["startswith(sec_short_name, '*ST')", "rank >= 20"], ["chg_pct > 0.098"])
    return flags.select("ticker", "trade_date", "is_buy", F.expr("is_sale and not is_hold").alias("sells"))


ORACLES["b05_trade_flags"] = ORACLES["b05_trade_flags"].replace(
    "coalesce((starts_with(sec_short_name, '*ST') or rnk >= 20) and not chg_pct > 0.098, false)",
    "coalesce(starts_with(sec_short_name, '*ST') or rnk >= 20, false) and not coalesce(chg_pct > 0.098, false)")


@add("b06_top10_by_bias", f"""select ticker, trade_date, {out('bias6')} as bias6, {out('r')} as bias_rank from (
    select *, row_number() over (partition by trade_date order by r, ticker) as n from (
      select *, rank() over (partition by trade_date order by {sig('bias6')} desc)
        + (count(*) over (partition by trade_date, {sig('bias6')}) - 1) / 2.0::double as r
      from sig where bias6 is not null)) where n <= 10""", SIGNALS)
def _(spark, sf):
    df = _signals(spark, sf).where("bias6 is not null").withColumn("bias_rank", xs.rank("bias6", False))
    return ranking.top_n(df, 10, ["bias_rank", "ticker"]).select("ticker", "trade_date", "bias6", "bias_rank")


def _rebalance(spark, sf):
    return cal.rebalance_dates(d.trade_calendar(spark, sf), START, END, EVERY)


REBALANCE = CALENDAR + f""",
opens as (select calendar_date as dt, row_number() over (order by calendar_date) - 1 as i from cal
  where is_open and calendar_date between date '{START}' and date '{END}'),
reb as (select cast(i // {EVERY} as int) as period, dt, lead(dt) over (order by dt) as end_date from opens
  where i % {EVERY} = 0)"""


@add("b07_rebalance_dates", "select period, dt as trade_date, end_date, count(b.ticker) as bars from reb"
     " left join bars b on b.trade_date = dt group by all", REBALANCE)
def _(spark, sf):
    return (_rebalance(spark, sf).join(d.bars(spark, sf), "trade_date", "left")
            .groupBy("period", "trade_date", "end_date").agg(F.count("ticker").alias("bars")))


def _held(spark, sf):
    """Best ranked tickers of every rebalance date, with the return until the next one."""
    full = portfolio.last_traded_price(m.back_adjust(d.bars(spark, sf)))
    signals = m.bias(filters.drop_suspended(full), "bias6", 6)
    reb = _rebalance(spark, sf)
    dated = signals.join(reb.where("end_date is not null"), "trade_date")
    picks = (ranking.top_n(ranking.rank(dated, FACTORS).where("rank is not null and chg_pct > -0.5"), POSITIONS)
             .select(F.lit("bias").alias("strategy"), "period", "ticker", "trade_date", "end_date", "px"))
    prices = portfolio.period_prices(full.select("ticker", "trade_date", "px"),
                                     cal.period_of_dates(d.trade_calendar(spark, sf), reb))
    return portfolio.period_returns(picks, prices)


HELD = REBALANCE + SIGNALS + """,
dated as (select s.*, r.period, r.end_date from sig s join reb r on r.dt = s.trade_date
  where r.end_date is not null)""" + ranked_ctes("dated") + f""",
picks as (select * from (select *, row_number() over (partition by trade_date order by rnk, ticker) as n from ranked
    where rnk is not null and chg_pct > -0.5) where n <= {POSITIONS}),
held0 as (select p.period, p.ticker, p.trade_date, p.end_date, p.hfq_close_price as px,
    coalesce((select a.hfq_close_price from adj a where a.ticker = p.ticker and a.open_price > 0
      and a.trade_date > p.trade_date and a.trade_date <= p.end_date order by a.trade_date desc limit 1),
      p.hfq_close_price) as end_px from picks p),
held as (select *, end_px / px - 1 as ret,
    coalesce(lead(period) over (partition by ticker order by period) = period + 1, false)
      or period = (select max(period) from held0) as kept from held0),
pret as (select period, trade_date, end_date, count(*) as positions,
    avg(ret - case when kept then 0 else {FEE}::double * (1 + ret) end) as ret from held group by all),
nav as (select *, product(1 + ret) over (order by period) as net from pret),
curve as (select *, net / max(net) over (order by period) - 1 as drawdown from nav)"""


@add("b08_period_returns", f"select period, ticker, trade_date, end_date, {out('px')} as px, {out('end_px')} as end_px,"
     f" {out('ret')} as ret from held", HELD)
def _(spark, sf):
    return _held(spark, sf).select("period", "ticker", "trade_date", "end_date", "px", "end_px", "ret")


@add("b09_portfolio_returns", f"select period, trade_date, end_date, positions, {out('ret')} as ret from pret", HELD)
def _(spark, sf):
    return portfolio.portfolio_returns(_held(spark, sf), FEE).select("period", "trade_date", "end_date", "positions",
                                                                     "ret")


@add("b09_weighted_returns", "select period, trade_date, end_date, positions, " + out("ret") + " as ret from ("
     "select period, trade_date, end_date, count(*) as positions, sum((1 + ticker % 3) * (ret - case when kept then 0 else"
     f" {FEE}::double * (1 + ret) end)) / sum(1 + ticker % 3) as ret from held group by all)", HELD)
def _(spark, sf):
    held = _held(spark, sf).withColumn("weight", F.expr("1D + ticker % 3"))
    return portfolio.portfolio_returns(held, FEE, "weight").select("period", "trade_date", "end_date", "positions", "ret")


@add("b06_affordable", f"""select trade_date, period, ticker, {out('balance')} as balance from (
    select *, row_number() over (partition by trade_date order by rnk, ticker) as n, 20000.0::double + 3500 * (period % 9) as balance
    from ranked where rnk is not null and chg_pct > -0.5)
  where n <= floor(balance / 10000) + case when balance - floor(balance / 10000) * 10000 >= 6000 then 1 else 0 end""",
     REBALANCE + SIGNALS + """,
dated as (select s.*, r.period, r.end_date from sig s join reb r on r.dt = s.trade_date)""" + ranked_ctes("dated"))
def _(spark, sf):
    """What a balance that differs by rebalance date buys of the candidates left after exclusions."""
    signals = m.bias(filters.drop_suspended(portfolio.last_traded_price(m.back_adjust(d.bars(spark, sf)))), "bias6", 6)
    dated = signals.join(_rebalance(spark, sf), "trade_date").withColumn("balance", F.expr("20000D + 3500 * (period % 9)"))
    candidates = ranking.rank(dated, FACTORS).where("rank is not null and chg_pct > -0.5")
    return ranking.affordable(candidates, "balance", 10000, 6000).select("trade_date", "period", "ticker", "balance")


def _nav(spark, sf):
    return portfolio.net_value(portfolio.portfolio_returns(_held(spark, sf), FEE))


@add("b10_net_value", f"select period, {out('net')} as net from nav", HELD)
def _(spark, sf):
    return _nav(spark, sf).select("period", "net")


@add("b11_drawdown", f"select period, {out('net')} as net, {out('drawdown')} as drawdown from curve", HELD)
def _(spark, sf):
    return portfolio.drawdown(_nav(spark, sf)).select("period", "net", "drawdown")


def _summary(column, sql):
    @add(column, f"select {out(sql)} as value from curve", HELD)
    def _(spark, sf):
        s = portfolio.summary(portfolio.drawdown(_nav(spark, sf)))
        return s.select(F.col(column.split("_", 1)[1]).alias("value"))


_summary("b12_max_drawdown", "coalesce(min(drawdown) * 100, 0)")
_summary("b13_max_roi", "max(net)")
_summary("b14_roi", "arg_max(net, period)")
_summary("b15_annual_roi", "pow(arg_max(net, period), 365.0 / (max(end_date) - min(trade_date))) - 1")

RUNS = HELD + """,
runs as (select ticker, min(period) as first_period, max(period) as last_period, min(trade_date) as buy_date,
    max(end_date) as sale_date, arg_min(px, period) as buy_price, arg_max(end_px, period) as sale_price
  from (select *, period - row_number() over (partition by ticker order by period) as grp from held)
  group by ticker, grp),
closed as (select *, sale_price / buy_price - 1 as chg from runs
  where last_period < (select max(last_period) from runs))"""


@add("b16_spells", "select ticker, first_period, last_period, buy_date, sale_date,"
     f" cast(sale_date - buy_date as int) as hold_days, {out('buy_price')} as buy_price from runs", RUNS)
def _(spark, sf):
    return portfolio.spells(_held(spark, sf)).select("ticker", "first_period", "last_period", "buy_date", "sale_date",
                                                     "hold_days", "buy_price")


@add("b17_closed_trades", f"select ticker, buy_date, sale_date, {out('buy_price')} as buy_price,"
     f" {out('sale_price')} as sale_price, {out('chg')} as chg_pct, cast(sale_date - buy_date as int) as hold_days"
     " from closed", RUNS)
def _(spark, sf):
    return portfolio.closed_trades(portfolio.spells(_held(spark, sf))).select(
        "ticker", "buy_date", "sale_date", "buy_price", "sale_price", "chg_pct", "hold_days")


@add("b18_cooldown", "select * from (select t.ticker, t.trade_date, cast(coalesce(t.trade_date - max(c.sale_date),"
     " 100000) as int) as sale_days from traded t left join closed c on c.ticker = t.ticker"
     " and c.sale_date <= t.trade_date group by t.ticker, t.trade_date) where sale_days >= 30", RUNS)
def _(spark, sf):
    sales = portfolio.closed_trades(portfolio.spells(_held(spark, sf))).select("ticker", "sale_date")
    return portfolio.after_cooldown(d.traded(spark, sf).select("ticker", "trade_date"), sales, 30).select(
        "ticker", "trade_date", "sale_days")


@add("b19_small_cap_monthly", f"""select start_date, trade_date, {out('all_next')} as all_next,
  {out('small_next')} as small_next, tickers,
  {out('product(1 + all_next) over l')} as line_all, {out('product(1 + small_next) over l')} as line_small
from days window l as (partition by start_date order by trade_date rows unbounded preceding)""", CALENDAR + f""",
daily as (select s.start_date, b.ticker, b.trade_date, b.is_open, b.market_value, b.chg_pct,
    product(1 + b.chg_pct) over mo - 1 as month_ret, count(case when b.is_open then 1 end) over mo as open_days
  from bars b join (values (date '1995-01-01'), (date '1997-01-01'), (date '1999-01-01')) s(start_date)
    on b.trade_date > s.start_date
  window mo as (partition by s.start_date, b.ticker, date_trunc('month', b.trade_date) order by b.trade_date)),
ends as (select * from (select daily.*, coalesce(lead(month_ret) over (partition by start_date, ticker
      order by trade_date), month_ret) as next_ret
    from daily join cal on calendar_date = trade_date where is_month_end)
  where is_open and open_days >= 2 and chg_pct <= 0.5),
marked as (select *, rank() over d + (count(*) over (partition by start_date, trade_date, {sig('market_value')}) - 1)
    / 2.0::double <= 5 as small from ends window d as (partition by start_date, trade_date order by
    {sig('market_value')})),
days as (select start_date, trade_date, avg(next_ret) as all_next, avg(case when small then next_ret end) as small_next,
    coalesce(string_agg(case when small then ticker::varchar end, ' ' order by ticker::varchar), '') as tickers
  from marked group by all)""")
def _(spark, sf):
    return portfolio.small_cap_monthly(d.bars(spark, sf), d.trade_calendar(spark, sf),
                                       ["1995-01-01", "1997-01-01", "1999-01-01"], 5, min_open_days=2, max_change=0.5)


@add("b22_export_ledger", f"select c.ticker, c.trade_date as buy_date, c.sale_date, {out('b.close_price')} as buy_close,"
     f" {out('s.close_price')} as sale_close, {out('s.close_price / b.close_price - 1')} as chg_pct,"
     f" abs(c.buy_price - b.close_price) <= {alike('c.buy_price', 'b.close_price')} as price_matches from choice c"
     " left join bars b on b.ticker = c.ticker and b.trade_date = c.trade_date"
     " left join bars s on s.ticker = c.ticker and s.trade_date = c.sale_date", CHOICE)
def _(spark, sf):
    bars = d.bars_once(spark, sf)
    trades = d.choice_of(bars).withColumnRenamed("trade_date", "buy_date")
    return portfolio.export_ledger(trades, bars).select(
        "ticker", "buy_date", "sale_date", "buy_close", "sale_close", "chg_pct", "price_matches")
