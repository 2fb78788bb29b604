"""Queries for scans, filters, joins, aggregations, sorts, set operations and the calendar."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import ts
from ..operators import calendar as cal
from ..operators import choices, filters, joins
from ..operators import metrics as m
from ..sources import choice_files, readers
from ..sources import driver_tables as d
from ..sources.store import long_form, null_audit
from .common import tidy
from .metrics import EQUITY, K60, PS, TSW, w
from .sql import TRADED, out

QUERIES, ORACLES = {}, {}
BAR = ["ticker", "trade_date", "open_price", "close_price", "turnover_vol"]
BAR_SQL = (f"ticker, trade_date, {out('open_price')} as open_price, {out('close_price')} as close_price,"
           f" {out('turnover_vol')} as turnover_vol")
CALENDAR = """,
cal as (select cast(c as date) as calendar_date, isodow(c) = 1 as is_open,
    isodow(c) = 1 and month(c + interval 7 day) <> month(c) as is_month_end
  from (select unnest(generate_series(date_trunc('week', min(l_shipdate)), date_trunc('week', max(l_shipdate)) + interval 6 day,
    interval 1 day)) as c from lineitem))"""
CHOICE = """,
choice as (select ticker, trade_date, trade_date + 21 as sale_date, close_price as buy_price
  from bars, (values (1), (2)) c(copy)
  where (ticker * 13 + wk) % 97 = 0 and (copy = 1 or (ticker = 3 and wk < 97)))"""


def add(name, sql, ctes=""):
    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: tidy(fn(spark, sf_dir))
        ORACLES[name] = f"with {TRADED}{ctes}\n{sql}"
        return fn
    return register


# ---- scans

@add("s01_bar_scan", f"select {BAR_SQL} from bars where trade_date between date '1997-01-01' and date '1998-12-31'")
def _(spark, sf):
    return readers.bars(d.bars(spark, sf, start="1997-01-01", end="1998-12-31").select(*BAR), "1997-01-01", "1998-12-31")


@add("s02_instruments", "select ticker, case when ticker % 4 = 0 then 'ETF' else 'LOF' end as etf_lof"
     " from equity where ticker % 4 = 0", EQUITY)
def _(spark, sf):
    return readers.instruments(d.fund(spark, sf), funds=True)


@add("s03_fund_bars", f"select {BAR_SQL} from bars where ticker % 4 = 0"
     " and trade_date between date '1996-01-01' and date '1999-12-31'")
def _(spark, sf):
    return readers.bars(d.fund_day(spark, sf, "1996-01-01", "1999-12-31").select(*BAR), "1996-01-01", "1999-12-31")


@add("s04_calendar", "select trade_date, is_open, is_month_end from (select distinct trade_date from bars)"
     " join cal on calendar_date = trade_date", CALENDAR)
def _(spark, sf):
    days = d.bars(spark, sf).select("trade_date").distinct()
    c = readers.calendar(d.trade_calendar(spark, sf))
    return days.join(c.withColumnRenamed("calendar_date", "trade_date"), "trade_date").select(
        "trade_date", "is_open", "is_month_end")


@add("s05_fundamentals", f"select ticker, end_date, pub as publish_date, {out('e')} as basic_eps,"
     f" {out('fcf')} as fcf_fps from ps", PS)
def _(spark, sf):
    return readers.fundamentals(d.ps_pit(spark, sf)).select("ticker", "end_date", "publish_date", "basic_eps",
                                                            "fcf_fps")


@add("s06_intraday", f"select ticker, trade_date, {out('kclose')} as close from k60"
     " where trade_date between date '1996-01-01' and date '1999-12-31'", K60)
def _(spark, sf):
    return readers.intraday(d.k60(spark, sf, "1996-01-01", "1999-12-31"), "1996-01-01", "1999-12-31")


def _log_lines(spark, sf):
    """Free-text export lines made from the choices; years moved to the 2020s, as the patterns expect."""
    c = d.choice(spark, sf).select("*", F.expr(
        "concat('202', substring(cast(trade_date as string), 4))").alias("day"))
    price = F.format_string("%.2f", F.round("buy_price", 2))
    return c.select(F.concat(
        F.col("ticker").cast("string"), F.lit("股票 ("), F.lpad(F.col("ticker").cast("string"), 6, "0"),
        F.lit(") 汽车 -- 零部件 "), "day", F.lit(" "), "day", F.lit(" "), price, F.lit(" "), price, F.lit(" -5.00%"),
    ).alias("value"))


@add("s08_log_cleaning",
     "select ticker::int as seq, '股票' as name, lpad(ticker::varchar, 6, '0') as ticker, '汽车' as industry,"
     " '零部件' as sub_industry, cast('202' || substr(trade_date::varchar, 4) as date) as buy_date,"
     " cast('202' || substr(trade_date::varchar, 4) as date) as sale_date,"
     f" {out('round(buy_price, 2)')} as buy_price, {out('round(buy_price, 2)')} as sale_price, '-5.00%' as change"
     " from choice", CHOICE)
def _(spark, sf):
    return choice_files.parse_log(choice_files.clean_log(_log_lines(spark, sf)))


@add("s08_too_long", "select ticker::int as seq, count(*) as lines from choice where ticker % 5 = 0 group by ticker", CHOICE)
def _(spark, sf):
    """Lines with two fields too many, as the report lists them."""
    twice = F.when(F.col("value").rlike("^[0-9]*[05]股票"), F.concat("value", F.lit(" 1.00 2.00 3.00"))).otherwise(F.col("value"))
    cleaned = choice_files.clean_log(_log_lines(spark, sf).select(twice.alias("value")))
    seq = F.regexp_extract("line", "^([0-9]+),", 1).cast("int")
    return choice_files.too_long(cleaned).groupBy(seq.alias("seq")).agg(F.count(F.lit(1)).alias("lines"))


@add("s10_long_metrics", " union all ".join(
    f"select ticker, trade_date, '{n}' as metric, {out(c)} as value from traded"
    for n, c in (("ma5", f"avg(close_price) {w(5)}"), ("ep", "1 / nullif(pe, 0)"))))
def _(spark, sf):
    df = m.ep(m.ma_any(d.traded(spark, sf), "ma5", 5, "close_price"), "ep")
    return long_form(df, ["ma5", "ep"])


# ---- filters and projections

@add("p01_drop_suspended", f"select {BAR_SQL} from bars where open_price > 0")
def _(spark, sf):
    return filters.drop_suspended(d.bars(spark, sf)).select(*BAR)


@add("p02_pool", f"select {BAR_SQL} from bars where ticker in (select ticker from equity where list_sector_cd"
     " in ('1', '2'))", EQUITY)
def _(spark, sf):
    pool = filters.instruments(d.equity(spark, sf), sectors=["1", "2"])
    return filters.in_pool(d.bars(spark, sf), pool).select(*BAR)


@add("p03_date_range", f"select {BAR_SQL} from bars where trade_date >= date '1999-06-01'")
def _(spark, sf):
    return filters.date_range(d.bars(spark, sf, start="1999-06-01"), "1999-06-01").select(*BAR)


@add("p04_conditions", f"select {BAR_SQL} from bars where open_price > 0 and open_price < 1500 and chg_pct < 0.5"
     " and chg_pct > -0.5")
def _(spark, sf):
    return filters.select_where(d.bars(spark, sf), "open_price > 0", "open_price < 1500", "chg_pct < 0.5",
                                "chg_pct > -0.5").select(*BAR)


@add("p05_names", "select ticker, trade_date, sec_short_name from bars where not starts_with(sec_short_name, 'ST')"
     " and not starts_with(sec_short_name, '*ST') and not contains(sec_short_name, '3')")
def _(spark, sf):
    return (d.bars(spark, sf).where(filters.not_special() & ~F.col("sec_short_name").contains("3"))
            .select("ticker", "trade_date", "sec_short_name"))


@add("p06_numeric", f"select {BAR_SQL} from traded join equity using (ticker) where neg_market_value < 2000000000"
     " and date_diff('day', list_date, trade_date) + 1 between 365 and 2000 and abs(chg_pct) < 0.8", EQUITY)
def _(spark, sf):
    df = m.list_days(d.traded(spark, sf), "list_days", d.equity(spark, sf))
    return filters.select_where(df, "neg_market_value < 2000000000", "list_days between 365 and 2000",
                                "chg_pct < 0.8", "chg_pct > -0.8").select(*BAR)


@add("p07_instrument_pool", "select ticker, list_date, list_sector_cd from equity where exchange_cd = 'XSHG'"
     " and list_sector_cd in ('1', '2')", EQUITY)
def _(spark, sf):
    return filters.instruments(d.equity(spark, sf), "XSHG", ["1", "2"]).select("ticker", "list_date", "list_sector_cd")


def _window_ratio(n):
    return f"sum(turnover_vol) {w(n)} / nullif(sum(turnover_vol) {w(2 * n)} - sum(turnover_vol) {w(n)}, 0)"


@add("p08_trade_flags",
     "select ticker, trade_date, coalesce(r <= 8 and chg_pct > -0.098, false) as is_buy,"
     " coalesce(starts_with(sec_short_name, '*ST') or vr > 3 or r >= 20, false) as is_sale,"
     " coalesce(chg_pct > 0.098, false) as is_hold from q",
     f", q as (select *, {_window_ratio(5)} as vr, rank() over (partition by trade_date order by deal_amount desc)"
     " + (count(*) over (partition by trade_date, deal_amount) - 1) / 2.0::double as r from traded)")
def _(spark, sf):
    df = m.rank(m.vol_rate(d.traded(spark, sf), "ma5_vol_rate", 5), "rank", "deal_amount", False)
    return (filters.trade_flags(df, ["rank <= 8", "chg_pct > -0.098"],
                                ["startswith(sec_short_name, '*ST')", "ma5_vol_rate > 3", "rank >= 20"],
                                ["chg_pct > 0.098"])
            .select("ticker", "trade_date", "is_buy", "is_sale", "is_hold"))


@add("p09_one_day", f"select {BAR_SQL} from bars where trade_date = date '1998-03-02'")
def _(spark, sf):
    return filters.one_day(d.bars(spark, sf, start="1998-03-02", end="1998-03-02"), "1998-03-02").select(*BAR)


@add("p10_complete_rows", f"select ticker, trade_date, {out('v')} as v60, {out('e')} as ep from"
     f" (select *, case when count(*) {w(60)} >= 60 then stddev_samp(chg_pct) {w(60)} end as v,"
     " 1 / nullif(pe, 0) as e from traded) where v is not null and e is not null")
def _(spark, sf):
    df = m.ep(m.roi_volat(d.traded(spark, sf), "v60", 60), "ep").select("ticker", "trade_date", "v60", "ep")
    return filters.complete_rows(df)


@add("p11_fill_missing", f"select ticker, trade_date, {out('coalesce(1 / nullif(pe, 0), 0)')} as ep from traded")
def _(spark, sf):
    return m.ep(d.traded(spark, sf), "ep").withColumn("ep", filters.fill_missing("ep")).select(
        "ticker", "trade_date", "ep")


@add("p12_percent_change", "select ticker, trade_date, coalesce(round_even((close_price - p) / nullif(p, 0) * 100, 2),"
     f" 0) as pct from (select *, lag(close_price) {TSW} as p from traded)")
def _(spark, sf):
    return filters.percent_change(d.traded(spark, sf), "pct").select("ticker", "trade_date", "pct")


ORACLES["p12_percent_change"] = ORACLES["p12_percent_change"].replace(
    "coalesce(round_even((close_price - p) / nullif(p, 0) * 100, 2), 0)",
    out("coalesce(round_even((close_price - p) / nullif(p, 0) * 100, 2), 0)"))


@add("p13_existed_for", "select ticker, trade_date, sale_date from (select *, max(trade_date) over p"
     " - min(trade_date) over p as span from choice window p as (partition by ticker)) where span >= 2000", CHOICE)
def _(spark, sf):
    return filters.existed_for(d.choice(spark, sf), 2000).select("ticker", "trade_date", "sale_date")


@add("p14_manifest_view", f"select ticker, sec_short_name, trade_date, {out('close_price')} as close_price,"
     f" {out('chg_pct')} as chg_pct, deal_amount from bars")
def _(spark, sf):
    return filters.manifest_view(d.bars(spark, sf).select("deal_amount", "chg_pct", "trade_date", "close_price",
                                                          "ticker", "sec_short_name"))


@add("p15_dedup_choices", f"select ticker, trade_date, sale_date, {out('buy_price')} as buy_price from"
     " (select distinct * from choice)", CHOICE)
def _(spark, sf):
    return choices.dedup(d.choice(spark, sf), ["sale_date", "buy_price"])


@add("p16_month_key", "select ticker, trade_date, cast(year(trade_date) * 100 + month(trade_date) as int)"
     " as trade_month from bars")
def _(spark, sf):
    return d.bars(spark, sf).select("ticker", "trade_date", filters.month_key().alias("trade_month"))


# ---- joins

@add("j02_list_date", "select ticker, trade_date, list_date from traded left join equity using (ticker)", EQUITY)
def _(spark, sf):
    return joins.with_list_date(d.traded(spark, sf), d.equity(spark, sf)).select("ticker", "trade_date", "list_date")


@add("j03_unmatched", "select ticker, trade_date from traded t where not exists"
     " (select 1 from equity e where e.ticker = t.ticker)", EQUITY)
def _(spark, sf):
    return joins.unmatched(d.traded(spark, sf), d.equity(spark, sf)).select("ticker", "trade_date")


@add("j04_choice_bars", f"select c.ticker, c.trade_date, c.sale_date, {out('t.open_price')} as open_price,"
     f" {out('t.turnover_vol')} as turnover_vol from choice c left join traded t using (ticker, trade_date)", CHOICE)
def _(spark, sf):
    return joins.choice_with_bars(d.choice(spark, sf), d.traded(spark, sf)).select(
        "ticker", "trade_date", "sale_date", "open_price", "turnover_vol")


@add("j05_pool_count", "select c.ticker, c.trade_date, n as select_equ_count from choice c left join"
     " (select trade_date, count(*) as n from traded group by 1) p using (trade_date)", CHOICE)
def _(spark, sf):
    return (d.choice(spark, sf).join(joins.pool_count(d.traded(spark, sf)), "trade_date", "left")
            .select("ticker", "trade_date", "select_equ_count"))


_LATEST = PS + """,
latest as (select * from (select *, row_number() over (partition by ticker order by pub desc, end_date desc) as n
  from ps) where n = 1)"""


@add("j06_latest_fundamentals", f"select c.ticker, c.trade_date, l.end_date, l.pub as publish_date, {out('l.e')}"
     " as basic_eps from choice c left join latest l using (ticker)", CHOICE + _LATEST)
def _(spark, sf):
    latest = joins.latest_per_ticker(d.ps_pit(spark, sf)).select("ticker", "end_date", "publish_date", "basic_eps")
    return d.choice(spark, sf).join(latest, "ticker", "left").select("ticker", "trade_date", "end_date",
                                                                      "publish_date", "basic_eps")


@add("j07_fundamentals_as_of", f"select t.ticker, t.trade_date, p.end_date, {out('p.e')} as basic_eps from traded t"
     " left join lateral (select end_date, e from ps where ps.ticker = t.ticker and ps.pub <= t.trade_date"
     " order by pub desc, end_date desc limit 1) p on true", PS)
def _(spark, sf):
    panel = d.bars_once(spark, sf).where("open_price > 0").select("ticker", "trade_date")
    return joins.fundamentals_as_of(panel, d.ps_pit(spark, sf), ["end_date", "basic_eps"])


@add("j08_intraday", f"select ticker, trade_date, {out('kclose')} as close_60 from traded left join k60"
     " using (ticker, trade_date)", K60)
def _(spark, sf):
    return joins.with_intraday(d.traded(spark, sf), d.k60(spark, sf)).select("ticker", "trade_date", "close_60")


@add("j09_month_ends", f"select ticker, trade_date, cast(year(trade_date) * 100 + month(trade_date) as int)"
     f" as trade_month, {out('close_price')} as close_price from bars join cal on calendar_date = trade_date"
     " where is_month_end", CALENDAR)
def _(spark, sf):
    return joins.month_ends(d.bars(spark, sf), d.trade_calendar(spark, sf)).select(
        "ticker", "trade_date", "trade_month", "close_price")


@add("j10_benchmark", f"select ticker, trade_date, {out('bo')} as bench_open, {out('bc')} as bench_close from bars"
     " left join (select trade_date, avg(open_price) as bo, avg(close_price) as bc from traded group by 1)"
     " using (trade_date)")
def _(spark, sf):
    return joins.with_benchmark(d.bars(spark, sf), d.benchmark(spark, sf)).select(
        "ticker", "trade_date", "bench_open", "bench_close")


@add("j11_exclude", f"select {BAR_SQL} from traded t where not exists (select 1 from choice c"
     " where c.ticker = t.ticker and c.trade_date = t.trade_date)", CHOICE)
def _(spark, sf):
    return joins.exclude(d.traded(spark, sf), d.choice(spark, sf), ("ticker", "trade_date")).select(*BAR)


@add("j12_last_sale", "select t.ticker, t.trade_date, cast(coalesce(t.trade_date - max(c.sale_date), 100000) as int)"
     " as sale_days from traded t left join choice c on c.ticker = t.ticker and c.sale_date <= t.trade_date"
     " group by t.ticker, t.trade_date", CHOICE)
def _(spark, sf):
    bars = d.bars_once(spark, sf)
    return joins.with_sale_days(bars.where("open_price > 0").select("ticker", "trade_date"),
                                d.choice_of(bars).select("ticker", "sale_date"))


@add("b20_choice_enrichment", f"select c.ticker, c.trade_date, {out('t.close_price')} as close_price, p.n as"
     f" select_equ_count, l.end_date, {out('l.e')} as basic_eps, {out('l.fcf')} as fcf_fps"
     " from (select distinct * from choice) c left join traded t using (ticker, trade_date)"
     " left join (select trade_date, count(*) as n from traded group by 1) p using (trade_date)"
     " left join latest l on l.ticker = c.ticker", CHOICE + _LATEST)
def _(spark, sf):
    bars = d.bars_once(spark, sf)
    unique = choices.dedup(d.choice_of(bars), ["sale_date", "buy_price"])
    return choices.enrich(unique, bars.where("open_price > 0"), d.ps_pit(spark, sf)).select(
        "ticker", "trade_date", "close_price", "select_equ_count", "end_date", "basic_eps", "fcf_fps")


# ---- aggregations

@add("a01_universe_size", "select trade_date, count(*) as select_equ_count from traded group by trade_date")
def _(spark, sf):
    return joins.pool_count(d.traded(spark, sf))


@add("a02_row_of_maximum", f"select ticker, arg_max(trade_date, (turnover_vol, trade_date)) as trade_date,"
     f" {out('max(turnover_vol)')} as turnover_vol from bars group by ticker")
def _(spark, sf):
    top = F.max(F.struct("turnover_vol", "trade_date")).alias("top")
    return d.bars(spark, sf).groupBy("ticker").agg(top).select("ticker", "top.trade_date", "top.turnover_vol")


@add("a03_distinct_tickers", "select exchange_cd, count(distinct ticker) as tickers from bars group by exchange_cd")
def _(spark, sf):
    return d.bars(spark, sf).groupBy("exchange_cd").agg(F.count_distinct("ticker").alias("tickers"))


@add("a04_mean_selected", f"select trade_date, {out('avg(chg_pct)')} as all_chg,"
     f" {out('avg(case when market_value < 3000000000 then chg_pct end)')} as small_chg from bars group by trade_date")
def _(spark, sf):
    small = F.when(F.col("market_value") < 3e9, F.col("chg_pct"))
    return d.bars(spark, sf).groupBy("trade_date").agg(F.avg("chg_pct").alias("all_chg"),
                                                       F.avg(small).alias("small_chg"))


@add("a05_ticker_list", "select trade_date, string_agg(ticker::varchar, ' ' order by ticker::varchar) as tickers"
     " from traded where chg_pct > 0.5 group by trade_date")
def _(spark, sf):
    names = F.array_join(F.array_sort(F.collect_list(F.col("ticker").cast("string"))), " ")
    return d.traded(spark, sf).where("chg_pct > 0.5").groupBy("trade_date").agg(names.alias("tickers"))


@add("a06_max_min_last", f"select ticker, {out('max(close_price)')} as hi, {out('min(close_price)')} as lo,"
     f" {out('arg_max(close_price, trade_date)')} as last from bars group by ticker")
def _(spark, sf):
    return d.bars(spark, sf).groupBy("ticker").agg(
        F.max("close_price").alias("hi"), F.min("close_price").alias("lo"),
        F.max_by("close_price", "trade_date").alias("last"))


@add("a07_null_audit", f"select count(*) - count(v) as v60, count(*) - count(m) as mom20, count(*) - count(p) as p21"
     f" from (select case when count(*) {w(60)} >= 60 then stddev_samp(chg_pct) {w(60)} end as v,"
     f" close_price / lag(close_price, 20) {TSW} - 1 as m,"
     f" case when count(*) {w(21)} >= 21 then 1 end as p from traded)")
def _(spark, sf):
    df = m.momentum(m.roi_volat(d.traded(spark, sf), "v60", 60), "mom20", 20, "close_price")
    return null_audit(df.withColumn("p21", ts.prod(F.lit(1.0), 21)), ["v60", "mom20", "p21"])


@add("a08_first_publication", f"select ticker, end_date, pub as publish_date, {out('e')} as basic_eps from"
     " (select *, row_number() over (partition by ticker, end_date order by pub) as n from ps) where n = 1", PS)
def _(spark, sf):
    ps = d.ps_pit(spark, sf).select("ticker", "end_date", "publish_date", "basic_eps")
    return filters.first_per_key(ps, ["ticker", "end_date"], ["publish_date"])


@add("a09_distinct_rows", f"select distinct ticker, trade_date, sale_date, {out('buy_price')} as buy_price"
     " from choice", CHOICE)
def _(spark, sf):
    return d.choice(spark, sf).distinct()


# ---- sorts, set operations

@add("o01_sorted", f"select {BAR_SQL} from bars")
def _(spark, sf):
    return d.bars(spark, sf).select(*BAR).orderBy("ticker", "trade_date")


@add("o03_last_rows", f"select {BAR_SQL} from (select *, row_number() over (partition by ticker"
     " order by trade_date desc) as n from bars) where n <= 10")
def _(spark, sf):
    newest = Window.partitionBy("ticker").orderBy(F.col("trade_date").desc())
    return (d.bars(spark, sf).withColumn("_n", F.row_number().over(newest)).where("_n <= 10").select(*BAR))


@add("o04_union", f"select {BAR_SQL}, case when chg_pct > 1 then 'up' end as mark from bars where chg_pct > 1"
     f" union all select {BAR_SQL}, null from bars where chg_pct < -0.5")
def _(spark, sf):
    df = d.bars(spark, sf)
    up = df.where("chg_pct > 1").select(*BAR, F.lit("up").alias("mark"))
    return up.unionByName(df.where("chg_pct < -0.5").select(*BAR), allowMissingColumns=True)


@add("o05_difference", "select ticker, trade_date from bars where open_price = 0")
def _(spark, sf):
    keys = ["ticker", "trade_date"]
    # what is in one set and not in the other, in one pass over both
    return d.bars(spark, sf).groupBy(*keys).agg(F.count_if(F.col("open_price") > 0).alias("_taken")).where(
        "_taken = 0").select(*keys)


@add("g0_complete_history", f"select {BAR_SQL} from (select *, row_number() over (partition by ticker order by"
     " trade_date desc) as n, count(*) over (partition by ticker) as c from traded) where n <= 250 and c >= 250")
def _(spark, sf):
    newest = Window.partitionBy("ticker").orderBy(F.col("trade_date").desc())
    recent = d.traded(spark, sf).withColumn("_n", F.row_number().over(newest)).where("_n <= 250")
    size = F.count(F.lit(1)).over(Window.partitionBy("ticker"))
    return recent.withColumn("_c", size).where("_c = 250").select(*BAR)


# ---- trade calendar

@add("t01_is_trade_date", "select ticker, sale_date, is_open from choice left join cal on calendar_date = sale_date",
     CHOICE + CALENDAR)
def _(spark, sf):
    return cal.is_trade_date(d.choice(spark, sf), d.trade_calendar(spark, sf), "sale_date").select(
        "ticker", "sale_date", "is_open")


@add("t01_unknown_dates", "select ticker, sale_date from choice where not exists"
     " (select 1 from cal where calendar_date = sale_date)", CHOICE + CALENDAR)
def _(spark, sf):
    return cal.unknown_dates(d.choice(spark, sf), d.trade_calendar(spark, sf), "sale_date").select("ticker", "sale_date")


def _offset_sql(k):
    side, order, skip = ("<=", "desc", k) if k >= 0 else (">=", "asc", -k)
    return (f"(select calendar_date from cal where is_open and calendar_date {side} o.d and o.d between"
            f" (select min(calendar_date) from cal) and (select max(calendar_date) from cal) order by calendar_date {order} limit 1 offset {skip})")


@add("t02_trade_date_by_offset", f"select o.d as day, {_offset_sql(0)} as back0, {_offset_sql(5)} as back5,"
     f" {_offset_sql(-3)} as ahead3 from (select distinct cast(o_orderdate as date) as d from orders) o", CALENDAR)
def _(spark, sf):
    days = d.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    c = d.trade_calendar(spark, sf)
    for k, name in ((0, "back0"), (5, "back5"), (-3, "ahead3")):
        days = cal.trade_date_by_offset(days, c, k, "day", name)
    return days.select("day", "back0", "back5", "ahead3")


@add("t03_trade_dates", "select trade_date, count(b.ticker) as bars from (select calendar_date as trade_date from cal"
     " where is_open and calendar_date between date '1997-01-01' and date '1997-12-31') left join bars b"
     " using (trade_date) group by trade_date", CALENDAR)
def _(spark, sf):
    days = cal.trade_dates(d.trade_calendar(spark, sf), "1997-01-01", "1997-12-31")
    return (days.join(d.bars(spark, sf, start="1997-01-01", end="1997-12-31"), "trade_date", "left")
            .groupBy("trade_date").agg(F.count("ticker").alias("bars")))


