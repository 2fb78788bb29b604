"""Queries that write files and read them back: choice CSV, day files, metric store, manifests."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import choices
from ..operators import metrics as m
from ..operators.metrics import SelectMetric
from ..sources import choice_files, day_files, readers, scratch, store
from ..sources import driver_tables as d
from .common import tidy
from .metrics import TSW, w
from .relational import CHOICE
from .sql import TRADED, out

QUERIES, ORACLES = {}, {}


def add(name, sql, ctes=""):
    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: tidy(fn(spark, sf_dir))
        ORACLES[name] = f"with {TRADED}{ctes}\n{sql}"
        return fn
    return register


@add("s07_choice_csv", "select lpad(ticker::varchar, 6, '0') as ticker, '汽车' as industry, trade_date as buy_date,"
     f" sale_date, {out('buy_price')} as buy_price from choice", CHOICE)
def _(spark, sf):
    values = {"seq": F.col("ticker"), "name": F.lit("股票"), "ticker": F.lpad(F.col("ticker").cast("string"), 6, "0"),
              "industry": F.lit("汽车"), "sub_industry": F.lit("零部件"), "buy_date": F.col("trade_date"),
              "sale_date": F.col("sale_date"), "buy_price": F.col("buy_price"), "sale_price": F.col("buy_price"),
              "change": F.lit("-5.00%")}
    named = [values[n].alias(c) for c, (n, _) in choice_files.CHOICE_COLUMNS.items()]
    path = scratch.folder(spark, "choices")
    choice_files.write_enriched(d.choice(spark, sf).select(*named), path)
    return choice_files.read_choices(spark, path).select("ticker", "industry", "buy_date", "sale_date", "buy_price")


_CENTS = "round_even({0} * 100, 0) / 100.0::double"
_CHANGE = "coalesce(round_even((c - p) / nullif(p, 0) * 100, 2), 0)"


@add("s09_day_files", f"select ticker::varchar as ticker, trade_date, {out('o')} as open_price, {out('c')} as"
     f" close_price, {out('a')} as turnover_value, vol as turnover_vol, {out(_CHANGE)} as chg_pct"
     f" from (select *, lag(c) {TSW} as p from (select ticker, trade_date, {_CENTS.format('open_price')} as o,"
     f" {_CENTS.format('close_price')} as c, cast(turnover_value as float)::double / 10 as a,"
     " cast(turnover_vol as bigint) as vol from traded))")
def _(spark, sf):
    cents = {"open": "open_price", "high": "highest_price", "low": "lowest_price", "close": "close_price"}
    rows = d.traded(spark, sf).select(
        F.col("ticker").cast("string").alias("ticker"), F.date_format("trade_date", "yyyyMMdd").cast("long").alias("day"),
        *[F.rint(F.col(c) * 100).cast("long").alias(n) for n, c in cents.items()],
        F.col("turnover_value").alias("amount"), F.col("turnover_vol").cast("long").alias("vol"))
    path = scratch.folder(spark, "days")
    day_files.write_day_files(rows, path)
    return day_files.read_day_files(spark, path).select(
        "ticker", "trade_date", "open_price", "close_price", "turnover_value", "turnover_vol", "chg_pct")


@add("s10_metric_store", f"select ticker, trade_date, {out(f'avg(close_price) {w(5)}')} as ma5 from traded")
def _(spark, sf):
    metric = SelectMetric("ma5", m.ma_any, 5, "close_price")
    return store.stored_metric(d.traded(spark, sf), metric, scratch.folder(spark, "metrics"))


@add("s11_manifest", f"select ticker, trade_date, sale_date, {out('buy_price')} as buy_price from choice", CHOICE)
def _(spark, sf):
    path = scratch.folder(spark, "positions")
    store.write_manifest(d.choice(spark, sf), path)
    return spark.read.parquet(f"{path}.parquet").select("ticker", "trade_date", "sale_date", "buy_price")


@add("s11_manifest_csv", f"select ticker, trade_date, sale_date, {out('buy_price')} as buy_price from choice", CHOICE)
def _(spark, sf):
    """The manifest's CSV half read back."""
    path = scratch.folder(spark, "positions")
    store.write_manifest(d.choice(spark, sf).select("ticker", "trade_date", "sale_date", "buy_price"), path)
    return readers.csv_checked(spark, f"{path}.csv", "ticker long, trade_date date, sale_date date, buy_price double")


@add("s14_row_count", "select count(*) as rows from choice", CHOICE)
def _(spark, sf):
    """A file that was loaded, and how many rows it has; one without rows is an error."""
    path = scratch.folder(spark, "loaded")
    choice_files.write_enriched(d.choice(spark, sf), path)
    loaded = readers.csv_checked(spark, path, "ticker long, trade_date date, sale_date date, buy_price double")
    return loaded.agg(F.count(F.lit(1)).alias("rows"))


@add("s12_enriched_csv", f"select c.ticker, c.trade_date, {out('t.close_price')} as close_price, p.n as"
     " select_equ_count from (select distinct * from choice) c left join traded t using (ticker, trade_date)"
     " left join (select trade_date, count(*) as n from traded group by 1) p using (trade_date)", CHOICE)
def _(spark, sf):
    unique = choices.dedup(d.choice(spark, sf), ["sale_date", "buy_price"])
    df = choices.enrich(unique, d.traded(spark, sf), d.ps_pit(spark, sf))
    path = scratch.folder(spark, "enriched")
    columns = ["ticker", "trade_date", "close_price", "select_equ_count"]
    choice_files.write_enriched(df.select(*columns), path)
    return readers.csv_checked(spark, path, "ticker long, trade_date date, close_price double,"
                                            " select_equ_count long")
