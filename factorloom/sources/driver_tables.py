"""Bar panel and companion tables derived from the TPC-H-like test tables.

Everything here is an ordinary Spark job over the whole of ``lineitem``: rows are reduced to bars with map-side
partial aggregation before the first exchange, so a hot part key costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import written

EPOCH = "1995-01-02"
TICKERS = 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The order of a bar's rows: day, order, line, extended price and quantity. Rows alike in all five have one price. A row
# whose numbers fit is placed by one decimal (1 + 12 + 3 + 12 + 9 digits, amounts in hundredths as the tables define them): a
# fixed-width aggregation buffer, so first and last price need no sort. Rows beyond are placed by the fields themselves in an
# aggregation of their own. Which rows those are is said by bounds on columns, so files without any are skipped unread.
FITS = ("l_orderkey between 0 and 999999999999 and l_linenumber between 0 and 999"
        " and l_extendedprice between 0 and 9999999999.99D and l_quantity between 0.01D and 9999999.99D")
BEYOND = ("l_orderkey < 0 or l_orderkey > 999999999999 or l_linenumber < 0 or l_linenumber > 999"
          " or l_extendedprice < 0 or l_extendedprice > 9999999999.99D or l_quantity < 0 or l_quantity > 9999999.99D")


def _hundredths(x: str) -> str:
    """round(x * 100) for what is not negative, as a long."""
    return f"(floor({x} * 100) + if({x} * 100 - floor({x} * 100) >= 0.5D, 1, 0))"


# two longs of 19 and 18 digits, so that a row costs one product and one sum of decimals
PLACE = (f"cast(datediff(l_shipdate, trunc(to_date(l_shipdate), 'week')) * 1000000000000000000L + l_orderkey * 1000000L + l_linenumber * 1000L"
         f" + {_hundredths('l_extendedprice')} div 1000000000L as decimal(19,0)) * 1000000000000000000BD"
         f" + cast({_hundredths('l_extendedprice')} % 1000000000L * 1000000000L + {_hundredths('l_quantity')} as decimal(18,0))")


def _fields(place: str) -> str:
    """A packed place as the struct that rows beyond the packing are placed by; NULL stays NULL."""
    def digits(start, n, kind):
        return f"cast(substring(lpad(cast({place} as string), 37, '0'), {start}, {n}) as {kind})"

    return (f"if({place} is null, null, struct(date_add(trade_date, {digits(1, 1, 'int')}) as day, {digits(2, 12, 'bigint')} as l_orderkey,"
            f" {digits(14, 3, 'int')} as l_linenumber, {digits(17, 12, 'double')} / 100 as l_extendedprice,"
            f" {digits(29, 9, 'double')} / 100 as l_quantity))")


# the price of a place, from the amounts as they are packed: rows of one place have one price
PACKED = f"try_divide({_hundredths('l_extendedprice')} / 100, {_hundredths('l_quantity')} / 100)"


def _raw_bars(spark, sf_dir, tickers=TICKERS, start=None, end=None) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    # a week's bar holds seven days from its Monday on
    if start is not None:
        lines = lines.where(F.col("l_shipdate") >= F.expr(f"trunc(date'{start}' + 6, 'week')").cast(lines.schema["l_shipdate"].dataType))
    if end is not None:
        lines = lines.where(F.col("l_shipdate") < F.expr(f"trunc(date'{end}', 'week') + 7").cast(lines.schema["l_shipdate"].dataType))
    return bars_of(lines, tickers)


def bars_of(lines: DataFrame, tickers: int | None = TICKERS) -> DataFrame:
    """Weekly bars of line items. A row without quantity has no price; rows without a part or date form a bar of their own."""
    key = [f"l_partkey % {tickers} as ticker" if tickers else "l_partkey as ticker", "trunc(to_date(l_shipdate), 'week') as trade_date"]
    usual = (
        lines
        .selectExpr(*key, "try_divide(l_extendedprice, l_quantity) as price", f"if({FITS}, cast({PLACE} as decimal(38,0)), null) as place",
                    f"if({FITS}, {PACKED}, null) as packed", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
        .groupBy("ticker", "trade_date")
        .agg(*map(F.expr, [
            "min(place) as first_place", "max(place) as last_place",
            "min_by(packed, place) as first_packed", "max_by(packed, place) as last_packed",
            "max(price) as highest_price", "min(price) as lowest_price",
            "sum(l_quantity) as qty", "sum(l_extendedprice) as val", "count(1) as deal_amount",
            "avg(l_discount) as disc", "avg(l_tax) as tax"]))
    )
    beyond = (
        lines.where(BEYOND).where("l_quantity != 0")
        .selectExpr(*key, "struct(to_date(l_shipdate) as day, l_orderkey, l_linenumber, l_extendedprice, l_quantity) as row")
        .groupBy("ticker", "trade_date").agg(F.min("row").alias("first_beyond"), F.max("row").alias("last_beyond"))
    )

    # the fields of a place are taken apart only where a row beyond the packing has to be compared with it
    return (
        usual.join(beyond, ["ticker", "trade_date"], "left")
        .withColumns({"first": F.expr(f"if(first_beyond is null, null, least({_fields('first_place')}, first_beyond))"),
                      "last": F.expr(f"if(last_beyond is null, null, greatest({_fields('last_place')}, last_beyond))")})
        .selectExpr("ticker", "trade_date",
                    "if(first_beyond is null, first_packed, try_divide(first.l_extendedprice, first.l_quantity)) as first_price",
                    "if(last_beyond is null, last_packed, try_divide(last.l_extendedprice, last.l_quantity)) as close_price",
                    "highest_price", "lowest_price", "qty", "val", "deal_amount", "disc", "tax")
    )


def bars(spark: SparkSession, sf_dir: str, tickers: int | None = TICKERS, start: str | None = None,
         end: str | None = None) -> DataFrame:
    """Weekly bars, suspended ones included (open, volume and value are 0 there).

    ``tickers`` folds the parts into so many tickers; with None every part is one. ``start`` and ``end`` restrict the
    trade dates in the scan; a ticker's first bar from ``start`` on then has no bar before it.
    """
    return (
        _raw_bars(spark, sf_dir, tickers, start, end)
        .selectExpr("*", f"floor(datediff(trade_date, date'{EPOCH}') / 7) as weeks")
        .selectExpr("*", "(ticker * 7 + weeks) % 41 = 0 as suspended",
                    "ticker = 5 and weeks % 50 = 0 as no_ratio",
                    "1000000 + ticker * 10000 + floor(weeks / 26) * 5000 as shares",
                    "coalesce(lag(close_price) over (partition by ticker order by trade_date), first_price)"
                    " as pre_close_price")
        .selectExpr(
            "ticker", "trade_date", "if(suspended, 0D, first_price) as open_price",
            "highest_price", "lowest_price", "close_price", "pre_close_price",
            "if(suspended, 0D, qty) as turnover_vol", "if(suspended, 0D, val) as turnover_value",
            "try_divide(val, qty) as vwap", "deal_amount", "suspended", "shares",
            "try_divide(close_price, pre_close_price) - 1 as chg_pct",
            "close_price * shares as neg_market_value", "close_price * shares * 1.5D as market_value",
            "if(suspended, 0D, qty / shares) as turnover_rate",
            "if(no_ratio, 0D, disc * 100 + 10) as pe", "if(no_ratio, 0D, tax * 10 + 1) as pb",
            "not suspended as is_open",
            "concat(case when ticker % 11 = 0 then '*ST' when ticker % 7 = 0 then 'ST' else 'N' end,"
            " cast(ticker as string)) as sec_short_name",
            "if(ticker % 2 = 0, 'XSHG', 'XSHE') as exchange_cd", "weeks as wk")
    )


def bars_once(spark: SparkSession, sf_dir: str, tickers: int | None = TICKERS) -> DataFrame:
    """The bars built once and written to the shared folder, for plans that use them several times."""
    return written(bars(spark, sf_dir, tickers), "bars")


def traded(spark: SparkSession, sf_dir: str, tickers: int | None = TICKERS) -> DataFrame:
    return bars(spark, sf_dir, tickers).where("open_price > 0")


def equity(spark, sf_dir) -> DataFrame:
    """Instrument master; two tickers are left out so that the unmatched report has rows."""
    t = F.col("ticker")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy((F.col("l_partkey") % TICKERS).alias("ticker"))
        .agg(F.trunc(F.to_date(F.min("l_shipdate")), "week").alias("first_date"))
        .where(~t.isin(22, 23))
        .select("ticker",
                F.date_sub("first_date", (t * 7).cast("int")).alias("list_date"),
                (t % 3 + 1).cast("string").alias("list_sector_cd"),
                F.when(t % 2 == 0, "XSHG").otherwise("XSHE").alias("exchange_cd"),
                F.lit("L").alias("list_status_cd"))
    )


def fund(spark, sf_dir) -> DataFrame:
    return equity(spark, sf_dir).select(
        "ticker", F.when(F.col("ticker") % 4 == 0, "ETF").otherwise("LOF").alias("etf_lof"))


def fund_day(spark, sf_dir, start=None, end=None) -> DataFrame:
    return bars(spark, sf_dir, start=start, end=end).where(F.col("ticker") % 4 == 0)


def trade_calendar(spark, sf_dir) -> DataFrame:
    """Every calendar day of the bar period; Mondays are open, the last Monday of a month is its end."""
    return calendar_of(table(spark, sf_dir, "lineitem"))


def calendar_of(lines: DataFrame) -> DataFrame:
    """The days of all weeks from the first shipping date of ``lines`` to the last: none without a date."""
    day, week = F.col("calendar_date"), F.trunc(F.to_date("l_shipdate"), "week")
    return (
        lines.agg(F.min(week).alias("first"), F.max(week).alias("last"))
        .select(F.explode(F.sequence("first", F.date_add("last", 6))).alias("calendar_date"))
        .select("calendar_date", F.lit("XSHG").alias("exchange_cd"),
                (F.dayofweek(day) == 2).alias("is_open"),
                ((F.dayofweek(day) == 2) & (F.month(F.date_add(day, 7)) != F.month(day))).alias("is_month_end"))
    )


def ps_pit(spark, sf_dir, tickers: int | None = TICKERS) -> DataFrame:
    """Quarterly per-share figures, published on the fifth Monday after the quarter, revised two weeks later."""
    quarter_end = F.date_sub(F.add_months(F.trunc(F.to_date("l_shipdate"), "quarter"), 3), 1)
    t = F.col("ticker")
    base = (
        table(spark, sf_dir, "lineitem")
        .groupBy((F.col("l_partkey") % tickers if tickers else F.col("l_partkey")).alias("ticker"), quarter_end.alias("end_date"))
        .agg(F.sum("l_extendedprice").alias("val"))
        .withColumn("q", F.year("end_date") * 4 + F.quarter("end_date"))
        .withColumn("basic_eps", F.col("val") / (t * 10000 + 1000000))
    )
    first_monday = F.next_day("end_date", "Mon")
    return (
        base.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("revision"))
        .withColumn("eps1", F.col("basic_eps") * F.when(F.col("revision") == 1, 1.1).otherwise(1.0))
        .select(
            "ticker", "end_date",
            F.date_add(first_monday, F.lit(28) + F.col("revision") * 14).alias("publish_date"),
            F.date_add(first_monday, F.lit(28) + F.col("revision") * 14).cast("timestamp").alias("act_pubtime"),
            F.col("eps1").alias("basic_eps"),
            (F.col("eps1") * 0.95).alias("diluted_eps"),
            (F.col("eps1") * 1.02).alias("eps"),
            (F.col("eps1") * 2.0).alias("reser_ps"),
            (F.col("eps1") * 1.5).alias("c_reser_ps"),
            (F.col("eps1") * 0.8).alias("n_cin_cash_ps"),
            F.when((t + F.col("q")) % 9 != 0, F.col("eps1") * 0.6).alias("fcf_fps"))
    )


def k60(spark, sf_dir, start=None, end=None) -> DataFrame:
    """Intraday reference close for the liquid bars only."""
    return (bars(spark, sf_dir, start=start, end=end).where("turnover_vol >= 100 and open_price > 0")
            .select("ticker", "trade_date", F.col("open_price").alias("open"),
                    ((F.col("open_price") + F.col("close_price")) / 2).alias("close")))


def benchmark(spark, sf_dir) -> DataFrame:
    """Index rows: the mean bar of each date."""
    return (traded(spark, sf_dir).groupBy("trade_date")
            .agg(F.avg("open_price").alias("bench_open"), F.avg("close_price").alias("bench_close")))


def choice(spark, sf_dir) -> DataFrame:
    """A choice list taken from the bars, one row of it duplicated."""
    return choice_of(bars(spark, sf_dir))


def choice_of(panel: DataFrame) -> DataFrame:
    picked = (
        panel
        .where("(ticker * 13 + wk) % 97 = 0")
        .select("ticker", "trade_date", F.date_add("trade_date", 21).alias("sale_date"),
                F.col("close_price").alias("buy_price"), "wk")
    )
    # copies come from an array, so that the bars are read once
    copies = F.when((F.col("ticker") == 3) & (F.col("wk") < 97), 2).otherwise(1)
    return picked.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("copy", "wk")


def factor_panel(spark, sf_dir, tickers: int | None = TICKERS) -> DataFrame:
    """Traded bars with the index open and close of their date.

    The index is one row per trade date. It is averaged over the panel's own day groups, which needs no join;
    day ranks that follow use the same partitioning.
    """
    from ..functions.xs import day

    return (traded(spark, sf_dir, tickers)
            .withColumn("bench_open", F.avg("open_price").over(day()))
            .withColumn("bench_close", F.avg("close_price").over(day())))
