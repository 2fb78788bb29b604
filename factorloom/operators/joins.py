"""Joins of a panel with metrics, dimensions, fundamentals and trade lists.

No side is broadcast by hint: dimensions fall under Spark's size threshold by themselves, and anything larger is
joined by shuffling on its keys, with AQE splitting skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ["ticker", "trade_date"]


def attach_metric(panel: DataFrame, metric: DataFrame) -> DataFrame:
    """Add the columns of a metric frame by key; rows without the metric keep NULL."""
    return panel.join(metric, KEYS, "left")


def with_list_date(panel: DataFrame, equity: DataFrame) -> DataFrame:
    return panel.join(equity.select("ticker", "list_date"), "ticker", "left")


def unmatched(panel: DataFrame, equity: DataFrame) -> DataFrame:
    """Rows whose ticker has no list date."""
    return panel.join(equity.where("list_date is not null").select("ticker"), "ticker", "left_anti")


def exclude(panel: DataFrame, taken: DataFrame, keys=("ticker",)) -> DataFrame:
    return panel.join(taken.select(*keys), list(keys), "left_anti")


def choice_with_bars(choice: DataFrame, bars: DataFrame) -> DataFrame:
    return choice.join(bars, KEYS, "left")


def pool_count(panel: DataFrame) -> DataFrame:
    return panel.groupBy("trade_date").agg(F.count(F.lit(1)).alias("select_equ_count"))


def latest_per_ticker(fundamentals: DataFrame) -> DataFrame:
    """The row published last, per ticker: a map-side maximum, then one exchange."""
    rest = [c for c in fundamentals.columns if c not in ("ticker", "act_pubtime")]
    top = F.max(F.struct("act_pubtime", "end_date", *[c for c in rest if c != "end_date"]))
    return (fundamentals.groupBy("ticker").agg(top.alias("_row"))
            .select(*[F.col("ticker") if c == "ticker" else F.col(f"_row.{c}").alias(c)
                      for c in fundamentals.columns]))


def as_of(left: DataFrame, right: DataFrame, right_time: Column, values: list[str], key="ticker",
          left_time="trade_date", order: list[str] | None = None, days=366) -> DataFrame:
    """For every left row the values of the newest right row at or before its time, NULL if there is none.

    The right side is first reduced to one row per key and time (the largest by ``order``, then by the values), with a
    map-side maximum, so that copies cost nothing later. A key's history is cut into ranges of so many ``days``. Both
    sides are stacked and sorted once per key and range, and the last right row seen is carried forward; what a range
    begins with comes from a second, small scan over the ranges' last right rows. So a key that holds most rows runs in
    as many tasks as it has ranges, and the left rows are exchanged once, without the row blow-up of a range join. Rows
    without a key or time match nothing. ``left`` is read twice, the second time for its keys and times alone.
    """
    def span(time):
        return F.floor(F.datediff(time, F.lit("1970-01-01").cast("date")) / F.lit(days))

    own = left.columns
    newest = (right.where(F.col(key).isNotNull() & right_time.isNotNull()).groupBy(F.col(key), right_time.alias("_t"))
              .agg(F.max(F.struct(*(order or []), *[v for v in values if v not in (order or [])])).alias("_value"))
              .withColumn("_span", span("_t")))
    empty = F.lit(None).cast(newest.schema["_value"].dataType)

    stacked = left.select(*own, F.col(left_time).alias("_t"), F.lit(1).alias("_side"), empty.alias("_value"),
                          span(left_time).alias("_span"))
    other = newest.select(
        *[F.col(c) if c == key else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in own],
        "_t", F.lit(0).alias("_side"), "_value", "_span")
    w = Window.partitionBy(key, "_span").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    within = stacked.unionByName(other).withColumn("_value", F.last("_value", ignorenulls=True).over(w)).where("_side = 1")

    ends = newest.groupBy(key, "_span").agg(F.max(F.struct("_t", "_value")).alias("_last"))
    starts = left.select(key, span(left_time).alias("_span")).distinct()
    spans = Window.partitionBy(key).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    before = (ends.join(starts.withColumn("_asked", F.lit(True)), [key, "_span"], "full")
              .withColumn("_before", F.last("_last", ignorenulls=True).over(spans)["_value"])
              .where("_asked and _before is not null").select(key, "_span", "_before"))
    return (within.join(before, [key, "_span"], "left").withColumn("_value", F.coalesce("_value", "_before"))
            .select(*own, *[F.col(f"_value.{v}").alias(v) for v in values]))


def fundamentals_as_of(panel: DataFrame, fundamentals: DataFrame, values: list[str]) -> DataFrame:
    """Latest figures published on or before each trade date."""
    return as_of(panel, fundamentals, F.to_date("act_pubtime"), values, order=["end_date"])


def with_intraday(panel: DataFrame, k60: DataFrame) -> DataFrame:
    return panel.join(k60.select(*KEYS, F.col("close").alias("close_60")), KEYS, "left")


def month_ends(panel: DataFrame, calendar: DataFrame) -> DataFrame:
    """Rows on the last open day of their month."""
    from .filters import month_key

    ends = (calendar.where("is_month_end")
            .select(F.col("calendar_date").alias("trade_date"), month_key("calendar_date").alias("trade_month")))
    return panel.withColumn("trade_month", month_key()).join(ends, ["trade_date", "trade_month"], "inner")


def with_benchmark(panel: DataFrame, index: DataFrame) -> DataFrame:
    return panel.join(index, "trade_date", "left")


def with_sale_days(panel: DataFrame, sales: DataFrame, never=100000) -> DataFrame:
    """Days since the ticker's last sale on or before each date; a large number if there was none."""
    joined = as_of(panel, sales, F.col("sale_date"), ["sale_date"])
    return (joined.withColumn("sale_days", F.coalesce(F.datediff("trade_date", "sale_date"), F.lit(never)))
            .drop("sale_date"))
