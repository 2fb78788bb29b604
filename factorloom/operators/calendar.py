"""Trade calendar: one row per calendar day, a few hundred per year, so numbering it in one window is bounded."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _numbered(calendar: DataFrame) -> DataFrame:
    """Per day: the number of open days up to it, itself included."""
    w = Window.partitionBy("exchange_cd").orderBy("calendar_date").rowsBetween(Window.unboundedPreceding, 0)
    return calendar.select("calendar_date", "is_open",
                           F.sum(F.col("is_open").cast("int")).over(w).alias("n_open"))


def is_trade_date(dates: DataFrame, calendar: DataFrame, column="trade_date") -> DataFrame:
    """Add ``is_open``; dates the calendar does not know get NULL (see ``unknown_dates``)."""
    cal = calendar.select(F.col("calendar_date").alias(column), "is_open")
    return dates.join(cal, column, "left")


def unknown_dates(dates: DataFrame, calendar: DataFrame, column="trade_date") -> DataFrame:
    return dates.join(calendar.select(F.col("calendar_date").alias(column)), column, "left_anti")


def trade_date_by_offset(dates: DataFrame, calendar: DataFrame, offset: int, column="trade_date",
                         out="offset_date") -> DataFrame:
    """offset >= 0: that many open days back from the last open day on or before the date;
    offset < 0: that many forward from the first open day on or after it. NULL outside the calendar."""
    days = _numbered(calendar)
    if offset >= 0:
        target = F.col("n_open") - offset
    else:
        target = F.col("n_open") + F.when(F.col("is_open"), 0).otherwise(1) - offset
    wanted = days.select(F.col("calendar_date").alias(column), target.alias("_n"))
    found = days.where("is_open").select(F.col("n_open").alias("_n"), F.col("calendar_date").alias(out))
    return dates.join(wanted, column, "left").join(found, "_n", "left").drop("_n")


def trade_dates(calendar: DataFrame, start, end) -> DataFrame:
    day = F.col("calendar_date")
    return (calendar.where(F.col("is_open") & day.between(F.lit(start).cast("date"), F.lit(end).cast("date")))
            .select(day.alias("trade_date")))


def rebalance_dates(calendar: DataFrame, start, end, every: int) -> DataFrame:
    """Every n-th open day: period number, its start and the start of the next one (NULL for the last)."""
    w = Window.partitionBy("exchange_cd").orderBy("calendar_date")
    day = F.col("calendar_date")
    return (
        calendar.where(F.col("is_open") & day.between(F.lit(start).cast("date"), F.lit(end).cast("date")))
        .withColumn("_n", F.row_number().over(w) - 1)
        .where(F.col("_n") % every == 0)
        .select((F.col("_n") / every).cast("int").alias("period"), day.alias("trade_date"),
                F.lead("calendar_date").over(w).alias("end_date"))
    )


def period_of_dates(calendar: DataFrame, rebalance: DataFrame) -> DataFrame:
    """The period each open day belongs to: after its start, up to and including its end."""
    w = (Window.partitionBy("exchange_cd").orderBy("calendar_date")
         .rowsBetween(Window.unboundedPreceding, -1))
    marked = calendar.where("is_open").join(
        rebalance.select(F.col("trade_date").alias("calendar_date"), "period"), "calendar_date", "left")
    return (marked.withColumn("period", F.max("period").over(w)).where("period is not null")
            .select(F.col("calendar_date").alias("trade_date"), "period"))
