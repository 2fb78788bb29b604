"""The published answers around the 2022 Spring Festival closure."""

import datetime

import pytest
from pyspark.sql import functions as F

from factorloom.operators import calendar as cal


def day(text):
    return datetime.date.fromisoformat(text)


@pytest.fixture(scope="module")
def calendar(spark):
    days = spark.sql("select explode(sequence(date'2022-01-17', date'2022-02-11')) as calendar_date")
    closed = F.dayofweek("calendar_date").isin(1, 7) | F.col("calendar_date").between("2022-01-31", "2022-02-04")
    return days.select("calendar_date", F.lit("XSHG").alias("exchange_cd"), (~closed).alias("is_open"))


@pytest.mark.parametrize("date, offset, answer", [
    ("2022-01-28", 1, "2022-01-27"), ("2022-01-28", 2, "2022-01-26"), ("2022-01-28", 5, "2022-01-21"),
    ("2022-01-29", 1, "2022-01-27"), ("2022-01-28", -1, "2022-02-07"), ("2022-01-29", -1, "2022-02-08"),
    ("2022-01-25", -5, "2022-02-08"), ("2022-01-29", 0, "2022-01-28"),
])
def test_offsets(spark, calendar, date, offset, answer):
    dates = spark.createDataFrame([(day(date),)], "trade_date date")
    assert cal.trade_date_by_offset(dates, calendar, offset).first().offset_date == day(answer)


def test_trade_day_flags(spark, calendar):
    dates = spark.createDataFrame([(day(d),) for d in ("2022-01-27", "2022-01-28", "2022-01-29", "1980-01-01")],
                                  "trade_date date")
    flags = {r.trade_date: r.is_open for r in cal.is_trade_date(dates, calendar).collect()}
    assert list(flags[day(f"2022-01-{d}")] for d in (27, 28, 29)) == [True, True, False]
    assert [r.trade_date for r in cal.unknown_dates(dates, calendar).collect()] == [day("1980-01-01")]


def test_range_and_rebalance(spark, calendar):
    assert cal.trade_dates(calendar, "2022-01-28", "2022-02-08").count() == 3
    periods = cal.rebalance_dates(calendar, "2022-01-24", "2022-02-11", 4).orderBy("period").collect()
    assert [(r.period, r.trade_date, r.end_date) for r in periods] == [
        (0, day("2022-01-24"), day("2022-01-28")), (1, day("2022-01-28"), day("2022-02-10")),
        (2, day("2022-02-10"), None)]
    of = {r.trade_date: r.period for r in cal.period_of_dates(
        calendar, cal.rebalance_dates(calendar, "2022-01-24", "2022-02-11", 4)).collect()}
    assert of[day("2022-01-25")] == 0 and of[day("2022-01-28")] == 0 and of[day("2022-02-07")] == 1
    assert day("2022-01-24") not in of
