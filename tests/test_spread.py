"""Cross-sections spread over several tasks a date, against the windows by date."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from factorloom.functions import spread, xs


@pytest.fixture(scope="module")
def panel(spark):
    rng = random.Random(4)
    rows = []
    for k in range(6):
        day = datetime.date(2020, 1, 6) + datetime.timedelta(weeks=k)
        for ticker in range(300 if k else 1):
            x = 0.0 if rng.random() < 0.35 else rng.choice([rng.gauss(0, 1), rng.gauss(0, 1) * 1e-10, rng.randrange(5) * 1e12])
            if k == 3 and ticker == 7 or k == 5:
                x = None
            rows.append((ticker, day, x, None if k == 4 and ticker == 9 else abs(rng.gauss(5, 2))))
    return spark.createDataFrame(rows, "ticker long, trade_date date, x double, neg_market_value double").cache()


def rows_of(df):
    return [(r.ticker, r.trade_date, None if r.v is None else round(r.v, 9)) for r in df.orderBy("trade_date", "ticker").collect()]


@pytest.mark.parametrize("slices", [1, 2, 64])
def test_ranks(panel, slices):
    got = rows_of(spread.rank_pct(panel, "x", "v", slices))
    assert got == rows_of(panel.withColumn("v", xs.rank_pct("x"))) and len(got) == panel.count()


@pytest.mark.parametrize("slices", [1, 7])
def test_medians(panel, slices):
    got = {r.trade_date: r.v for r in spread.median(panel, "x", "v", slices).collect()}
    want = {r.trade_date: r.v for r in panel.groupBy("trade_date").agg(F.median("x").alias("v")).where("v is not null").collect()}
    assert got == want


def test_clipped_and_neutral(panel):
    small = panel.withColumn("x", F.when(F.abs("x") < 1e6, F.col("x")).otherwise(F.when(F.col("x").isNotNull(), 3.0)))
    assert rows_of(spread.winsorize(small, "x", "v")) == rows_of(xs.winsorize(small, "x", "v"))
    assert rows_of(spread.neutralize(small, "x", "v")) == rows_of(xs.neutralize(small, "x", "v"))


def test_a_date_is_many_slices(panel):
    held = spread.places(panel, "x").where("total > 100")
    plan = held._jdf.queryExecution().optimizedPlan().toString()
    # windows are by date and slice; by date alone only over the sums of the slices
    assert "[trade_date" in plan and "slice" in plan
    assert spread.places(panel.where("false"), "x").count() == 0


def test_a_median_sorts_values_around_the_middle(spark):
    """Not all values of a date, and exact where a value fills the middle or a date has two values."""
    df = spark.range(40_000).selectExpr("date_add(date'2020-01-06', cast(id % 2 as int) * 7) as trade_date", "id * 1.0D as x")
    few = spread.middle(df, "x")
    assert few.count() < 40_000 / 8 and {r.total for r in few.collect()} == {20_000}
    assert sorted(r.v for r in spread.median(df, "x", "v").collect()) == [19_999.0, 20_000.0]
    tied = spark.createDataFrame([("a", v) for v in [1.0, 5.0]] + [("b", v) for v in [0.0] * 50 + [7.0] * 50 + [float("inf")]]
                                 + [("c", None), ("d", -2.0)], "trade_date string, x double")
    assert {r.trade_date: r.v for r in spread.median(tied, "x", "v").collect()} == {"a": 3.0, "b": 7.0, "d": -2.0}


def columns_written(monkeypatch, spark, name):
    from factorloom.plans import universe

    seen, write = [], spread.written
    for module in (spread, universe, universe.d):
        monkeypatch.setattr(module, "written", lambda df, label: seen.append((label, df.columns)) or write(df, label), raising=False)
    assert universe.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
    return [columns for label, columns in seen if label in ("panel", "bars", "traded")]


def test_a_neutral_panel_is_written_with_the_columns_in_use(monkeypatch, spark):
    assert columns_written(monkeypatch, spark, "universe_neutralize") == [["ticker", "trade_date", "turnover_rate", "neg_market_value"]]
    assert columns_written(monkeypatch, spark, "universe_x01_rank_pct") == [["ticker", "trade_date", "turnover_vol"]]


def test_a_panel_joined_as_of_is_written_with_its_keys(monkeypatch, spark):
    assert columns_written(monkeypatch, spark, "universe_as_of") == [["ticker", "trade_date"]]
