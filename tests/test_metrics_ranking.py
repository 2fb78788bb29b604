"""Metrics, ranking and portfolio analytics on the test tables and on small literals."""

import datetime

import pytest
from pyspark.sql import functions as F

from factorloom.operators import filters, joins, portfolio, ranking
from factorloom.operators import metrics as m
from factorloom.operators.metrics import SelectMetric
from factorloom.operators.ranking import RankFactor
from factorloom.sources import driver_tables as d

SF = "/root/testdata/sf0.001"


def test_warm_up_lengths(spark):
    """59 missing values for a 60-row deviation; 20 for a 20-row change, momentum and a 21-row product."""
    full = m.back_adjust(d.bars(spark, SF))
    df = m.append_metrics(filters.drop_suspended(full), [
        SelectMetric("v", m.roi_volat, 60), SelectMetric("mom", m.momentum, 20, "close_price"),
        SelectMetric("rev", m.revers_21, d.k60(spark, SF))])
    n = m.n_chg_pct(full, "chg", 20)
    nulls = df.groupBy("ticker").agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in ("v", "mom", "rev")]).collect()
    assert {(r.v, r.mom, r.rev) for r in nulls} == {(59, 20, 20)}
    assert {r.c for r in n.groupBy("ticker").agg(F.count_if(F.col("chg").isNull()).alias("c")).collect()} <= {20, 21}


def test_bad_arguments(spark):
    df = spark.createDataFrame([(1, 2.0)], "ticker long, x double")
    with pytest.raises(ValueError):
        SelectMetric("", m.ep)
    with pytest.raises(ValueError):
        m.ma_any(df, "ma", 1, "x")
    with pytest.raises(ValueError):
        m.momentum(df, "mom", 0, "x")
    with pytest.raises(ValueError):
        ranking.rank(df, [RankFactor("missing")])


def test_shares_stay_inside_the_ticker(bars_of):
    df, _ = bars_of({"neg_market_value": {1: [10, 10, 40], 2: [99, 99, 99]}, "close_price": {1: [1] * 3, 2: [1] * 3},
                     "open_price": {1: [1] * 3, 2: [1] * 3}})
    rows = m.neg_share_incr(df, "incr", 2).orderBy("ticker", "trade_date").collect()
    assert [r.incr for r in rows] == [0, 0.003, 0, 0, 0, 0]


def test_back_adjusted_prices_follow_the_change(bars_of):
    df, _ = bars_of({"close_price": {1: [10, 5.5]}, "open_price": {1: [9, 5]}, "pre_close_price": {1: [8, 5]},
                     "chg_pct": {1: [0.25, 0.1]}})
    r = m.back_adjust(df).orderBy("trade_date").collect()[1]
    assert (r.hfq_close_price, r.hfq_open_price, r.hfq_pre_close_price) == pytest.approx((11, 9.9, 8.8))


def test_rank_direction_and_blend(spark):
    day = datetime.date(2020, 1, 6)
    df = spark.createDataFrame([(i, day, float(x), float(y)) for i, (x, y) in enumerate([(1, 9), (2, 9), (3, 1)])],
                               "ticker long, trade_date date, x double, y double")
    r = ranking.rank(df, [RankFactor("x", True, 1), RankFactor("y", False, 3)]).orderBy("ticker").collect()
    assert [round(q.x_subrank, 4) for q in r] == [33.3333, 66.6667, 100]
    assert [round(q.y_subrank, 4) for q in r] == [66.6667, 66.6667, 100]
    assert [q["rank"] for q in r] == [3, 2, 1]
    assert [q.ticker for q in ranking.top_n(ranking.rank(df, [RankFactor("x")]), 2).orderBy("rank").collect()] == [2, 1]
    assert (ranking.buy_count(100, 15, 1), ranking.buy_count(90, 15, 1), ranking.buy_count(92, 15, 5)) == (7, 6, 6)


def test_as_of_takes_the_newest_on_or_before(spark):
    dates = [datetime.date(2020, 1, x) for x in range(1, 8)]
    left = spark.createDataFrame([(1, x) for x in dates], "ticker long, trade_date date")
    right = spark.createDataFrame([(1, dates[2], 7.0), (1, dates[5], None), (2, dates[0], 1.0)],
                                  "ticker long, at date, v double")
    got = [r.v for r in joins.as_of(left, right, F.col("at"), ["v"]).orderBy("trade_date").collect()]
    assert got == [None, None, 7, 7, 7, None, None]
    days = [r.sale_days for r in joins.with_sale_days(left, right.withColumnRenamed("at", "sale_date"))
            .orderBy("trade_date").collect()]
    assert days == [100000, 100000, 0, 1, 2, 0, 1]


@pytest.mark.parametrize("days", [1, 7, 30, 5000])
def test_as_of_over_ranges_of_a_hot_key(spark, days):
    """The cut of a key's history changes no row; rows without key or time match nothing."""
    import random

    rng, first = random.Random(days), datetime.date(1969, 11, 20)
    at = lambda n: first + datetime.timedelta(days=rng.randrange(n))
    left = [(rng.choice([1, 1, 1, 2, 3, None]), rng.choice([at(200), at(200), None]) if i % 9 == 0 else at(200), i) for i in range(300)]
    right = [(rng.choice([1, 1, 2, 4, None]), None if i % 11 == 0 else at(150), rng.choice([None, float(i)]), i) for i in range(60)]
    got = joins.as_of(spark.createDataFrame(left, "ticker long, trade_date date, i int"),
                      spark.createDataFrame(right, "ticker long, at date, v double, r int"), F.col("at"), ["v", "r"], order=["r"], days=days)
    want = {}
    for key, day, i in left:
        known = [(a, r, v) for k, a, v, r in right if None not in (key, day, a) and k == key and a <= day]
        want[i] = max(known, key=lambda x: x[:2])[:0:-1] if known else (None, None)
    assert {x.i: (x.v, x.r) for x in got.collect()} == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(ticker") and "_span" in plan and "NestedLoop" not in plan


def test_net_value_and_drawdown(spark):
    rets = [0.1, -0.5, 0.2, 1.0, 0.0, -0.1]
    rows = [("s", i, r, datetime.date(2020, 1, 1) + datetime.timedelta(days=30 * i),
             datetime.date(2020, 1, 31) + datetime.timedelta(days=30 * i)) for i, r in enumerate(rets)]
    df = spark.createDataFrame(rows, "strategy string, period int, ret double, trade_date date, end_date date")
    s = portfolio.summary(portfolio.drawdown(portfolio.net_value(df))).first()
    assert s.max_drawdown == pytest.approx(-50) and s.max_roi == pytest.approx(1.32)
    assert s.roi == pytest.approx(1.188) and s.annual_roi == pytest.approx(1.188 ** (365 / 180) - 1)


def test_spells_ledger_and_cooldown(spark):
    start = datetime.date(2020, 1, 6)

    def row(t, p):
        return ("s", p, t, start + datetime.timedelta(weeks=p), start + datetime.timedelta(weeks=p + 1),
                10.0 + p, 11.0 + p)
    held = spark.createDataFrame([row(1, 0), row(1, 1), row(1, 3), row(2, 2), row(2, 3), row(3, 0)],
                                 "strategy string, period int, ticker long, trade_date date, end_date date,"
                                 " px double, end_px double")
    runs = portfolio.spells(held)
    got = sorted((r.ticker, r.first_period, r.last_period, r.hold_days) for r in runs.collect())
    assert got == [(1, 0, 1, 14), (1, 3, 3, 7), (2, 2, 3, 14), (3, 0, 0, 7)]
    trades = portfolio.closed_trades(runs)
    assert sorted((r.ticker, round(r.chg_pct, 6)) for r in trades.collect()) == [(1, 0.2), (3, 0.1)]
    days = spark.createDataFrame([(1, start + datetime.timedelta(days=x)) for x in (7, 15, 50)],
                                 "ticker long, trade_date date")
    assert portfolio.after_cooldown(days, trades.select("ticker", "sale_date"), 3).count() == 2


def test_first_per_key_is_deterministic(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (2, "z", 1)], "k int, x string, n int")
    got = sorted((r.k, r.x, r.n) for r in filters.first_per_key(df, ["k"], ["x"]).collect())
    assert got == [(1, "a", 9), (2, "z", 1)]
