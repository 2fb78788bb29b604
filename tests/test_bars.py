"""Bars of line items that the test tables do not hold: large numbers, ties, other years."""

import datetime

import duckdb
import pandas as pd
import pytest

from factorloom.plans.sql import with_bars
from factorloom.sources import driver_tables as d

SCHEMA = ("l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double,"
          " l_tax double, l_shipdate timestamp")
DAY = datetime.datetime(2024, 3, 5)
BIG = [10 ** 12, 2 ** 63 - 1, -5]


def row(order, line, quantity, price, part=1, day=DAY):
    return order, part, line, float(quantity), float(price), 0.01, 0.02, day


FIXTURES = {
    "line 12": [row(1, 12, 1, 5), row(2, 1, 1, 7)],
    "a large price": [row(1, 1, 1, 12_000_000), row(1, 2, 3, 12_000_000)],
    "quantity alone": [row(1, 1, 2, 90), row(1, 1, 3, 90), row(1, 1, 1, 90)],
    "price alone": [row(1, 1, 2, 90), row(1, 1, 2, 80.25), row(1, 1, 2, 91.5)],
    "order before line": [row(2, 1, 1, 1), row(1, 999, 1, 2), row(10 ** 12 - 1, 0, 1, 3)],
    "beyond and within": [row(5, 1, 1, 1), *[row(o, 1, 1, 10 + i) for i, o in enumerate(BIG)]],
    "only beyond": [row(1, 5000, 1, 4), row(1, 4000, 1, 3), row(1, 4000, 2, 3)],
    "prices beyond": [row(1, 1, 1, 2e10), row(1, 1, 1, 3), row(1, 1, 2, -4), row(1, 1, 2e7, 8)],
    "no quantity": [row(1, 1, 0, 5), row(2, 1, 1, 7), row(3, 1, 0, 9)],
    "day before order": [row(1, 1, 1, 5, day=DAY + datetime.timedelta(days=1)), row(9, 1, 1, 7), row(BIG[0], 1, 1, 9, day=DAY - datetime.timedelta(days=1))],
}


@pytest.mark.parametrize("name", FIXTURES)
def test_first_and_last_price(spark, name):
    rows = FIXTURES[name]
    got = d.bars_of(spark.createDataFrame(rows, SCHEMA)).select("ticker", "first_price", "close_price").collect()
    con = duckdb.connect()
    con.register("lineitem", pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")]))
    want = con.execute(with_bars("select ticker, first_price, close_price from agg_bars")).fetchall()
    assert [tuple(r) for r in got] == want


def test_random_rows_as_sorted(spark):
    import random

    rng = random.Random(1)
    rows = [row(rng.choice([1, 2, 3, *BIG]), rng.choice([1, 2, 12, 999, 1000]), rng.choice([1, 2.5, 1e7]), rng.choice([5, 7.25, 1e10, 12_000_000]),
                part, DAY + datetime.timedelta(days=rng.randrange(5))) for part in range(20) for _ in range(6)]
    got = {r.ticker: (r.first_price, r.close_price) for r in d.bars_of(spark.createDataFrame(rows, SCHEMA), None).collect()
           if r.trade_date == datetime.date(2024, 3, 4)}
    for part, prices in got.items():
        mine = sorted((r[7], r[0], r[2], r[4], r[3]) for r in rows if r[1] == part and r[7] < datetime.datetime(2024, 3, 11))
        assert prices == (mine[0][3] / mine[0][4], mine[-1][3] / mine[-1][4])


def test_no_sort_of_the_input(spark):
    plan = d._raw_bars(spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
    # the rows beyond the packing are aggregated on their own; all others are hashed
    assert plan.count("HashAggregate") == 2 and plan.count("Sort") == plan.count("SortAggregate") <= 2


def test_calendar_follows_the_dates(spark):
    days = d.calendar_of(spark.createDataFrame([row(1, 1, 1, 1), row(2, 1, 1, 1, day=DAY + datetime.timedelta(days=400))], SCHEMA))
    r = days.selectExpr("min(calendar_date) a", "max(calendar_date) b", "count(1) n", "count_if(is_open) o").first()
    assert (str(r.a), str(r.b), r.n, r.o) == ("2024-03-04", "2025-04-13", 406, 58)
    assert d.calendar_of(spark.createDataFrame([], SCHEMA)).count() == 0


def test_prices_come_with_their_place(spark):
    """A place of 37 digits is taken apart only beside a row beyond the packing."""
    plan = d.bars_of(spark.createDataFrame([row(1, 1, 1, 1)], SCHEMA)).select("first_price", "close_price")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "min_by" in text and "max_by" in text and "if (isnull(first_beyond" in text
    # halves and amounts finer than a hundredth, as they are packed
    got = d.bars_of(spark.createDataFrame([row(1, 1, 3, 0.125), row(2, 1, 0.015, 10.004)], SCHEMA)).first()
    assert (got.first_price, got.close_price) == (0.13 / 3, 10.0 / 0.02)
