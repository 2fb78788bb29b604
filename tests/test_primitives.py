"""Window primitives against pandas and hand-computed answers."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from factorloom.factors import staging
from factorloom.functions import scalar, ts, xs

X = {1: [3, 1, 4, None, 5, 9, 2, 6], 2: [2, 7, 1, 8, 2, 8, 1, 8]}
Y = {1: [1, 2, 3, 4, 5, 6, 7, 8], 2: [5, 5, 5, 5, 5, 5, 5, 5]}


def column(df, expr):
    df = staging._add_tickers(df, {"v": expr})
    rows = df.select("ticker", "trade_date", "v").orderBy("ticker", "trade_date").collect()
    return [r.v for r in rows]


def grouped(pdf, f, col="x"):
    return [None if v != v else v for v in pdf.groupby("ticker")[col].transform(f)]


def same(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert (g is None and w is None) or g == pytest.approx(w, abs=1e-9), (got, want)


@pytest.fixture(scope="module")
def panel(bars_of):
    return bars_of({"x": X, "y": Y})


@pytest.mark.parametrize("make, pandas_form", [
    (lambda: ts.total("x", 3), lambda s: s.rolling(3).sum()),
    (lambda: ts.mean("x", 3), lambda s: s.rolling(3).mean()),
    (lambda: ts.mean("x", 3, 1), lambda s: s.rolling(3, min_periods=1).mean()),
    (lambda: ts.total("x", 3, 2), lambda s: s.rolling(3, min_periods=2).sum()),
    (lambda: ts.std("x", 3), lambda s: s.rolling(3).std()),
    (lambda: ts.low("x", 3), lambda s: s.rolling(3).min()),
    (lambda: ts.high("x", 3), lambda s: s.rolling(3).max()),
    (lambda: ts.prod("x", 3), lambda s: s.rolling(3).apply(np.prod)),
    (lambda: ts.delay("x", 2), lambda s: s.shift(2)),
    (lambda: ts.ahead("x", 2), lambda s: s.shift(-2)),
    (lambda: ts.delta("x", 1), lambda s: s.diff(1)),
    (lambda: ts.change("x", 1), lambda s: s.pct_change(1, fill_method=None)),
    (lambda: ts.rank("x", 4), lambda s: s.rolling(4).rank()),
    (lambda: ts.argmax("x", 4), lambda s: s.rolling(4).apply(lambda a: a.argmax() + 1, raw=True)),
    (lambda: ts.argmin("x", 4), lambda s: s.rolling(4).apply(lambda a: a.argmin() + 1, raw=True)),
    (lambda: ts.highday("x", 4), lambda s: s.rolling(4).apply(lambda a: 4 - a.argmax(), raw=True)),
    (lambda: ts.decay("x", 3), lambda s: s.rolling(3).apply(lambda a: (a * [1, 2, 3]).sum() / 6, raw=True)),
    (lambda: ts.slope("x", 4), lambda s: s.rolling(4).apply(lambda a: np.polyfit(range(4), a, 1)[0], raw=True)),
    (lambda: ts.ewm("x", 0.3), lambda s: s.ewm(alpha=0.3).mean()),
    (lambda: ts.ewm_recursive("x", 0.3), lambda s: s.ewm(alpha=0.3, adjust=False).mean()),
    (lambda: ts.cumprod("x"), lambda s: s.cumprod().ffill()),
    (lambda: ts.cummax("x"), lambda s: s.cummax().ffill()),
])
def test_rolling_like_pandas(panel, make, pandas_form):
    df, pdf = panel
    same(column(df, make()), grouped(pdf, pandas_form))


@pytest.mark.parametrize("alpha", [0.5, 1 / 6, 1.0])
@pytest.mark.parametrize("adjust", [True, False])
def test_exponential_means_over_long_gaps(bars_of, alpha, adjust):
    """200 missing rows outlast the rows that the fold looks back."""
    df, pdf = bars_of({"x": {1: [10, 4, *[None] * 200, 7, None, 3], 2: [None] * 3 + [5, *[None] * 200, 1]}})
    make = ts.ewm if adjust else ts.ewm_recursive
    same(column(df, make("x", alpha)), grouped(pdf, lambda s: s.astype(float).ewm(alpha=alpha, adjust=adjust).mean()))


def test_two_sided_windows(panel):
    df, pdf = panel
    want = []
    for _, g in pdf.groupby("ticker"):
        want += list(g["x"].astype(float).rolling(4).cov(g["y"].astype(float)))
    same(column(df, ts.cov("x", "y", 4)), [None if v != v else v for v in want])
    got = column(df, ts.corr("x", "y", 3))
    assert got[2] == pytest.approx(np.corrcoef([3, 1, 4], [1, 2, 3])[0, 1])
    assert got[3:6] == [None] * 3  # a gap in the window
    assert got[8:] == [None] * 8  # constant side: no error, no value


def test_rank_of_top_differs_only_with_a_tied_maximum(bars_of):
    df, _ = bars_of({"x": {1: [1, 2, 2, 3]}})
    assert column(df, ts.rank_of_top("x", 3))[2] == pytest.approx(2.5 / 2.5)
    assert column(df, ts.rank_pct("x", 3))[2] == pytest.approx(2.5 / 3)
    assert column(df, ts.rank_of_top("x", 3))[3] == pytest.approx(1.0)


def test_slope_of_index_drops_weak_fits(bars_of):
    df, _ = bars_of({"x": {1: [1, 2, 3, 4, 5, 7, 1, 9]}})
    got = column(df, ts.slope_of_index("x", 6, critical_t=2.776))
    assert got[5] == pytest.approx(np.polyfit([1, 2, 3, 4, 5, 7], range(6), 1)[0])
    assert got[6] is None


@pytest.fixture(scope="module")
def one_day(spark):
    rows = [(1, 2.0, 10.0), (2, 2.0, 20.0), (3, 5.0, 30.0), (4, None, 40.0), (5, 1.0, 50.0), (6, 9.0, 60.0)]
    return spark.createDataFrame(rows, "ticker long, x double, mv double").withColumn(
        "trade_date", F.lit("2020-01-06").cast("date"))


def test_cross_section_ranks(one_day):
    s = pd.Series([2.0, 2.0, 5.0, None, 1.0, 9.0])
    same(column(one_day, xs.rank("x")), [None if v != v else v for v in s.rank()])
    same(column(one_day, xs.rank("x", False)), [None if v != v else v for v in s.rank(ascending=False)])
    same(column(one_day, xs.rank_max("x")), [None if v != v else v for v in s.rank(method="max")])
    same(column(one_day, xs.rank_pct("x")), [None if v != v else v for v in s.rank(pct=True)])
    same(column(one_day, xs.rank_max_pct("x")), [None if v != v else v for v in s.rank(pct=True, method="max")])
    same(column(one_day, xs.scale("x")), [None if v != v else v for v in s / 19])


def test_neutralize_like_least_squares(one_day):
    full = one_day.withColumn("x", F.coalesce("x", F.lit(100.0)))
    got = [r.r for r in xs.neutralize(full, "x", "r", "mv").orderBy("ticker").collect()]
    x, mv = np.array([2.0, 2, 5, 100, 1, 9]), np.arange(10.0, 70, 10)
    med = np.median(x)
    band = 3 * 1.4826 * np.median(abs(x - med))
    z = np.clip(x, med - band, med + band)
    z = (z - z.mean()) / z.std()
    b, a = np.polyfit(mv, z, 1)
    same(got, list(z - a - b * mv))


def test_a_day_with_a_gap_is_not_neutralized(one_day):
    assert {r.r for r in xs.neutralize(one_day, "x", "r", "mv").collect()} == {None}


def test_scalars_give_null_instead_of_errors(spark):
    row = spark.range(1).select(
        scalar.div(F.lit(1.0), F.lit(0.0)), scalar.ln(F.lit(0.0)), scalar.power(F.lit(-1.0), 0.5),
        scalar.power(F.lit(0.0), -1.0), scalar.larger(F.lit(1.0), F.lit(None).cast("double")),
        scalar.finite(F.lit(float("nan")))).first()
    assert list(row) == [None] * 6


@pytest.mark.parametrize("size", [1e-10, 1e-3, 1.0, 1e12, 1e200])
def test_values_of_any_size_rank_apart_and_noise_ties(spark, size):
    import datetime

    values = [1, 2, 3, 4, 5, 6, 0.1 + 0.2, 0.3]
    df = spark.createDataFrame([(i, datetime.date(2020, 1, 6), v * size) for i, v in enumerate(values)],
                               "ticker long, trade_date date, x double")
    got = [r.r for r in df.withColumn("r", xs.rank("x")).orderBy("ticker").collect()]
    assert got == [3, 4, 5, 6, 7, 8, 1.5, 1.5]
    line = df.withColumns({"trade_date": F.expr("date_add(trade_date, cast(ticker as int))"), "ticker": F.lit(0)})
    ranks = line.withColumns({"r": ts.rank("x", 6), "top": ts.argmax("x", 6), "low": ts.argmin("x", 2)}).orderBy("trade_date").collect()
    assert [r.r for r in ranks[5:]] == [6, 1, 1.5] and [r.top for r in ranks[5:]] == [6, 5, 4] and ranks[-1].low == 1


def test_comparisons_by_the_size_of_the_operands(spark):
    rows = [(1e-10, 2e-10), (0.1 + 0.2, 0.3), (1e12, 1e12 + 1e4), (0.0, 1e-30), (-1e-30, 0.0), (5.0, 5.0)]
    df = spark.createDataFrame(rows, "a double, b double").select(
        scalar.less("a", "b").alias("lt"), scalar.less("b", "a").alias("gt"), scalar.not_more("a", "b").alias("le"),
        scalar.minus("b", "a").alias("d"), scalar.sign(F.col("a")).alias("s"))
    got = df.collect()
    assert [r.lt for r in got] == [True, False, True, True, True, False]
    assert not any(r.gt for r in got) and all(r.le for r in got)
    assert got[1].d == 0 and got[3].d == 1e-30 and [r.s for r in got] == [1, 1, 1, 0, -1, 1]
