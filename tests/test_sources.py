"""Files: choice lists, export logs, day files, metric store, manifests."""

import datetime
import struct

import pytest
from pyspark.sql import functions as F

from factorloom.operators import metrics as m
from factorloom.operators.metrics import SelectMetric
from factorloom.sources import choice_files, day_files, readers, store

HEADER = ",".join(choice_files.CHOICE_COLUMNS)


def test_choice_csv_keeps_leading_zeros(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{HEADER}\n1,甲,000042,造纸,纸浆,2023-03-06,2023-03-10,10.00,9.50,-5.00%\n")
    (tmp_path / "b.csv").write_text(f"{HEADER}\n2,乙,600077,航运,港口,2023-03-07,2023-03-10,8.00,8.40,5.00%\n")
    rows = choice_files.read_choices(spark, str(tmp_path)).orderBy("seq").collect()
    assert [r.ticker for r in rows] == ["000042", "600077"]
    assert rows[0].buy_date == datetime.date(2023, 3, 6) and rows[1].sale_price == 8.4


def test_log_cleaning(spark):
    lines = ["1 甲甲 (600077) 航运 -- 港口2023-03-06 2023-03-10 10.00 9.50 -5.00%",
             "12 乙乙 (000042)航运 -- 港口 2023-03-06 2023-03-10 8.00 8.40 5.00%",
             "3 a (1) b -- c 2023-03-06 2023-03-07 2023-03-10 1.00 2.00 3.00 4.00 5.00%"]
    df = choice_files.clean_log(spark.createDataFrame([(x,) for x in lines], "value string"))
    cleaned = [r.line for r in df.collect()]
    assert cleaned[0] == "1,甲甲,600077,航运,港口,2023-03-06,2023-03-10,10.00,9.50,-5.00%"
    parsed = choice_files.parse_log(df).collect()
    assert [r.ticker for r in parsed] == ["600077", "000042"] and parsed[1].change == "5.00%"
    assert df.where("too_long").count() == 1


def test_day_files(spark, tmp_path):
    records = [(20220104, 1000, 1100, 900, 1050, 123.0, 500, 0), (20220105, 1050, 1200, 1000, 1155, 50.5, 600, 0),
               (20220106, 1155, 1155, 1155, 1155, 10.0, 700, 0)]
    (tmp_path / "sh510300.day").write_bytes(b"".join(struct.pack("<IIIIIfII", *r) for r in records) + b"\0" * 7)
    rows = day_files.read_day_files(spark, str(tmp_path)).orderBy("trade_date").collect()
    assert [r.ticker for r in rows] == ["510300"] * 3
    assert rows[0].trade_date == datetime.date(2022, 1, 4) and rows[0].open_price == 10.0
    assert [r.chg_pct for r in rows] == [0.0, 10.0, 0.0]
    assert rows[1].turnover_value == pytest.approx(5.05) and rows[2].turnover_vol == 700


def test_metric_store_recomputes_only_on_reset(spark, bars_of, tmp_path):
    df, _ = bars_of({"close_price": {1: [1, 2, 3, 4]}})
    metric = SelectMetric("ma", m.ma_any, 2, "close_price")
    path = str(tmp_path)
    first = [r.ma for r in store.stored_metric(df, metric, path).orderBy("trade_date").collect()]
    assert first == [1, 1.5, 2.5, 3.5]
    doubled = df.withColumn("close_price", F.col("close_price") * 2)
    kept = [r.ma for r in store.stored_metric(doubled, metric, path).orderBy("trade_date").collect()]
    assert kept == first
    new = [r.ma for r in store.stored_metric(doubled, metric, path, reset_cache=True).orderBy("trade_date").collect()]
    assert new == [2, 3, 5, 7]
    other = SelectMetric("ma", m.ma_any, 3, "close_price")
    assert store.metric_key(other) != store.metric_key(metric)


def test_metric_store_tells_functions_frames_and_panels_apart(spark, bars_of, tmp_path):
    df, _ = bars_of({"close_price": {1: [1, 2]}, "pe": {1: [4, 4]}, "pb": {1: [5, 5]}})

    def values(metric, panel="p"):
        return [r.a for r in store.stored_metric(df, metric, str(tmp_path), panel=panel).collect()]

    assert values(SelectMetric("a", m.ep)) == [0.25, 0.25] and values(SelectMetric("a", m.bp)) == [0.2, 0.2]
    with pytest.raises(ValueError):
        store.metric_key(SelectMetric("a", m.ep, df))
    assert store.metric_key(SelectMetric("a", m.ep), "p") != store.metric_key(SelectMetric("a", m.ep), "q")


def test_manifest_and_enriched_sinks(spark, tmp_path):
    df = spark.createDataFrame([("000042", "甲", 1.5)], "ticker string, name string, v double")
    store.write_manifest(df, str(tmp_path / "positions"))
    assert spark.read.parquet(str(tmp_path / "positions.parquet")).collect() == df.collect()
    choice_files.write_enriched(df, str(tmp_path / "gbk"), "GBK")
    # a partition without rows leaves a file with the header only
    texts = [part.read_bytes().decode("gbk") for part in (tmp_path / "gbk").glob("*.csv")]
    assert {line for text in texts for line in text.splitlines()} == {"ticker,name,v", "000042,甲,1.5"}


def test_empty_sources_are_errors(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n")
    with pytest.raises(ValueError):
        readers.csv_checked(spark, str(tmp_path / "x.csv"), "a int, b int")
    with pytest.raises(ValueError):
        readers.instruments(spark.createDataFrame([], "ticker long"))


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, n int")
    assert [r.x for r in readers.no_nan(df).collect()] == [None, 2.0]


def test_day_files_of_years_and_by_name(spark, tmp_path):
    rows = [("12", 20201228, 100, 120, 90, 110, 5.0, 7), ("12", 20210104, 110, 130, 100, 121, 6.0, 8), ("7", 20210104, 1, 1, 1, 1, 0.0, 0),
            *[("9", 20000101 + i, 10, 10, 10, 10 + i, 1.0, 0xffffffff) for i in range(28)]]
    df = spark.createDataFrame(rows, "ticker string, day long, open long, high long, low long, close long, amount double, vol long")
    day_files.write_day_files(df.repartition(3), str(tmp_path / "days"))
    got = day_files.read_day_files(spark, str(tmp_path / "days")).orderBy("ticker", "trade_date").collect()
    assert len(got) == len(rows) and [r.close_price for r in got if r.ticker == "12"] == [1.1, 1.21]
    assert [r.chg_pct for r in got if r.ticker == "12"] == [0.0, 10.0]  # the change crosses from one file to the next
    assert {r.turnover_vol for r in got if r.ticker == "9"} == {0xffffffff}
    files = {str(f.parent.relative_to(tmp_path / "days")) for f in (tmp_path / "days").rglob("*.txt")}
    assert files == {"ticker=12/year=2020", "ticker=12/year=2021", "ticker=7/year=2021", "ticker=9/year=2000"}
