"""Stored metrics and manifests."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.metrics import SelectMetric, append_metric

KEYS = ["ticker", "trade_date"]


def metric_key(metric: SelectMetric, panel: str = "") -> str:
    """Folder name of a metric: panel, name, function and arguments. A frame among the arguments has no name that tells
    it from others, so such a metric must be given as one whose function closes over it, under a name of its own."""
    if any(isinstance(a, DataFrame) for a in metric.args):
        raise ValueError(f"{metric.name}: a frame as an argument cannot be part of a key")
    function = getattr(metric.func, "__qualname__", type(metric.func).__name__)
    text = json.dumps([panel, metric.name, getattr(metric.func, "__module__", ""), function, [repr(a) for a in metric.args]])
    return f"{metric.name}-{hashlib.sha256(text.encode()).hexdigest()[:16]}"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def stored_metric(bars: DataFrame, metric: SelectMetric, store: str, reset_cache=False, panel: str = "") -> DataFrame:
    """The metric from the store, computed and written first if it is not there or is to be reset.

    One Parquet folder per panel, metric, function and arguments; returns (ticker, trade_date, <name>). ``panel`` names
    the bars: what was stored under the same name is returned whatever ``bars`` holds now, until it is reset.
    """
    spark = bars.sparkSession
    path = f"{store}/metric={metric_key(metric, panel)}"
    if reset_cache or not _exists(spark, f"{path}/_SUCCESS"):
        append_metric(bars, metric).select(*KEYS, metric.name).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def long_form(panel: DataFrame, names: list[str]) -> DataFrame:
    """(ticker, trade_date, metric, value), one row per metric."""
    pairs = ", ".join(f"{json.dumps(n)}, cast(`{n}` as double)" for n in names)
    return panel.selectExpr(*KEYS, f"stack({len(names)}, {pairs}) as (metric, value)")


def write_manifest(df: DataFrame, path: str) -> None:
    """Positions or sales as Parquet, and as CSV next to it."""
    df.write.mode("overwrite").parquet(f"{path}.parquet")
    df.write.mode("overwrite").option("header", True).csv(f"{path}.csv")


def null_audit(df: DataFrame, names: list[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(n).isNull()).alias(n) for n in names])
