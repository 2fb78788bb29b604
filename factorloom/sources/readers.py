"""Table readers: explicit schemas, filters and columns that reach the scan."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parquet(spark: SparkSession, path: str, columns: list[str] | None = None, where: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    df = df if where is None else df.where(where)
    return df if columns is None else df.select(*columns)


def no_nan(df: DataFrame) -> DataFrame:
    """NaN to NULL in every floating column: Spark sorts NaN as largest, and it poisons sums."""
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if t in ("double", "float") else F.col(c)
                       for c, t in df.dtypes])


def bars(source: DataFrame, start, end) -> DataFrame:
    """Bars of a date range; on a table partitioned by trade_date this prunes partitions."""
    return no_nan(source.where(F.col("trade_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))))


def instruments(source: DataFrame, funds=False) -> DataFrame:
    """Equities, or exchange-traded funds only; an empty master is an error."""
    df = source.where("etf_lof = 'ETF'") if funds else source
    if df.isEmpty():
        raise ValueError("the instrument master is empty")
    return df


def calendar(source: DataFrame, exchange="XSHG") -> DataFrame:
    return source.where(F.col("exchange_cd") == exchange)


def fundamentals(source: DataFrame) -> DataFrame:
    return source.select("ticker", "publish_date", "end_date", "act_pubtime", "basic_eps", "diluted_eps", "eps",
                         "reser_ps", "c_reser_ps", "n_cin_cash_ps", "fcf_fps")


def intraday(source: DataFrame, start, end) -> DataFrame:
    return (source.where("open > 0")
            .where(F.col("trade_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
            .select("ticker", "trade_date", "close"))


def jdbc(spark: SparkSession, table: str, column: str, lower, upper, partitions: int) -> DataFrame:
    """A database table read in parallel ranges of one column; the connection comes from the environment."""
    options = {"user": os.environ["BARS_DB_USER"], "password": os.environ["BARS_DB_PASSWORD"]}
    return spark.read.jdbc(os.environ["BARS_DB_URL"], table, column=column, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=options)


def csv_checked(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A header CSV; an empty one is an error."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    if df.isEmpty():
        raise ValueError(f"{path} holds no rows")
    return df
