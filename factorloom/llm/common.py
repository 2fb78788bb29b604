"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import math
import tempfile
import uuid

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column="text"):
    """The text of a row; a null text counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; one of our own only on a single machine where it is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="factorloom-shared-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and no lost executor takes it along."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared one that no query reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def text_groups(column, most: int = 1_500_000):
    """The texts of an Arrow column as lists of about ``most`` characters at most, or of one longer text."""
    group, size = [], 0
    for text in column:
        text = text.as_py()
        if group and size + len(text) > most:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def cut_batch(batch, column: int, most: int):
    """An Arrow batch cut where the texts of a column pass another ``most`` bytes."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // most, prepend=-1)).tolist()
    for a, b in zip(at, [*at[1:], batch.num_rows]):
        yield batch.slice(a, b - a)


def hash_bound(rank, rows: int, size: int):
    """Whether a row may be among the ``size`` of least ``rank`` (a 64-bit hash) of ``rows``: true of about twice as many."""
    bound = int(-2 ** 63 + 2 ** 64 * min(1.0, (2 * size + 64) / max(1, rows))) - 1
    return rank <= F.lit(str(min(bound, 2 ** 63 - 1))).cast("long")


def hash_sample(df: DataFrame, rank, rows: int, size: int) -> DataFrame:
    """The ``size`` rows of least ``rank`` (a 64-bit hash) of the ``rows`` in ``df``. All but about twice as many are left
    out by a bound where they are read, so that no task gathers more, however many partitions there are."""
    return df.where(hash_bound(rank, rows, size)).orderBy(rank).limit(size)


def parts_for(rows: int, rows_each: int) -> int:
    return max(1, math.ceil(rows / rows_each))
