"""What all query modules share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def settled(x):
    """How results are compared: 24 significant bits, whatever the size of the value."""
    def split(v):
        c = v * F.lit(536870913.0)
        return c - (c - v)

    return F.when(F.abs(x) >= 1e290, split(x * F.lit(2.0 ** -100)) * F.lit(2.0 ** 100)).otherwise(split(x))


def tidy(df: DataFrame) -> DataFrame:
    return df.select(*[settled(F.col(c)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
