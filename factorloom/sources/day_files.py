"""Fixed-width day files: 32-byte little-endian records, decoded on the executors."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import percent_change

RECORD = 32
SCHEMA = ("ticker string, trade_date date, open_price double, highest_price double, lowest_price double, "
          "close_price double, turnover_value double, turnover_vol long")


def _decode(batches):
    import numpy as np
    import pyarrow as pa

    # fixed values: the layout of one record
    layout = np.dtype([("day", "<u4"), ("open", "<u4"), ("high", "<u4"), ("low", "<u4"), ("close", "<u4"),
                       ("amount", "<f4"), ("vol", "<u4"), ("unused", "<u4")])
    for batch in batches:
        named = "ticker" in batch.schema.names
        names = batch.column("ticker" if named else "path").to_pylist()
        for name, content in zip(names, batch.column("content").to_pylist()):
            name = name if named else name.rsplit("/", 1)[-1].split(".")[0]
            rows = np.frombuffer(content, layout, count=len(content) // RECORD)
            day = rows["day"].astype("int64")
            months = (day // 10000 - 1970) * 12 + day // 100 % 100 - 1
            dates = months.astype("datetime64[M]").astype("datetime64[D]") + (day % 100 - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([re.sub("^(sh|sz)", "", name)] * len(rows), pa.string()), pa.array(dates, pa.date32())]
                + [pa.array(rows[c] / 100.0, pa.float64()) for c in ("open", "high", "low", "close")]
                + [pa.array(rows["amount"].astype("float64") / 10, pa.float64()),
                   pa.array(rows["vol"].astype("int64"), pa.int64())],
                names=[f.split()[0] for f in SCHEMA.split(", ")])


def _pack(rows):
    """The bars of a ticker and year as the content of a day file."""
    import numpy as np
    import pandas as pd

    rows = rows.sort_values("day")
    records = np.zeros(len(rows), "<u4,<u4,<u4,<u4,<u4,<f4,<u4,<u4")
    for i, c in enumerate(("day", "open", "high", "low", "close", "amount", "vol")):
        records[f"f{i}"] = rows[c].to_numpy()
    return pd.DataFrame({"content": [records.tobytes()], "ticker": [rows["ticker"].iloc[0]], "year": [rows["day"].iloc[0] // 10000]})


def write_day_files(bars: DataFrame, path: str) -> None:
    """Day files of ``bars`` (ticker, day as yyyymmdd, prices in cents, amount, vol) in one job: one for a ticker and
    year, so that neither a group nor a file holds a whole history. Bytes behind the last whole record are not read."""
    year = F.floor(F.col("day") / 10000).alias("year")
    packed = bars.groupBy("ticker", year).applyInPandas(_pack, "content binary, ticker string, year int")
    # a text file's rows are written byte by byte
    packed.select(F.col("content").cast("string").alias("value"), "ticker", "year").write.partitionBy("ticker", "year").text(path)


def read_day_files(spark: SparkSession, path: str) -> DataFrame:
    """Bars of all files under a path, with the change in percent carried from file to file.

    A file's ticker is its folder's (as ``write_day_files`` has them) or else its name.
    """
    files = spark.read.format("binaryFile").load(path)
    return decode(files.select("path", "content", *[F.col(c).cast("string") for c in files.columns if c == "ticker"]))


def decode(files: DataFrame) -> DataFrame:
    """Bars from (path, content) rows, and the ticker if there is such a column."""
    return percent_change(files.mapInArrow(_decode, SCHEMA), "chg_pct")


def record_count(files: DataFrame) -> DataFrame:
    return files.select("path", F.floor(F.length("content") / RECORD).alias("records"))
