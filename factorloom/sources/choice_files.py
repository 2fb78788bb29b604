"""Choice-list files: header CSV, free-text export logs, and the enriched list as CSV."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: the header of a choice-list file and our names for its columns
CHOICE_COLUMNS = {
    "序号": ("seq", "int"),
    "股票名": ("name", "string"),
    "ticker": ("ticker", "string"),
    "一级行业分类": ("industry", "string"),
    "二级行业分类": ("sub_industry", "string"),
    "买入日期": ("buy_date", "date"),
    "卖出日期": ("sale_date", "date"),
    "买入价格(前复权)": ("buy_price", "double"),
    "卖出价格(前复权)": ("sale_price", "double"),
    "涨幅": ("change", "string"),
}
CHOICE_SCHEMA = ", ".join(f"`{c}` {t}" for c, (_, t) in CHOICE_COLUMNS.items())


def read_choices(spark: SparkSession, path: str) -> DataFrame:
    """All files of a folder at once; the ticker stays text, so that leading zeros survive."""
    df = spark.read.schema(CHOICE_SCHEMA).option("header", True).csv(path)
    return df.select(*[F.col(f"`{c}`").alias(n) for c, (n, _) in CHOICE_COLUMNS.items()])


def clean_line(line: Column) -> Column:
    """Put the commas into a line of the free-text export.

    A comma follows the leading number and surrounds dates and two-digit prices; brackets and dashes between
    fields become commas; what that doubles is collapsed, and spaces go.
    """
    # fixed values: the patterns of the export's field borders, applied in this order
    steps = [
        (r"^([0-9]+)", "$1,"),
        (r" \(", ","),
        (r"\)", ","),
        (r" -- ", ","),
        (r"(202[0-9]-[0-9][0-9]-[0-9][0-9])", ",$1,"),
        (r"([0-9]+\.[0-9][0-9])", ",$1,"),
        (r"-,", "-"),
        (r",,", ","),
        (r",%", "%"),
        (r" ", ""),
        (r", ,", ","),
        (r",,", ","),
    ]
    for pattern, replacement in steps:
        line = F.regexp_replace(line, pattern, replacement)
    return line


def clean_log(lines: DataFrame, column="value") -> DataFrame:
    """Cleaned text, and whether it has more fields than a choice has (ten commas or more)."""
    cleaned = clean_line(F.col(column))
    return lines.select(cleaned.alias("line"), cleaned.rlike("(.*,){10}").alias("too_long"))


def too_long(cleaned: DataFrame) -> DataFrame:
    """The lines that ``parse_log`` leaves out, for a report."""
    return cleaned.where("too_long").select("line")


def parse_log(cleaned: DataFrame) -> DataFrame:
    parts = F.split("line", ",")
    return cleaned.where("not too_long").select(
        *[F.get(parts, F.lit(i)).try_cast(t).alias(n) for i, (n, t) in enumerate(CHOICE_COLUMNS.values())])


def write_enriched(df: DataFrame, path: str, encoding="UTF-8") -> None:
    """CSV with a header. Encodings beyond Spark's short list, such as GBK, need its Java charset switch."""
    conf, name = df.sparkSession.conf, "spark.sql.legacy.javaCharsets"
    before = conf.get(name)
    try:
        conf.set(name, "true")
        df.write.mode("overwrite").option("header", True).option("encoding", encoding).csv(path)
    finally:
        conf.set(name, before)
