"""Line deduplication over overlapping windows of consecutive lines.

Every run of three lines is hashed (128 bits). A window that occurs more than once in the whole table keeps its first
occurrence, by doc_id and line; the lines of all later ones are covered, and a document loses the union of its covered
lines. Texts are shuffled once, to meet their covered positions; the windows travel as two hashes and a place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, stored, whole_text

WINDOW = 3


def _lines():
    return F.split(whole_text(), "\n", -1)


def windows(docs: DataFrame, size: int = WINDOW, row: str | None = None) -> DataFrame:
    """doc_id, ``body`` (the text's hash), ``pos`` (from 0) and the hashes h1, h2 of every window that is not blank.

    ``place`` orders windows by doc_id (null first), then line: one number, so that its minimum aggregates by hash. With
    ``row``, a column of distinct numbers, the text's hash and this number break its ties, and the number is kept.
    """
    def hashes(lines):
        def window(_, i):
            parts = [F.get(lines, i + k) for k in range(size)]
            filled = F.concat(*parts).rlike("\\S")
            return F.when(filled, F.struct(F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(1), *parts).alias("h2")))

        return F.transform(F.slice(lines, 1, F.greatest(F.size(lines) - size + 1, F.lit(0))), window)

    first = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.lit("-9223372036854775809").cast("decimal(20,0)"))
    own = ["doc_id", "body"] if row is None else ["doc_id", "body", row]
    place = first * F.lit(1 << 31).cast("decimal(10,0)") + F.col("pos").cast("decimal(10,0)")
    return (docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("body"), _lines().alias("lines"), *own[2:])
            .select(*own, F.posexplode(hashes(F.col("lines"))).alias("pos", "h"))
            .where("h is not null")
            .select(*own, "pos", "h.h1", "h.h2",
                    (place if row is None else F.struct(place.alias("at"), "body", row)).alias("place")))


def covered(docs: DataFrame, size: int = WINDOW, row: str | None = None) -> DataFrame:
    """doc_id, body (and ``row``) and the sorted ``places`` at which later occurrences start, for the documents that have
    any."""
    all_ = windows(docs, size, row)
    repeated = (all_.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
                .where("n > 1").drop("n"))
    later = all_.join(repeated, ["h1", "h2"]).where("place > first")
    return later.groupBy("doc_id", "body", *([] if row is None else [row])).agg(F.array_sort(F.collect_set("pos")).alias("places"))


def remove_repeats(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows and columns of ``docs``, its texts without the lines that later occurrences cover, and two columns more:
    ``n_lines`` and ``n_removed`` (long; a taken name gets an underscore).

    A line ends at a line feed; a text of fewer than ``size`` lines has no window and stays. Blank windows do not count.
    All rows stay, if with an empty text; ``n_chars`` is counted anew where lines went. A null text stays null. Rows of
    the same id compete by line number, then by the hash of their text; of rows of the same id and text one comes first. An
    empty table gives an empty result.
    """
    row, columns = None, docs.columns
    if not docs.groupBy("doc_id").count().where("count > 1").isEmpty():
        # ids do not tell rows apart: number them, once for both reads
        row = free_name(docs, "row_")
        docs = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    names = [free_name(docs, n) for n in ("n_lines", "n_removed", "places_", "body_", "id_", "lines_", "kept_")]
    n_lines, n_removed, places, body, id_, lines, kept = names
    if row is None:
        found = covered(docs.select("doc_id", "text"), size).select(
            F.col("doc_id").alias(id_), F.col("body").alias(body), F.col("places").alias(places))
        same = F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (F.col(lines) == F.col(body))
    else:
        found = covered(docs.select("doc_id", "text", row), size, row).select(
            F.col(row).alias(id_), F.col("places").alias(places))
        same = F.col(row) == F.col(id_)
    own = docs.withColumn(lines, F.xxhash64("text"))
    joined = own.join(found, same, "left")
    # what stays lies between the end of one covered window and the start of the next
    starts = F.concat(F.array(F.lit(0)), F.transform(places, lambda p: p + size))
    stops = F.concat(F.col(places), F.array(F.size(lines)))
    between = F.zip_with(starts, stops, lambda a, b: F.slice(F.col(lines), a + 1, F.greatest(b - a, F.lit(0))))
    out = (joined.withColumn(lines, _lines())
           .withColumn(kept, F.when(F.col(places).isNotNull(), F.flatten(between)))
           .withColumn("text", F.when(F.col(kept).isNotNull(), F.array_join(kept, "\n")).otherwise(F.col("text")))
           .withColumn(n_lines, F.size(lines).cast("long"))
           .withColumn(n_removed, F.coalesce(F.size(lines) - F.size(kept), F.lit(0)).cast("long")))
    if "n_chars" in docs.columns:
        count = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col(kept).isNotNull(), count).otherwise(F.col("n_chars")))
    return out.select(*columns, n_lines, n_removed)


#: The same in DuckDB.
SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
runs AS (
  SELECT doc_id, pos, line || chr(10) || lead(line, 1) OVER w || chr(10) || lead(line, 2) OVER w AS run
  FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
ranked AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) AS nth
  FROM runs WHERE run IS NOT NULL AND regexp_matches(run, '\\S')),
gone AS (
  SELECT DISTINCT doc_id, pos + k AS pos FROM ranked, (VALUES (0), (1), (2)) AS t(k) WHERE nth > 1)
SELECT lines.doc_id, coalesce(string_agg(line, chr(10) ORDER BY lines.pos) FILTER (WHERE gone.pos IS NULL), '') AS text,
       count(*) AS n_lines, count(gone.pos) AS n_removed
FROM lines LEFT JOIN gone ON lines.doc_id = gone.doc_id AND lines.pos = gone.pos
GROUP BY lines.doc_id
"""
