"""Document fingerprints: bottom-k sketches of word-shingle hashes, in DataFrame functions alone.

A sketch is the sorted array of the k least distinct hashes of a document's shingles. Sketches of parts merge into that of
the whole, and estimate resemblance, containment and the number of distinct shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import parts_for, whole_text

K = 128
SHINGLE = 5
SPAN = 2.0 ** 64
RANGE_ROWS = 1024  # documents of one range when documents are put in order,
RANGES = 4096  # up to so many ranges


def hashes(text, shingle: int = SHINGLE) -> Column:
    """Hashes of the word shingles of a text; of all its words if it has fewer, none without a word."""
    words = F.filter(F.split(text, "\\s+", -1), lambda w: w != "")

    def of(words):
        inner = F.transform(F.slice(words, 1, F.greatest(F.size(words) - shingle + 1, F.lit(0))),
                            lambda _, i: F.xxhash64(*[F.get(words, i + k) for k in range(shingle)]))
        short = F.when(F.size(words) > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(words) >= shingle, inner).otherwise(short)

    # the words are bound once; else each shingle would split the text anew
    return F.get(F.transform(F.array(words), of), F.lit(0))


def bottom(values, k: int = K) -> Column:
    """The ``k`` least distinct values. Long arrays are first cut down to what lies under a bound that most likely keeps
    over k of them; where it does not, all are sorted."""
    def least(v):
        return F.slice(F.array_sort(F.array_distinct(v)), 1, k)

    def cut(v):
        # under this bound lie about four times k of the hashes, if they are distinct
        bound = (F.lit(4.0 * k * SPAN) / F.size(v) - F.lit(SPAN / 2)).cast("bigint")
        return F.array_distinct(F.filter(v, lambda h: h < bound))

    def chosen(v):
        return F.get(F.transform(F.array(cut(v)), lambda c: F.when(
            F.size(c) >= k, F.slice(F.array_sort(c), 1, k)).otherwise(least(v))), F.lit(0))

    return F.get(F.transform(F.array(values), lambda v: F.when(F.size(v) > 16 * k, chosen(v)).otherwise(least(v))), F.lit(0))


def sketch(text, k: int = K, shingle: int = SHINGLE) -> Column:
    return bottom(hashes(text, shingle), k)


def merge(a, b, k: int = K) -> Column:
    """The sketch of both documents' shingles together."""
    return F.slice(F.array_sort(F.array_union(a, b)), 1, k)


def distinct_shingles(a, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below ``k``, else from the k-th least hash."""
    kth = (F.element_at(a, F.lit(-1)).cast("double") + SPAN / 2) / SPAN
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / kth)


def resemblance(a, b, k: int = K) -> Column:
    """Estimated Jaccard likeness of two documents' shingle sets, from 0 to 1; two without a shingle are alike."""
    both = merge(a, b, k)
    shared = F.size(F.array_intersect(F.array_intersect(both, a), b)).cast("double")
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(shared / F.size(both))


def containment(a, b, k: int = K) -> Column:
    """Estimated part of a's distinct shingles that b has as well, from 0 to 1; 1 if a has none."""
    shared = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    n = distinct_shingles(a, k)
    return F.when(n == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / n))


def fingerprint(a) -> Column:
    """A sketch as text: its hashes as 16 hexadecimal digits each."""
    return F.array_join(F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def sketches(docs: DataFrame, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and ``sketch`` of every row; a null text counts as empty and has an empty sketch. Other columns are
    ignored."""
    return docs.select("doc_id", sketch(whole_text(), k, shingle).alias("sketch"))


def merged(parts: DataFrame, key: str, k: int = K) -> DataFrame:
    """One sketch for each value of ``key`` from the column ``sketch`` of its parts. Rows are hashes, so that a key with
    very many parts is reduced before the shuffle and no task gathers its sketches."""
    rows = parts.select(key, F.explode_outer("sketch").alias("h")).distinct()
    least = Window.partitionBy(key).orderBy("h")
    ranked = rows.withColumn("nth", F.row_number().over(least)).where((F.col("nth") <= k) | F.col("h").isNull())
    return ranked.groupBy(key).agg(F.array_sort(F.collect_list("h")).alias("sketch"))


def _longs(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>") if values else F.array().cast("array<bigint>")


def _range_of(id_, starts: list[int]) -> Column:
    """Number of the values in ``starts`` (sorted) that are at most ``id_``, by halving; 0 for null."""
    steps = [1 << i for i in range(max(1, len(starts)).bit_length() - 1, -1, -1)]

    def step(at, width):
        there = F.get(_longs(starts), at + width - 1)
        return F.when(F.coalesce(there <= id_, F.lit(False)), at + width).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``docs`` with ``next_`` before each of ``columns``: the value of the row that follows by doc_id (null first, then
    by text); the last row is followed by the first.

    Rows go to ranges of doc_id, at most ``RANGES``, in one exchange. A range's first rows are dealt to the range before
    as well, so that its last row finds its successor there.
    """
    id_ = F.col("doc_id").cast("long")
    ids = docs.select(id_.alias("doc_id"))
    n = ids.count()
    ranges = min(RANGES, parts_for(n, RANGE_ROWS))
    cuts = [] if ranges < 2 else ids.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.2 / ranges)
    # the ids that do come first in their range, whatever the quantiles' precision
    firsts = sorted({r["first"] for r in ids.groupBy(_range_of(id_, sorted({int(c) for c in cuts})).alias("at")).agg(
        F.min("doc_id").alias("first"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).collect()
        if r["first"] is not None})
    nulls = n > 0 and not ids.where("doc_id is null").isEmpty()
    head, starts = (None, firsts) if nulls or not firsts else (firsts[0], firsts[1:])
    at = _range_of(id_, starts)
    leads = F.coalesce(F.array_contains(_longs(starts), id_), F.lit(False))

    def seat(place, guest, holds):
        there = F.struct(F.expr(str(place)).alias("at") if isinstance(place, int) else place.alias("at"),
                         F.lit(guest).alias("guest"))
        return F.when(holds, there)

    dealt = (docs.withColumn("at_", at)
             .withColumn("seat_", F.explode(F.filter(F.array(
                 seat(F.col("at_"), 0, F.lit(True)), seat(F.col("at_") - 1, 1, leads),
                 seat(len(starts), 2, id_.eqNullSafe(F.lit(head).cast("long")))), lambda x: x.isNotNull())))
             .withColumns({"at_": F.col("seat_.at"), "guest_": F.col("seat_.guest")}).drop("seat_"))
    order = Window.partitionBy("at_").orderBy("guest_", F.asc_nulls_first("doc_id"), "text")
    dealt = dealt.withColumn("follows_", F.lead(F.struct(*columns)).over(order)).where("guest_ = 0")
    return dealt.withColumns({f"next_{c}": F.col(f"follows_.{c}") for c in columns}).drop("at_", "guest_", "follows_")


def edited_likeness(docs: DataFrame, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """How each document's sketch likens it to an edited copy and to the next document.

    The edited copy has the last half of its code points (rounded down) replaced by the first as many of the next
    document's. Returns doc_id, n_chars, edited (the text), sketch, edited_sketch, near_edited, near_next, and estimates
    of the distinct shingles and of how much of the text the edited copy holds. A null text counts as empty; repeated rows
    and null ids are documents in the order of ``with_next``. Other columns are ignored. An empty table gives an empty
    result.
    """
    base = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).withColumn(
        "sketch", sketch(F.col("text"), k, shingle))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    both = (with_next(base, ["text", "sketch"]).withColumn("edited", edited)
            .withColumn("edited_sketch", sketch(F.col("edited"), k, shingle)))
    return both.select(
        "doc_id", n.cast("long").alias("n_chars"), "edited", "sketch", "edited_sketch",
        resemblance("sketch", "edited_sketch", k).alias("near_edited"),
        resemblance("sketch", "next_sketch", k).alias("near_next"),
        distinct_shingles("sketch", k).alias("shingles"), containment("sketch", "edited_sketch", k).alias("held"))
