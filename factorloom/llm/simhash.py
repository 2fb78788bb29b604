"""SimHash near-duplicates: fingerprints of word shingles, linked exactly through vantage-point trees.

A vantage-point tree over a bounded sample of fingerprints cuts the space into shards: each inner node has a vantage point
and a Hamming distance; what lies within goes left, the rest right. Every distinct fingerprint lives in one shard and is
a query to the other shards that its ball of the linking radius touches by the triangle bound. A task holds a block of one
shard's fingerprints, builds a vantage-point tree over it and runs a block of queries through it, pruning by the same
bound. Equal texts have become one fingerprint before; tasks return spanning links only, never all pairs of a group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, hash_sample, stored, whole_text
from .components import components, forest

SHINGLE = 4
DISTANCE = 4
SAMPLE = 4096  # fingerprints that the shards are laid out by; results do not depend on it
SHARDS = 32
SHARD_ROWS = 65_536
BLOCK = 32_768  # fingerprints or queries of a task
LEAF = 64
PAIRS = 1_000_000  # pairs that a task gathers before it reduces them to a forest


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64-bit SimHash, signed, of the word shingles of a text in lower case (A-Z); 0 without a word."""
    words = text.encode().lower().split()  # both as ASCII has it
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        stops = np.cumsum(sizes + 1) - 1
        starts = stops - sizes
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(joined[a:b], 42) for a, b in
                              zip(starts[:len(words) - shingle + 1].tolist(), stops[shingle - 1:].tolist())),
                             np.uint64, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        some = hashes[at:at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(some, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, *more) -> DataFrame:
    """doc_id and ``fp`` (long) of every row, and ``more`` columns; a null text counts as empty."""
    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return docs.select("doc_id", of(whole_text()).alias("fp"), *more)


def _distance(a, b):
    # the count of a negative number would be that of its absolute value
    return np.bitwise_count(np.asarray(a ^ b).view(np.uint64))


def layout(sample: np.ndarray, shards: int) -> list[tuple]:
    """Inner nodes and leaves of the shard tree, in preorder: (vantage point, distance, number of the right child) or
    (shard,)."""
    nodes: list[tuple] = []
    count = 0

    def grow(points, want):
        nonlocal count
        at = len(nodes)
        nodes.append(())
        away = _distance(points, points[0]) if len(points) else np.zeros(0, np.uint8)
        cut = int(np.median(away)) if want > 1 and len(points) > 1 else 0
        cut = min(cut, int(away.max()) - 1) if len(points) > 1 else 0
        if want <= 1 or len(points) < 2 or cut < 0 or away.max() == 0:
            nodes[at] = (count,)
            count += 1
            return
        near = away <= cut
        # what a lopsided cut leaves is dealt out in proportion
        left = min(want - 1, max(1, round(want * near.mean())))
        grow(points[near], left)
        nodes[at] = (int(points[0]), cut, len(nodes))
        grow(points[~near], want - left)

    grow(sample, shards)
    return nodes


def visits(nodes: list[tuple], points: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each shard: its number, and which points live there and which only touch it, as positions."""
    def walk(at, inside, touching):
        if not len(inside) and not len(touching):
            return
        if len(nodes[at]) == 1:
            yield nodes[at][0], inside, touching
            return
        vantage, cut, right = nodes[at]
        a, b = _distance(points[inside], vantage).astype(int), _distance(points[touching], vantage).astype(int)
        yield from walk(at + 1, inside[a <= cut], np.concatenate(
            [touching[b <= cut + radius], inside[(a > cut) & (a <= cut + radius)]]))
        yield from walk(right, inside[a > cut], np.concatenate(
            [touching[b > cut - radius], inside[(a <= cut) & (a > cut - radius)]]))

    yield from walk(0, np.arange(len(points)), np.zeros(0, np.int64))


def tree_pairs(home: np.ndarray, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (one of ``home``, one of ``queries``) at most ``radius`` apart, through a vantage-point tree over ``home``."""
    todo = [(home, queries)]
    while todo:
        home, queries = todo.pop()
        if not len(home) or not len(queries):
            continue
        away = _distance(home, home[0])
        if len(home) <= LEAF or away.max() == 0:
            for at in range(0, len(queries), 1 << 14):
                some = queries[at:at + (1 << 14)]
                i, j = np.nonzero(_distance(home[:, None], some[None, :]) <= radius)
                yield home[i], some[j]
            continue
        cut = min(int(np.median(away)), int(away.max()) - 1)
        to = _distance(queries, home[0]).astype(np.int16)
        todo.append((home[away <= cut], queries[to <= cut + radius]))
        todo.append((home[away > cut], queries[to > cut - radius]))


def _spanning(radius):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        fp, query = rows["fp"].to_numpy(), rows["query"].to_numpy()
        home, queries = fp[~query], fp[query]
        kept_a, kept_b, a, b, size = [], [], [], [], 0

        def reduce():
            nonlocal kept_a, kept_b, a, b, size
            x, y = forest(np.concatenate([*kept_a, *a]), np.concatenate([*kept_b, *b]))
            kept_a, kept_b, a, b, size = [x], [y], [], [], 0

        for x, y in tree_pairs(home, queries, radius):
            other = x != y
            a.append(x[other])
            b.append(y[other])
            size += int(other.sum())
            if size > PAIRS:
                reduce()
        if a:
            reduce()
        return pd.DataFrame({"a": kept_a[0] if kept_a else np.zeros(0, np.int64),
                             "b": kept_b[0] if kept_b else np.zeros(0, np.int64)})

    return run


def links(points: DataFrame, radius: int = DISTANCE) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``, no nulls) that span the groups of those at most
    ``radius`` apart."""
    n = points.count()
    shards = min(SAMPLE // 8, max(SHARDS, math.ceil(n / SHARD_ROWS)))
    sample = hash_sample(points, F.xxhash64(F.lit(7), "fp"), n, SAMPLE).toPandas()["fp"].to_numpy(np.int64)
    nodes = layout(sample, shards)

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            fps = frame["fp"].to_numpy(np.int64)
            own = np.zeros(len(fps), np.int64)
            found = list(visits(nodes, fps, radius))
            for shard, inside, _ in found:
                own[inside] = shard
            for shard, inside, touching in found:
                # a pair meets in the shard of the larger number
                touching = touching[own[touching] < shard]
                at = np.concatenate([inside, touching])
                yield pd.DataFrame({"shard": shard, "fp": fps[at], "query": np.arange(len(at)) >= len(inside)})

    dealt = stored(points.select("fp").mapInPandas(deal, "shard int, fp long, query boolean"), "dealt")
    sizes = dealt.groupBy("shard").agg(F.count_if(~F.col("query")).alias("homes"), F.count(F.lit(1)).alias("all"))
    # blocks of a shard: each block of fingerprints meets each block of queries
    plan = sizes.select("shard", F.ceil(F.col("homes") / BLOCK).cast("int").alias("h"),
                        F.ceil(F.col("all") / (4 * BLOCK)).cast("int").alias("q"))
    salt = F.pmod(F.xxhash64(F.lit(11), "fp"), F.lit(1 << 30))
    both = dealt.join(F.broadcast(plan), "shard")  # a row for each shard: at most SAMPLE / 8
    own, each = F.pmod(salt, F.greatest("h", F.lit(1))).cast("int"), F.pmod(salt, F.col("q")).cast("int")

    def numbers(n):
        return F.sequence(F.lit(0), F.col(n) - 1)

    homes = (both.where("not query").withColumn("i", own).withColumn("j", F.explode(numbers("q"))))
    asked = (both.where("h > 0").withColumn("j", each).withColumn("i", F.explode(numbers("h"))))
    rows = homes.select("shard", "i", "j", "fp", F.lit(False).alias("query")).union(
        asked.select("shard", "i", "j", "fp", F.lit(True).alias("query")))
    return rows.groupBy("shard", "i", "j").applyInPandas(_spanning(radius), "a long, b long")


def _groups(docs: DataFrame, shingle: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """doc_id and fp of every row; for each fp its group's ``root`` and ``first``, the least row of this fp: its id (null
    last) and its text's hash."""
    of = fingerprints(docs.select("doc_id", "text"), shingle, F.xxhash64(whole_text()).alias("body"))
    fps = stored(of, "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "body"))
    points = stored(fps.groupBy("fp").agg(first.alias("first")), "points")
    found = components(links(points, radius))
    return fps, points.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = DISTANCE) -> DataFrame:
    """One row per row of ``docs``: doc_id, ``fp`` and ``component_id``, the least doc_id reachable by links.

    A null text counts as empty; texts without a word have fingerprint 0 and link like any other. Repeated rows share a
    component. Null ids belong to their fingerprint's component and are its id only where no row of it has another. Other
    columns are ignored, whatever their names. An empty table gives an empty result.
    """
    fps, roots = _groups(docs, shingle, radius)
    ids = roots.groupBy("root").agg(F.min("first.doc_id").alias("component_id"))
    named = roots.join(ids, "root").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, radius: int = DISTANCE) -> DataFrame:
    """One row of ``docs`` for each component, with all columns: that of its least doc_id; of rows that share this id, one
    whose text has the least hash.

    A row with a null id is kept only where its component has no other id.
    """
    id_, body, all_ = free_name(docs, "kept_id_"), free_name(docs, "kept_body_"), free_name(docs, "kept_row_")
    _, roots = _groups(docs, shingle, radius)
    chosen = roots.groupBy("root").agg(F.min("first").alias("first")).select(
        F.col("first.doc_id").alias(id_), F.col("first.body").alias(body))
    # a text's hash stands for its component, so id and hash name the chosen row and its exact copies
    own = F.xxhash64(whole_text())
    kept = docs.join(chosen, F.col("doc_id").eqNullSafe(F.col(id_)) & (own == F.col(body)), "left_semi")
    one = F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns))
    return (kept.groupBy(F.col("doc_id").alias(id_), own.alias(body)).agg(one.alias(all_))
            .select(*[F.col(all_)[c].alias(c) for c in docs.columns]))
