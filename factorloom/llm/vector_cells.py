"""Embedding near-duplicates: spherical k-means cells, blocked cosine products, one representative for each group.

Centroids are fitted on a bounded sample; every vector is assigned. A vector also visits each other cell whose border lies
within the linking angle: x of cell a can have a partner in cell b only if x.n <= sin(angle), n being the unit normal of
the border between the centroids of a and b. So no link is lost, whatever the centroids are. Equal vectors of a label are
one row with a count before anything is compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_sample, stored
from .components import components, forest

THRESHOLD = 0.93
SAMPLE = 4096  # vectors that the centroids are fitted on
CELLS = 8  # at least
CELL_ROWS = 65_536
BLOCK = 2048  # vectors or queries of a task


def unit(vectors) -> np.ndarray:
    """Rows of unit length in double precision."""
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """At most ``k`` unit centroids of unit rows; starts from rows that are far from those chosen before."""
    chosen, near = [0], x @ x[0]
    while len(chosen) < min(k, len(x)):
        at = int(near.argmin())
        if near[at] > 1 - 1e-9:
            break
        chosen.append(at)
        near = np.maximum(near, x @ x[at])
    c = x[chosen]
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(size > 1e-9, total / np.maximum(size, 1e-9), c)
    return c


def usable():
    """Vectors that can link: finite, not zero, with a label."""
    ok = F.forall("embedding", lambda v: v.isNotNull() & (F.abs(v.cast("double")) < float("inf")))
    some = F.exists("embedding", lambda v: v != 0)
    return F.coalesce(F.col("label").isNotNull() & ok & some, F.lit(False))


def _deal(centroids: np.ndarray, threshold: float):
    reach = math.sqrt(1 - threshold * threshold) + 1e-9
    gap = np.sqrt(np.maximum(2 - 2 * centroids @ centroids.T, 0))  # of unit centroids

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            width = frame["embedding"].map(len).to_numpy()
            own = np.full(len(frame), -1)
            known = np.flatnonzero(width == centroids.shape[1]) if len(centroids) else np.zeros(0, int)
            if len(known):
                near = unit(frame["embedding"].iloc[known]) @ centroids.T
                own[known] = near.argmax(1)
            yield frame.assign(cell=own, query=False)
            for cell in range(len(centroids) if len(known) else 0):
                a = own[known]
                # a pair meets in the cell of the larger number
                margin = (near.max(1) - near[:, cell]) / np.maximum(gap[a, cell], 1e-12)
                at = known[(a < cell) & (margin <= reach)]
                if len(at):
                    yield frame.iloc[at].assign(cell=cell, query=True)

    return run


def _linked(threshold):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """Rows (a, null, n): a's links to n vectors of this block; rows (a, b, null): links that span the groups."""
        ids, copies = rows["node"].to_numpy(), rows["copies"].to_numpy()
        x, query = unit(rows["embedding"]), rows["query"].to_numpy()
        foreign = rows["foreign"].to_numpy()
        home, asked = np.flatnonzero(~query), np.flatnonzero(query)
        a, b, n = [], [], np.zeros(len(rows), np.int64)
        for at in range(0, len(asked), 512):
            some = asked[at:at + 512]
            i, j = np.nonzero(x[home] @ x[some].T >= threshold)
            i, j = home[i], some[j]
            other = ids[i] != ids[j]
            i, j = i[other], j[other]
            # a shard's own pairs are met from both sides, a visitor's from one
            np.add.at(n, j, copies[i])
            visit = foreign[j]
            np.add.at(n, i[visit], copies[j[visit]])
            a.append(ids[i])
            b.append(ids[j])
        x, y = forest(np.concatenate(a), np.concatenate(b)) if a else (ids[:0], ids[:0])
        some = np.flatnonzero(n)
        return pd.concat([pd.DataFrame({"a": ids[some], "b": None, "n": n[some]}),
                          pd.DataFrame({"a": x, "b": y, "n": None})]).astype({"a": "Int64", "b": "Int64", "n": "Int64"})

    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``vectors``: vec_id, ``n_links``, ``component_id``, ``kept``.

    Rows link where their labels are equal and their cosine, in double precision, is at least ``threshold``. A row
    without label or usable vector (null, empty, zero, with null or non-finite components) has no links and is its
    own component; vectors of different lengths do not link. Rows that repeat a vector are linked with each other, rows
    that share an id only if their vectors are. A row without id links like any other; a component without any id has none.
    ``kept`` holds where the id is its component's least (null where both are). An empty table gives no rows. Other
    columns are ignored, whatever their names.
    """
    base = vectors.select("vec_id", "label", "embedding", usable().alias("ok"))
    points = stored(base.where("ok").groupBy("label", "embedding").agg(
        F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies")).withColumn("node", F.monotonically_increasing_id()), "points")
    n = points.count()
    sample = hash_sample(points, F.xxhash64(F.lit(7), "node"), n, SAMPLE).select("embedding").toPandas()["embedding"]
    width = int(sample.map(len).mode()[0]) if len(sample) else 0
    sample = [v for v in sample if len(v) == width]
    centroids = spherical_kmeans(unit(sample), max(CELLS, math.ceil(n / CELL_ROWS))) if sample else np.zeros((0, 0))
    vectors_ = points.drop("vec_id")  # nodes are numbers of their own: ids may repeat or be missing
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors_.schema) + ", cell int, query boolean"
    dealt = stored(vectors_.mapInPandas(_deal(centroids, threshold), schema).withColumn("width", F.size("embedding")),
                   "dealt")
    key = ["label", "width", "cell"]
    sizes = dealt.groupBy(*key).agg(F.count_if(~F.col("query")).alias("homes"), F.count(F.lit(1)).alias("all")).select(
        *key, F.ceil(F.col("homes") / BLOCK).cast("int").alias("h"), F.ceil(F.col("all") / BLOCK).cast("int").alias("q"))
    both = dealt.join(sizes, key)
    salt = F.pmod(F.xxhash64(F.lit(11), "node"), F.lit(1 << 30))

    def numbers(n):
        return F.sequence(F.lit(0), F.col(n) - 1)

    homes = both.where("not query").withColumn("i", F.pmod(salt, F.col("h")).cast("int")).withColumn(
        "j", F.explode(numbers("q")))
    asked = both.where("h > 0").withColumn("j", F.pmod(salt, F.col("q")).cast("int")).withColumn(
        "i", F.explode(numbers("h")))
    columns = [*key, "i", "j", "node", "copies", "embedding"]
    rows = homes.select(*columns, F.lit(False).alias("query"), F.lit(False).alias("foreign")).union(
        asked.select(*columns, F.lit(True).alias("query"), F.col("query").alias("foreign")))
    found = stored(rows.groupBy(*key, "i", "j").applyInPandas(_linked(threshold), "a long, b long, n long"), "found")
    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    roots = components(found.where("b is not null").select("a", "b"))
    nodes = (points.join(counts, "node", "left").join(roots, "node", "left")
             .select("label", "embedding", "vec_id", "copies", F.coalesce("n", F.lit(0)).alias("n"),
                     F.coalesce("root", "node").alias("root")))
    least = nodes.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    nodes = nodes.join(least, "root").select("label", "embedding", "component_id", (F.col("copies") - 1 + F.col("n")).alias("n_links"))
    named = base.where("ok").join(nodes, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = base.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return named.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
