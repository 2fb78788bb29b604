"""Connected components of links, over Spark joins alone."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, least node of its component) that connect what the links a-b connect; at most one for each node."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, label[left], low)
        np.minimum.at(label, label[right], low)
        while not np.array_equal(label, label[label]):
            label = label[label]
        if np.array_equal(before, label):
            break
    linked = label != np.arange(len(nodes))
    return nodes[linked], nodes[label[linked]]


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b: long): root is the least node that it reaches.

    Alternates two steps until nothing changes: each node hands its least neighbour to its larger neighbours, then to
    its smaller ones and itself. The number of rounds grows with the logarithm of the longest chain. Least neighbours are
    aggregated before the shuffle; a hub's links meet it in a join that adaptive execution can split. Each round is
    written to the shared folder. Nulls and links of a node with itself are left out; no links give no rows.
    """
    links = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                   "links")
    mark = None
    while True:
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == mark:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                links.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        mark = state
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        larger = both.join(least, both.a == least.k).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        larger = larger.where("a <> b").distinct()
        least = larger.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "k")
        smaller = (larger.join(least, larger.a == least.k)
                   .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                   .select("e.a", "e.b").where("a <> b"))
        links = stored(smaller.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
