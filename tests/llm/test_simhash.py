import re

import numpy as np
import pandas as pd
import pytest
import xxhash

from factorloom.llm import components as cc
from factorloom.llm import simhash as s

from .conftest import components


def slow_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))] if words else []
    return sum((sum(h >> bit & 1 for h in hashes) * 2 > len(hashes)) << bit for bit in range(64))


def least_ids(ids, fps, radius=4):
    fps = np.array(fps, np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    return [int(ids[c]) for c in components(len(fps), zip(*np.nonzero(near)))]


def test_groups_against_brute_force(documents, rows):
    got = s.near_duplicates(documents).orderBy("doc_id").toPandas()
    want = [slow_fingerprint(t) for t in rows.text]
    assert [int(f) % 2**64 for f in got.fp] == want
    roots = least_ids(rows.doc_id, want)
    assert got.component_id.tolist() == roots and len(set(roots)) < len(roots)


def near_points(n, seed=1):
    """Fingerprints of which many are a few bits apart, in chains and in balls."""
    rng = np.random.default_rng(seed)
    points = [int(x) for x in rng.integers(0, 2**63, n // 4)]
    while len(points) < n:
        x = points[rng.integers(len(points))]
        for bit in rng.integers(0, 64, rng.integers(1, 7)):
            x ^= 1 << int(bit)
        points.append(x)
    return np.unique(np.array(points, np.uint64)).view(np.int64)


@pytest.mark.parametrize("block", [s.BLOCK, 100])
def test_shards_and_blocks_lose_no_link(spark, monkeypatch, block):
    monkeypatch.setattr(s, "BLOCK", block)
    monkeypatch.setattr(s, "PAIRS", 50)
    points = near_points(1500)
    df = spark.createDataFrame(pd.DataFrame({"fp": points}))
    got = cc.components(s.links(df)).toPandas().set_index("node").root
    want = least_ids(points, points.view(np.uint64))
    # brute force names the least by position, links by value; points are sorted as unsigned
    named = dict(zip(points.tolist(), want))
    groups = {}
    for p in points.tolist():
        groups.setdefault(named[p], []).append(p)
    assert all(len({int(got.get(p, p)) for p in g}) == 1 for g in groups.values())
    assert len({int(got.get(p, p)) for p in points.tolist()}) == len(groups)


def test_tree_pairs_equal_all_pairs():
    home, queries = near_points(900, 2), near_points(300, 2)
    got = {(int(a), int(b)) for x, y in s.tree_pairs(home, queries, 4) for a, b in zip(x, y)}
    near = np.bitwise_count(home.view(np.uint64)[:, None] ^ queries.view(np.uint64)[None, :]) <= 4
    assert got == {(int(home[i]), int(queries[j])) for i, j in zip(*np.nonzero(near))}


def test_every_close_pair_meets_in_a_shard():
    points = near_points(800, 3)
    nodes = s.layout(points[::5], 16)
    homes, seen = {}, {}
    for shard, inside, touching in s.visits(nodes, points, 4):
        homes.update({int(i): shard for i in inside})
        seen[shard] = set(inside.tolist()) | set(touching.tolist())
    assert sorted(homes) == list(range(len(points)))
    near = np.bitwise_count(points.view(np.uint64)[:, None] ^ points.view(np.uint64)[None, :]) <= 4
    for i, j in zip(*np.nonzero(near)):
        assert i in seen[homes[j]] and j in seen[homes[i]]


def test_components_of_chains_stars_and_rings(spark):
    rng = np.random.default_rng(5)
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(7, 200 + i) for i in range(60)]
    ring = [(300 + i, 300 + (i + 1) % 9) for i in range(9)] + [(5, 5), (None, 4)]
    rows = [chain + star + ring][0]
    rng.shuffle(rows)
    got = {r.node: r.root for r in cc.components(spark.createDataFrame([tuple(r) for r in rows], "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, 7: 7, **{200 + i: 7 for i in range(60)}, **{300 + i: 300 for i in range(9)}}


def test_edges(edge, nothing):
    got = s.near_duplicates(edge).toPandas()
    assert len(got) == edge.count()
    empty = got[got.doc_id.isin([3, 4, 5, 10])]
    assert set(empty.fp) == {0} and set(empty.component_id) == {3}
    kept = s.keep_first(edge)
    assert kept.columns == edge.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and {1, 3, 6, 7} <= set(ids) and not {2, 4, 5, None} & set(ids)
    assert s.near_duplicates(nothing).count() == s.keep_first(nothing).count() == 0


def test_one_row_of_each_group_whatever_the_ids(spark):
    a, b, c, d = ("".join(f"{x}{i} " for i in range(30)) for x in "abcd")
    rows = [(None, a), (None, a), (None, b), (1, c), (1, d), (2, d), (None, c), (3, None)]
    got = s.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, [(None, a), (None, b), (1, c), (1, d), (3, None)]))
