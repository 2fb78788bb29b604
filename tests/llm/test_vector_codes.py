import hashlib
import math

import numpy as np
import pytest

from factorloom.llm import vector_codes as v

from .conftest import SF


def brute(rows):
    """rows: (vec_id, vector, label), sorted. Python integers and all distances."""
    length = -(-len(rows[0][1]) // 4)
    ints = [[math.floor(x * 1024) if abs(x) < 2 ** 53 else int(x) * 1024 for x in vec] for _, vec, _ in rows]
    ints = [x + [0] * (4 * length - len(x)) for x in ints]
    parts = [[x[k * length:(k + 1) * length] for k in range(4)] for x in ints]
    books = [[parts[i][k] for i in range(min(256, len(rows)))] for k in range(4)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(p[k], e)), j) for j, e in enumerate(books[k])) for k in range(4)] for p in parts]

    for _ in range(4):
        chosen = assign()
        for k in range(4):
            for j in range(len(books[k])):
                mine = [p[k] for p, c in zip(parts, chosen) if c[k][1] == j]
                if mine:
                    books[k][j] = [sum(c) // len(mine) for c in zip(*mine)]
    sha = hashlib.sha256(",".join(str(c) for k in books for e in k for c in e).encode()).hexdigest()
    out = [("".join(f"{j:02x}" for _, j in c), sum(d for d, _ in c)) for c in assign()]
    sums = {}
    for (_, _, label), (_, error) in zip(rows, out):
        sums[label] = sums.get(label, 0) + error
    return [(i, code, error, sums[label], sha) for (i, _, label), (code, error) in zip(rows, out)]


def test_transform():
    for p in (1, 2, 4, 16, 32):
        h = v.walsh(np.eye(p, dtype=np.int64)).T
        assert (h @ h.T == p * np.eye(p)).all()
        assert [int((np.diff(row) != 0).sum()) for row in h] == list(range(p))


@pytest.mark.parametrize("kind", [np.int64, object])
@pytest.mark.parametrize("block", [v.BLOCK, 3])
def test_nearest_against_all_distances(monkeypatch, kind, block):
    monkeypatch.setattr(v, "BLOCK", block)
    rng = np.random.default_rng(0)
    for length in (1, 3, 4, 5, 16):
        x, e = rng.integers(-3, 4, (50, length)), rng.integers(-3, 4, (40, length))
        d = ((x[:, None] - e[None]) ** 2).sum(2)
        index, error = v.nearest(v.walsh(v.padded(x.astype(kind))), v.walsh(v.padded(e.astype(kind))))
        assert (index == d.argmin(1)).all() and (error == d.min(1)).all()  # many ties in such small ranges


def test_table_against_brute_force(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet").where("vec_id < 320").repartition(3)
    rows = sorted((r.vec_id, r.embedding, r.label) for r in df.collect())
    got = sorted(tuple(r) for r in v.compress(df).collect())
    assert got == brute(rows) and len(got) > 256 or len(got) == len(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(7, [0.5, -1.0, 0.25, 3.0, 1.0], 1), (None, [0.5, -1.0, 0.25, 3.0, -1.0], None), (2, [0.5, -1.0, 0.3, 3.0, 0.0], None),
            (2, [0.25, -1.0, 0.3, 3.0, 0.0], 2), (2, [0.25, -1.0, 0.3, 3.0, 0.0], 2)]
    bad = [(1, None, 1), (1, [nan] * 5, 1), (1, [inf] * 5, 1), (1, [None] * 5, 1), (1, [], 1), (1, [1.0], 1)]
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows + bad], "vec_id long, embedding array<float>, label int, code string, part string, of string")
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    order = [(i, np.array(x, np.float32).tolist(), label) for i, x, label in order]
    assert sorted(map(tuple, v.compress(df).collect()), key=repr) == sorted(brute(order), key=repr)
    assert v.compress(df.where("false")).count() == 0
    assert v.compress(df.where("embedding is null")).count() == 0
    empty = v.compress(df.where("size(embedding) = 0")).collect()
    assert [(r.code, r.error) for r in empty] == [("00000000", 0)]


def test_numbers_beyond_64_bits(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=8) * 10.0 ** rng.integers(-3, 30)).tolist(), i % 2) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(2)
    want = [(i, code, *[x if x < 2 ** 63 else None for x in (error, total)], sha) for i, code, error, total, sha in brute(rows)]
    assert sorted((tuple(r) for r in v.compress(df).collect()), key=lambda r: r[0]) == want
