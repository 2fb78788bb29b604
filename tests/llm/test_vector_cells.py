import numpy as np
import pytest

from factorloom.llm import vector_cells as v

from .conftest import SF, components


def brute(frame, threshold=v.THRESHOLD):
    n, pairs, links = len(frame), [], [0] * len(frame)
    for i in range(n):
        for j in range(n):
            a, b = frame.embedding[i], frame.embedding[j]
            if i == j or frame.label[i] is None or frame.label[i] != frame.label[j] or len(a) != len(b):
                continue
            a, b = np.array(a, float), np.array(b, float)
            if a @ b >= threshold * np.linalg.norm(a) * np.linalg.norm(b):
                links[i] += 1
                pairs.append((i, j))
    return links, [int(frame.vec_id[c]) for c in components(n, pairs)]


@pytest.mark.parametrize("block", [v.BLOCK, 7])
def test_groups_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(v, "BLOCK", block)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(25, 6))
    rows = [(int(i), (centres[rng.integers(25)] * rng.uniform(0.1, 9) + rng.normal(size=6) * 0.25).tolist(), int(rng.integers(3)))
            for i in rng.permutation(260)]
    rows += [(300 + i, rows[i % 4][1], rows[i % 4][2]) for i in range(12)]  # exact copies
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = v.near_duplicates(df).orderBy("vec_id").toPandas()
    links, roots = brute(df.orderBy("vec_id").toPandas())
    assert got.n_links.tolist() == links and sum(links) > 100
    assert got.component_id.tolist() == roots
    assert (got.kept == (got.vec_id == got.component_id)).all()


def test_every_link_of_the_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    x = df.orderBy("vec_id").toPandas()
    e = np.array(x.embedding.tolist(), float)
    e /= np.linalg.norm(e, axis=1)[:, None]
    linked = (e @ e.T >= 0.2) & (x.label.values[:, None] == x.label.values[None])
    np.fill_diagonal(linked, False)
    got = v.near_duplicates(df, 0.2).orderBy("vec_id").toPandas()
    assert got.n_links.tolist() == linked.sum(1).tolist() and linked.sum() > 0  # recall is 1


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1, "q"), (2, [2.0, 0.0], 1, "q"), (3, [1.0, 0.0], 2, "q"), (4, [1.0, 0.0], None, "q"), (5, None, 1, "q"),
            (6, [], 1, "q"), (7, [0.0, 0.0], 1, "q"), (8, [nan, 1.0], 1, "q"), (9, [inf, 1.0], 1, "q"), (10, [None, 1.0], 1, "q"),
            (None, [1.0, 0.0], 1, "q"), (11, [1.0, 0.0, 0.0], 1, "q"), (2, [2.0, 0.0], 1, "q"), (12, [3e38, 0.0], 1, "q")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, n_links string").selectExpr(
        "*", "'x' as cell", "'x' as query", "'x' as node", "'x' as copies")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id) for r in v.near_duplicates(df).collect())
    assert got == [(0, 4, 1), (1, 4, 1), (2, 4, 1), (2, 4, 1), *[(i, 0, i) for i in range(3, 12)], (12, 4, 1)]
    assert v.near_duplicates(df.where("false")).count() == 0


def test_centroids_are_unit_and_assign_all():
    x = v.unit(np.random.default_rng(1).normal(size=(200, 8)))
    c = v.spherical_kmeans(x, 5)
    assert c.shape == (5, 8) and np.allclose(np.linalg.norm(c, axis=1), 1)
    assert (x @ c.T).max(1).mean() > 0.4
    assert len(v.spherical_kmeans(np.repeat(x[:1], 9, 0), 5)) == 1


def test_repeated_and_missing_ids(spark):
    rows = [(1, [1.0, 0.0], "a"), (2, [1.0, 0.01], "a"), (2, [0.0, 1.0], "b"), (3, [0.01, 1.0], "b"), (2, [0.0, -1.0], "a"),
            (None, [5.0, 5.0], "c"), (None, [5.0, 5.1], "c"), (None, [1.0, 0.02], "a"), (None, [-1.0, 0.0], "d"), (9, [-1.0, -0.01], "d")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string")
    got = sorted(((r.vec_id or 0, r.n_links, r.component_id or 0) for r in v.near_duplicates(df).collect()))
    assert got == sorted([(1, 2, 1), (2, 2, 1), (2, 1, 2), (3, 1, 2), (2, 0, 2), (0, 1, 0), (0, 1, 0), (0, 2, 1), (0, 1, 9), (9, 1, 9)])


def test_random_repeated_ids_against_brute_force(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 4))
    rows = [(int(rng.integers(1, 30)) if rng.random() > 0.1 else None, (centres[rng.integers(12)] + rng.normal(size=4) * 0.2).tolist(),
             int(rng.integers(2))) for _ in range(150)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    linked = (x @ x.T >= v.THRESHOLD) & (np.array([r[2] for r in rows])[:, None] == np.array([r[2] for r in rows])[None])
    roots = components(len(rows), [(int(i), int(j)) for i, j in zip(*np.nonzero(linked)) if i < j])
    least = {}
    for r, root in zip(rows, roots):
        least[root] = min([i for i in (least.get(root), r[0]) if i is not None], default=None)
    want = sorted((r[0] or 0, int(n) - 1, least[root] or 0) for r, root, n in zip(rows, roots, linked.sum(1)))
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0) for r in v.near_duplicates(df).collect()) == want
