import numpy as np
from pyspark.sql import functions as F

from factorloom.llm import sketch as sk


def shingles(text):
    w = text.split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_edited_copies_and_estimates(documents, rows, monkeypatch):
    monkeypatch.setattr(sk, "RANGE_ROWS", 30)
    got = sk.edited_likeness(documents).orderBy("doc_id").toPandas()
    texts = rows.text.tolist()
    error = []
    for i, text in enumerate(texts):
        after = texts[(i + 1) % len(texts)]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        assert got.edited[i] == edited and got.n_chars[i] == len(text)
        a, b, c = shingles(text), shingles(edited), shingles(after)
        error += [got.near_edited[i] - len(a & b) / max(1, len(a | b)), got.near_next[i] - len(a & c) / max(1, len(a | c))]
        assert abs(got.shingles[i] - len(a)) <= max(1e-9, 0.4 * len(a)) and abs(got.held[i] - len(a & b) / max(1, len(a))) < 0.25
    assert np.abs(error).max() < 0.2 and abs(np.mean(error)) < 0.02


def test_exact_below_k(documents, rows):
    got = sk.sketches(documents, k=100_000).orderBy("doc_id").toPandas()
    assert [len(s) for s in got.sketch] == [len(shingles(t)) for t in rows.text]
    assert all(list(s) == sorted(set(s)) for s in got.sketch)


def test_bottom_takes_the_least_of_long_and_repeated_arrays(spark):
    rng = np.random.default_rng(1)
    some = [rng.integers(-2**63, 2**63 - 1, 5000).tolist(), [7] * 5000, list(range(3000)), [2**62 + i for i in range(4000)]]
    df = spark.createDataFrame([(x,) for x in some], "v array<bigint>").select(sk.bottom(F.col("v"), 16).alias("b"))
    assert [r.b for r in df.collect()] == [sorted(set(x))[:16] for x in some]


def test_sketches_of_parts_merge(documents, rows):
    parts = sk.sketches(documents).withColumn("part", F.col("doc_id") % 3)
    got = {r.part: r.sketch for r in sk.merged(parts, "part").collect()}
    for part, merged in got.items():
        every = sorted({h for r in parts.where(F.col("part") == part).collect() for h in r.sketch})
        assert merged == every[:sk.K]


def test_next_across_ranges(spark, monkeypatch):
    monkeypatch.setattr(sk, "RANGE_ROWS", 3)
    ids = [2**61 + 7, 5, 9, 2**61 + 8, 1, 3, 12, 40, 41, 42, -3, 9]
    df = spark.createDataFrame([(i, str(n)) for n, i in enumerate(ids)], "doc_id long, text string")
    got = [(r.doc_id, r.text, r.next_text) for r in sk.with_next(df, ["text"]).collect()]
    order = sorted(((i, str(n)) for n, i in enumerate(ids)))
    assert sorted(got) == [(*a, b[1]) for a, b in zip(order, order[1:] + order[:1])]


def test_edges(edge, nothing):
    got = sk.edited_likeness(edge).toPandas()
    assert len(got) == edge.count() and got.near_edited.between(0, 1).all() and got.near_next.between(0, 1).all()
    assert sk.edited_likeness(nothing).count() == 0
    alone = sk.edited_likeness(edge.where("doc_id = 8")).first()
    assert alone.near_next == 1.0
