import numpy as np

from factorloom.llm import quality as q

from .conftest import SF


def test_scorer_agrees_with_labels_it_has_not_seen(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id").quality
    got = q.classify(documents).toPandas().set_index("doc_id").join(labels, how="inner")
    assert got[got.quality == 1].kept.mean() >= 0.99
    assert (~got[got.quality == 0].kept).mean() >= 0.85


def test_accuracies_are_recovered():
    rng = np.random.default_rng(1)
    n = 40_000
    good = rng.random(n) < 0.8
    kind = rng.integers(0, 3, n)  # a bad document fails heuristics 3 * kind and the two after it
    bad_rate = np.where(good[:, None], 0.02, np.where(np.arange(9) // 3 == kind[:, None], 0.9, 0.02))
    votes = np.where(rng.random((n, 9)) < bad_rate, -1, 1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    share, table = q.fit_votes(list(zip(patterns.tolist(), counts.tolist())))
    assert abs(share[0] - 0.8) < 0.05
    assert all(1 - a < 0.06 for a, _ in q.accuracies(share, table).values())
    assert ((q.posterior(votes, share, table) > 0.5) == good).mean() > 0.95


def test_votes_on_kinds_of_junk():
    names = dict(zip(q.HEURISTICS, range(9)))
    prose = "The cat of the house is in the garden and it was glad. " * 3 + "A dog and a bird are with it for the day on this hill."
    assert -1 not in q.votes(prose)
    assert q.votes("BUY NOW THE BEST " * 20)[names["capitals"]] == -1
    assert q.votes("word " * 60)[names["repetition"]] == -1
    assert q.votes("menu | item | " * 20)[names["symbols"]] == -1
    assert q.votes("") == [-1] * 9


def test_edges(edge, nothing):
    got = q.classify(edge).toPandas()
    assert len(got) == edge.count() and got.score.between(0, 1).all()
    assert got[got.doc_id.isin([3, 4, 5, 10])].score.tolist() == [0.0] * 4
    assert q.keep_good(edge).columns == edge.columns
    assert q.classify(nothing).count() == q.keep_good(nothing).count() == 0


def test_long_documents_are_fitted_on_and_filtered(spark, rows):
    kept = q.classify(spark.createDataFrame(rows[["doc_id", "text"]])).toPandas().set_index("doc_id").kept
    prose = [t for i, t in zip(rows.doc_id, rows.text) if kept[i] and len(t) > 500]
    good = ["\n".join((prose[i:] + prose[:i]) * 9)[:30_000] for i in range(0, 40, 2)]
    junk = [" ".join(f"#{i * j % 97}% |||| $$$ &{j}" for j in range(3000)) for i in range(1, 11)]
    texts = good + junk
    assert min(map(len, texts)) > 20_000
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = q.classify(docs).orderBy("doc_id").toPandas()
    assert got.kept.tolist() == [True] * len(good) + [False] * len(junk)


def test_heuristics_abstain_on_other_scripts_and_judge_long_texts():
    russian = "Мама мыла раму каждое утро перед работой. Потом она пила чай и читала газету у окна. " * 3
    at = dict(zip(q.HEURISTICS, q.votes(russian)))
    assert at["function_words"] == 0 and at["sentence_ends"] == 1
    assert dict(zip(q.HEURISTICS, q.votes("spam eggs " * 4000)))["variety"] == -1
