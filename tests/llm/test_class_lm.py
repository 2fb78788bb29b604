import math
import zlib
from collections import Counter

import numpy as np

from factorloom.llm import class_lm as lm


def test_counts_and_base_score(documents, rows):
    got = lm.score(documents).orderBy("doc_id").toPandas()
    tokens = [t.encode().lower().split() + [b""] for t in rows.text]
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in rows.doc_id]
    count = Counter(w for t, h in zip(tokens, held) if not h for w in t)
    n, v = sum(count.values()), len(count)
    assert got.held_out.tolist() == held and (got.train_tokens == n).all()
    assert got.n_tokens.tolist() == [len(t) for t in tokens]
    assert got.n_known.tolist() == [sum(count[w] > 0 for w in t) for t in tokens]
    want = [sum(math.log10((count[w] + 1) / (n + 1 * (v + 1))) for w in t) for t in tokens]
    assert np.allclose(got.base_score, want, rtol=1e-12)
    out = got[got.held_out]
    assert out.score.sum() > out.base_score.sum()  # better on texts it has not seen


def test_exchange_tells_languages_apart():
    rng = np.random.default_rng(1)
    n, kinds = 60, 2
    # two languages in turns; each class starts with words of both
    stream = [lang * 30 + rng.integers(30) for lang in rng.integers(kinds, size=300) for _ in range(20)]
    own = np.arange(n) % 20 + 1

    def pairs(own):
        cls = own[stream]
        found = np.zeros((lm.ALL, lm.ALL))
        np.add.at(found, (np.append(0, cls[:-1]), cls), 1)
        return found

    def gain(p):
        q = p / p.sum()
        e = np.outer(q.sum(1), q.sum(0))
        return (q[q > 0] * np.log(q[q > 0] / e[q > 0])).sum()

    before = gain(pairs(own))
    for turn in range(8):
        cls = own[stream]
        dense = np.zeros((n, 2 * lm.ALL))
        np.add.at(dense, (stream, np.append(0, cls[:-1])), 1)
        np.add.at(dense, (stream, lm.ALL + np.append(cls[1:], 0)), 1)
        dense[np.arange(n) % 2 != turn % 2] = 0
        cell = np.flatnonzero(dense)
        new = lm.best_classes(own, cell // (2 * lm.ALL), cell % (2 * lm.ALL), dense.ravel()[cell], pairs(own))
        own = np.where(np.arange(n) % 2 == turn % 2, new, own)
    assert gain(pairs(own)) > before + 0.05
    assert not set(own[:30]) & set(own[30:])


def test_probabilities_sum_to_one():
    pairs = np.random.default_rng(2).integers(0, 50, (lm.ALL, lm.ALL))
    size = pairs.sum(0)
    prior = (size + 1) / (size.sum() + lm.ALL)
    steps = (pairs + lm.ALL * prior) / (pairs.sum(1, keepdims=True) + lm.ALL)
    assert np.allclose(steps.sum(1), 1)


def test_edges(edge, nothing):
    got = lm.score(edge).toPandas()
    assert len(got) == edge.count() and np.isfinite(got.score).all() and (got.score <= 0).all()
    assert got[got.doc_id == 4].n_tokens.tolist() == [1]
    assert lm.score(nothing).count() == 0
    assert lm.score(edge.where("doc_id = 4")).count() == 1


def test_words_seen_a_few_times_have_classes(spark):
    rng = np.random.default_rng(4)
    # two languages of 600 words, each word seen about 11 times
    texts = [" ".join(f"w{lang}x{i}" for i in rng.integers(600, size=100)) for lang in (0, 1) for _ in range(80)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = lm.score(docs).toPandas()
    out = got[got.held_out]
    # log10(2) a token at most: a language has half of the words
    assert ((out.score - out.base_score) / out.n_tokens).mean() > 0.1


def test_moves_together_raise_the_likelihood_like_moves_one_by_one():
    rng = np.random.default_rng(7)
    kinds = 6  # words of a kind follow words of the next kind
    words_ = rng.integers(200, size=40_000) // kinds * kinds
    words_ = words_ + np.arange(40_000) % kinds
    n = int(words_.max()) + 1
    own = rng.integers(1, lm.CLASSES + 1, n)

    def run(often, batch):
        now = own.copy()
        for _ in range(3):
            cls = now[words_]
            pairs = np.zeros((lm.ALL, lm.ALL))
            np.add.at(pairs, (np.append(0, cls[:-1]), cls), 1)
            dense = np.zeros((n, 2 * lm.ALL))
            np.add.at(dense, (words_, np.append(0, cls[:-1])), 1)
            np.add.at(dense, (words_, lm.ALL + np.append(cls[1:], 0)), 1)
            cell = np.flatnonzero(dense)
            now = lm.best_classes(now, cell // (2 * lm.ALL), cell % (2 * lm.ALL), dense.ravel()[cell], pairs, often, batch)
        cls = now[words_]
        pairs = np.zeros((lm.ALL, lm.ALL))
        np.add.at(pairs, (np.append(0, cls[:-1]), cls), 1)
        return lm.likelihood(pairs)

    start = run(10 ** 9, 1)
    alone, together = run(0, 1), run(10 ** 9, 512)
    assert together > alone - 0.05 * abs(alone) and abs(start - alone) < 0.05 * abs(alone)


def test_scores_of_the_module_are_probabilities(spark):
    """The score of a text is the sum of what the module gives its class steps and words, computed here once more."""
    texts = ["a b a b c", "b a c a", "a a b", "c b a", "x y", "", None] * 9
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in lm.score(df).collect()}
    assert len(got) == len(texts)
    same = {}
    for i, text in enumerate(texts):
        same.setdefault(text or "", set()).add(round(got[i].score, 9))
    assert all(len(scores) == 1 for scores in same.values())  # equal texts have equal scores
    # all texts of one token sum to less than 1: the end alone, each known word, and what is left for unknown words
    assert 10 ** got[5].score < 1 and all(r.score < 0 for r in got.values())
    mass = sum(10 ** s for s in (next(iter(same[t])) for t in same))
    assert mass < 1


def test_python_meets_a_word_once_a_piece(monkeypatch):
    """Split, lowered and numbered as bytes.lower().split() would, over cuts between pieces, with one look-up a distinct word."""
    import pyarrow as pa
    from collections import defaultdict

    monkeypatch.setattr(lm, "PIECE", 40)
    texts = ["A b\x0bB  a\u00a0c", "", " \t", "\u0130x\x1cY \u0130X\x1cy\r\n", "b" * 100 + " a " * 30, "z"] * 3

    class Counted(defaultdict):
        asked = 0

        def __getitem__(self, word):
            Counted.asked += 1
            return super().__getitem__(word)

    numbers = Counted()
    numbers.default_factory = numbers.__len__
    numbers[""]
    rows = pa.RecordBatch.from_arrays([pa.array(range(18)), pa.array([False] * 18), pa.array(texts)], names=["a", "b", "text"])
    pieces = [lm._encoded(p.column(2), numbers) for p in lm._pieces(rows)]
    assert len(pieces) > 3
    got, sizes = np.concatenate([p[0] for p in pieces]), np.concatenate([p[1] for p in pieces])
    want = [t.encode().lower().split() + [b""] for t in texts]
    spelt = [w.encode() for w in numbers]
    assert [spelt[i] for i in got] == [w for t in want for w in t] and sizes.tolist() == [len(t) for t in want]
    assert Counted.asked < len(got) / 2
    first = list(dict.fromkeys(w for t in want for w in t if w))
    assert spelt[1:] == first


def test_a_round_moves_rows_by_bucket_and_block():
    """Classes reach a block as one row for each bucket of words, however many words it holds; each word gets its own."""
    import pandas as pd

    rng = np.random.default_rng(3)
    h = np.unique(rng.integers(-2 ** 63, 2 ** 63 - 1, 5000))
    rows = pd.DataFrame([(b << 12, lid, h[w]) for b in range(3) for lid, w in enumerate(rng.choice(len(h), 2000, False), 1)],
                        columns=["block", "lid", "h"]).sample(frac=1, random_state=1)
    rows["start"] = rows["h"] % 7 + 20
    held = np.unique(rows["h"])
    top = held[[900, 5, 77]]
    found = lm._places(top)((4,), rows)
    classes, places = found[found["block"].isna()], found[found["block"].notna()]
    assert len(classes) == 1 and sorted(places["block"]) == [0, 1 << 12, 2 << 12]
    assert np.frombuffer(classes["h"].iloc[0], "<i8").tolist() == held.tolist()
    want = {int(x): int(x) % 7 + 20 for x in held} | {int(x): i + 1 for i, x in enumerate(top)}
    for block, words in lm._classed(places, classes).groupby("block"):
        mine = rows[rows["block"] == block]
        table = lm._table(words)
        assert table[mine["lid"]].tolist() == [want[int(x)] for x in mine["h"]]


def test_sums_of_cells_are_those_of_each_word():
    rng = np.random.default_rng(8)
    for n in (1, 2, 300):
        width = rng.integers(1, 40, n)
        starts = np.cumsum(width) - width
        rows, kind = rng.normal(size=(500, 33)), rng.integers(500, size=int(width.sum()))
        want = [np.add.accumulate(rows[kind[a:a + w]])[-1] for a, w in zip(starts, width)]
        got = lm._sums(rows, kind, starts, width)
        assert (got == want).all() and np.allclose(got, np.add.reduceat(rows[kind], starts, axis=0), atol=1e-12)
