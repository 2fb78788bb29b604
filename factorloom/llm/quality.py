"""Quality classifier without labels: a weak-label model and a hashed linear scorer.

Overlapping heuristics vote good, bad or nothing on every document. Expectation-maximisation over the counts of all vote
patterns (at most 3 to the number of heuristics, whatever the table's size) estimates how often each heuristic votes what
on good documents and on several kinds of bad ones, and with that the probability that a document is good. These probabilities train a logistic
scorer on hashed token features of a bounded sample; the scorer judges every document by its whole text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, hash_bound, whole_text

SAMPLE = 4096  # documents that the scorer is fitted on: those of the least hashes of id and text
STRETCH = 5000  # words; the variety of a longer text is the mean over its stretches
BUCKETS = 1024  # hashed features; half for shapes, half for words
KEPT = 300_000

# fixed values: frequent function words of the languages that the heuristics know
FUNCTION_WORDS = frozenset("""
the of and to in a is that it for on was be with as at by this or from are
de la le les et un une des en que dans pour est qui pas sur
der die das und ist den von mit ein eine auf im dem nicht
el los las por para con se del una lo como y
""".split())
SYMBOLS = b"|%&$*#@^~<>{}[]_=+\\/!"
#: First bytes, in UTF-8, of Latin letters, and of the other scripts (without the punctuation and signs of U+2000-2FFF).
LATIN = bytes([*range(65, 91), *range(97, 123), *range(0xC3, 0xCA)])
FOREIGN = bytes([*range(0xCA, 0xE2), *range(0xE3, 0xF0)])
EDGE = ".,;:!?%*&$#|\"'()"

HEURISTICS = ("symbols", "symbol_words", "capitals", "repetition", "function_words", "sentence_ends", "word_length", "variety", "lines")


def _vote(value, good, bad):
    """1 if ``value`` lies in the range ``good``, -1 if it lies in one of ``bad``, else 0."""
    if any(a <= value <= b for a, b in bad):
        return -1
    return 1 if good[0] <= value <= good[1] else 0


def votes(text: str) -> list[int]:
    """One vote for each heuristic; a text without a word gets -1 from all.

    Function words, sentence ends and the length of words say nothing bad of a text that is mostly not in Latin script.
    """
    words = text.split()
    n = len(words)
    if not n:
        return [-1] * len(HEURISTICS)
    raw = text.encode()
    symbols = (len(raw) - len(raw.translate(None, SYMBOLS))) / len(raw)
    marked = sum(w[-1] in "|%&$*#@^~<>{}[]_=+" for w in words) / n
    capitals = sum(w[:2].isupper() and len(w) > 1 for w in words) / n
    repetition = sum(map(eq, words, words[1:])) / n
    function = sum(w.strip(EDGE).lower() in FUNCTION_WORDS for w in words) / n
    ends = sum(w[-1] in ".?!" for w in words) / n
    length = sum(map(len, words)) / n
    variety = sum(len(set(words[at:at + STRETCH])) for at in range(0, n, STRETCH)) / n
    lines = text.split("\n")
    short = n < 30  # then shares of words say little
    foreign = not raw.isascii() and len(raw.translate(None, FOREIGN)) < len(raw.translate(None, LATIN))

    def known(vote):
        return max(0, vote) if foreign else vote

    return [
        _vote(symbols, (0, 0.02), [(0.05, 1)]),
        _vote(marked, (0, 0.05), [(0.15, 1)]),
        _vote(capitals, (0, 0.1), [(0.3, 1)]),
        _vote(repetition, (0, 0.06), [(0.2, 1)]),
        1 if short else known(_vote(function, (0.08, 0.6), [(0, 0.03)])),
        1 if short else known(_vote(ends, (0.02, 0.4), [(0.6, 1), (0, 0.005)])),
        known(_vote(length, (2.5, 12), [(0, 2), (15, float("inf"))])),
        1 if short else _vote(variety, (0.4, 1), [(0, 0.2)]),
        _vote(len(set(lines)) / len(lines), (0.6, 1), [(0, 0.5)] if len(lines) >= 5 else []),
    ]


def fit_votes(patterns: list[tuple[list[int], int]], rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the kinds of documents, and [kind, heuristic, vote + 1] the probability of a vote, from (votes, number
    of documents).

    Kind 0 is good. Bad documents fail in different ways, and one that fails in one way passes the other heuristics, so
    there is a bad kind for each heuristic: it starts from the documents that this heuristic rejects (shared where several
    do), kind 0 from those that none rejects. One pseudo-count on each outcome.
    """
    v = np.array([p for p, _ in patterns])
    n = np.array([c for _, c in patterns], float)
    bad = (v < 0).astype(float)
    kinds = np.concatenate([(bad.sum(1, keepdims=True) == 0), bad / np.maximum(1, bad.sum(1, keepdims=True))], 1).T
    for _ in range(rounds):
        share = (kinds @ n + 1) / (n.sum() + len(kinds))
        table = np.stack([(kinds * n) @ (v == vote) + 1 for vote in (-1, 0, 1)], 2)
        table /= table.sum(2, keepdims=True)
        new = _kinds(v, share, table)
        done = np.abs(new - kinds).max() < 1e-9
        kinds = new
        if done:
            break
    return share, table


def _kinds(votes_, share, table):
    at = np.arange(table.shape[1])
    logs = np.log(table)[:, at, np.asarray(votes_) + 1].sum(2) + np.log(share)[:, None]
    odds = np.exp(logs - logs.max(0))
    return odds / odds.sum(0)


def posterior(votes_, share: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Probability that a document with these votes is good."""
    return _kinds(votes_, share, table)[0]


def accuracies(share: np.ndarray, table: np.ndarray) -> dict[str, tuple[float, float]]:
    """For each heuristic, the probability of no bad vote on a good document, and of a bad vote on a bad one."""
    bad = (share[1:, None] * table[1:, :, 0]).sum(0) / share[1:].sum()
    return {name: (1 - table[0, j, 0], bad[j]) for j, name in enumerate(HEURISTICS)}


_RUN = re.compile(r"(.)\1+")


def buckets(word: str) -> tuple[int, int]:
    """Hashed features of a word: its shape, and its letters in lower case."""
    shape = "".join(["X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c for c in word])
    shape = _RUN.sub(r"\1", shape)
    half = BUCKETS // 2
    return zlib.crc32(shape.encode()) % half, half + zlib.crc32(word.strip(EDGE).lower().encode()) % half


def features(text: str) -> np.ndarray:
    """Relative frequency of each feature among the words, of words that repeat the one before, and a constant."""
    words = text.split()
    found = np.bincount([b for w in words for b in buckets(w)], minlength=BUCKETS).astype(np.float32)
    n = max(1, len(words))
    return np.concatenate([found / n, [sum(map(eq, words, words[1:])) / n, 1.0]]).astype(np.float32)


def fit_scorer(x: np.ndarray, good: np.ndarray, rounds: int = 400, decay: float = 1e-4) -> np.ndarray:
    """Weights of a logistic model of the probabilities ``good``, by Adam over the whole sample."""
    w = np.zeros(x.shape[1])
    m, s = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - good) / len(x) + decay * w
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        w -= 0.2 * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
    return w


class _Weights(dict):
    """The weight of a word, computed once while the table has room."""

    def __init__(self, weights):
        super().__init__()
        self.weights = weights.tolist()

    def __missing__(self, word):
        a, b = buckets(word)
        value = self.weights[a] + self.weights[b]
        if len(self) < KEPT:
            self[word] = value
        return value


def train(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(share, table) of the weak-label model from all documents, and the scorer's weights."""
    @F.pandas_udf("array<tinyint>")
    def cast(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(votes)

    text = whole_text()
    patterns = docs.select(cast(text).alias("votes")).groupBy("votes").count().collect()  # at most 3 ** 9 rows
    if not patterns:
        return np.ones(1), np.ones((1, len(HEURISTICS), 3)), np.zeros(BUCKETS + 2)
    share, table = fit_votes([(list(r["votes"]), r["count"]) for r in patterns])

    def sample(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"rank": frame["rank"], "votes": frame["text"].map(votes),
                                "x": [features(t).astype(np.float16).tobytes() for t in frame["text"]]})

    rank = F.xxhash64("doc_id", "text")
    # texts of any length become features where they are read; only these are gathered
    some = docs.where(hash_bound(rank, sum(r["count"] for r in patterns), SAMPLE)).select(rank.alias("rank"), text.alias("text"))
    chosen = some.mapInPandas(sample, "rank long, votes array<int>, x binary").orderBy("rank").limit(SAMPLE).toPandas()
    if not len(chosen):
        return share, table, np.zeros(BUCKETS + 2)
    x = np.stack([np.frombuffer(b, np.float16) for b in chosen["x"]]).astype(np.float32)
    return share, table, fit_scorer(x, posterior(np.array(chosen["votes"].tolist()), share, table))


def _scores(docs, weights):
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = _Weights(weights)
        repeat, constant = float(weights[-2]), float(weights[-1])
        for texts in batches:
            out = []
            for text in texts:
                words = text.split()
                if words:
                    total = sum(map(of.__getitem__, words)) + repeat * sum(map(eq, words, words[1:]))
                    out.append(1 / (1 + np.exp(-np.clip(total / len(words) + constant, -500, 500))))
                else:
                    out.append(0.0)
            yield pd.Series(out, dtype="float64")

    return score(whole_text())


def classify(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, ``score`` (probability of good quality), ``kept`` (score of 0.5 or more).

    A null text counts as empty; a text without a word has score 0. Every row is judged by itself, so repeated rows and
    null ids give as many result rows. Other columns are ignored. An empty table gives an empty result.
    """
    _, _, weights = train(docs)
    return docs.select("doc_id", _scores(docs, weights).alias("score")).withColumn("kept", F.col("score") >= 0.5)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is 0.5 or more."""
    _, _, weights = train(docs)
    score = free_name(docs, "score_")
    return docs.withColumn(score, _scores(docs, weights)).where(F.col(score) >= 0.5).drop(score)
