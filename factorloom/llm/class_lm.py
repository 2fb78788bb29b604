"""Brown class-based bigram model: exchange clustering of words, class transitions, word emissions.

The texts become blocks of token numbers with a vocabulary of their own, so that only each block's distinct words, not its
tokens, meet the corpus counts. The clustering is the exchange algorithm with words dealt out to tasks: a round counts, for
each word, the classes before and after it, reduces these counts by word, and moves each word of one part of the
vocabulary in turn to the class with the highest likelihood of the class bigrams. Sweeps over all parts end when one no
longer raises the likelihood, or after SWEEPS of them: a sweep reads all tokens, so their number is bounded. Blocks lie in a table bucketed by block: a round shuffles the words' classes and
counts, never the tokens. What reaches the driver is classes times classes.

All words seen twice or more are exchanged; their classes grow in number with the cube root of the vocabulary. Words seen
once stand for the unknown words, and both share a class: its transitions are all that is known of unknown words.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_batch, discard, parts_for, shared_folder, stored, whole_text

CLASSES = 32  # at least; a large vocabulary has more
MIN_COUNT = 2
BANDS = MIN_COUNT.bit_length() - 1  # classes of rarer words
ALL = 1 + CLASSES + BANDS  # at least; the end of a text is class 0
PARTS = 2  # parts of the vocabulary that move in turn
SWEEPS = 2  # exchanges of each word at most
TOLERANCE = 1e-3  # a sweep that raises the log likelihood of a token by less is the last
OFTEN = 512  # contexts from which on a word moves on its own
BATCH = 512  # words that move together, if rarer
BLOCK_TOKENS = 6_000_000
STEP = 500_000  # tokens of a block that are counted at once
BLOCK_WORDS = 600_000
PIECE = 4_000_000  # bytes of texts that are split at once
BUCKET_WORDS = 4096  # words whose counts one task reduces
RESULT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
          "score double")


def _planes(ids: np.ndarray) -> bytes:
    """Token numbers with their lowest bytes first, then the next ones: the upper bytes are mostly alike and compress."""
    return ids.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<i4").ravel()


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch cut after every PIECE bytes of text."""
    return cut_batch(batch, 2, PIECE)


def _encoded(texts: pa.Array, numbers: defaultdict) -> tuple[np.ndarray, np.ndarray]:
    """The word numbers of some texts, each text with its end (0), and how many each has. New words get the next numbers in
    the order in which they come; a text's words are split, lowered and told apart by Arrow, so that Python meets each once."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words = lists.flatten().dictionary_encode()
    distinct = words.dictionary.to_numpy(zero_copy_only=False)  # the quickest way to Python strings
    known = np.fromiter(map(numbers.__getitem__, distinct), np.int32, len(distinct))
    ids = known[words.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.int32)
    real = ids != 0  # white space at a text's margin leaves an empty word there
    upto = np.append(0, np.cumsum(real))
    cuts = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = upto[cuts[1:] - cuts[0]] - upto[cuts[:-1] - cuts[0]] + 1
    out = np.zeros(int(sizes.sum()), np.int32)
    inner = np.ones(len(out), bool)
    inner[np.cumsum(sizes) - 1] = False
    out[inner] = ids[real]
    return out, sizes


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of documents (their tokens as numbers of the block's words) and, after them, of the block's words with how
    often its training documents hold them. Word 0 is the end of a text, written as an empty word."""
    names = ["block", "doc_id", "held_out", "ids", "base", "words", "counts"]
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int64())]
    block = TaskContext.get().partitionId() << 12
    numbers, seen, tokens = None, None, 0

    def begin():
        nonlocal numbers, seen, tokens
        numbers, seen, tokens = defaultdict(), [], 0
        numbers.default_factory = numbers.__len__
        numbers[""]

    def batch(columns):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def words():
        count = np.bincount(np.concatenate(seen) if seen else np.zeros(0, np.int32), minlength=len(numbers))
        all_ = list(numbers)
        for at in range(0, len(all_), 50_000):
            yield batch([[block], [None], [None], [None], [at], [all_[at:at + 50_000]], [count[at:at + 50_000]]])

    begin()
    for rows in batches:
        out, size = [], 0
        for piece in _pieces(rows):
            ids, sizes = _encoded(piece.column(2), numbers)
            ends = np.cumsum(sizes)
            held = piece.column(1).to_numpy(zero_copy_only=False).astype(bool)
            seen.append(ids[~np.repeat(held, sizes)])
            for doc_id, h, a, b in zip(piece.column(0).to_pylist(), held.tolist(), (ends - sizes).tolist(), ends.tolist()):
                out.append((block, doc_id, h, _planes(ids[a:b])))
            size += len(ids)
            tokens += len(ids)
            full = tokens > BLOCK_TOKENS or len(numbers) > BLOCK_WORDS
            if size > 1_000_000 or full:
                yield batch([*zip(*out), [None] * len(out), [None] * len(out), [None] * len(out)])
                out, size = [], 0
            if full:
                yield from words()
                block += 1
                begin()
        if out:
            yield batch([*zip(*out), [None] * len(out), [None] * len(out), [None] * len(out)])
    if tokens:
        yield from words()


def _flat(docs: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """All token numbers of a block, and where each document starts."""
    ids = [_numbers(raw) for raw in docs["ids"]]
    sizes = np.array([len(i) for i in ids], np.int64)
    return np.concatenate(ids) if ids else np.zeros(0, np.int32), np.cumsum(sizes) - sizes


def _enrich(total: int, distinct: int, band_tokens: list[int], unknown: float):
    def run(key, docs: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        """Documents with what depends on counts alone, and one row without an id for the block's exchanged words.

        Token numbers become 0 for the end of a text, 1 to BANDS for the bands of words that are not exchanged, and a
        word's number plus BANDS for the others.
        """
        count = np.zeros(int(words["lid"].max()) + 1, np.int64)
        count[words["lid"].to_numpy()] = words["c"].to_numpy()
        band = np.minimum(np.floor(np.log2(np.maximum(count, 1))).astype(np.int64), BANDS - 1)
        common = count >= MIN_COUNT
        common[0] = True
        number = np.where(common, np.arange(len(count)) + BANDS, 1 + band).astype(np.int32)
        number[0] = 0
        base = np.log10((count + 1) / (total + 1 * (distinct + 1)))
        size = np.maximum(np.array(band_tokens, float), 1)[band]
        rare = np.log10(np.where(count == 0, unknown, np.maximum(count, 1) / size * np.where(count == 1, 1 - unknown, 1.0)))
        rare[common] = 0
        ids, start = _flat(docs)
        stop = np.append(start[1:], len(ids))
        new = number[ids]
        exchanged = words[words["h"] != 0].sort_values("lid")
        rows = pd.DataFrame({
            "block": docs["block"], "doc_id": docs["doc_id"].astype("Int64"), "held_out": docs["held_out"], "n_tokens": stop - start,
            "n_known": np.add.reduceat(count[ids] > 0, start, dtype=np.int64),
            "base_score": np.add.reduceat(base[ids], start), "rare_score": np.add.reduceat(rare[ids], start),
            "ids": [_planes(new[a:b]) for a, b in zip(start, stop)], "lids": None, "hashes": None, "counts": None})
        own = pd.DataFrame([{
            "block": key[0], "doc_id": None, "held_out": False, "n_tokens": 0, "n_known": 0, "base_score": 0.0, "rare_score": 0.0,
            "ids": b"", "lids": exchanged["lid"].to_numpy().astype("<i4").tobytes(),
            "hashes": exchanged["h"].to_numpy().astype("<i8").tobytes(), "counts": exchanged["c"].to_numpy().astype("<i8").tobytes()}])
        return pd.concat([rows, own.astype({"doc_id": "Int64"})])

    return run


def _words(docs: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers, hashes and counts of a block's exchanged words, by number."""
    row = docs[docs["lids"].notna()].iloc[0]
    return np.frombuffer(row["lids"], "<i4"), np.frombuffer(row["hashes"], "<i8"), np.frombuffer(row["counts"], "<i8")


def _places(top: np.ndarray):
    """For a bucket of words: one row with their hashes in order and their first classes, and for each block one with the
    numbers that the block gives its words and their places among the hashes. The words of ``top`` start a class each."""
    def run(key, words: pd.DataFrame) -> pd.DataFrame:
        h, at = np.unique(words["h"].to_numpy(), return_inverse=True)
        start = np.zeros(len(h), "<u2")
        start[at] = words["start"].to_numpy()
        place = np.minimum(np.searchsorted(h, top), len(h) - 1)
        mine = np.flatnonzero(h[place] == top)
        start[place[mine]] = mine + 1
        block = words["block"].to_numpy()
        order = np.argsort(block, kind="stable")
        block, at, lids = block[order], at[order].astype("<i4"), words["lid"].to_numpy()[order].astype("<i4")
        cuts = np.flatnonzero(np.diff(block, prepend=-1)).tolist()
        rows = [(key[0], None, h.astype("<i8").tobytes(), start.tobytes(), None, None)]
        rows += [(key[0], block[a], None, None, at[a:b].tobytes(), lids[a:b].tobytes()) for a, b in zip(cuts, [*cuts[1:], len(at)])]
        return pd.DataFrame(rows, columns=["bucket", "block", "h", "class", "at", "lids"]).astype({"block": "Int64"})

    return run


def _classed(places: pd.DataFrame, classes: pd.DataFrame) -> pd.DataFrame:
    """The words of a bucket by block: their numbers there and their classes."""
    now = np.frombuffer(classes["class"].iloc[0], "<u2")
    return pd.DataFrame({"block": places["block"], "lids": places["lids"],
                         "class": [now[np.frombuffer(at, "<i4")].tobytes() for at in places["at"]]})


def _table(words: pd.DataFrame) -> np.ndarray:
    """The class of each word number."""
    lids = np.frombuffer(b"".join(words["lids"]), "<i4")
    table = np.zeros(int(lids.max()) + 1 if len(lids) else 1, np.uint16)
    table[lids] = np.frombuffer(b"".join(words["class"]), "<u2")
    return table


def _classes(ids: np.ndarray, table: np.ndarray, n_classes: int) -> np.ndarray:
    """The class of each token."""
    now = np.empty(len(ids), np.uint16)
    for at in range(0, len(ids), STEP):
        some = ids[at:at + STEP]
        now[at:at + STEP] = np.where(some > BANDS, table[np.maximum(some - BANDS, 0)], np.where(some == 0, 0, n_classes + some))
    return now


def _transitions(n_classes: int):
    all_ = 1 + n_classes + BANDS

    def run(key, docs: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        ids, _ = _flat(docs)
        now = _classes(ids, _table(words), n_classes)
        before = np.concatenate([np.zeros(1, np.uint16), now[:-1]])  # a text ends with class 0, so the next begins after it
        found = np.zeros(all_ * all_, np.int64)
        for at in range(0, len(ids), STEP):
            found += np.bincount(before[at:at + STEP].astype(np.int64) * all_ + now[at:at + STEP], minlength=all_ * all_)
        some = np.flatnonzero(found)
        return pd.DataFrame({"pair": some, "n": found[some]})

    return run


def _contexts(turn: int, parts: int, buckets: int, n_classes: int):
    all_ = 1 + n_classes + BANDS

    def run(key, docs: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        """For the words whose turn it is, the classes before (0 to all_ - 1) and after (from all_) them, as sparse rows
        packed by bucket."""
        ids, _ = _flat(docs)
        table = _table(words)
        now = _classes(ids, table, n_classes)
        lids, h, _ = _words(docs)
        mine = (h & (parts - 1)) == turn
        lids, h = lids[mine], h[mine]
        bucket = (h >> 16) % buckets
        order = np.lexsort((h, bucket))
        lids, h, bucket = lids[order], h[order], bucket[order]
        if not len(h) or not len(ids):
            return pd.DataFrame()
        row_of = np.full(max(int(ids.max()) - BANDS, int(lids.max())) + 1, -1, np.int64)
        row_of[lids] = np.arange(len(lids))
        cells, counts = [], []
        last = len(ids) - 1
        for at in range(0, len(ids), STEP):
            some = ids[at:at + STEP]
            row = np.where(some > BANDS, row_of[np.maximum(some - BANDS, 0)], -1)
            here = np.flatnonzero(row >= 0)
            row, here = row[here] * (2 * all_), here + at
            # a word is never the last token of a text; the first token has the end of a text before it
            before = np.where(here > 0, now[here - 1], 0)
            cell, n = np.unique(np.concatenate([row + before, row + all_ + now[np.minimum(here + 1, last)]]), return_counts=True)
            cells.append(cell)
            counts.append(n.astype(np.uint32))
        cells, counts = np.concatenate(cells), np.concatenate(counts)
        order = np.argsort(cells, kind="stable")
        cells, counts = cells[order], counts[order]
        starts = np.flatnonzero(np.diff(cells, prepend=-1))
        cell, n = cells[starts], (np.add.reduceat(counts, starts) if len(starts) else counts).astype("<u4")
        width = np.bincount(cell // (2 * all_), minlength=len(h)).astype("<u2")
        k = (cell % (2 * all_)).astype("<u2")
        ends = np.cumsum(width, dtype=np.int64)
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
        out = []
        for a, b in zip(cuts, np.append(cuts[1:], len(h))):
            x, y = ends[a] - width[a], ends[b - 1]
            out.append((bucket[a], h[a:b].tobytes(), width[a:b].tobytes(), k[x:y].tobytes(), n[x:y].tobytes()))
        return pd.DataFrame(out, columns=["bucket", "h", "width", "k", "n"])

    return run


def _g(x):
    return x * np.log(np.maximum(x, 1.0))


def _sums(rows: np.ndarray, kind: np.ndarray, starts: np.ndarray, width: np.ndarray) -> np.ndarray:
    """The sum of each word's cells, added from the first to the last as np.add.reduceat(rows[kind], starts, axis=0) would,
    but one place of all words at a time: words that move together have about as many cells."""
    order = np.argsort(-width, kind="stable")
    first, longer = starts[order], np.cumsum(np.bincount(width)[::-1])[::-1]  # longer[d]: words of d cells or more
    total = rows[kind[first]]
    for d in range(1, len(longer) - 1):
        total[:longer[d + 1]] += rows[kind[first[:longer[d + 1]] + d]]
    out = np.empty_like(total)
    out[order] = total
    return out


def best_classes(own: np.ndarray, word: np.ndarray, k: np.ndarray, n: np.ndarray, pairs: np.ndarray, often: int = OFTEN,
                 batch: int = BATCH) -> np.ndarray:
    """The classes, 1 to the number of them in ``pairs``, after one exchange of each word, the most frequent first; a word stays where it
    is among equals.

    ``word`` (sorted), ``k``, ``n``: counts of the class before (k below the length of ``pairs``) or after (k less this
    length) a word; ``pairs``: class bigrams. Moves change this task's copy of the bigrams, so that words do not all run
    after the same class: at once for words with ``often`` contexts or more, after each ``batch`` of the others.
    """
    own, pairs = own.copy(), pairs.astype(float)
    all_, size = len(pairs), pairs.sum(0)
    ends = np.searchsorted(word, np.arange(len(own) + 1))
    each = slice(1, all_ - BANDS)
    total_of = np.bincount(word, n, minlength=len(own))
    order = np.argsort(-total_of, kind="stable")
    frequent = int((total_of >= often).sum())
    for w in order[:frequent].tolist():
        at, count = k[ends[w]:ends[w + 1]], n[ends[w]:ends[w + 1]]
        first = np.searchsorted(at, all_)
        before, x, after, y = at[:first], count[:first], at[first:] - all_, count[first:]
        total, a = x.sum(), own[w]
        pairs[before, a] -= x
        pairs[a, after] -= y
        size[a] -= total
        left, right, rest = np.maximum(pairs[before, each], 0), np.maximum(pairs[each, after], 0), np.maximum(size[each], 0)
        gain = ((_g(left + x[:, None]) - _g(left)).sum(0) + (_g(right + y) - _g(right)).sum(1) - 2 * (_g(rest + total) - _g(rest)))
        b = int(gain.argmax()) + 1
        if gain[a - 1] >= gain[b - 1] - 1e-9:
            b = a
        pairs[before, b] += x
        pairs[b, after] += y
        size[b] += total
        own[w] = b
    share, at = size.sum() / 200, frequent
    while at < len(own):
        # those that move together hold little of the text, or they would all run after the same class
        some = order[at:at + batch]
        some = some[:max(1, int(np.searchsorted(np.cumsum(total_of[some]), share)))]
        at += len(some)
        some = some[ends[some + 1] > ends[some]]
        if not len(some):
            continue
        width = ends[some + 1] - ends[some]
        starts = np.cumsum(width) - width
        cells = np.repeat(ends[some] - starts, width) + np.arange(width.sum())
        context, count, row = k[cells], n[cells], np.repeat(np.arange(len(some)), width)
        total = np.add.reduceat(np.where(context < all_, count, 0), starts)
        a = own[some]
        around = np.maximum(np.concatenate([pairs[:, each], pairs[each].T]), 0)  # bigrams by context and class
        # cells with one context and count have one row of gains
        kinds, kind = np.unique(context * (1 << 32) + count.astype(np.int64), return_inverse=True)
        old, new = around[kinds >> 32], (kinds & (1 << 32) - 1)[:, None]
        gain = _sums(_g(old + new) - _g(old), kind, starts, width)
        rest = np.maximum(size[each], 0)
        gain -= 2 * (_g(rest + total[:, None]) - _g(rest))
        # what a word's own class loses without it
        held = around[context, a[row] - 1]
        stay = np.add.reduceat(_g(held) - _g(np.maximum(held - count, 0)), starts)
        stay -= 2 * (_g(rest[a - 1]) - _g(np.maximum(rest[a - 1] - total, 0)))
        every = np.arange(len(some))
        gain[every, a - 1] = stay
        b = gain.argmax(1) + 1
        moved = gain[every, b - 1] > stay + 1e-9
        own[some[moved]] = b[moved]
        np.add.at(size, a[moved], -total[moved])
        np.add.at(size, b[moved], total[moved])
        go = moved[row]
        context, count, a, b = context[go], count[go], a[row[go]], b[row[go]]
        left = context < all_
        np.add.at(pairs, (context[left], a[left]), -count[left])
        np.add.at(pairs, (context[left], b[left]), count[left])
        after = context[~left] - all_
        np.add.at(pairs, (a[~left], after), -count[~left])
        np.add.at(pairs, (b[~left], after), count[~left])
    return own


def _exchange(pairs: np.ndarray):
    all_ = len(pairs)

    def run(rows: pd.DataFrame, classes: pd.DataFrame) -> pd.DataFrame:
        """The classes of a bucket's words after the exchange of those whose contexts are in ``rows``."""
        every, now = np.frombuffer(classes["h"].iloc[0], "<i8"), np.frombuffer(classes["class"].iloc[0], "<u2").copy()
        if len(rows):
            h, word = np.unique(np.frombuffer(b"".join(rows["h"]), np.int64), return_inverse=True)
            width = np.frombuffer(b"".join(rows["width"]), "<u2")
            k = np.frombuffer(b"".join(rows["k"]), "<u2").astype(np.int64)
            n = np.frombuffer(b"".join(rows["n"]), "<u4").astype(float)
            dense = np.bincount(np.repeat(word, width) * 2 * all_ + k, n, minlength=len(h) * 2 * all_)
            cell, at = np.flatnonzero(dense), np.searchsorted(every, h)
            now[at] = best_classes(now[at].astype(np.int64), cell // (2 * all_), cell % (2 * all_), dense[cell], pairs)
        return classes.assign(**{"class": [now.tobytes()]})

    return run


def likelihood(pairs: np.ndarray) -> float:
    """The part of the training texts' log likelihood that depends on the words' classes."""
    def g(x):
        return (x * np.log(np.maximum(x, 1.0))).sum()

    return g(pairs) - g(pairs.sum(0)) - g(pairs.sum(1))


def _scores(pairs: np.ndarray, total: int):
    all_, size = len(pairs), pairs.sum(0)
    prior = (size + 1) / (size.sum() + all_)
    steps = np.log10((pairs + all_ * prior) / (pairs.sum(1, keepdims=True) + all_))

    def run(key, docs: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        table = _table(words)
        lids, _, count = _words(docs)
        docs = docs[docs["lids"].isna()]
        ids, start = _flat(docs)
        now = _classes(ids, table, all_ - 1 - BANDS)
        before = np.concatenate([np.zeros(1, np.uint16), now[:-1]])
        emit = np.zeros(max(int(ids.max()) - BANDS, int(lids.max()) if len(lids) else 0, 0) + 1)
        emit[lids] = np.log10(count / np.maximum(size[table[lids]], 1))
        score = steps[before, now]
        score += np.where(ids > BANDS, emit[np.maximum(ids - BANDS, 0)], 0.0)
        return pd.DataFrame({
            "doc_id": docs["doc_id"].astype("Int64"), "held_out": docs["held_out"], "n_tokens": docs["n_tokens"],
            "n_known": docs["n_known"], "train_tokens": total, "base_score": docs["base_score"],
            "score": np.add.reduceat(score, start) + docs["rare_score"].to_numpy()})

    return run


def _pairs(blocks, words, n_classes: int) -> np.ndarray:
    """Class bigrams of the training texts; classes times classes numbers reach the driver."""
    all_ = 1 + n_classes + BANDS
    found = (blocks.where("not held_out").select("block", "ids").groupBy("block").cogroup(words.groupBy("block"))
             .applyInPandas(_some(_transitions(n_classes)), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
             .toPandas())
    pairs = np.zeros(all_ * all_, np.int64)
    pairs[found["pair"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return pairs.reshape(all_, all_)


def score(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Texts in which crc32 of the doc_id as text leaves 2 modulo 7 are held out, all others trained on (a null id as well).
    A null text counts as empty: one token, the end. ``base_score`` is the add-one unigram score, ``score`` the log10
    probability under the class model. Repeated rows are texts of their own. Other columns are ignored, whatever their
    names. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    id_ = F.col("doc_id").cast("long")
    held = F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 7 == 2, F.lit(False))
    raw = stored(docs.select(id_.alias("doc_id"), held.alias("held_out"), whole_text().alias("text")).mapInArrow(
        _block_rows, "block long, doc_id long, held_out boolean, ids binary, base int, words array<string>, "
                     "counts array<long>"), "tokens")
    listed = (raw.where("words is not null")
              .select("block", "base", F.posexplode(F.arrays_zip("words", "counts")).alias("pos", "w"))
              .select((F.shiftleft("block", 24) + F.col("base") + F.col("pos")).alias("place"), F.col("w.words").alias("word"),
                      F.col("w.counts").alias("n")))
    # a word has one row for each block that holds it; a block has less than 2 ** 24 words
    same = Window.partitionBy("word").orderBy("place")  # one order for both, or the words are sorted twice
    all_ = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    words = stored(listed.withColumns({"c": F.sum("n").over(all_), "nth": F.row_number().over(same)}).select(
        F.shiftright("place", 24).alias("block"), F.col("place").bitwiseAND(F.lit((1 << 24) - 1)).cast("int").alias("lid"), "c",
        (F.col("nth") == 1).alias("first"),
        F.when((F.col("c") >= MIN_COUNT) & (F.col("word") != ""), F.xxhash64("word")).alias("h")), "words")
    once = words.where("first")
    c = F.col("c")
    bands = [F.coalesce(F.sum(F.when((c >= 1 << b) & (c < 2 << b), c)), F.lit(0)).alias(f"band{b}") for b in range(BANDS)]
    sums = once.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("total"), F.count_if(c > 0).alias("distinct"), *bands,
                    F.count_if(c == 1).alias("n1"), F.count_if(c == 2).alias("n2"), F.count("h").alias("common")).first()
    if sums["distinct"] == 0 and raw.isEmpty():
        return spark.createDataFrame([], RESULT)
    total = sums["total"]
    # what unseen words take of the class of words seen once (Good-Turing)
    unknown = (sums["n1"] + 1) / (sums["n1"] + 2 * sums["n2"] + 2)
    buckets = parts_for(raw.select("block").distinct().count(), 1)
    name = f"class_lm_{uuid.uuid4().hex}"
    (raw.where("ids is not null").select("block", "doc_id", "held_out", "ids").groupBy("block")
     .cogroup(words.select("block", "lid", "c", F.coalesce("h", F.lit(0)).alias("h")).groupBy("block"))
     .applyInPandas(_enrich(total, sums["distinct"], [sums[f"band{b}"] for b in range(BANDS)], unknown),
                    "block long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, "
                    "rare_score double, ids binary, lids binary, hashes binary, counts binary")
     .write.format("parquet").option("compression", "zstd").bucketBy(min(buckets, 4096), "block")
     .option("path", f"{shared_folder(spark)}/{name}").saveAsTable(name))
    blocks = spark.table(name)
    # the most frequent words start a class each, the others are spread
    n_classes = max(CLASSES, round(sums["common"] ** (1 / 3)))
    top = [r["h"] for r in once.where("h is not null").orderBy(F.desc("c"), "h").limit(n_classes).select("h").collect()]
    spread = F.pmod(F.xxhash64(F.lit(3), "h"), F.lit(n_classes)) + 1
    # bucketed by word: the rounds bring a bucket's classes to it, and shuffle a row for each bucket and block, not each word
    groups = parts_for(sums["common"], BUCKET_WORDS * PARTS)
    bucket = F.pmod(F.shiftright("h", 16), F.lit(groups)).cast("long")
    (words.where("h is not null").select(bucket.alias("bucket"), "block", "lid", "h", spread.alias("start"))
     .repartition(min(buckets, 4096), "bucket").groupBy("bucket")
     .applyInPandas(_places(np.array(top, np.int64)), "bucket long, block long, h binary, class binary, at binary, lids binary")
     .write.format("parquet").option("compression", "zstd").bucketBy(min(buckets, 4096), "bucket")
     .option("path", f"{shared_folder(spark)}/{name}_words").saveAsTable(f"{name}_words"))
    places = spark.table(f"{name}_words").where("block is not null").select("bucket", "block", "at", "lids")
    classes = spark.table(f"{name}_words").where("block is null").select("bucket", "h", "class")

    def classed(classes: DataFrame) -> DataFrame:
        return (places.groupBy("bucket").cogroup(classes.groupBy("bucket"))
                .applyInPandas(_classed, "block long, lids binary, class binary"))

    own = classed(classes)
    pairs = _pairs(blocks, own, n_classes)
    for _ in range(SWEEPS if sums["common"] else 0):
        start = likelihood(pairs)
        for turn in range(PARTS):
            moved = (blocks.where("not held_out").select("block", "ids", "lids", "hashes", "counts").groupBy("block")
                     .cogroup(own.groupBy("block"))
                     .applyInPandas(_some(_contexts(turn, PARTS, groups, n_classes)),
                                    "bucket long, h binary, width binary, k binary, n binary")
                     .groupBy("bucket").cogroup(classes.groupBy("bucket"))
                     .applyInPandas(_exchange(pairs), "bucket long, h binary, class binary"))
            new = stored(moved, "classes")
            found = _pairs(blocks, classed(new), n_classes)
            # tasks do not see each other's moves: a round that lowers the likelihood is undone
            if likelihood(found) >= likelihood(pairs):
                classes, own, pairs = new, classed(new), found
        if likelihood(pairs) - start <= TOLERANCE * total:
            break
    scored = stored(blocks.groupBy("block").cogroup(own.groupBy("block"))
                    .applyInPandas(_some(_scores(pairs, total)), RESULT), "scores")
    for table in (name, f"{name}_words"):
        spark.sql(f"drop table {table}")
        discard(spark, f"{shared_folder(spark)}/{table}")
    return scored


def _some(function):
    """Cogroups in which one side may be empty: no documents give no rows."""
    def run(key, docs: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        return function(key, docs, words) if len(docs) else pd.DataFrame()

    return run
