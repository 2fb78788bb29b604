"""Packing token ids into training sequences by order-preserving dynamic programming.

The documents of a task form a stream. Sequences are windows of the stream, cut at document or sentence ends; a window
over a stretch without such an end may also be cut inside. The cuts minimise padding plus a penalty for each cut inside a
document. With ``best[j]`` the least cost of the stream up to cut j,

    best[j] = penalty(j) + min over cuts i with 0 < j - i <= window of best[i] + padding(j - i)

where padding(n) is 0 for a power of two, else window - n. The first kind of transition takes the power-of-two
predecessors one by one, the second is a sliding minimum of best[i] + i, kept in a monotone queue.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import ChunkTable, flat
from .common import cut_batch, whole_text

WINDOW = 4096
END_ID = 2
SENTENCE_CUT = 24  # penalties in padding tokens
INNER_CUT = 96
STRIDES = 16  # inner cuts to a window where neither a document nor a sentence ends
STREAM = 1 << 20  # tokens planned at once, or those of a group of texts
KEPT = 600_000  # words whose ids a task keeps: memory for time, ids do not depend on it
GROUP = 8_000_000  # bytes of texts that are encoded at once

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "sequence_length long, ids binary")

# fixed values: letters that the tokenizer knows alone or in lower case, and characters that it parts from them
WORD = "^(?P<word>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[.,!%*&$#|]*)$"
LETTERS = re.compile("[a-zß-öø-ÿ]+")
LINE = 2000  # plain words encoded as one text


class Words:
    """Ids of texts under a word-level tokenizer whose words end at white space."""

    def __init__(self, path: str, kept: int = KEPT):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core: threads would wait for each other
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.parts = ChunkTable(self._parts, kept)
        ends = [self.tokenizer.token_to_id(f"{end}</w>") for end in (".", "!", "?", "!!", "...", "。")]
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[e for e in ends if e is not None]] = True
        self.finals = np.zeros(len(self.ends), bool)
        self.finals[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True

    def _library(self, texts):
        return flat([e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])

    def _parts(self, parts):
        """Plain words are encoded many to a text, where each ends with a final piece; if not, one by one as all others."""
        plain = [LETTERS.fullmatch(p) is not None for p in parts]
        words = list(compress(parts, plain))
        lines = [" ".join(words[at:at + LINE]) for at in range(0, len(words), LINE)]
        ids, _ = self._library(lines)
        ends = np.flatnonzero(self.finals[ids]) + 1
        if not words or len(ends) != len(words) or ends[-1] != len(ids):
            return self._library(parts)
        others, other_count = self._library([p for p, ok in zip(parts, plain) if not ok])
        plain = np.array(plain)
        count = np.empty(len(parts), np.int64)
        count[plain], count[~plain] = np.diff(ends, prepend=0), other_count
        out = np.empty(len(ids) + len(others), np.int32)
        mine = np.repeat(plain, count)
        out[mine], out[~mine] = ids, others
        return out, count

    def _chunks(self, chunks: pa.Array) -> pa.ListArray:
        """The ids of each chunk. A plain word and the punctuation behind it are looked up apart, in lower case: the
        tokenizer splits there. All other chunks are left to the library."""
        found = pc.extract_regex(chunks, WORD)
        plain = found.is_valid()
        found, rest = found.filter(plain), chunks.filter(pc.invert(plain))
        words = pc.utf8_lower(found.field("word")).dictionary_encode()
        marks = found.field("marks").dictionary_encode()
        kinds = [words.dictionary, rest, marks.dictionary]
        ids, count = self.parts.gather([part for kind in kinds for part in kind.to_numpy(zero_copy_only=False)])
        parts = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.append(count, 0))), pa.int32()), pa.array(ids))
        # the two parts of each chunk; the second may be the empty list at the end
        two = np.full((len(chunks), 2), len(count), np.int32)
        plain = plain.to_numpy(zero_copy_only=False)
        two[plain, 0] = words.indices.to_numpy()
        two[~plain, 0] = len(kinds[0]) + np.arange(len(rest))
        two[plain, 1] = len(kinds[0]) + len(rest) + marks.indices.to_numpy()
        both = parts.take(pa.array(two.ravel()))
        return pa.ListArray.from_arrays(pa.array(both.offsets.to_numpy()[::2]), both.flatten())

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has. Texts are split at ASCII white space, which
        ends a word for the tokenizer as all white space does; Arrow tells the chunks apart, so that Python meets each once."""
        lists = pc.ascii_split_whitespace(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        chunks = lists.flatten().dictionary_encode()
        ids = self._chunks(chunks.dictionary).take(chunks.indices)
        cuts = lists.offsets.to_numpy()
        return ids.flatten().to_numpy(), np.diff(ids.offsets.to_numpy()[cuts - cuts[0]])


@lru_cache(maxsize=4)
def words(path: str, kept: int = KEPT) -> Words:
    return Words(path, kept)


def cut_points(doc_ends: np.ndarray, sentence_ends: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Places where a stream may be cut, with their penalties; both arguments sorted, ``doc_ends`` up to the stream's end.

    Inner cuts are added only to stretches that no window could cross otherwise, or longer than a fourth of a window.
    """
    total = int(doc_ends[-1]) if len(doc_ends) else 0
    # the penalty at every place of the stream; -1 where it is not cut
    fine = np.full(total + 1, -1, np.int32)
    fine[sentence_ends] = SENTENCE_CUT
    fine[doc_ends] = 0
    fine[0] = 0
    soft = np.flatnonzero(fine >= 0)
    gap = np.diff(soft)
    stride = max(1, window // STRIDES)
    for at in np.flatnonzero(gap > window // 4):
        fine[soft[at] + stride:soft[at + 1]:stride] = INNER_CUT
    cuts = np.flatnonzero(fine >= 0)
    return cuts, fine[cuts].astype(np.int64)


def plan(cuts: np.ndarray, penalty: np.ndarray, window: int = WINDOW) -> list[int]:
    """Numbers of the chosen cuts, from the first to the last, at least cost; among equals the longer last window."""
    places, fines = cuts.tolist(), penalty.tolist()
    # the power-of-two predecessors that are cuts, longest first: (j, i) by j
    number = np.full(int(cuts[-1]) + 1, -1, np.int32)
    number[cuts] = np.arange(len(cuts))
    later, earlier = [], []
    for power in (1 << k for k in range(window.bit_length() - 1, -1, -1)):
        reach = int(np.searchsorted(cuts, power))
        i = number[cuts[reach:] - power]
        j = np.flatnonzero(i >= 0)
        later.append(j + reach)
        earlier.append(i[j])
    later, earlier = np.concatenate(later), np.concatenate(earlier)
    order = np.argsort(later, kind="stable")
    steps, first = earlier[order].tolist(), np.searchsorted(later[order], np.arange(len(places) + 1)).tolist()
    nearest = np.searchsorted(cuts, cuts - window).tolist()  # the first cut within a window before each
    best, back = [0] * len(places), [0] * len(places)
    # the queue: cuts i and best[i] + place, both rising, from ``head`` on
    keys, queued, head = [0], [0], 0
    for j in range(1, len(places)):
        at, least = places[j], nearest[j]
        while queued[head] < least:
            head += 1
        cost, i = keys[head] + window - at, queued[head]
        for k in steps[first[j]:first[j + 1]]:
            if best[k] < cost or best[k] == cost and k < i:
                cost, i = best[k], k
        cost += fines[j]
        best[j], back[j] = cost, i
        key = cost + at
        while keys and keys[-1] > key and len(keys) > head:
            keys.pop()
            queued.pop()
        keys.append(key)
        queued.append(j)
    chosen, j = [len(places) - 1], len(places) - 1
    while j:
        j = back[j]
        chosen.append(j)
    return chosen[::-1]


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = True,
         kept: int = KEPT) -> DataFrame:
    """One row per piece of a document: its ids, where they start in the document, its sequence and place there.

    Every document's ids (a null text counts as empty) get ``end_id`` at the end, so every row has at least one piece;
    repeated rows and null ids are documents of their own. Other columns are ignored, whatever their names. Sequences
    follow the order of rows, hold at most ``window`` ids and belong to one task: a stream of ``STREAM`` ids or more is planned
    at once, and what follows its last full windows goes into the next plan. ``ids`` holds the piece's ids as
    little-endian unsigned 32-bit numbers, null without ``with_ids``. ``kept`` trades a task's memory for time
    (about 150 bytes an entry). ``tokenizer_path`` must exist on every executor.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.default_memory_pool().release_unused()  # what earlier tasks of this process have left
        w = words(tokenizer_path, kept)
        sequence = TaskContext.get().partitionId() << 40
        # the stream's documents: (id, number of ids, ids that earlier plans placed), and their unplaced ids
        names: list[tuple[int | None, int, int]] = []
        stream = np.zeros(0, np.int32)

        def place(last: bool):
            """Plans the stream and yields a batch; unless it is the last, the windows near its end wait."""
            nonlocal names, stream, sequence
            left = np.array([n - done for _, n, done in names], np.int64)
            doc_ends = np.cumsum(left)
            cuts, penalty = cut_points(doc_ends, np.flatnonzero(w.ends[stream]) + 1, window)
            chosen = cuts[plan(cuts, penalty, window)]
            if not last:
                chosen = chosen[chosen <= len(stream) - 4 * window]
            if len(chosen) < 2:
                return
            bounds = np.union1d(chosen, doc_ends[doc_ends <= chosen[-1]])
            first, length = bounds[:-1], np.diff(bounds)
            doc = np.searchsorted(doc_ends, first, "right")
            seq = np.searchsorted(chosen, first, "right") - 1
            raw = memoryview(stream.astype("<u4").tobytes())
            pieces = [raw[4 * a:4 * (a + n)] for a, n in zip(first.tolist(), length.tolist())]
            total = np.array([n for _, n, _ in names], np.int64)[doc]
            done = np.array([n for _, _, n in names], np.int64)[doc]
            start = done + first - (doc_ends - left)[doc]
            yield pa.RecordBatch.from_arrays([
                pa.array([names[d][0] for d in doc.tolist()], pa.int64()), pa.array(start), pa.array(length),
                pa.array([zlib.crc32(p) for p in pieces], pa.int64()), pa.array(total), pa.array(sequence + seq),
                pa.array(first - chosen[seq]), pa.array(np.diff(chosen)[seq]),
                pa.array([p.tobytes() for p in pieces] if with_ids else [None] * len(pieces), pa.binary())],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
                       "sequence_length", "ids"])
            sequence += len(chosen) - 1
            gone = int(chosen[-1])
            at = int(np.searchsorted(doc_ends, gone, "right"))
            if at < len(names):
                name, n, before = names[at]
                names[at] = (name, n, n - int(doc_ends[at] - gone))
            names, stream = names[at:], stream[gone:]

        for batch in batches:
            for rows in cut_batch(batch, 1, GROUP):
                ids, count = w.encode(rows.column(1))
                stream = np.concatenate([stream, np.insert(ids, np.cumsum(count), end_id)])
                names += zip(rows.column(0).to_pylist(), (count + 1).tolist(), repeat(0))
                if len(stream) >= STREAM:
                    yield from place(False)
        if names:
            yield from place(True)

    return docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInArrow(run, SCHEMA)
