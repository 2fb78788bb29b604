"""Ids of text chunks that repeat, kept by a task up to a bound."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain, compress, islice, repeat

import numpy as np

KEPT = 700_000


def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all lists, one after the other, and how many each has."""
    count = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int32, int(count.sum())), count


class ChunkTable:
    """Encodes each distinct chunk once while it is kept. Beyond ``kept`` chunks the later half goes: what came first is
    what comes often.

    The bound limits memory only: a chunk that is not kept is encoded again, with the same ids.
    """

    def __init__(self, encode_many: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], kept: int = KEPT):
        self.encode_many, self.kept = encode_many, kept
        self.slots: dict[str, int] = {}
        self.ids, self.at, self.count = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def _shrink(self, n: int):
        if n < len(self.slots):
            self.slots = dict(islice(self.slots.items(), n))
            self.ids = self.ids[:self.at[n]].copy()
            self.at, self.count = self.at[:n].copy(), self.count[:n].copy()

    def gather(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all chunks, one after the other, and how many ids each chunk has."""
        where = np.fromiter(map(self.slots.get, chunks, repeat(-1)), np.int32, len(chunks))
        unknown = where < 0
        if unknown.any():
            missed = list(compress(chunks, unknown.tolist()))
            new = list(dict.fromkeys(missed))
            if len(self.slots) + len(new) > self.kept:
                self._shrink(self.kept // 2)
                unknown |= where >= len(self.slots)  # their places are gone
                missed = list(compress(chunks, unknown.tolist()))
                new = list(dict.fromkeys(missed))
            found, count = self.encode_many(new)
            self.at = np.concatenate([self.at, len(self.ids) + np.cumsum(count, dtype=np.int32) - count.astype(np.int32)])
            self.count = np.concatenate([self.count, count.astype(np.int32)])
            self.ids = np.concatenate([self.ids, found])
            self.slots.update(zip(new, range(len(self.slots), len(self.slots) + len(new))))
            where[unknown] = np.fromiter(map(self.slots.__getitem__, missed), np.int32, len(missed))
        count = self.count[where]
        first = np.repeat(self.at[where] - (np.cumsum(count, dtype=np.int32) - count), count)
        first += np.arange(len(first), dtype=np.int32)
        return self.ids[first], count.astype(np.int64)
