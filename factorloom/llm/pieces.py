"""SentencePiece encoding and decoding with spans in the original bytes.

A text is normalised by the longest match in the model's compiled character map, and each normalised byte keeps the
range of original bytes that it came from. The normalised text falls into chunks that no piece can cross (a run of
spaces and what follows up to the next space; checked against the vocabulary, else the whole text is one chunk), so
chunks are segmented alone. They repeat, so a task keeps those it has seen, up to a bound.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import ChunkTable, flat
from .common import text_groups, whole_text

SPACE = "▁"
UNKNOWN = " ⁇ ".encode()  # what an unknown piece decodes to
SCHEMA = "doc_id long, ids array<int>, starts array<int>, stops array<int>, decoded string"


def _fields(raw: bytes):
    """(number, value) of the fields of one protobuf message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, raw[at:at + size]
            at += size


class CharMap:
    """A compiled character map: a double-array trie over UTF-8 bytes, then the replacements, each ended by a zero."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4:4 + size], "<u4").tolist() if blob else []
        self.texts = blob[4 + size:]
        self.known: dict[bytes, tuple[int, bytes] | None] = {}

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest entry that ``data`` has at ``at``."""
        units = self.units
        if not units:
            return None
        node, found = units[0], None
        place = (node >> 10) << ((node & 512) >> 6)
        for i in range(at, len(data)):
            place ^= data[i]
            node = units[place]
            if node & 0x800000FF != data[i]:
                break
            place ^= (node >> 10) << ((node & 512) >> 6)
            if node >> 8 & 1:
                start = units[place] & 0x7FFFFFFF
                found = (i + 1 - at, self.texts[start:self.texts.index(0, start)])
        return found


class Model:
    """What a model file says. Normalised chunks are segmented by the library, with its own normaliser switched off."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as file:
            raw = file.read()
        message = list(_fields(raw))
        trainer = dict(_fields(next((v for k, v in message if k == 2), b"")))
        normalizer = dict(_fields(next((v for k, v in message if k == 3), b"")))
        pieces = [dict(_fields(v)) for k, v in message if k == 1]
        kinds = [p.get(3, 1) for p in pieces]  # 1 normal, 2 unknown, 3 control, 4 user-defined, 5 unused, 6 byte
        if trainer.get(3, 1) != 2 or trainer.get(24, 0) or 4 in kinds or kinds.count(6) != 256:
            raise ValueError("only BPE models with byte pieces, and without user-defined symbols or spaces as suffixes")
        self.map = CharMap(normalizer.get(2, b""))
        self.dummy, self.trim, self.escape = (bool(normalizer.get(k, 1)) for k in (3, 4, 5))
        # a later field replaces the file's: identity map, no added or removed spaces, spaces stay
        plain = b"\x0a\x08identity\x12\x00\x18\x00\x20\x00\x28\x00"
        library = sentencepiece.SentencePieceProcessor(model_proto=raw + b"\x1a" + bytes([len(plain)]) + plain)
        self.chunks = ChunkTable(lambda names: flat(library.encode(names, num_threads=1)))
        names = [p.get(1, b"").decode() for p in pieces]
        self.width = np.array([len(n.encode()) for n in names], np.int32)
        self.byte = np.array([int(n[3:5], 16) if k == 6 else -1 for n, k in zip(names, kinds)], np.int32)
        # the bytes that each id stands for, one after the other; control pieces stand for none
        shown = [bytes([b]) if b >= 0 else b"" if k == 3 else UNKNOWN if k == 2 else n.encode()
                 for n, k, b in zip(names, kinds, self.byte.tolist())]
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.shown_size = np.array([len(x) for x in shown], np.int64)
        self.shown_at = np.cumsum(self.shown_size) - self.shown_size
        # no piece has a space after something else: then a chunk ends before each run of spaces
        crossing = any(SPACE in n.lstrip(SPACE) for n, k in zip(names, kinds) if k in (1, 5))
        self.chunk = re.compile("(?s:.+)" if crossing or not self.escape else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")

    # --- normalisation

    def normalize(self, text: str) -> tuple[str, np.ndarray | None]:
        """The normalised text; for each of its bytes and the end, the original byte. None: spaces were marked, no more."""
        mark = SPACE if self.escape else " "
        if not self.map.units and not self.trim and self.escape and SPACE not in text:
            return ((mark if self.dummy else "") + text.replace(" ", mark) if text else ""), None
        data, out, origin, at = text.encode(), bytearray(), [], 0
        pieces = []  # (original place, length, replacement)
        while at < len(data):
            got = self.map.longest(data, at)
            if got is None:
                size = 1 if data[at] < 0x80 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
                got = (size, data[at:at + size])
            pieces.append((at, *got))
            at += got[0]
        if self.trim:
            first = next((i for i, p in enumerate(pieces) if p[2] != b" "), len(pieces))
            pieces = pieces[first:]
        if not pieces:
            return "", np.array([0])
        space = mark.encode()
        if self.dummy:
            out += space
            origin += [pieces[0][0]] * len(space)
        spaced = self.trim
        for place, _, new in pieces:
            if spaced and self.trim:
                new = new.lstrip(b" ")
            for byte in new:
                got = space if byte == 32 else bytes([byte])
                out += got
                origin += [place] * len(got)
            if new:
                spaced = new.endswith(b" ")
        end = len(data)
        while self.trim and out.endswith(space):
            end = origin[len(out) - len(space)]
            del out[-len(space):], origin[-len(space):]
        return out.decode(), np.array([*origin, end])

    # --- segmentation

    def widths(self, ids: np.ndarray) -> np.ndarray:
        """Normalised bytes under each id; of a character's byte pieces, the last carries them all."""
        width = self.width[ids]
        byte = self.byte[ids]
        width[byte >= 0] = 0
        lead = np.flatnonzero((byte >= 0) & (byte & 0xC0 != 0x80))
        size = 1 + (byte[lead] >= 0xC0) + (byte[lead] >= 0xE0) + (byte[lead] >= 0xF0)
        width[lead + size - 1] = size
        return width

    def decode(self, ids: np.ndarray, count: np.ndarray) -> list[str]:
        """The texts of ids, ``count`` of them each: their bytes, marks as spaces, without the space that was put first."""
        size = self.shown_size[ids]
        ends = np.concatenate([[0], np.cumsum(size)])
        where = np.repeat(self.shown_at[ids] - ends[:-1], size)
        where += np.arange(len(where))
        raw = self.shown[where].tobytes()
        bounds = ends[np.cumsum(np.concatenate([[0], count]))].tolist()
        mark, out = SPACE if self.escape else " ", []
        for a, b in zip(bounds, bounds[1:]):
            text = raw[a:b].decode(errors="replace")
            if self.dummy and text.startswith(mark):
                text = text[1:]
            out.append(text.replace(SPACE, " ") if self.escape else text)
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """Number of ids of each text; of all of them the ids and their first and last (exclusive) original bytes; what the
        ids decode to."""
        normal = [self.normalize(t) for t in texts]
        names = [self.chunk.findall(n) for n, _ in normal]
        ids, count = self.chunks.gather([c for n in names for c in n])
        of_chunk = np.concatenate([[0], np.cumsum(count)])
        ends = of_chunk[np.cumsum([0, *map(len, names)])]
        width = self.widths(ids)
        starts, stops = [], []
        for (text, origin), first, last in zip(normal, ends, ends[1:]):
            to = np.concatenate([[0], np.cumsum(width[first:last])])
            origin = marked_origin(text, self.dummy) if origin is None else origin
            starts.append(origin[to[:-1]])
            stops.append(origin[to[1:]])
        return np.diff(ends), ids, np.concatenate(starts), np.concatenate(stops), self.decode(ids, np.diff(ends))


def marked_origin(normal: str, dummy: bool) -> np.ndarray:
    """Original byte for each byte of a text, and for its end, in which every mark stands for a space.

    A mark has three bytes for one of the original; a leading one that was added has three for none.
    """
    raw = np.frombuffer(normal.encode(), np.uint8)
    step = np.ones(len(raw), np.int32)
    if len(raw) > 2:
        marks = np.flatnonzero((raw[:-2] == 0xE2) & (raw[1:-1] == 0x96) & (raw[2:] == 0x81))
        step[marks + 1] = step[marks + 2] = 0
        if dummy:
            step[0] = 0
    return np.concatenate([[0], np.cumsum(step)]).astype(np.int32)


@lru_cache(maxsize=4)
def model(path: str) -> Model:
    return Model(path)


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """One row per document: doc_id, ``ids``, and for each id the original UTF-8 bytes ``starts`` to ``stops`` (exclusive).

    ``decoded`` is the text that the ids decode to. The bytes of a character that fell back to byte pieces share its
    span: all but the last are empty spans at its start. A null text counts as empty and has no ids. Every row is
    encoded by itself, so repeated rows and null ids give as many result rows; other columns are ignored, whatever their
    names. An empty table gives no rows; texts of any length are encoded whole. ``model_path`` must exist on every executor.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(model_path)
        for batch in batches:
            at = 0
            for texts in text_groups(batch.column(1)):
                count, *columns, decoded = m.encode(texts)
                offsets = pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(c.astype(np.int32))) for c in columns]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), *lists, pa.array(decoded, pa.string())],
                    names=["doc_id", "ids", "starts", "stops", "decoded"])
                at += len(texts)

    return docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInArrow(run, SCHEMA)


def digest(encoded: DataFrame) -> DataFrame:
    """The contract's columns from ``encode``; ``covered`` is the number of original bytes under the spans."""
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.coalesce(F.try_element_at("stops", F.lit(-1)), F.lit(0)).cast("long").alias("covered"))
