import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from factorloom.llm import packing as p

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check(pieces, ids, window=p.WINDOW):
    """Every id lies in one piece; sequences are gapless, within the window and in order."""
    for doc, group in pieces.groupby("doc_id"):
        at = 0
        for x in group.sort_values("start").itertuples():
            part = np.array(ids[doc][x.start:x.start + x.length], "<u4").tobytes()
            assert (x.start, x.doc_tokens, x.ids_crc32) == (at, len(ids[doc]), zlib.crc32(part))
            at += x.length
        assert at == len(ids[doc])
    for _, group in pieces.groupby("sequence_id"):
        group = group.sort_values("offset")
        assert group.offset.tolist() == [0, *group.length.cumsum().tolist()[:-1]]
        assert group.length.sum() == group.sequence_length.iloc[0] <= window
        assert group.doc_id.is_monotonic_increasing


def test_pieces_on_documents(documents, rows, tokenizer):
    ids = {i: tokenizer.encode(t, add_special_tokens=False).ids + [2] for i, t in zip(rows.doc_id, rows.text)}
    got = p.pack(documents.coalesce(1).orderBy("doc_id"), PATH).toPandas()
    check(got, ids)
    assert all(np.frombuffer(x.ids, "<u4").tolist() == ids[x.doc_id][x.start:x.start + x.length] for x in got.itertuples())
    lengths = got.groupby("sequence_id").length.sum()
    padding = sum(0 if n & (n - 1) == 0 else p.WINDOW - n for n in lengths)
    assert padding < 0.02 * lengths.sum()


def test_streams_continue_between_plans(documents, rows, tokenizer):
    ids = {i: tokenizer.encode(t, add_special_tokens=False).ids + [2] for i, t in zip(rows.doc_id, rows.text)}
    got = p.pack(documents.repartition(3, "doc_id").sortWithinPartitions("doc_id"), PATH, window=64, with_ids=False).toPandas()
    check(got, ids, 64)
    assert got.ids.isna().all()


def test_plan_is_the_least_cost():
    rng = random.Random(4)
    for _ in range(200):
        cuts = np.array(sorted({0, *rng.sample(range(1, 60), rng.randint(1, 14))}))
        cuts = np.unique(np.concatenate([cuts, np.arange(0, cuts[-1], 8)]))
        fines = np.array([0, *[rng.choice([0, 3, 9]) for _ in cuts[1:]]])

        def padding(n):
            return 0 if n & (n - 1) == 0 else 16 - n

        best = [0] + [None] * (len(cuts) - 1)
        for j in range(1, len(cuts)):
            best[j] = min(best[i] + padding(cuts[j] - cuts[i]) for i in range(j) if cuts[j] - cuts[i] <= 16) + fines[j]
        chosen = p.plan(cuts, fines, 16)
        widths = np.diff(cuts[chosen])
        assert widths.max() <= 16 and chosen[0] == 0 and chosen[-1] == len(cuts) - 1
        assert sum(map(padding, widths)) + fines[chosen[1:]].sum() == best[-1]


def test_chunk_ids_equal_the_library(tokenizer):
    rng = random.Random(2)
    alphabet = " \t\n\x1c\x85 　abÉßſK'sdtTHE.,!%9١漢😀éİΣ<|endoftext|>"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    texts += ["it's WE'LL x<|endoftext|>y <|endoftext|> ÉTÉ. ##", ""]
    ids, count = p.Words(PATH).encode(texts)
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert count.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]


def test_python_meets_a_chunk_once_a_group(tokenizer):
    """A group's words are split and told apart by Arrow: one look-up a distinct word, the library's ids all the same."""
    texts = ["The cat, the CAT\x1c sat.\u3000It's 12 cats!! ", "", "  the\n\tcat sat. \u00e9\u0301t\u00e9", "no,no $%x\u0085"] * 250
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    w = p.Words(PATH)
    asked = []

    class Counted(dict):
        def get(self, chunk, default):
            asked.append(chunk)
            return super().get(chunk, default)

    for each in vars(w).values():
        if isinstance(each, p.ChunkTable):
            each.slots = Counted()
    groups = list(p.cut_batch(batch, 0, 12_000))
    assert len(groups) > 1 and sum(g.num_rows for g in groups) == len(texts)
    got = [w.encode(g.column(0)) for g in groups]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert np.concatenate([count for _, count in got]).tolist() == list(map(len, want))
    assert np.concatenate([ids for ids, _ in got]).tolist() == [i for x in want for i in x]
    assert len(asked) < 30 * len(groups) < len(texts)


def test_edges(edge, nothing):
    got = p.pack(edge, PATH, with_ids=False).toPandas()
    assert got.groupby("sequence_id").length.sum().max() <= p.WINDOW
    assert got[got.start == 0].shape[0] == edge.count()  # every row has a first piece
    assert got[got.doc_id == 4][["length", "doc_tokens"]].values.tolist() == [[1, 1]]
    assert p.pack(nothing, PATH).count() == 0
