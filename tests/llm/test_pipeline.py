import corpus_pipeline as c
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry
from factorloom.llm import quality
from factorloom.llm.common import stored

from .conftest import SF
from .test_line_dedup import brute
from .test_secrets import base
from .test_simhash import least_ids, slow_fingerprint


def test_stages_against_brute_force(spark, documents):
    docs, columns = documents, documents.columns
    stages = dict(c.STAGES)
    assert list(stages) == ["quality classifier", "line dedup", "SimHash near-dedup", "secret scans", "packing"]

    def step(name):
        nonlocal docs
        before = docs.orderBy("doc_id").toPandas()
        docs = stored(stages[name](spark, docs, SF), "stage")
        return before, docs.orderBy("doc_id").toPandas()

    before, after = step("quality classifier")
    kept = {r.doc_id for r in quality.classify(documents).where("kept").collect()}
    assert list(after.columns) == columns and after.equals(before[before.doc_id.isin(kept)].reset_index(drop=True))
    before, after = step("line dedup")
    assert list(after.columns) == columns and after.text.tolist() == brute(zip(before.doc_id, before.text))
    before, after = step("SimHash near-dedup")
    roots = least_ids(before.doc_id, [slow_fingerprint(t) for t in before.text])
    assert list(after.columns) == columns and after.equals(before[before.doc_id == roots].reset_index(drop=True))
    before, after = step("secret scans")
    assert list(after.columns) == columns and after.doc_id.tolist() == before.doc_id.tolist()
    for old, new in zip(before.text, after.text):
        assert base(new) == [] and (base(old) or old == new)
    before, after = step("packing")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = after.sort_values(["doc_id", "start"]).groupby("doc_id").ids.apply(b"".join)
    assert {i: np.frombuffer(x, "<u4").tolist() for i, x in got.items()} == {
        i: tokenizer.encode(t, add_special_tokens=False).ids + [2] for i, t in zip(before.doc_id, before.text)}


def test_stages_on_edges(spark, edge, nothing):
    for docs in (edge, nothing):
        for name, stage in c.STAGES:
            out = stored(stage(spark, docs, SF), "stage")
            assert name == "packing" or out.columns == docs.columns
            docs = out


def test_registered(spark):
    names = [n for n in entry.queries() if n.startswith("op") and "_" in n]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
