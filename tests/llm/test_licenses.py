import random
from fractions import Fraction

import pytest

from factorloom.llm import licenses as x


def brute(words, templates, containment):
    """All blocks of all sizes against all templates."""
    out = []
    for number, (_, text) in enumerate(templates):
        t = x.words_of(text)
        size, distinct = x.size_class(len(t)), set(t)
        for at in range(0, max(1, len(words)), size):
            common = len(distinct & set(words[at:at + 2 * size]))
            if common and Fraction(common, len(distinct)) >= containment:
                out.append((number, at, min(len(words), at + 2 * size), common))
    return sorted(out)


@pytest.mark.parametrize("containment", [Fraction(8, 10), Fraction(1, 2), Fraction(1), Fraction(1, 10)])
def test_every_block_is_found(containment):
    rng = random.Random(3)
    for _ in range(150):
        words = [f"w{i}" for i in range(12)]
        templates = [("l", " ".join(rng.choices(words, k=rng.randrange(1, 14)))) for _ in range(6)]
        counts = {w: rng.randrange(5) for w in words}
        index = x.Index(templates, counts, containment)
        text = rng.choices(words + ["other", "more"], weights=[1] * 12 + [8, 8], k=rng.randrange(90))
        assert sorted(index.matches(text)) == brute(text, templates, containment)


def test_scan_of_the_table(spark, documents):
    counts = x.word_counts(documents, x.TEMPLATES)
    rows = {r.doc_id: r for r in x.scan(documents).collect()}
    everything = [w for r in rows.values() for w in x.words_of(r.text or "")]
    assert all(counts.get(w, 0) == everything.count(w) for w in {"license", "the", "mit", "gnu"})
    found = 0
    for r in rows.values():
        words = x.words_of(r.text or "")
        blocks = brute(words, x.TEMPLATES, x.CONTAINMENT)
        assert sorted((b.template, b.first_word, b.end_word) for b in r.licenses.blocks) == [b[:3] for b in blocks]
        found += len(blocks)
        starts = [(i, label) for label, p in x.PHRASES for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
        assert r.licenses.n_base == len(starts) and r.licenses.base_labels == sorted({label for _, label in starts})
        assert (r.licenses.first_word, r.licenses.last_word) == ((min(starts)[0], max(starts)[0]) if starts else (None, None))
    assert found


def test_words_and_notices(spark):
    texts = ["Under THE MIT-license, under the mit LICENSE", "licensed under the Apache\nLicense, version 2.0!", "CC-BY-NC 4.0", "mit license under the",
             "Permission is hereby granted, free of charge, to any person obtaining this software and associated documentation files"
             " (the Software) to deal in the Software without any restriction", "İ under the mit licenses", "", None,
             "word " * 70_000 + "Released under the MIT License." + " word" * 70_000]
    df = spark.createDataFrame([(i, t, "q", "w") for i, t in enumerate(texts)], "doc_id long, text string, licenses string, blocks string")
    got = {r.doc_id: r for r in x.digest(df).collect()}
    assert (got[0].n_words, got[0].n_base, got[0].first_word, got[0].last_word, got[0].base_labels) == (8, 2, 0, 4, "mit")
    assert got[1].base_labels == "apache-2" and got[1].labels == "apache-2" and got[1].score == 1
    assert got[2].base_labels == "cc-by-nc" and got[2].n_words == 5
    assert got[3].n_base == 0 and got[3].labels == "mit" and got[3].first_word is None  # all words of a block, in another order
    assert got[4].base_labels == "" and got[4].labels == "mit" and 0.8 <= got[4].score < 1
    assert got[5].n_base == 0 and got[5].n_words == 5 and got[5].labels == ""  # 'İ' is a word of its own, 'licenses' another word
    assert tuple(got[6])[1:] == tuple(got[7])[1:] == (0, 0, None, None, "", "", 0.0, 0)
    assert got[8].n_base == 1 and got[8].first_word == 70_001
    assert "licenses_" in x.scan(df).columns and x.scan(df).count() == len(texts)


def test_edges(edge, nothing):
    assert x.digest(edge).count() == edge.count() and x.scan(nothing).count() == 0
    copies = [tuple(r) for r in x.digest(edge).where("doc_id = 2").collect()]
    assert len(copies) == 2 and copies[0] == copies[1]
