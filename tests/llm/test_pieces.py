import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from factorloom.llm import pieces as p

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def same(model, library, texts):
    count, ids, starts, stops, decoded = model.encode(texts)
    at = 0
    for text, n, back in zip(texts, count, decoded):
        want = library.encode(text)
        assert ids[at:at + n].tolist() == want and back == library.decode(want)
        if n:
            assert starts[at] == 0 and stops[at + n - 1] == len(text.encode())
            assert (starts[at + 1:at + n] == stops[at:at + n - 1]).all()
        for i, a, b in zip(want, starts[at:at + n], stops[at:at + n]):
            piece = library.id_to_piece(i)
            if not library.is_byte(i):  # the span holds the piece, but for an added space
                assert text.encode()[a:b].decode().replace(" ", p.SPACE) in (piece, piece[1:])
        at += n


def test_random_texts_equal_the_library(library):
    rng = random.Random(1)
    alphabet = " ▁  \n\tabcdeéßñ漢字😀\x00́<s>0x41.,'\"ÀÉ 　"
    same(p.model(PATH), library, ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(5000)])
    same(p.model(PATH), library, ["", " ", "  ", "▁", "x" * 5000, "😀" * 300])


def test_documents_equal_the_library(documents, rows, library):
    got = p.encode(documents, PATH).orderBy("doc_id").toPandas()
    for row, text in zip(got.itertuples(), rows.text):
        want = library.encode(text)
        assert list(row.ids) == want and row.decoded == library.decode(want)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf"])
def test_compiled_character_maps(rule):
    """The library's own maps: longest match, and the source of every normalised byte."""
    normalizer = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True,
                                                       remove_extra_whitespaces=True)
    spec = dict(p._fields(next(v for k, v in p._fields(normalizer.serialized_model_proto()) if k == 3)))
    model = p.Model.__new__(p.Model)
    model.map, model.dummy, model.trim, model.escape = p.CharMap(spec[2]), True, True, True
    rng = random.Random(7)
    alphabet = "aA ﬁ①ｶﾞ㌔Ǻé　\t​İß漢ｱ½ "
    for _ in range(1500):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25)))
        want, offsets = normalizer.normalize(text, with_offsets=True)
        got, origin = model.normalize(text)
        assert got == want, text
        assert len(origin) == len(got.encode()) + 1 and (origin[1:] >= origin[:-1]).all() and origin[-1] <= len(text.encode())


def test_edges(edge, nothing):
    got = p.digest(p.encode(edge, PATH)).toPandas()
    assert len(got) == edge.count()
    assert got[got.doc_id.isin([3, 4])].n_tokens.tolist() == [0, 0]
    assert p.encode(nothing, PATH).count() == 0


def test_decoding_reads_the_ids():
    m, library = p.model(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = ["Two words", "", " lead", "é漢字🙂 x", "a\u2581b", "tab\tand\nline  two"]
    count, ids, _, _, decoded = m.encode(texts)
    lists = np.split(ids, np.cumsum(count)[:-1])
    assert decoded == [library.decode(x.tolist()) for x in lists]
    wrong = ids.copy()
    wrong[0] = (wrong[0] + 1) % len(m.width)
    assert m.decode(wrong, count)[0] != decoded[0] and m.decode(wrong, count)[1:] == decoded[1:]
    rng = np.random.default_rng(2)
    plain = np.flatnonzero((m.byte < 0) & (m.shown_size > 0))
    for _ in range(30):
        some = rng.choice(plain, 12)
        assert m.decode(some, np.array([12])) == [library.decode(some.tolist())]
