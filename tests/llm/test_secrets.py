import re

from factorloom.llm import secrets


def base(text):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(secrets.KINDS[k], a, b) for a, k, b in sorted(found)]


def test_base_spans_stay(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = documents.toPandas()
    found = {r.doc_id: [(s.kind, s.start, s.stop) for s in r.spans] for r in secrets.scan(documents).collect()}
    assert sum(map(len, found.values())) > 0
    for i, text in zip(rows.doc_id, rows.text):
        assert [s for s in found[i] if s[0] in secrets.KINDS[:3]] == base(text)


def kinds(text, reach=secrets.REACH):
    return [secrets.KINDS[k] for k, *_ in secrets.spans_of(text, reach)]


def test_weak_parts_need_a_complement():
    identifier, key, host = "AB12CD34EF56GH78", "aB3dE5fG7hJ9kL1mN3pQ5", "https://db.example.com/x"
    assert kinds(identifier) == kinds(key) == kinds(host) == []
    assert kinds(f"{identifier} and {key}") == ["identifier", "key"]
    assert kinds(f"{host} {key}") == ["endpoint", "key"]
    assert kinds(f"{identifier} {host}") == ["endpoint"]  # the identifier has no secret
    assert kinds(f"{identifier}{' ' * 300}{key}") == []
    assert kinds(f"{identifier}{' ' * 300}{key}", 300) == ["identifier", "key"]
    assert kinds(f"token=abcdef {identifier}") == ["assign", "identifier"]


def test_a_failing_match_uses_its_text():
    assert kinds("token=token:abcdefgh") == []
    assert kinds("ſecret=abcdefgh toKen: 'abcdefgh'") == ["assign"]


def test_links_equal_all_pairs():
    import random

    rng = random.Random(3)
    for _ in range(300):
        parts, at = [], 0
        for _ in range(rng.randint(0, 12)):
            at += rng.randint(0, 30)
            parts.append((rng.randint(0, 5), at, at + rng.randint(1, 20)))
        parts.sort(key=lambda p: (p[1], p[0]))
        got = secrets.link(parts, 25)
        for (kind, a, b), near in zip(parts, got):
            gaps = [max(0, c - b, a - d) for k, c, d in parts if secrets.ROLE[k] in secrets.COMPLEMENT[secrets.ROLE[kind]]]
            assert (near is not None) == (min(gaps, default=99) <= 25)


def test_redaction(edge, nothing):
    out = secrets.redact(edge)
    assert out.columns == edge.columns and out.count() == edge.count()
    for r in out.collect():
        assert r.text is None or "abcdef123" not in r.text
        assert r.n_chars == (None if r.text is None else len(r.text))
    assert secrets.redact(nothing).count() == secrets.scan(nothing).count() == 0
    empty = [r for r in secrets.scan(edge).collect() if r.doc_id in (3, 4)]
    assert [r.spans for r in empty] == [[], []]
    assert secrets.digest(secrets.scan(edge)).count() == edge.count()
