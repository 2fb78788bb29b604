import duckdb

from factorloom.llm import line_dedup


def brute(rows):
    """rows: (id, text). Texts without the lines of later windows."""
    seen, out = set(), []
    for _, text in sorted(rows, key=lambda r: r[0]):
        lines = (text or "").split("\n")
        gone = set()
        for i in range(len(lines) - 2):
            window = tuple(lines[i:i + 3])
            if not "".join(window).strip():
                continue
            if window in seen:
                gone |= {i, i + 1, i + 2}
            seen.add(window)
        out.append("\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


def test_against_brute_force(documents, rows):
    got = line_dedup.remove_repeats(documents).orderBy("doc_id").toPandas()
    assert got.text.tolist() == brute(zip(rows.doc_id, rows.text))
    assert got.n_removed.sum() > 0 and (got.n_chars == got.text.str.len()).all()


def test_against_sql(documents, rows):
    documents = rows  # noqa: F841 - DuckDB reads it by name
    want = duckdb.sql(line_dedup.SQL).df().sort_values("doc_id")
    assert want.text.tolist() == brute(zip(rows.doc_id, rows.text))


def test_overlapping_windows_merge(spark):
    df = spark.createDataFrame([(1, "a\nb\nc\nd\ne"), (2, "x\na\nb\nc\nd\ny"), (3, "a\na\na\na\na")], "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.remove_repeats(df).collect()}
    assert got == {1: ("a\nb\nc\nd\ne", 0), 2: ("x\ny", 4), 3: ("a", 4)}


def test_edges(edge, nothing):
    out = line_dedup.remove_repeats(edge)
    assert out.columns == [*edge.columns, "n_lines_", "n_removed_"] and out.count() == edge.count()
    got = out.toPandas()
    first = got[got.doc_id.isna() & got.text.notna()]
    assert first.n_removed_.tolist() == [0]  # a null id comes first
    assert got[got.doc_id == 1].text.tolist() == [""] and got[got.doc_id == 2].text.tolist() == ["", ""]
    assert got[got.doc_id == 10].n_removed_.tolist() == [0]  # blank windows do not count
    assert line_dedup.remove_repeats(nothing).count() == 0


def test_copies_under_one_id_go(spark):
    text = "a\nb\nc\nd"
    for id_ in (None, 7):
        rows = [(id_, text), (id_, text), (id_, text + "\ne"), (9, "x\n" + text)]
        got = line_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
        assert len(got) == 4 and sum(t.count("a") for t in got.text) == 1
        assert got[got.doc_id == 9].text.tolist() == ["x"]
