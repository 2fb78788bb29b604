import random

import pytest

SF = "/root/testdata/sf0.001"
EXTRA = ["spans", "row", "fp", "n_lines", "n_removed", "body_", "lines_", "kept_", "places_", "id_", "score_", "entities",
         "out_", "known_", "new_text_", "kept_id_", "kept_rank_", "sketch", "block", "words", "h", "ids", "component_id"]


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="session")
def rows(documents):
    return documents.orderBy("doc_id").toPandas()


@pytest.fixture(scope="session")
def edge(spark):
    """Null ids and texts, empty and blank texts, repeated rows, ties, a very long text, columns with clashing names."""
    rng = random.Random(5)
    words = ["alpha", "Beta", "the", "of", "and", "gamma.", "delta,", "ÉTÉ", "漢字", "token=abcdef123"]
    long_ = "\n".join(" ".join(rng.choice(words) for _ in range(12)) for _ in range(4000))
    some = "One two three four five six.\nSeven eight nine ten.\nEleven twelve thirteen.\nFourteen fifteen."
    texts = [(1, some), (2, some), (2, some), (None, some), (3, None), (4, ""), (5, " \n\t\n  \n"), (6, long_),
             (None, None), (7, "x"), (8, some + " more"), (9, "a\n\n\n\n\n\nb"), (10, "\n\n\n")]
    extra = ", ".join(f"{c} string" for c in EXTRA)
    return spark.createDataFrame(
        [(i, t, None, "s", None if t is None else len(t), *[c for c in EXTRA]) for i, t in texts],
        f"doc_id long, text string, lang string, source string, n_chars long, {extra}").cache()


@pytest.fixture(scope="session")
def nothing(edge):
    return edge.where("false")


def components(n, pairs):
    """Least number that each of n reaches through pairs."""
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]
