import hashlib
import itertools
import random
import re
import zlib

import pytest

from factorloom.llm import repair as r

from .conftest import SF

PATTERN = re.compile(r"(s?(ua)+)?")


def brute(rows):
    """All edit sequences of little cost, one row after another: the least (cost, audit, repaired rows)."""
    seen, faults = set(), []
    for role, text in rows:
        end = text.strip(" \t\n\x0b\x0c\r")[-1:]
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else "")
        seen.add((role, text))
    paths = [(0, "", ())]
    limit = 3 * len(rows)  # deleting all rows is always possible
    for i in range(len(rows) + 1):
        grown = []
        for cost, audit, done in paths:
            grown.append((cost, audit, done))
            for k in range(1, (limit - cost) // 2 + 1):
                for roles in itertools.product(("user", "assistant"), repeat=k):
                    grown.append((cost + 2 * k, audit + "I" * k, done + tuple((x, "") for x in roles)))
        if i == len(rows):
            paths = grown
            break
        (role, text), fault, paths = rows[i], faults[i], []
        for cost, audit, done in grown:
            some = [(cost + 3, audit + "D", done)]
            if fault not in ("blank", "duplicate"):
                late = fault == "truncated"
                some.append((cost + late, audit + "K", done + ((role, text),)))
                some += [(cost + 2 + late, audit + "R", done + ((x, text),)) for x in ("user", "assistant")]
            # a prefix that no role sequence continues goes
            paths += [p for p in some if p[0] <= limit and re.fullmatch(r"s?(ua)*u?", "".join(x[0][:1] or "?" for x in p[2]))]
    paths = [p for p in paths if PATTERN.fullmatch("".join(x[0][:1] or "?" for x in p[2]))]
    return min(paths, key=lambda p: p[:2]), faults


def want(conv, rows):
    """rows: (turn, role, text) after damage, in order."""
    (cost, audit, done), faults = brute([x[1:] for x in rows])
    turns = [t for t, _, _ in rows if t is not None]
    first = [role[:1] for _, role, _ in rows]
    return (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") or not a or not b for a, b in zip(first, first[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{x}:{y}" for x, y in done).encode()).hexdigest())


def damaged(rows):
    out = []
    for conv, turn, role, text in sorted(rows, key=lambda x: (x[1] is not None, x[1] or 0)):
        conv, role, text = (" " if x is None else x for x in (conv, role, text))
        kind = zlib.crc32(f"{conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_least_audit_against_all_paths(seed):
    rng = random.Random(seed)
    for _ in range(120):
        rows = [(rng.choice(["system", "user", "assistant", "user", "assistant", "tool", ""]), rng.choice(["a.", "b!", "c", " ", "d?", f"{rng.random()}."]))
                for _ in range(rng.randrange(5))]
        (cost, audit, _), faults = brute(rows)
        codes = bytes(3 * {"s": 0, "u": 1, "a": 2}.get(role[:1], 3) + (r.REMOVE if f in ("blank", "duplicate") else f == "truncated" and r.TRUNCATED)
                      for (role, _), f in zip(rows, faults))
        assert r.cheapest(codes) == (cost, audit), rows


def shortest(codes):
    """Least (cost, audit) by passes over all edges, with whole strings."""
    n = len(codes)
    best = {0: (0, "")}
    for _ in range(3 * n + 6):
        for v, (cost, audit) in sorted(best.items()):
            for letter, more, w in r._out(v, codes, n):
                best[w] = min(best.get(w, (10 ** 9, "")), (cost + more, audit + letter))
    return min(best[e] for e in (n * 4, n * 4 + 3) if e in best)


def test_longer_conversations():
    rng = random.Random(9)
    for n in (7, 12, 25, 40):
        for _ in range(12):
            codes = bytes(rng.randrange(12) for _ in range(n))
            assert r.cheapest(codes) == shortest(codes)
    assert r.cheapest(b"") == (0, "")
    alternating = bytes([3, 6] * 20_000)
    assert r.cheapest(alternating) == (0, "K" * 40_000)
    assert r.cheapest(bytes([3 + r.REMOVE]) * 5_000) == (15_000, "D" * 5_000)


def table_rows(df):
    found = {}
    for x in df.collect():
        found.setdefault(x.conv_id, []).append((x.conv_id, x.turn, x.role, x.text))
    return found


def test_whole_table_against_dijkstra_free_model(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    got = {x.conv_id: x for x in r.digest(r.damage(df)).collect()}
    rows = table_rows(df)
    assert set(got) == set(rows)
    assert any(g.cost > 0 for g in got.values()) and any(g.duplicate for g in got.values())
    for conv, some in rows.items():
        left = damaged(some)
        if len(left) <= 5:
            assert tuple(got[conv]) == want(conv, left)


def test_repaired_rows_hash_to_the_digest(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = r.rows_of(df)
    digests = {x.conv_id: x for x in r.digest(rows).collect()}
    out = {}
    for x in sorted(r.repair(df).collect(), key=lambda x: (x.conv_id, x.place)):
        out.setdefault(x.conv_id, []).append(x)
    for conv, d in digests.items():
        some = out.get(conv, [])
        assert [x.place for x in some] == list(range(len(some)))
        assert "".join(x.edit for x in some) == d.audit.replace("D", "")
        assert PATTERN.fullmatch("".join(x.role[0] for x in some))
        assert hashlib.sha256("\n".join(f"{x.role}:{x.text}" for x in some).encode()).hexdigest() == d.repaired_sha256


def test_edges(spark):
    long_ = "word " * 60_000
    rows = [(1, 0, "user", "Hi."), (1, None, "user", "First."), (1, None, "assistant", "Nulls."), (1, 7, None, None), (2, 3, "", "x."),
            (2, 3, "", "x."), (None, 1, "user", long_), (None, 2, "assistant", long_ + "."), (3, None, "user", " \n"), (4, -2 ** 63, "user", "a."), (4, 2 ** 63 - 1, "assistant", "b."), (5, 1, "uSER", "é。")]
    df = spark.createDataFrame([(*x, "q", "w") for x in rows], "conv_id long, turn long, role string, text string, h string, facts string")
    got = {x.conv_id: x for x in r.digest(r.rows_of(df)).collect()}
    assert set(got) == {None, 1, 2, 3, 4, 5}
    for conv in (None, 3, 5):
        plain = [(t, *(" " if v is None else v for v in x)) for c, t, *x in rows if c == conv]
        assert tuple(got[conv]) == want(conv, plain)
    assert (got[2].duplicate, got[2].illegal, got[2].audit, got[2].cost) == (1, 1, "DD", 6)
    assert got[4].gaps is None and got[4].audit == "KK"
    assert got[1].blank == 1 and got[1].gaps == 6
    for conv, some in table_rows(df).items():
        left = damaged([x[:4] for x in some])
        if conv in (None, 3, 5):
            damaged_row = next(x for x in r.digest(r.damage(df)).collect() if x.conv_id == conv)
            assert tuple(damaged_row) == want(conv, left)
    assert r.digest(r.damage(df.where("false"))).count() == 0
    all_gone = r.damage(df.where("conv_id = 1").selectExpr("*")).withColumn("copy", r.F.lit(None).cast("int"))
    gone = r.digest(all_gone).collect()
    assert [tuple(x) for x in gone] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
