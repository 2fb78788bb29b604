"""Conversation structure repair: the cheapest edits after which roles read (system?) (user assistant)+, or nothing.

A conversation is a lattice of nodes (rows read, role reached). Edits are its edges: Delete and Keep and Rerole read a row,
Insert reads none. Dijkstra runs from both ends; the heaps stop when no path through what is left can be as cheap, so that
all crossings of the least cost are finished, and of these the least audit (the edits' initials) is taken.

From a node no two edges have one letter: a kept row's role and the role that is needed next fix where an edit leads. Hence an audit
names one path, the least audit can be walked from the start letter by letter, and no strings are held or compared.

Rows meet twice, sorted by conversation: first as codes without texts, which gives the audits, then with their texts behind
the audit. Texts stream through; a task holds a byte a row and a hash a row of the conversation that it reads, no more
than the audit that is returned for it asks for.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
OTHER = 3  # the initials s, u, a and all others count as 0, 1, 2 and 3
KEEP_TO = ({0: SYSTEM, 1: USER}, {1: USER}, {2: ASSISTANT}, {1: USER})  # by state: the state after an initial
NEEDED = (USER, USER, ASSISTANT, USER)  # by state: what Rerole and Insert lead to
BEFORE = tuple(tuple(s for s in range(STATES) if NEEDED[s] == t) for t in range(STATES))
KEPT_BEFORE = tuple({i: tuple(s for s in range(STATES) if KEEP_TO[s].get(i) == t) for i in range(4)} for t in range(STATES))
DELETE, INSERT, REROLE, LATE = 3, 2, 2, 1  # costs; LATE: a truncated row that stays
SOUND, REMOVE, TRUNCATED = range(3)
ROLES = {USER: "user", ASSISTANT: "assistant"}
SPACE = " \t\n\x0b\x0c\r"
LEGAL = {(0, 1), (1, 2), (2, 1)}
SHORT = 64  # rows of a conversation whose repair is remembered in a task


def _out(node: int, codes: bytes, n: int):
    """Edges (letter, cost, next node), letters ascending."""
    i, state = divmod(node, STATES)
    if i < n:
        initial, fault = divmod(codes[i], 3)
        yield "D", DELETE, node + STATES
        yield "I", INSERT, node - state + NEEDED[state]
        if fault != REMOVE:
            late = LATE if fault == TRUNCATED else 0
            to = KEEP_TO[state].get(initial)
            if to is not None:
                yield "K", late, (i + 1) * STATES + to
            yield "R", REROLE + late, (i + 1) * STATES + NEEDED[state]
    else:
        yield "I", INSERT, node - state + NEEDED[state]


def _in(node: int, codes: bytes):
    """Edges (letter, cost, node before)."""
    i, state = divmod(node, STATES)
    for s in BEFORE[state]:
        yield "I", INSERT, i * STATES + s
    if i:
        initial, fault = divmod(codes[i - 1], 3)
        yield "D", DELETE, node - STATES
        if fault != REMOVE:
            late = LATE if fault == TRUNCATED else 0
            for s in KEPT_BEFORE[state][initial]:
                yield "K", late, (i - 1) * STATES + s
            for s in BEFORE[state]:
                yield "R", REROLE + late, (i - 1) * STATES + s


def cheapest(codes: bytes) -> tuple[int, str]:
    """Least cost and, of the audits at that cost, the least in ASCII order. A code is 3 * initial + fault."""
    n = len(codes)
    ends = (n * STATES + START, n * STATES + ASSISTANT)
    ahead, parents, passed = {START: 0}, {START: []}, set()
    behind, follow, reached = dict.fromkeys(ends, 0), {}, set()
    best = 0 if START in behind else float("inf")
    forward, reverse = [(0, START)], [(0, 0, e) for e in ends]
    while forward and reverse and forward[0][0] + reverse[0][0] <= best:
        if forward[0][0] <= reverse[0][0]:
            d, node = heapq.heappop(forward)
            if node in passed:
                continue
            passed.add(node)
            for _, cost, to in _out(node, codes, n):
                new, old = d + cost, ahead.get(to)
                if old is None or new < old:
                    ahead[to], parents[to] = new, [node]
                    heapq.heappush(forward, (new, to))
                    if to in behind:
                        best = min(best, new + behind[to])
                elif new == old:
                    parents[to].append(node)
        else:
            # nodes of one cost leave the heap from the end on, so all that a Keep without cost leads to is settled before
            d, _, node = heapq.heappop(reverse)
            if node in reached:
                continue
            reached.add(node)
            for letter, cost, back in _in(node, codes):
                new, old = d + cost, behind.get(back)
                if old is None or new < old:
                    behind[back], follow[back] = new, (letter, node)
                    heapq.heappush(reverse, (new, n - back // STATES, back))
                    if back in ahead:
                        best = min(best, new + ahead[back])
                elif new == old and (back not in follow or letter < follow[back][0]) and back not in ends:
                    follow[back] = letter, node
    reached.update(ends)

    def crosses(d, cost, to):
        return to in reached and d + cost + behind[to] == best

    # forward nodes from which a crossing of the least cost is reached
    good, todo = set(), [v for v in passed if any(crosses(ahead[v], c, w) for _, c, w in _out(v, codes, n))]
    while todo:
        v = todo.pop()
        if v not in good:
            good.add(v)
            todo.extend(parents[v])
    audit, node, last = [], START, n * STATES
    while not (node in reached and ahead[node] + behind[node] == best):
        for letter, cost, to in _out(node, codes, n):
            if crosses(ahead[node], cost, to) or (to in good and ahead[node] + cost == ahead[to]):
                audit.append(letter)
                node = to
                break
    while node not in ends or node < last:
        letter, node = follow[node]
        audit.append(letter)
    return best, "".join(audit)


_remembered = functools.lru_cache(1 << 16)(cheapest)


def _summary(turns: list, codes: bytearray, counts: list) -> dict:
    """What is returned of a conversation without its texts."""
    seen = [t for t in turns if t is not None]
    gaps = seen[-1] - seen[0] + 1 - len(set(seen)) if seen else 0
    cost, audit = (_remembered if len(codes) <= SHORT else cheapest)(bytes(codes))
    initials = [c // 3 for c in codes]
    illegal = sum(pair not in LEGAL for pair in zip(initials, initials[1:]))
    return {"gaps": gaps if gaps < 2 ** 63 else None, "blank": counts[0], "duplicate": counts[1], "truncated": counts[2],
            "illegal": illegal, "cost": cost, "audit": audit}


FACTS = pa.schema([(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
                  + [("audit", pa.string())])
FACTS_SQL = ", ".join(f"{f.name} {'string' if f.name == 'audit' else 'long'}" for f in FACTS)


def _audits(id_type):
    schema = FACTS.insert(0, pa.field("conv_id", id_type))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, conv, first = [], None, True
        turns, codes, counts, seen = [], bytearray(), [0, 0, 0], set()
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "fault", "h")]
            for conv_id, turn, initial, fault, h in zip(*columns):
                if first or conv_id != conv:
                    if not first:
                        out.append({"conv_id": conv, **_summary(turns, codes, counts)})
                    conv, first = conv_id, False
                    turns, codes, counts, seen = [], bytearray(), [0, 0, 0], set()
                if initial is None:  # a row that is gone
                    continue
                if fault == REMOVE:
                    counts[0] += 1
                elif h in seen:
                    fault = REMOVE
                    counts[1] += 1
                elif fault == TRUNCATED:
                    counts[2] += 1
                seen.add(h)
                if turn is None or not turns or turns[-1] != turn:
                    turns.append(turn)
                codes.append(3 * initial + fault)
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
        if not first:
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, **_summary(turns, codes, counts)}], schema)

    return run


def _edited(batches: Iterator[pa.RecordBatch]):
    """Events of sorted rows, each conversation's audit before its rows: (batch ends,), (id, facts) and (edit, role, text)."""
    letters, state = iter(()), START

    def inserts():
        nonlocal state
        for letter in letters:
            if letter != "I":
                return letter
            state = NEEDED[state]
            held.append(("I", ROLES[state], ""))
        return None

    held, names = [], FACTS.names
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "facts", "role", "text", "initial")]
        for conv_id, facts, role, text, initial in zip(*columns):
            if facts is not None:
                inserts()
                yield from held
                held.clear()
                letters, state = iter(facts["audit"]), START
                yield conv_id, {c: facts[c] for c in names}
                continue
            letter = inserts()
            yield from held
            held.clear()
            if letter == "K":
                state = KEEP_TO[state][initial]
            elif letter == "R":
                state = NEEDED[state]
                role = ROLES[state]
            yield letter, role, text
        yield ()
    inserts()
    yield from held


def _digests(id_type):
    schema = FACTS.insert(0, pa.field("conv_id", id_type)).append(pa.field("repaired_sha256", pa.string()))

    def run(batches):
        out, now, text, any_row = [], None, None, False
        for event in _edited(batches):
            if len(event) == 3:
                if event[0] != "D":
                    text.update(b"\n" * any_row + f"{event[1]}:{event[2]}".encode())
                    any_row = True
            elif event:
                if now is not None:
                    out.append({**now, "repaired_sha256": text.hexdigest()})
                now, text, any_row = {"conv_id": event[0], **event[1]}, hashlib.sha256(), False
            else:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if now is not None:
            yield pa.RecordBatch.from_pylist([{**now, "repaired_sha256": text.hexdigest()}], schema)

    return run


def _rows(id_type):
    schema = pa.schema([("conv_id", id_type), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()),
                        ("text", pa.string())])

    def run(batches):
        out, conv, place = [], None, 0
        for event in _edited(batches):
            if len(event) == 3:
                if event[0] != "D":
                    out.append({"conv_id": conv, "place": place, "edit": event[0], "role": event[1], "text": event[2]})
                    place += 1
            elif event:
                conv, place = event[0], 0
            else:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _plain(column):
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def rows_of(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` as :func:`audits` takes them; a null role or text is one space."""
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), _plain("role").alias("role"),
                                _plain("text").alias("text"), F.lit(0).alias("copy"))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by the checksum of ``conv_id:turn`` modulo 20 (nulls: one space), as :func:`audits` takes them. Dropped rows stay with
    a null ``copy``, so that no conversation is lost."""
    kind = F.crc32(F.concat(_plain("conv_id"), F.lit(":"), _plain("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(_plain("text"), ".!?", "")).otherwise(_plain("text"))
    copies = F.when(kind == 0, F.array(F.lit(None).cast("int"))).when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0)))
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"),
                                F.when(kind == 4, "user").otherwise(_plain("role")).alias("role"), text.alias("text"),
                                F.explode(copies).alias("copy"))


ORDER = ["turn", "role", "h", "copy"]


def _coded(rows: DataFrame) -> DataFrame:
    """Rows with ``initial`` (null for a dropped row), ``fault`` so far as the row alone shows it, and a hash of role and text."""
    end = F.rtrim(F.col("text"), F.lit(SPACE))
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(OTHER)
    fault = F.when(end == "", REMOVE).when(F.right(end, F.lit(1)).isin(".", "!", "?"), SOUND).otherwise(TRUNCATED)
    return rows.select("*", F.when(F.col("copy").isNotNull(), initial).alias("initial"), fault.alias("fault"),
                       F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))).alias("h"))


def _id_type(rows):
    from pyspark.sql.pandas.types import to_arrow_type

    kind = rows.schema["conv_id"].dataType
    return to_arrow_type(kind), f"conv_id {kind.simpleString()}"


def audits(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, copy): gaps, faults, cost and audit.

    Rows are read by turn, nulls first; rows of one turn by role and by a hash of role and text, so that repeats are
    adjacent. Null ids are one conversation. A row with a null ``copy`` is gone, but its conversation is returned. Blank
    is a text without a visible character, however long; a role that is empty or starts with none of s, u, a cannot be kept.
    ``gaps`` is null where it exceeds a long. An empty table gives no rows.
    """
    arrow, sql = _id_type(rows)
    codes = _coded(rows).select("conv_id", *ORDER, "initial", "fault")
    return codes.repartition("conv_id").sortWithinPartitions("conv_id", *ORDER).mapInArrow(_audits(arrow), f"{sql}, {FACTS_SQL}")


def _with_audits(rows: DataFrame) -> DataFrame:
    facts = audits(rows)
    coded = _coded(rows).where("copy is not null")
    heads = facts.select("conv_id", F.struct(*FACTS.names).alias("facts"))
    both = coded.withColumn("head", F.lit(1)).unionByName(heads.withColumn("head", F.lit(0)), allowMissingColumns=True)
    return (both.repartition("conv_id").sortWithinPartitions("conv_id", "head", *ORDER)
            .select("conv_id", "facts", "role", "text", "initial"))


def digest(rows: DataFrame) -> DataFrame:
    """:func:`audits` with ``repaired_sha256``, the hash of the repaired rows as ``role:text`` joined by newlines. A
    conversation without rows has zeros, an empty audit and the hash of an empty string."""
    arrow, sql = _id_type(rows)
    return _with_audits(rows).mapInArrow(_digests(arrow), f"{sql}, {FACTS_SQL}, repaired_sha256 string")


def repair(conversations: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, ``place`` from 0, ``edit`` (K, R or I), role and text. Other columns are left out."""
    rows = rows_of(conversations)
    arrow, sql = _id_type(rows)
    return _with_audits(rows).mapInArrow(_rows(arrow), f"{sql}, place long, edit string, role string, text string")
