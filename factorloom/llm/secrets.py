"""Secret scans: multipart credential linking.

Strong candidates are reported by themselves. Weak ones (something that only looks like an access identifier, a key or
an endpoint) are reported only where a complementary part stands in the same scope: an identifier needs a secret, a
secret needs an identifier or an endpoint, an endpoint needs either. A scope never crosses documents, so the interval
join is a merge of each text's sorted parts beside the text: no exchange, and no pairs however many parts a scope holds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, whole_text

# fixed values: the strong kinds, in the order in which equal starts are listed
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

# weak kinds: what they look like, and where the part itself stands
IDENTIFIER = re.compile(r"(?<![A-Za-z0-9])(?=[A-Z]*[0-9])(?=[0-9]*[A-Z])[A-Z0-9]{16,32}(?![A-Za-z0-9])")
NAMED_IDENTIFIER = re.compile(
    r"""(?<![A-Za-z])(?:client_?id|access_?key_?id|account_?id|user_?name|login)["']?\x20*[:=]\x20*["']?([\w.@-]{3,})""",
    re.I | re.A)
KEY = re.compile(r"(?<![A-Za-z0-9+/])(?=[A-Za-z+/]*[0-9])(?=[a-z0-9+/]*[A-Z])(?=[A-Z0-9+/]*[a-z])"
                 r"[A-Za-z0-9+/]{20,}={0,2}(?![A-Za-z0-9+/])")
ENDPOINT = re.compile(r"(?:https?|ftp|jdbc:\w+|postgres(?:ql)?|mysql|redis|amqp|mongodb)://[^\s\"'<>]+"
                      r"|(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}:\d{2,5}(?!\d)", re.A)
HOST = re.compile(r"""(?<![A-Za-z])(?:host|endpoint|server)["']?\x20*[:=]\x20*["']?([A-Za-z0-9.-]+)""", re.I | re.A)

KINDS = ("assign", "access", "hex", "identifier", "key", "endpoint")
ROLE = ("secret", "identifier", "secret", "identifier", "secret", "endpoint")
COMPLEMENT = {"identifier": ("secret",), "secret": ("identifier", "endpoint"), "endpoint": ("identifier", "secret")}
REACH = 200


def find_parts(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of every candidate; weak ones that overlap a strong one are left out."""
    found = [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(1, m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(2, m.start(), m.end()) for m in HEX.finditer(text)]
    weak = [(3, m.start(), m.end()) for m in IDENTIFIER.finditer(text)]
    weak += [(3, m.start(1), m.end(1)) for m in NAMED_IDENTIFIER.finditer(text)]
    weak += [(4, m.start(), m.end()) for m in KEY.finditer(text)]
    weak += [(5, m.start(), m.end()) for m in ENDPOINT.finditer(text)]
    weak += [(5, m.start(1), m.end(1)) for m in HOST.finditer(text)]
    if not weak:
        return found
    covered = sorted((s, e) for _, s, e in found)
    last, i, reach = [], 0, -1
    for kind, start, end in sorted(set(weak), key=lambda w: (w[1], -w[2], w[0])):
        while i < len(covered) and covered[i][0] < end:
            reach = max(reach, covered[i][1])
            i += 1
        if start >= reach and (not last or start >= last[-1][2]):
            last.append((kind, start, end))
    return found + last


def link(parts: list[tuple[int, int, int]], reach: int) -> list[int | None]:
    """For each part, sorted by start, the start of the nearest complementary part at most ``reach`` away."""
    best: list[tuple[int, int] | None] = [None] * len(parts)
    ended = {}  # by role, the part that ends last among those that start no later
    for i, (kind, start, stop) in enumerate(parts):
        for other in COMPLEMENT[ROLE[kind]]:
            if other in ended:
                gap = max(0, start - ended[other][0])
                if gap <= reach:
                    best[i] = min(best[i] or (gap, ended[other][1]), (gap, ended[other][1]))
        ended[ROLE[kind]] = max(ended.get(ROLE[kind], (-1, -1)), (stop, start))
    following = {}
    for i in range(len(parts) - 1, -1, -1):
        kind, start, stop = parts[i]
        for other in COMPLEMENT[ROLE[kind]]:
            if other in following:
                gap = max(0, following[other] - stop)
                if gap <= reach:
                    best[i] = min(best[i] or (gap, following[other]), (gap, following[other]))
        following[ROLE[kind]] = start
    return [b and b[1] for b in best]


def spans_of(text: str, reach: int = REACH) -> list[tuple[int, int, int, int | None]]:
    """(kind number, start, stop, start of the linked part) of all that is reported."""
    parts = sorted(find_parts(text), key=lambda p: (p[1], p[0]))
    if not parts:
        return []
    return [(*p, at) for p, at in zip(parts, link(parts, reach)) if p[0] <= 2 or at is not None]


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per document: doc_id and ``spans``, an array of (kind, start, stop, linked) by start, then kind.

    Positions are code points, the end is exclusive. ``linked`` is the start of the nearest complementary part within
    ``reach`` code points, null where a strong candidate stands alone. A null or empty text has no spans. Every row is
    judged by itself, so repeated rows and null ids give as many result rows. Other columns are ignored, whatever their
    names. An empty table gives an empty result.
    """
    @F.pandas_udf("array<struct<kind:string,start:int,stop:int,linked:int>>")
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([[{"kind": KINDS[k], "start": s, "stop": e, "linked": at}
                              for k, s, e, at in spans_of(t, reach)] for t in texts], dtype=object)

    return docs.select("doc_id", spans(whole_text()).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``scan``."""
    def kinds(*names):
        return F.filter("spans", lambda s: s["kind"].isin(*names))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")

    return found.select(
        "doc_id", *[F.size(kinds(k)).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(joined(kinds(*KINDS[:3])), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["linked"].isNotNull())).cast("long").alias("n_linked"))


def redact(docs: DataFrame, reach: int = REACH, mask: str = "[secret]") -> DataFrame:
    """The rows and columns of ``docs`` with every reported span replaced by ``mask``, overlapping ones by one.

    ``n_chars``, if there, is counted anew where the text changed. Texts without a finding stay as they are, a null text
    stays null; all rows are kept.
    """
    def masked(text):
        out, at = [], 0
        for _, start, stop, _ in spans_of(text, reach):
            if start >= at:
                out += [text[at:start], mask]
            at = max(at, stop)
        return "".join(out) + text[at:] if out else None

    @F.pandas_udf("string")
    def change(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([masked(t) for t in texts], dtype=object)

    new = free_name(docs, "new_text_")
    out = docs.withColumn(new, change(whole_text()))
    if "n_chars" in docs.columns:
        count = F.length(new).cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col(new).isNotNull(), count).otherwise(F.col("n_chars")))
    return out.withColumn("text", F.coalesce(new, "text")).drop(new)
