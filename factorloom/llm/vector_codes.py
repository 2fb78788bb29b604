"""Vector code compression: product codes of integer vectors, nearest entries found through Walsh-Hadamard transforms.

Components become floor(1024 x). A part and the entries of its codebook are padded with zeros to p = 2^k places and transformed by
sums and differences alone. The transform scales squared distances by p, so squared differences of coefficients, summed
in sequency order (smooth rows first), are lower bounds of p times the distance that end in its exact value. Entries whose
sum exceeds the full sum of the entry that led after the first coefficients are dropped on the way. No floating point is
involved after the components' floors; numbers too large for 64 bits are carried as Python integers.

Every round is one pass over the vectors: a task sums its parts by entry, Spark adds these sums, and the driver holds the
codebooks alone (256 entries, whatever the table). Codes and errors of the last pass are written, summed by label and joined.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
BLOCK = 512  # vectors compared with all entries at a time
STEP = 4  # coefficients between two eliminations
LIMB = 32  # bits


def walsh(x: np.ndarray) -> np.ndarray:
    """The transform along the last axis, whose length is a power of two; coefficients in sequency order."""
    p = x.shape[-1]
    x, half = x.copy(), 1
    while half < p:
        pairs = x.reshape(*x.shape[:-1], p // (2 * half), 2, half)
        x = np.stack([pairs[..., 0, :] + pairs[..., 1, :], pairs[..., 0, :] - pairs[..., 1, :]], -2).reshape(x.shape)
        half *= 2
    return x[..., sequency(p)]


def sequency(p: int) -> list[int]:
    """Rows of the transform by their number of sign changes: bits of the Gray code of that number, reversed."""
    bits = p.bit_length() - 1
    return [int(f"{s ^ s >> 1:b}".zfill(bits)[::-1], 2) if bits else 0 for s in range(p)]


def padded(x: np.ndarray) -> np.ndarray:
    """Zeros up to a power of two along the last axis, which then has one place at least."""
    p = 1 << max(0, x.shape[-1] - 1).bit_length()
    return np.concatenate([x, np.zeros((*x.shape[:-1], p - x.shape[-1]), x.dtype)], -1)


def integers(flat: np.ndarray, length: int) -> np.ndarray:
    """floor(1024 x) of finite numbers: 64-bit where any squared distance over ``length`` places stays exact, else of Python."""
    p = 1 << max(0, length - 1).bit_length()
    top = float(np.abs(flat).max()) * SCALE + 1 if flat.size else 0.0
    if 4 * p ** 3 * top * top < 2.0 ** 61:
        return np.floor(flat.astype(np.float64) * SCALE).astype(np.int64)
    return np.array([math.floor(x * SCALE) if abs(x) < 2.0 ** 53 else int(x) * SCALE for x in flat.tolist()], object)


def parts_of(flat: np.ndarray, rows: int) -> np.ndarray:
    """(rows, 4, length) integers; vectors whose length is no multiple of four end in zeros."""
    width = len(flat) // rows if rows else 0
    length = -(-width // PARTS)
    x = integers(flat, length).reshape(rows, width)
    x = np.concatenate([x, np.zeros((rows, PARTS * length - width), x.dtype)], 1)
    return x.reshape(rows, PARTS, length)


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (ties: the least) and squared distance, of transformed rows and entries."""
    n, p = x.shape
    index, error = np.empty(n, np.int64), np.empty(n, x.dtype)
    columns = entries.T.copy()
    for at in range(0, n, BLOCK):
        some = x[at:at + BLOCK]
        sums = np.zeros((len(some), len(entries)), x.dtype)
        for c in range(min(STEP, p)):
            sums += (some[:, c, None] - columns[c]) ** 2
        lead = sums.argmin(1)
        bound = ((some - entries[lead]) ** 2).sum(1)
        row, entry = np.nonzero(sums <= bound[:, None])
        sums = sums[row, entry]
        for c in range(STEP, p):
            sums = sums + (some[row, c] - columns[c][entry]) ** 2
            if c % STEP == STEP - 1:
                left = np.flatnonzero(sums <= bound[row])
                row, entry, sums = row[left], entry[left], sums[left]
        # the leading entry of a row is never dropped, so each row has a run of pairs, entries ascending
        starts = np.flatnonzero(np.diff(row, prepend=-1))
        least = np.minimum.reduceat(sums, starts)
        best = np.flatnonzero(sums == least[row])
        _, first = np.unique(row[best], return_index=True)
        index[at:at + BLOCK] = entry[best[first]]
        error[at:at + BLOCK] = least // p
    return index, error


def _assign(batch: pa.RecordBatch, codebooks: np.ndarray, width: int):
    flat = batch.column("embedding").flatten().to_numpy(zero_copy_only=False)
    x = parts_of(flat[:batch.num_rows * width], batch.num_rows)
    # a batch and the codebooks are of one kind, the wider one
    y = codebooks.astype(object) if x.dtype == object else codebooks
    x = x.astype(object) if y.dtype == object else x
    found = [nearest(walsh(padded(x[:, k])), walsh(padded(y[k]))) for k in range(PARTS)]
    return x, [i for i, _ in found], [e for _, e in found]


def _limbs(total: int):
    place = 0
    while not -2 ** 62 <= total < 2 ** 62:
        yield place, total & (1 << LIMB) - 1
        total, place = total >> LIMB, place + 1
    yield place, total


SUMS = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("place", pa.int32()), ("limb", pa.int32()), ("total", pa.int64())])


def _sums(codebooks, width):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(codebooks.shape, object)
        counts = np.zeros(codebooks.shape[:2], np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, index, _ = _assign(batch, codebooks, width)
            for k, chosen in enumerate(index):
                order = chosen.argsort(kind="stable")
                starts = np.flatnonzero(np.diff(chosen[order], prepend=-1))
                used = chosen[order][starts]
                totals[k, used] += np.add.reduceat(x[order, k], starts, axis=0)
                counts[k] += np.bincount(chosen, minlength=codebooks.shape[1])
        rows = []
        for k, entry in zip(*np.nonzero(counts)):
            rows.append((k, entry, -1, 0, counts[k, entry]))
            rows += [(k, entry, place, *limb) for place, t in enumerate(totals[k, entry]) for limb in _limbs(int(t))]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([int(v) for v in c], f.type) for c, f in zip(zip(*rows), SUMS)], schema=SUMS)

    return run


def _long(x: int) -> int | None:
    return int(x) if x < 2 ** 63 else None


def _codes(codebooks, width, schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, error = [], []
            if batch.num_rows:
                _, index, errors = _assign(batch, codebooks, width)
                code = [bytes(row).hex() for row in np.stack(index, 1).astype(np.uint8)]
                error = [_long(e) for e in sum(e.astype(object) for e in errors)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(code, pa.string()),
                                              pa.array(error, pa.int64())], schema=schema)

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """Rows whose vector is not null and holds finite numbers alone."""
    ok = F.forall("embedding", lambda v: v.isNotNull() & (F.abs(v.cast("double")) < float("inf")))
    return vectors.where(F.coalesce(ok, F.lit(False))).select("vec_id", "label", "embedding")


def fit(vectors: DataFrame) -> tuple[np.ndarray, int]:
    """Codebooks (4, entries, length) of ``vectors`` and the width that they hold for, the most frequent one (ties: the longest)."""
    common = vectors.groupBy(F.size("embedding").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if common is None:
        return np.zeros((PARTS, 0, 0), np.int64), 0
    width = common["width"]
    kept = vectors.where(F.size("embedding") == width)
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(ENTRIES).select("embedding").collect()
    flat = np.array([v for row in first for v in row["embedding"]], np.float64)
    codebooks = parts_of(flat, len(first)).transpose(1, 0, 2)
    for _ in range(ROUNDS):
        found = (kept.mapInArrow(_sums(codebooks, width), "part int, entry int, place int, limb int, total long")
                 .groupBy("part", "entry", "place", "limb").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect())
        totals, counts = {}, {}
        for r in found:  # as many rows as the codebooks have numbers
            if r.place < 0:
                counts[r.part, r.entry] = int(r.total)
            else:
                at = r.part, r.entry, r.place
                totals[at] = totals.get(at, 0) + (int(r.total) << LIMB * r.limb)
        renewed = codebooks.astype(object)
        for (k, entry, place), total in totals.items():
            renewed[k, entry, place] = total // counts[k, entry]
        codebooks = renewed if codebooks.dtype == object else renewed.astype(np.int64)
    return codebooks, width


def codebooks_text(codebooks: np.ndarray) -> str:
    return ",".join(str(int(v)) for v in codebooks.reshape(-1))


def compress(vectors: DataFrame) -> DataFrame:
    """One row per usable vector: vec_id, ``code`` (two hex digits a part), ``error``, ``label_error`` and ``codebooks_sha256``.

    A vector is usable if it is not null, holds finite numbers alone and has the table's most frequent length. The codebooks
    start from the 256 least ids (null ids last, repeated ids by their vectors; fewer rows: fewer entries). ``label_error`` sums the
    errors of equal labels, nulls together. An error or sum beyond a long is null, and such a sum too. Repeated rows count
    each. An empty table gives no rows; other columns are ignored, whatever their names.
    """
    kept = usable(vectors)
    codebooks, width = fit(kept)
    kept = kept.where(F.size("embedding") == width)
    from pyspark.sql.pandas.types import to_arrow_schema

    ids = kept.select("vec_id", "label").schema
    schema = pa.schema([*to_arrow_schema(ids), pa.field("code", pa.string()), pa.field("error", pa.int64())])
    sql = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ids)
    coded = stored(kept.mapInArrow(_codes(codebooks, width, schema), f"{sql}, code string, error long"), "codes")
    # a label's sum is one row, so that a label of any size is met by a broadcast or, with many labels, in a splittable join
    sums = coded.groupBy(F.col("label").alias("of")).agg(
        F.when(F.count_if(F.col("error").isNull()) == 0, F.expr("try_cast(sum(cast(error as decimal(38,0))) as bigint)")).alias("label_error"))
    sha = hashlib.sha256(codebooks_text(codebooks).encode()).hexdigest()
    return coded.join(sums, coded["label"].eqNullSafe(sums["of"])).select(
        "vec_id", "code", "error", "label_error", F.lit(sha).alias("codebooks_sha256"))


def _sql() -> str:
    steps = ["""kept as materialized (select row_number() over (order by vec_id nulls last, embedding) as r, vec_id, label, embedding
  from embeddings where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
places as (select r, embedding, len(embedding) // 4 as length, unnest(range(len(embedding))) as i from kept),
v as materialized (select r, i // length as part, i % length as place, floor(1024 * cast(embedding[i + 1] as double))::bigint as x
  from places),
c0 as materialized (select part, place, r - 1 as entry, x as c from v where r <= 256)"""]
    for i in range(ROUNDS + 1):
        steps.append(f"""d{i} as (select r, part, entry, sum((x - c) * (x - c))::bigint as d from v join c{i} using (part, place) group by all),
n{i} as materialized (select r, part, arg_min(entry, row(d, entry)) as entry, min(d) as d from d{i} group by all)""")
        if i < ROUNDS:
            steps.append(f"""s{i} as (select part, entry, place, sum(x)::bigint as s, count(*) as n from n{i} join v using (r, part) group by all),
c{i + 1} as materialized (select part, place, entry, case when n is null then c else (s - ((s % n) + n) % n) // n end as c
  from c{i} left join s{i} using (part, place, entry))""")
    return "with " + ",\n".join(steps) + f"""
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
  (select sha256(string_agg(c::varchar, ',' order by part, entry, place)) from c{ROUNDS}) as codebooks_sha256
from (select r, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' order by part) as code, sum(d)::bigint as error
  from n{ROUNDS} group by r) join kept using (r)"""


SQL = _sql()
