"""Run registered queries on Spark and their SQL on DuckDB, and compare all rows.

    python tests/compare.py [--sf 0.01] [name or prefix ...]
"""

from __future__ import annotations

import collections
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def session(cpus="8"):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("factorloom-check")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def compare(df, con, sql):
    """Empty string if both sides hold the same rows, else what differs."""
    cols = sorted(df.columns)
    got = [tuple(norm(r[c]) for c in cols) for r in df.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != cols:
        return f"columns {cols} / {sorted(names)}", len(got), 0
    idx = [names.index(c) for c in cols]
    want = [tuple(norm(r[i]) for i in idx) for r in cur.fetchall()]
    a, b = collections.Counter(got), collections.Counter(want)
    values = [i for i, c in enumerate(cols) if c not in ("ticker", "trade_date")]
    filled = sum(1 for r in got if any(r[i] is not None for i in values))
    if a == b:
        kinds = {(type(x), type(y)) for g, w in zip(sorted(got, key=repr)[:200], sorted(want, key=repr)[:200])
                 for x, y in zip(g, w) if type(x) is not type(y)}
        return (f"types {kinds}" if kinds else ""), len(got), filled
    only_a, only_b = list((a - b).items()), list((b - a).items())
    first = [sorted((k for k, _ in s), key=repr)[:3] for s in (only_a, only_b)]
    return (f"rows {len(got)}/{len(want)} differing {sum(n for _, n in only_a)}/{sum(n for _, n in only_b)}"
            f"\n   spark {first[0]}\n   sql   {first[1]}"), len(got), filled


def main(argv):
    import __spark_entry__ as entry

    sf = "0.01"
    if argv[:1] == ["--sf"]:
        sf, argv = argv[1], argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = session(), duck(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, q in queries.items():
        if argv and not any(name == a or (a.startswith("-") and name != a[1:]) or (a.endswith("*") and name.startswith(a[:-1])) for a in argv):
            continue
        t0 = t1 = t2 = time.time()
        try:
            if name in oracle:
                df = q(spark, sf_dir)
                t1 = time.time()
                df.collect()
                t2 = time.time()
                diff, n, filled = compare(df, con, oracle[name])
                filled_note = f"{filled}/{n}"
            else:
                diff, filled_note = "", f"{q(spark, sf_dir).count()} rows, no SQL"
        except Exception as e:  # keep going, report at the end
            diff, filled_note = f"{type(e).__name__} {str(e)[:600]}", ""
        bad += bool(diff)
        print(f"{'BAD ' if diff else 'ok  '}{name} build {t1 - t0:.1f} run {t2 - t1:.1f} all {time.time() - t0:.1f} {filled_note} {diff}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
