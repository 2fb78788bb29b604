"""Compute many factors over one panel with few exchanges.

A factor is a generator. Each ``yield`` asks for the columns of one step, all of them windows by ticker or all of
them windows by trade date, and gets them back as plain column references; the return value is the factor. Spark
allows no window inside a window, so the steps are the ``withColumn`` calls one would write by hand. Asked for
several factors, ``attach`` adds the steps of the same kind in one go: all ticker windows share one exchange and one
sort, then all day windows share one exchange, and so on, instead of two exchanges per factor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from types import SimpleNamespace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import xs
from ..functions.scalar import significant
from ..functions.ts import Carried, carry

KEYS = ["ticker", "trade_date"]

@dataclass(frozen=True)
class DayRank:
    """The percent rank of a column within its trade date, average rank for ties."""

    x: Column


def rank(x) -> DayRank:
    return DayRank(x)


@dataclass(frozen=True)
class Step:
    key: str
    columns: tuple


def by_ticker(*columns) -> Step:
    return Step("ticker", columns)


def by_date(*columns) -> Step:
    return Step("trade_date", columns)


Factor = Callable[[SimpleNamespace], Iterator[Step]]

INPUTS = dict(
    O="open_price", H="highest_price", L="lowest_price", C="close_price", V="turnover_vol",
    A="turnover_value", W="vwap", P="pre_close_price", CAP="neg_market_value",
    BO="bench_open", BC="bench_close",
)


def inputs() -> SimpleNamespace:
    """Short names for the bar columns, as the published formulas use them."""
    return SimpleNamespace(**{k: F.col(v) for k, v in INPUTS.items()})


def _rank_long(df: DataFrame, operands: dict[str, Column]) -> DataFrame:
    """Add the percent rank of many operands with one sort.

    The frame must be partitioned by trade date. Each row is turned into one narrow row per operand; only the first
    of them carries the other columns. Ranking and regrouping both keep the partitioning, so nothing is shuffled.
    """
    rest = F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in KEYS])
    items = [F.struct(F.lit(i).alias("pos"), significant(x).alias("x"),
                      (rest if i == 0 else F.when(F.lit(False), rest)).alias("rest"))
             for i, x in enumerate(operands.values())]
    w = Window.partitionBy("trade_date", "pos").orderBy(F.col("x").asc_nulls_last())
    first, all_rows = Window.unboundedPreceding, (Window.unboundedPreceding, Window.unboundedFollowing)
    place = (F.rank().over(w) + F.count("x").over(w.rangeBetween(first, Window.currentRow))) / 2
    ranked = (
        df.select(*KEYS, F.inline(F.array(*items)))
        .select(*KEYS, "pos", "rest",
                F.when(F.col("x").isNotNull(), place / F.count("x").over(w.rowsBetween(*all_rows))).alias("r"))
    )
    return (
        ranked.groupBy("trade_date", "ticker")
        .agg(F.first("rest", ignorenulls=True).alias("rest"),
             F.array_sort(F.collect_list(F.struct("pos", "r"))).alias("ranks"))
        .select(*KEYS, "rest.*", *[F.col("ranks")[i]["r"].alias(n) for i, n in enumerate(operands)])
    )


def _add_days(df: DataFrame, columns: dict, several: bool) -> DataFrame:
    """Add the columns of one by-date step. The ranks of several factors are taken in long form: every ranked operand
    would need a sort of its own otherwise."""
    ranks = {n: c.x for n, c in columns.items() if isinstance(c, DayRank)}
    other = {n: c for n, c in columns.items() if n not in ranks}
    if several and ranks:
        return _rank_long((df.withColumns(other) if other else df).repartition("trade_date"), ranks)
    return df.withColumns({**{n: xs.rank_pct(x) for n, x in ranks.items()}, **other})


def _add_tickers(df: DataFrame, columns: dict) -> DataFrame:
    """Add the columns of one by-ticker step, then carry forward those that ask for it."""
    carried = {n: carry(n) for n, c in columns.items() if isinstance(c, Carried)}
    df = df.withColumns({n: c.x if n in carried else c for n, c in columns.items()})
    return df.withColumns(carried) if carried else df


def attach(panel: DataFrame, factors: dict[str, Factor]) -> DataFrame:
    """The panel's key plus one column per factor."""
    b = inputs()
    ready: dict[str, Column] = {}
    running: dict[str, tuple[Iterator, Step]] = {}
    own: dict[str, list[str]] = {name: [] for name in factors}

    def advance(name, gen, value):
        try:
            running[name] = (gen, gen.send(value))
        except StopIteration as end:
            running.pop(name, None)
            ready[name] = end.value

    for name, make in factors.items():
        made = make(b)
        if isinstance(made, Column):
            ready[name] = made
        else:
            advance(name, made, None)

    finished: list[str] = []
    df, serial = panel.select(*KEYS, *[c for c in INPUTS.values() if c in panel.columns]), 0
    base = [c for c in df.columns if c not in KEYS]

    def settle(df):
        """Turn finished factors into one column each and drop what only they needed."""
        if not ready:
            return df
        values = [c.alias(f"={n}") for n, c in ready.items()]
        keep = dict.fromkeys(c for n in running for c in own[n])
        df = df.select(*KEYS, *base, *keep, *[F.col(f"`={n}`") for n in finished], *values)
        finished.extend(ready)
        ready.clear()
        return df

    while running:
        # keep going on one key as long as any factor wants it, then switch: one exchange per switch
        for key in ("ticker", "trade_date"):
            while wanted := {n: r for n, r in running.items() if r[1].key == key}:
                df = settle(df)
                new, given = {}, {}
                for name, (_, step) in wanted.items():
                    names = [f"_{serial + i}" for i in range(len(step.columns))]
                    serial += len(names)
                    new.update(zip(names, step.columns))
                    own[name] += names
                    refs = [F.col(n) for n in names]
                    given[name] = refs[0] if len(refs) == 1 else tuple(refs)
                df = _add_tickers(df, new) if key == "ticker" else _add_days(df, new, len(factors) > 1)
                for name, (gen, _) in wanted.items():
                    advance(name, gen, given[name])
    df = settle(df)
    return df.select(*KEYS, *[F.col(f"`={n}`").alias(n) for n in factors])
