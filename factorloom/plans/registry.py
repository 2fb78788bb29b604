"""All registered queries and the SQL texts that check them."""

from __future__ import annotations

from . import factors, files, metrics, portfolio, primitives, relational, universe

MODULES = (relational, files, primitives, metrics, portfolio, factors, universe)


def queries():
    return {name: fn for m in MODULES for name, fn in m.QUERIES.items()}


def oracle_sql():
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
