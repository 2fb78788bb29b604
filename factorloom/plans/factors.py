"""Factor queries: one per factor, and one per whole collection."""

from __future__ import annotations

from functools import partial

from ..factors import alpha101, gtja191
from ..factors.staging import attach
from ..sources.driver_tables import factor_panel
from . import alpha101_sql, gtja191_sql
from .common import tidy
from .sql import factor_sql


def _run(factors, spark, sf_dir):
    return tidy(attach(factor_panel(spark, sf_dir), factors))


SETS = {
    "f0_alpha101": (alpha101.FACTORS, alpha101_sql.FORMULAS),
    "g0_gtja191": (gtja191.FACTORS, gtja191_sql.FORMULAS),
}

QUERIES, ORACLES = {}, {}
for _name, (_factors, _formulas) in SETS.items():
    for _key, _factor in _factors.items():
        QUERIES[_key] = partial(_run, {"value": _factor})
        ORACLES[_key] = factor_sql({"value": _formulas[_key]})
    QUERIES[_name] = partial(_run, _factors)
    ORACLES[_name] = factor_sql(_formulas)
