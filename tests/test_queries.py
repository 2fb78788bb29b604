"""Registered queries against their SQL on DuckDB, and the batch form of the factors against the single form."""

import os

import pytest
from compare import compare, duck

import __spark_entry__ as entry
from factorloom.factors import alpha101, staging
from factorloom.plans import registry
from factorloom.sources.driver_tables import factor_panel

SF = "/root/testdata/sf0.001"
SAMPLE = ["s01_bar_scan", "s08_log_cleaning", "p08_trade_flags", "j07_fundamentals_as_of", "j12_last_sale",
          "a05_ticker_list", "t02_trade_date_by_offset", "m06_ps_pit", "m15_wq_alpha16", "m18_ntra_bias",
          "m22_float_rate", "w04_corr", "w15_ewm", "j01_metric_attach", "b20_choice_enrichment", "b22_export_ledger", "x08_neutralize", "b01_rank", "b04_daily_choice",
          "b11_drawdown", "b17_closed_trades", "b19_small_cap_monthly", "f001", "f029", "f077", "f096", "g021", "g075",
          "g138", "g159", "g174", "e01_scalars", "p09_one_day", "universe_x01_rank_pct", "universe_as_of",
          "universe_neutralize"]


def chosen():
    """All of them with ALL_QUERIES=1; tests/compare.py does the same at any scale factor."""
    return list(registry.oracle_sql()) if os.environ.get("ALL_QUERIES") else SAMPLE


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", chosen())
def test_same_rows_as_sql(spark, con, name):
    difference, rows, filled = compare(registry.queries()[name](spark, SF), con, registry.oracle_sql()[name])
    assert difference == ""
    assert rows > 0 and filled > 0


def test_every_query_has_a_check():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert len([n for n in registry.queries() if n[0] == "f" and n[1:].isdigit()]) == 83
    assert len([n for n in registry.queries() if n[0] == "g" and n[1:].isdigit()]) == 169


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_factors_together_equal_factors_alone(spark):
    """The long form of the ranks changes nothing."""
    names = ["f004", "f013", "f015", "f027", "f042", "f050", "f060", "f078", "f083"]
    panel = factor_panel(spark, SF)
    alone = {n: staging.attach(panel, {n: alpha101.FACTORS[n]}) for n in names}
    together = staging.attach(panel, {n: alpha101.FACTORS[n] for n in names})
    rows = {(r.ticker, r.trade_date): r for r in together.collect()}
    for n, df in alone.items():
        for r in df.collect():
            got, want = rows[(r.ticker, r.trade_date)][n], r[n]
            assert (got is None and want is None) or got == pytest.approx(want, abs=1e-9), n


def test_batch_plan_keeps_its_exchanges_few(spark):
    df = staging.attach(factor_panel(spark, SF), alpha101.FACTORS)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 10


@pytest.mark.parametrize("name", ["j01_metric_attach", "j12_last_sale", "b22_export_ledger"])
def test_bars_are_built_once(spark, name):
    """The plan reads the written bars; line items are read by the job that writes them, and by no other."""
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_partkey" not in plan and "l_orderkey" not in plan
