"""Registered queries against their check SQL on the smallest tables.

The default run takes one query per family; BARLAKE_ALL=1 takes all of them.
"""

import os
import re

import pytest

import __spark_entry__ as entry
from barlake.plans import catalog
from tools.check import TABLES, norm

SF = "/root/testdata/sf0.001"
SAMPLE = (
    "ind_ma", "ind_macd", "agg_rps20", "agg_breadth", "min_vwap_gate", "min_audit", "src_daily_docs", "src_raw_quotes", "snk_tables",
    "prj_snapshot_output", "flt_request_validate", "jn_live_reference", "jn_classification", "jn_adjust", "dq_run_grade", "dq_source_health",
    "cal_phase", "scr_v2", "scr_select", "st_exit_replay", "st_slot", "strm_minutes", "strm_lifecycle",
)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()) if os.environ.get("BARLAKE_ALL") else SAMPLE)
def test_query_equals_its_check(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cur = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(names)
    order = [names.index(c) for c in df.columns]
    want = [tuple(norm(r[i]) for i in order) for r in cur.fetchall()]
    got = [tuple(norm(v) for v in r) for r in df.collect()]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_every_query_has_a_check():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert all(re.fullmatch(r"[a-z]+_[a-z0-9_]+", n) for n in catalog.QUERIES)
    assert set(catalog.QUERIES) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_bar_building_stays_hash_based(spark):
    from barlake.plans.bindings import bars

    plan = bars(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "partial_min_by" in plan


def test_history_limit_is_applied_before_the_shuffle(spark):
    from barlake.operators.indicators import cutoff
    from barlake.plans.bindings import bars

    plan = cutoff(bars(spark, SF), ["2001-12-01"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_the_indicators_of_the_universe_are_worked_out_once(spark):
    from barlake.plans.bindings import universe

    plan = universe(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1
