from barlake.plans import bindings as bd
from barlake.plans.registry import QUERIES

D = "/root/testdata/sf0.001"


def test_bars_of_the_last_dates(spark):
    """The last dates of a code give the same bars when only their rows are summed up, in one shuffle."""
    import barlake.plans.catalog  # noqa: F401

    every = sorted(tuple(r) for r in bd.bars(spark, D).collect())
    by_code = {}
    for r in every:
        by_code.setdefault(r[0], []).append(r)
    for n in (1, 2, 250):
        few = bd.bars(spark, D, last=n)
        assert sorted(tuple(r) for r in few.collect()) == sorted(r for rows in by_code.values() for r in rows[-n:])
    plan = QUERIES["prj_provider_tables"](spark, D)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit [code" in plan and "hashpartitioning(code" in plan
    assert not [x for x in plan.splitlines() if "hashpartitioning(code" in x and ", dt" in x]


def test_screens_read_the_universe_once(spark):
    """A screen reads its trades while the universe is written and never again."""
    for name in ("scr_fees", "scr_opportunity"):
        plan = QUERIES[name](spark, D)._jdf.queryExecution().optimizedPlan().toString()
        assert "l_shipdate" not in plan and "s_suppkey" not in plan


def test_unlisted_securities_count_in_ranks(spark):
    every = {r.code: r.rps20 for r in bd.universe(spark, D).collect()}
    half = {r.code: r.rps20 for r in bd.universe(spark, D, listed=bd.dims(spark, D).where("k % 2 = 0")).collect()}
    assert half == {c: v for c, v in every.items() if int(c) % 2 == 0} and len(half) < len(every)
