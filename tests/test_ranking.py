import random
import statistics

from pyspark.sql import functions as F

from barlake.functions import ranking
from barlake.functions.ranking import binned_row_number, exact_median, leading_bytes, percent_rank_average, value_positions


def data(spark, hot=600):
    rnd = random.Random(7)
    rows = [("hot", float(rnd.choice([1, 1, 1, 2, 3, rnd.random() * 10]))) for _ in range(hot)]
    rows += [("cold", float(x)) for x in (5, 1, 5, None) if x is not None] + [("cold", None)]
    return rows, spark.createDataFrame(rows, "k string, v double")


def test_positions_are_exact_for_a_hot_key(spark):
    rows, df = data(spark)
    got = {(r.k, r.v): (r.cnt, r.below, r.n) for r in value_positions(df, ["k"], "v", bins=8).collect()}
    for k in ("hot", "cold"):
        vals = [v for kk, v in rows if kk == k and v is not None]
        for v in set(vals):
            assert got[(k, v)] == (vals.count(v), sum(x < v for x in vals), len(vals))


def test_median_and_rank(spark):
    rows, df = data(spark)
    med = {r.k: r.m for r in exact_median(df, ["k"], "v", "m").collect()}
    assert med["hot"] == statistics.median(v for k, v in rows if k == "hot")
    assert med["cold"] == 5.0
    ranks = [(r.v, r.p and round(r.p, 9)) for r in percent_rank_average(df, ["k"], "v", "p").where("k = 'cold'").collect()]
    assert sorted(ranks, key=str) == sorted([(1.0, round(100 / 3, 9)), (5.0, round(250 / 3, 9)), (5.0, round(250 / 3, 9)), (None, None)], key=str)


def test_median_without_keys(spark):
    df = spark.createDataFrame([(float(x),) for x in (4, 1, 3, 2)], "v double")
    assert exact_median(df, [], "v", "m").collect()[0].m == 2.5


def test_binned_row_number_equals_a_window(spark):
    rnd = random.Random(5)
    rows = [("a" if rnd.random() < 0.9 else None, rnd.choice([0.0] * 8 + [rnd.uniform(-9, 9) for _ in range(4)]), f"{rnd.randrange(4000):06d}") for _ in range(3000)]
    rows = [(k, v, c, i) for i, (k, v, c) in enumerate(rows)]
    df = spark.createDataFrame(rows, "key string, v double, code string, tie long").repartition(4)
    order = [F.col("v").desc(), F.col("code"), F.col("tie")]
    lead = F.lit(0.5) - F.atan("v") / F.pi()
    got = binned_row_number(df, ["key"], lead, leading_bytes(F.col("code")), order, "n", bins=8)
    want = {}
    for key in ("a", None):
        for n, r in enumerate(sorted((r for r in rows if r[0] == key), key=lambda r: (-r[1], r[2], r[3])), 1):
            want[r[3]] = n
    assert {r.tie: r.n for r in got.collect()} == want
    assert binned_row_number(df.limit(0), ["key"], lead, leading_bytes(F.col("code")), order, "n").count() == 0


def test_leading_bytes_keep_the_order(spark):
    texts = sorted(["", "a", "ab", "abcdefgh", "abcdefgi", "b", "é", "中", "0", "000001"], key=str.encode)
    got = [r.x for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", leading_bytes(F.col("t")).alias("x")).collect()]
    assert got == sorted(got) and got[1] < got[-1]


def loose_edges(column, cuts, accuracy):
    """Sketched edges that come out differently each time they are worked out, as those of many executors do."""

    @F.udf("array<double>")
    def some(values):
        return sorted(random.SystemRandom().sample(values, min(len(values), len(cuts))))

    return some(F.collect_list(column))


def test_positions_do_not_rest_on_equal_edges(spark, monkeypatch):
    monkeypatch.setattr(ranking.F, "percentile_approx", loose_edges)
    rows = [("ab"[i % 2], float(i * 37 % 501)) for i in range(1200)]
    df = spark.createDataFrame(rows, "k string, v double")
    for keys in (["k"], []):
        # a broadcast side would be reused and hide the fault
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            got = value_positions(df, keys, "v", bins=8).collect()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for r in got:
            vals = [v for k, v in rows if not keys or k == r.k]
            assert (r.cnt, r.below, r.n) == (vals.count(r.v), sum(x < r.v for x in vals), len(vals))
        assert len(got) == len({(k if keys else "", v) for k, v in rows})


def test_row_numbers_do_not_rest_on_equal_edges(spark, monkeypatch):
    monkeypatch.setattr(ranking.F, "percentile_approx", loose_edges)
    rows = [("k", float(i * 37 % 101), f"{i * 7919 % 4000:06d}", i) for i in range(1500)]
    df = spark.createDataFrame(rows, "key string, v double, code string, tie long")
    order = [F.col("v"), F.col("code"), F.col("tie")]
    got = binned_row_number(df, ["key"], F.col("v"), leading_bytes(F.col("code")), order, "n", bins=8)
    want = {r[3]: n for n, r in enumerate(sorted(rows, key=lambda r: r[1:]), 1)}
    assert {r.tie: r.n for r in got.collect()} == want
