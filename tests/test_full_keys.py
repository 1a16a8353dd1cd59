"""Keys beyond six digits stay distinct, vendors keep their own column names, adjustment runs in one direction."""

from pyspark.sql import functions as F

from barlake.operators import merges as mg
from barlake.operators import normalize as nz
from barlake.plans import bindings


def test_codes_of_large_keys_stay_distinct(spark):
    keys = [7, 123456, 1234567, 1234568, 10**10, 10**10 + 1]
    rows = spark.createDataFrame([(k,) for k in keys], "k long").select(bindings.code_of(F.col("k")).alias("c")).collect()
    assert [r.c for r in rows] == ["000007", "123456", "1234567", "1234568", "10000000000", "10000000001"]


def test_bars_of_large_keys(spark, tmp_path):
    big = 10**10
    rows = [
        (big * 100 + k, 1, big + k, 1_000_000 * 10 + k, "2000-01-03", 10.0 + k, 5.0) for k in range(4)
    ] + [(big * 100 + 9, 2, big + 3, 1_000_000 * 10 + 3, "2000-01-03", 99.0, 1.0)]
    names = "l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long, l_shipdate string, l_extendedprice double, l_quantity double"
    spark.createDataFrame(rows, names).write.parquet(str(tmp_path / "lineitem.parquet"))
    got = bindings.bars(spark, str(tmp_path)).orderBy("code").collect()
    assert [r.code for r in got] == [str(10_000_000 + k) for k in range(4)]
    assert (float(got[3].open), float(got[3].close)) == (13.0, 99.0)


def test_each_vendor_has_its_own_columns(spark):
    row = spark.createDataFrame([("600000", "n", "1.5")], ["股票代码", "股票名称", "最新价"])
    assert nz.provider_schema(row, "efinance").columns == ["code", "name", "price"]
    assert nz.provider_schema(row, "akshare_em").columns == ["price"]


def test_adjustment_takes_the_next_known_factor(spark):
    bars = spark.createDataFrame([("a", f"2024-01-0{k}", *[float(k)] * 4) for k in range(1, 6)], "code string, dt string, open double, high double, low double, close double")
    factors = spark.createDataFrame([("a", "2024-01-02", 2.0), ("a", "2024-01-04", 4.0)], "code string, dt string, factor double")
    got = mg.adjust_prices_both(bars, factors).orderBy("dt").collect()
    assert [r.hfq_close for r in got] == [2.0, 4.0, 12.0, 16.0, None]
    assert [r.qfq_close for r in got] == [0.5, 1.0, 3.0, 4.0, None]
    plan = mg.adjust_prices_both(bars, factors)._jdf.queryExecution().toString().lower()
    assert "unboundedfollowing" not in plan
