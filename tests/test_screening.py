import itertools

import pytest
from pyspark.sql import functions as F

from barlake.functions.text import board_of, market_of, normalize_code, vendor_symbol
from barlake.operators import screening as sc


def test_decision_matrix(spark):
    expected = {
        ("strong", "low"): "can_enter_candidate", ("strong", "medium"): "can_enter_candidate", ("strong", "high"): "conditional_watch",
        ("moderate", "low"): "can_enter_candidate", ("moderate", "medium"): "can_enter_candidate", ("moderate", "high"): "conditional_watch",
        ("weak", "low"): "conditional_watch", ("weak", "medium"): "reject", ("weak", "high"): "reject",
        ("poor", "low"): "reject", ("poor", "medium"): "reject", ("poor", "high"): "reject",
    }
    pairs = list(itertools.product(("strong", "moderate", "weak", "poor"), ("low", "medium", "high")))
    df = spark.createDataFrame(pairs, "q string, r string").withColumn("d", sc.decision_matrix("q", "r"))
    assert {(r.q, r.r): r.d for r in df.collect()} == expected


def test_price_zones(spark):
    df = spark.createDataFrame([(100.0, 5.0, 99.0, 95.0)], "price double, atr14 double, trigger_reference double, structural_support double")
    r = sc.fees(sc.protection(sc.sell_zones(sc.buy_zone(df))), "buy_upper", "sell1_lower").collect()[0]
    assert (r.buy_lower, r.buy_upper, r.no_chase_price) == (99.5, 100.48, 100.48)
    assert not r.buy_zone_empty and not r.above_no_chase
    assert r.sell1_lower == pytest.approx(103.98) and r.sell1_upper == pytest.approx(104.48) and r.sell2_available
    assert r.protection_price == pytest.approx(96.48) and r.protection_ok
    assert r.buy_commission == 5.0 and r.net_profit < 350


def test_sell_zone_inside_buy_zone(spark):
    df = spark.createDataFrame([(100.0, 0.0, 100.0)], "price double, atr14 double, buy_upper double")
    assert sc.sell_zones(df).collect()[0].sell_zone_error == "sell_zone_inside_buy_zone"


def test_limits_by_board(spark):
    rows = [("600001", "A", 11.0, 10.0), ("300001", "B", 11.0, 10.0), ("688001", "C", 12.0, 10.0), ("430001", "D", 13.0, 10.0), ("600002", "*STx", 10.5, 10.0), ("000001", "E", 9.0, 10.0)]
    t = sc.tradability(spark.createDataFrame(rows, "code string, name string, price double, pre_close double"))
    got = {r.code: (r.is_limit_up, r.is_limit_down, r.is_st, r.delist_risk) for r in t.collect()}
    assert got["600001"][0] and not got["300001"][0] and got["688001"][0] and got["430001"][0]
    assert got["600002"] == (True, False, True, True) and got["000001"][1]


def test_codes_and_markets(spark):
    df = spark.createDataFrame([("1.0",), ("sh600000",), ("nan",), ("12000001",), ("920001",), ("399006",)], "c string")
    got = [tuple(r) for r in df.select(normalize_code("c").alias("n")).select("n", market_of("n"), board_of("n"), vendor_symbol("n", "suffix")).collect()]
    assert [g[0] for g in got] == ["000001", "600000", "", "000001", "920001", "399006"]
    assert [g[1] for g in got] == ["sz", "sh", None, "sz", "bj", "sz"]
    assert got[4][2] == "北交所" and got[4][3] == "920001.BJ" and got[1][3] == "600000.SH"


def test_substitute_order(spark):
    rows = [("3", "strong", "high", 9.0), ("2", "strong", "low", 1.0), ("1", "strong", "low", 1.0), ("4", "odd", "odd", None), ("5", "strong", "low", 2.0)]
    df = spark.createDataFrame(rows, "code string, opportunity_quality string, tail_risk string, reward_risk_ratio double").withColumn("g", F.lit(1))
    assert [r.code for r in sc.rank_substitutes(df, ["g"]).orderBy("position").collect()] == ["5", "1", "2", "3", "4"]


def test_labels_round_the_exact_value_with_ties_to_even(spark):
    # 3189 and 681 of 6,000 securities: 53.15 and 11.35 are a little less in binary; 62.25 is a tie
    rows = [(3189 / 6000 * 100, -0.10005), (681 / 6000 * 100, 0.00125), (62.25, -0.00001), (62.75, 0.07375)]
    df = spark.createDataFrame(rows, "rps20 double, return_20d double").selectExpr(
        "*", "1d AS price", "2d AS ma11", "3d AS ma23", "50.5d AS rsi14", "1d AS momentum_delta_1", "1d AS momentum_delta_3", "0.5d AS ctx_boll_position",
        "1d AS atr14", "1d AS low", "1d AS full_day_vwap", "false AS long_upper_shadow",
    )
    got = {r.rps20: (r.channels[0].reason, r.channels[1].reason) for r in sc.channels(df).collect()}
    assert got == {
        rps: (f"price_not_above_ma_sequence; rps20_below_70 ({rps:.1f})", f"price_not_above_ma23; return_20d_below_8pct ({ret:.2%})") for rps, ret in rows
    }
    row = spark.createDataFrame([(50.5, -0.25, 0.0625)], "rsi14 double, change_pct double, return_20d double").selectExpr(
        "*", "1.25d AS volume_ratio", "0d AS volume", "1d AS price", "1d AS amount", "-0.04d AS industry_chg", "false AS trend_aligned", "false AS trend_near"
    )
    tags = sc.opportunity_score(row).collect()[0].opportunity_tags
    assert tags == ["rsi_healthy(50)", "vr_good(1.2)", "chg_flat(-0.2%)", "ind_weak(-0.0%)", "ret20_pos(+6.2%)"]
