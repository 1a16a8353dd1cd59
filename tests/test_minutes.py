import datetime as dt

import pytest
from pyspark.sql import functions as F

from barlake.operators import minutes as mn
from barlake.sources.raw_text import parse_minute_lines

DAY = dt.date(2024, 1, 8)


def minute_bars(spark, points, code="000001"):
    rows = [(code, DAY, dt.datetime(2024, 1, 8, m // 60, m % 60), float(p), float(p), float(p), float(p), float(v), float(p * v)) for m, p, v in points]
    df = spark.createDataFrame(rows, "code string, trade_date date, ts timestamp_ntz, open double, high double, low double, close double, volume double, amount double")
    return df


def test_raw_lines(spark):
    lines = ["0930 10.0 100 1000", "0931 10.1 150 1505", "0931 10.2 160 1600", "bad", "2561 1 1 1", "0932 nan 1 1", "0933 1 -1 1", "0934 1 1"]
    raw = spark.createDataFrame([("a", i, x) for i, x in enumerate(lines)], "code string, line_no int, line string")
    got = sorted((r.time, r.price, r.volume) for r in parse_minute_lines(raw, ["code"]).collect())
    assert got == [("09:30", 10.0, 100.0), ("09:31", 10.2, 160.0)]


def test_cumulative_rows_become_bars(spark):
    b = minute_bars(spark, [(570, 10, 100), (571, 11, 150), (572, 9, 120), (573, 12, 170)])
    cum = b.withColumnRenamed("close", "price").drop("open", "high", "low")
    got = [(r.open, r.high, r.low, r.close, r.volume) for r in mn.bars_from_cumulative(cum).orderBy("ts").collect()]
    # 09:32 falls back and is dropped, 09:33 still differs from 09:32
    assert got == [(10.0, 11.0, 10.0, 11.0, 50.0), (9.0, 12.0, 9.0, 12.0, 50.0)]


def full_day(skip=()):
    ms = [*range(570, 691), *range(780, 901)]
    return [(m, 10 + m % 3, 10) for m in ms if m not in skip]


@pytest.mark.parametrize(
    "skip,source",
    [((), "minute_bars"), (tuple(range(600, 606)), "unavailable"), (tuple(range(580, 602, 2)), "unavailable"), ((580, 590), "minute_bars")],
)
def test_vwap_gate(spark, skip, source):
    b = minute_bars(spark, full_day(skip))
    prices = spark.createDataFrame([("000001", DAY, 11.0)], "code string, trade_date date, price double")
    r = mn.gated_vwap(b, prices).collect()[0]
    assert r.vwap_source == source and (r.vwap is not None) == (source == "minute_bars")


def test_pivots_and_afternoon_low(spark):
    path = [5, 6, 7, 9, 7, 6, 5, 3, 5, 6, 7]
    b = minute_bars(spark, [(780 + i, p, 1) for i, p in enumerate(path)])
    p = mn.pivots(b)
    assert sorted((r.pivot_type, r.price, r.sequence) for r in p.collect()) == [("high", 9.0, 3), ("low", 3.0, 7)]
    assert mn.afternoon_low(p).collect()[0].price == 3.0


def test_full_session_has_no_missing_minutes(spark):
    b = minute_bars(spark, full_day())
    assert mn.missing_minutes(b, 900).count() == 0
    assert mn.continuity_breaks(b).count() == 0


def test_missing_periods_have_real_lengths(spark):
    b = minute_bars(spark, full_day(skip=(600, 601, 602, 800)))
    got = sorted((r.start, r.end, r.minutes) for r in mn.missing_periods(b, 900).collect())
    assert got == [("10:00", "10:02", 3), ("13:20", "13:20", 1)]


@pytest.mark.parametrize(
    "prices,vwaps,target,triggered,kind,reason",
    [
        ([108, 99, 98, 97], [104, 100, 99, 98], 110, True, "gap_arrival", "early_target_reversal_detected"),
        ([99, 100, 107, 99, 98], [100, 101, 103, 100, 99], 110, True, "intraday_runup", "early_target_reversal_detected"),
        ([99, 100, 101, 100], [101] * 4, 120, False, None, "not_activated"),
        ([108, 109], [104, 104], 110, False, None, "insufficient_post_activation_data"),
        ([108, 99, 98, 97], [104, 100, 99, 98], 95, False, None, "target_progress_denominator_invalid"),
    ],
)
def test_early_reversal(spark, prices, vwaps, target, triggered, kind, reason):
    b = minute_bars(spark, [(570 + i, p, 1) for i, p in enumerate(prices)])
    vw = F.element_at(F.array(*[F.lit(float(v)) for v in vwaps]), (F.minute("ts") - 29))
    pos = spark.createDataFrame([(1, "000001", DAY, 100.0, 95.0, float(target))], "position_id int, code string, trade_date date, opening_reference double, entry_price double, first_zone_lower double")
    r = mn.early_reversal(pos, b.withColumn("vwap", vw)).collect()[0]
    assert (r.triggered, r.activation_type, r.reason) == (triggered, kind, reason)
