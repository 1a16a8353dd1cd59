import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from barlake.operators import crosssection as cs
from barlake.operators import indicators as ind


def bars(spark, closes, code="000001", start=dt.date(2024, 1, 1), ohlc=None):
    rows = []
    for i, c in enumerate(closes):
        o, h, low = (c - 0.5, c + 1.0, c - 1.0) if ohlc is None else ohlc[i]
        rows.append((code, start + dt.timedelta(days=i), float(o), float(h), float(low), float(c), 100.0, c * 100.0))
    return spark.createDataFrame(rows, "code string, dt date, open double, high double, low double, close double, volume double, amount double")


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_ramp_of_250_bars(spark):
    r = one(ind.indicators_as_of(bars(spark, [float(x) for x in range(1, 251)]), ["2030-01-01"]))
    assert r.ma5 == 248 and r.ma250 == 125.5
    assert r.rsi14 == 100 and r.atr14 == pytest.approx(2.0) and r.atr14_pct == pytest.approx(0.8)
    assert r.used_rows == 250


def test_only_the_last_250_completed_bars_count(spark):
    b = bars(spark, [float(x) for x in range(1, 401)])
    r = one(ind.indicators_as_of(b, ["2024-12-31"]))  # 365 bars lie before that date
    assert r.used_rows == 250 and r.last_close == 365 and str(r.last_date) == "2024-12-30"


def test_short_history_gives_null(spark):
    r = one(ind.indicators_as_of(bars(spark, [float(x) for x in range(1, 11)]), ["2030-01-01"]))
    assert r.ma5 == 8.0
    assert (r.ma11, r.rsi14, r.macd_dif, r.atr14, r.boll_upper, r.return_10d, r.overheated) == (None,) * 7


def ema(values, span):
    out, a = [values[0]], 2 / (span + 1)
    for v in values[1:]:
        out.append(a * v + (1 - a) * out[-1])
    return out


def test_macd_and_momentum_against_plain_recursion(spark):
    rnd = random.Random(3)
    closes = [round(100 + i + rnd.uniform(-5, 5), 2) for i in range(60)]
    dif = [a - b for a, b in zip(ema(closes, 12), ema(closes, 26))][25:]
    dea = ema(dif, 9)
    hist = [2 * (a - b) for a, b in zip(dif, dea)]
    r = one(ind.indicators_as_of(bars(spark, closes), ["2030-01-01"]))
    assert r.macd_dif == pytest.approx(dif[-1]) and r.macd_dea == pytest.approx(dea[-1]) and r.macd_hist == pytest.approx(hist[-1])
    assert r.momentum_delta_1 == pytest.approx(hist[-1] - hist[-2]) and r.momentum_delta_3 == pytest.approx(hist[-1] - hist[-4])


@pytest.mark.parametrize("n,known", [(33, False), (34, True)])
def test_macd_needs_34_closes(spark, n, known):
    r = one(ind.indicators_as_of(bars(spark, [100.0 + i % 7 for i in range(n)]), ["2030-01-01"]))
    assert r.macd_dif is not None and (r.macd_dea is not None) == known


def test_flat_prices(spark):
    r = one(ind.indicators_as_of(bars(spark, [10.0] * 30, ohlc=[(10, 10, 10)] * 30), ["2030-01-01"]))
    assert r.rsi14 == 50 and r.boll_position == 0.5 and r.upper_shadow_ratio is None


def test_shadows(spark):
    r = one(ind.indicators_as_of(bars(spark, [101.0] * 6, ohlc=[(100, 110, 99)] * 6), ["2030-01-01"]))
    assert r.upper_shadow_ratio == pytest.approx(9 / 11) and r.lower_shadow_ratio == pytest.approx(1 / 11)


@pytest.mark.parametrize("closes,expected", [([101, 101, 104, 101, 101], True), ([104] * 5, False)])
def test_repeated_upper_shadow(spark, closes, expected):
    b = bars(spark, closes, ohlc=[(100, 105, 100)] * 5)
    assert one(ind.indicators_as_of(b, ["2030-01-01"])).repeated_upper_shadow is expected


def test_history_equals_as_of(spark):
    rnd = random.Random(1)
    b = bars(spark, [round(rnd.uniform(10, 90), 2) for _ in range(300)])
    day = "2024-10-20"
    a = one(ind.indicators_as_of(b, [day]))
    h = one(ind.indicators_history(b).where(F.col("dt") == "2024-10-19"))
    for c in ("ma5", "ma60", "ma250", "boll_upper", "boll_position", "return_20d", "high_20d", "low_20d"):
        assert a[c] == pytest.approx(h[c]), c


def test_relative_strength(spark):
    df = spark.createDataFrame([("A", 1, 0.10), ("B", 1, 0.05), ("C", 1, -0.02), ("D", 1, 0.20), ("E", 1, None)], "code string, d int, return_20d double")
    got = {r.code: r.rps20 for r in cs.relative_strength(df, ["d"]).collect()}
    assert got == {"A": 75, "B": 50, "C": 25, "D": 100, "E": None}


def test_vwap_ignores_incomplete_rows_and_zero_volume(spark):
    df = spark.createDataFrame([("a", 2.0, 20.0), ("a", 3.0, 60.0), ("a", None, 5.0), ("b", 0.0, 1.0)], "code string, volume double, amount double")
    assert {r.code: r.vwap for r in ind.vwap(df, ["code"]).collect()} == {"a": 16.0, "b": None}


def test_average_volume_needs_five_positive_bars(spark):
    b = bars(spark, [1.0] * 7).withColumn("volume", F.when(F.dayofmonth("dt") == 3, 0.0).otherwise(F.dayofmonth("dt") * 1.0))
    assert one(ind.average_volume(b, "2030-01-01")).avg5_volume == (7 + 6 + 5 + 4 + 2) / 5
    assert ind.average_volume(b, "2024-01-05").count() == 0


def test_hot_code_does_not_change_the_result(spark):
    # one code owns almost all bars; its map-side limit keeps 250 of them
    many = bars(spark, [float(i % 50 + 1) for i in range(3000)], "000001", dt.date(2010, 1, 1))
    few = bars(spark, [float(x) for x in range(1, 6)], "000002")
    got = {r.code: (r.used_rows, r.ma5) for r in ind.indicators_as_of(many.unionByName(few), ["2030-01-01"]).collect()}
    assert got == {"000001": (250, 48.0), "000002": (5, 3.0)}


def test_every_bar_has_the_value_of_its_as_of_date(spark):
    from barlake.operators import recursions as rec

    rnd = random.Random(8)
    rows = []
    for code, n in (("000001", 330), ("000002", 40), ("000003", 1)):
        for i in range(n):
            c = round(20 + rnd.uniform(-5, 5), 2)
            h, low = c + rnd.random(), c - rnd.random()
            gap = rnd.random()
            rows.append((code, dt.date(2024, 1, 1) + dt.timedelta(days=i), c, None if gap < 0.03 else h, low, None if gap > 0.97 else c))
    b = spark.createDataFrame(rows, "code string, dt date, open double, high double, low double, close double")
    fields = ("rsi14", "macd_dif", "macd_dea", "macd_hist", "momentum_delta_1", "momentum_delta_3", "momentum_improving", "atr14", "atr14_pct")
    old = rec.BLOCK
    rec.BLOCK = 64  # frames reach across blocks
    try:
        got = {(r.code, r.dt): tuple(r[f] for f in fields) for r in rec.recursive_history(b.repartition(3)).collect()}
    finally:
        rec.BLOCK = old
    assert len(got) == sum(r[5] is not None for r in rows)
    for code, day in [(r[0], r[1]) for r in rows if r[5] is not None][::37]:
        want = one(ind.indicators_as_of(b.where(F.col("code") == code), [str(day + dt.timedelta(days=1))]))
        for f, x in zip(fields, got[code, day], strict=True):
            assert x == want[f] if want[f] is None or isinstance(x, bool) else x == pytest.approx(want[f], rel=1e-12)


def test_frames_of_short_histories(spark):
    from barlake.operators import recursions as rec

    m = {r.dt.day: r for r in rec.frame_meta(bars(spark, [1.0, 2.0, 3.0, 4.0]), "2024-01-04 10:00:00", keep=2).collect()}
    assert [(m[k].frame_rows, m[k].truncated_to, m[k].first_date.day) for k in (1, 2, 3, 4)] == [(1, 1, 1), (2, 2, 1), (2, 3, 2), (2, None, 3)]
    assert m[1].includes_intraday_today
    assert rec.recursive_history(bars(spark, [1.0]).limit(0)).count() == 0


def test_only_the_recursions_asked_for_run(spark, monkeypatch):
    import numpy as np

    from barlake.operators import recursions as rec

    ran = []
    for name in ("_gains", "_averages", "_ranges"):
        monkeypatch.setattr(rec, name, lambda *a, _n=name, _f=getattr(rec, name): ran.append(_n) or _f(*a))
    x = np.array([1.0, 2.0, np.nan, 3.0] * 20)
    start = np.maximum(np.arange(80) - 39, 0)
    every = rec.frame_values(start, 5, x, x + 1, x - 1, rec.VALUES)
    for wanted, parts in ((["rsi14"], ["_gains"]), (["macd_hist"], ["_averages"]), (["atr14"], ["_ranges"])):
        ran.clear()
        got = rec.frame_values(start, 5, x, x + 1, x - 1, wanted)
        assert ran == parts
        assert all(np.array_equal(got[w], every[w], equal_nan=True) for w in wanted)
