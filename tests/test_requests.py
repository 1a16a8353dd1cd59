import random

from pyspark.sql import functions as F

from barlake.operators import merges as mg


def test_intervals_against_brute_force(spark):
    rnd = random.Random(4)
    minutes = [(c, d, m, float(m), m * 10 + len(c), float(m * 3)) for c in ("a", "bb") for d in ("2024-01-08", "2024-01-09") for m in rnd.sample(range(540, 905), 200)]
    asks = [(f"q{i}", rnd.choice(["a", "bb", "none"]), rnd.choice(["2024-01-08", "2024-01-09", "2024-01-10"]), (lo := rnd.randrange(530, 900)), lo + rnd.choice([-1, 0, 1, 29, 30, 31, 200])) for i in range(150)]
    asks += [("edge1", "a", "2024-01-08", 570, 599), ("edge2", "a", "2024-01-08", 0, 1439)]
    m = spark.createDataFrame(minutes, "code string, date string, minute int, price double, volume long, amount double")
    a = spark.createDataFrame(asks, "ask string, code string, date string, low int, high int")
    facts = {r.ask: (r.n, r.volume, r.amount) for r in mg.interval_facts(a, m).collect()}
    rows = {r.ask: [x.minute for x in r.minute_raw] for r in mg.interval_rows(a, m).collect()}
    for ask, code, day, low, high in asks:
        own = sorted(r for r in minutes if r[:2] == (code, day) and low <= r[2] <= high)
        assert facts.get(ask) == ((len(own), own[-1][4], own[-1][5]) if own else None)
        assert rows.get(ask, []) == [r[2] for r in own]


def test_equal_intervals_are_answered_once(spark, monkeypatch):
    """Requests for one interval share its answer; each sees the fields that it asked for."""
    asked = []
    for name in ("interval_facts", "interval_rows"):
        monkeypatch.setattr(mg, name, lambda a, m, f=getattr(mg, name): asked.append(a.count()) or f(a, m))
    ends = [("09:00", "10:00"), ("09:00", "10:01"), ("10:00", "09:00")]
    rows = [(f"q{i}", ["a"], None, ("2024-01-08" if i % 4 else "no date", *ends[i % 3], [["raw"], ["vwap"], ["raw", "vwap"], []][i // 3 % 4])) for i in range(120)]
    interval = "struct<date:string,start:string,end:string,fields:array<string>>"
    requests = spark.createDataFrame(rows, f"request_id string, codes array<string>, daily struct<lookback:int,fields:array<string>>, minute {interval}")
    values = ("ma5", "ma10", "ma20", "ma60", "ma120", "ma250", "rsi14", "macd_dif", "macd_dea", "macd_hist", "atr14", "atr14_pct")
    rec = spark.createDataFrame([], ", ".join(["code string", "used_rows long", *[f"{v} double" for v in values]]))
    bars = spark.createDataFrame([], "code string, k int, dt date, open double, high double, low double, close double, volume long")
    minutes = spark.createDataFrame([("a", "2024-01-08", m, 1.0, m * 10, m * 30.0) for m in (539, 540, 600, 601)], "code string, date string, minute int, price double, volume long, amount double")
    minutes = minutes.withColumn("date", F.col("date").cast("date"))
    got = {r.request_id: r for r in mg.fulfil_requests(requests, rec, bars, minutes, minute_as=lambda r: r["minute"]).collect()}
    assert asked == [2, 2]
    assert len(got) == 120
    for i in range(120):
        r, want = got[f"q{i}"], [540, 600, 601][: 2 + i % 3] if i % 3 < 2 and i % 4 else []
        fields = rows[i][3][3]
        assert (r.ok, r.rows, r.error is None) == (bool(want), len(want), bool(want))
        assert r.minute_raw == (want if want and "raw" in fields else None)
        assert r.vwap == (3.0 if want and "vwap" in fields else None)
