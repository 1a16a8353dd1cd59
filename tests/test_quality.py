import datetime as dt
import random

from barlake.operators import quality as dq


def test_health_of_shuffled_logs(spark):
    rnd = random.Random(3)
    start = dt.datetime(2023, 12, 31, 23, 50)
    log = []
    for k in range(900):
        source = rnd.choice("aaaaaab")
        at = start + dt.timedelta(seconds=rnd.choice([0, 0, 20, 90, 4000]) * (k // 40))
        log.append((source, at, k, rnd.random() < 0.25, rnd.randrange(100)))
    log += [("c", start, 1, False, None), ("c", start, 0, True, None), ("d", start, 5, False, 1), ("e", start, 5, None, 1)]
    rows = rnd.sample(log, len(log))
    df = spark.createDataFrame(rows, "source string, ts timestamp_ntz, seq long, ok boolean, rows long").repartition(5)
    now = max(r[1] for r in log) + dt.timedelta(seconds=60)
    got = {r.source: r for r in dq.source_health(df, str(now)).collect()}
    for source in "abcde":
        own = sorted((r for r in log if r[0] == source), key=lambda r: (r[1], r[2]))
        good = [r for r in own if r[3]]
        tail = [r for r in own if not good or (r[1], r[2]) > good[-1][1:3]]
        r = got[source]
        assert (r.successes, r.total_failures, r.failures) == (len(good), len(own) - len(good), len(tail))
        assert r.last_rows == (good[-1][4] if good and good[-1][4] is not None else 0)
        assert r.last_success_at == (good[-1][1] if good else None)
        assert r.disabled == (len(tail) >= 3 and now - tail[-1][1] < dt.timedelta(seconds=300))
    plan = dq.source_health(df, str(now))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "SortAggregate" not in plan
    assert dq.source_health(df.limit(0), str(now)).count() == 0
