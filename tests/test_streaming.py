import datetime as dt
import random

from pyspark.sql import functions as F

from barlake.operators import lifecycle as lc
from barlake.operators import minutes as mn
from barlake.plans.catalog_streaming import run_health, run_increments, run_lifecycle
from barlake.streaming import jobs
from barlake.streaming import ordered as od


def folders(spark, tmp_path, rows, schema, parts):
    """The same rows as one file, as files in order (one per trigger), and as shuffled files (one per trigger)."""
    rnd = random.Random(4)
    mixed = rnd.sample(rows, len(rows))
    size = -(-len(rows) // parts)
    cut = lambda r: [r[i : i + size] for i in range(0, len(r), size)]
    for name, files, per in (("one", [rows], None), ("ordered", cut(rows), 1), ("mixed", cut(mixed), 1)):
        src = str(tmp_path / name)
        for part in files:
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
        yield name, jobs.file_stream(spark, src, "*.parquet", spark.createDataFrame([], schema).schema, per)


def test_lifecycle_rows_do_not_depend_on_batches(spark, tmp_path):
    rnd = random.Random(2)
    names = list(lc.ENTRY_TRANSITIONS)
    rows = [(e, i, rnd.choice([*names, "unheard_of"])) for i in range(40) for e in range(3)]
    schema = "entity long, seq long, to_state string"
    cols = ["entity", "seq", "to_state", "from_state", "legal", "state_after"]
    want = sorted(map(tuple, lc.entry_replay(spark.createDataFrame(rows, schema)).select(cols).collect()))
    for name, stream in folders(spark, tmp_path, rows, schema, 2):
        events = stream.withColumn("ts", F.timestamp_seconds("seq"))
        out = run_lifecycle(events, str(tmp_path / f"{name}-out"), "7 seconds", "1 hour")
        assert sorted(map(tuple, out.select(cols).collect())) == want


def test_health_rows_do_not_depend_on_batches_and_resume(spark, tmp_path):
    rnd = random.Random(6)
    start = dt.datetime(2024, 1, 1)
    rows = [(rnd.choice("ab"), k, start + dt.timedelta(hours=k // 3), rnd.random() < 0.3) for k in range(240)]
    want, n = [], {"a": 0, "b": 0}
    for source, seq, _, ok in rows:
        n[source] = 0 if ok else n[source] + 1
        if n[source] >= 3:
            want.append((source, seq, n[source]))
    for name, stream in folders(spark, tmp_path, rows, "source string, seq long, ts timestamp, ok boolean", 2):
        path = str(tmp_path / f"{name}-out")
        first = run_health(stream, path, "6 hours", "30 days", closing=False)
        assert first.count() == 0  # nothing is over yet
        out = run_health(stream, path, "6 hours", "30 days")
        got = out.select("source", "seq", "failures").collect()
        assert sorted(map(tuple, got)) == sorted(want)


def test_increments_equal_the_batch_operator(spark, tmp_path):
    rnd = random.Random(9)
    rows = []
    for code in ("000001", "000002"):
        volume, amount = 0, 0.0
        for k in range(50):
            volume, amount = volume + rnd.randint(0, 9), amount + rnd.randint(0, 90)
            fall = 5 if k % 11 == 10 else 0
            rows.append((code, dt.date(2024, 1, 8), dt.datetime(2024, 1, 8, 9, 30) + dt.timedelta(minutes=k), round(10.0 + rnd.random(), 2), volume - fall, amount))
    rows.sort(key=lambda r: r[2])
    schema = "code string, trade_date date, ts timestamp_ntz, price double, volume long, amount double"
    cols = ["code", "ts", "open", "high", "low", "close", "volume", "amount", "cum_volume"]
    flat = lambda df: sorted(tuple(round(float(v), 3) if k > 1 else v for k, v in enumerate(r)) for r in df.select(cols).collect())
    want = flat(mn.bars_from_cumulative(spark.createDataFrame(rows, schema)))
    assert 0 < len(want) < len(rows) - 2
    for name, stream in folders(spark, tmp_path, rows, schema, 2):
        assert flat(run_increments(stream, str(tmp_path / f"{name}-out"), "10 minutes", "1 day")) == want


def test_the_end_mark_closes_each_window_once(spark, tmp_path):
    schema = "code string, ts timestamp, seq long, price double, volume long, amount double"
    t = lambda h, m, s=0: dt.datetime(2024, 1, 8, h, m, s)
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    rows = [("a", t(9, 30), 1, 10.0, 5, 50.0), ("a", t(9, 55), 2, 12.0, 5, 60.0), ("a", t(9, 55, 9), 3, 11.0, 1, 11.0)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(src)
    stream = jobs.file_stream(spark, src, "*.parquet", spark.createDataFrame([], schema).schema)
    job = lambda: jobs.minute_bars(od.with_end_marks(stream, "ts", out))
    for _ in range(2):  # closing again adds nothing
        od.run_to_end(job, "ts", "2024-01-09", out)
        got = spark.read.parquet(f"{out}/data").select(F.date_format("ts_min", "HH:mm").alias("m"), "volume").collect()
        assert sorted(map(tuple, got)) == [("09:30", 5), ("09:55", 6)]


def test_late_run_does_not_replace_a_newer_one(spark, tmp_path):
    src = str(tmp_path / "src")
    schema = "grade string, generated_at string, run_id long"
    for row in (("g", "2024-01-02", 2), ("g", "2024-01-01", 1)):
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(src)
    stream = jobs.file_stream(spark, src, "*.parquet", spark.createDataFrame([], schema).schema, 1)
    jobs.run_newest(stream, str(tmp_path / "out"), ["grade"])
    assert [r.run_id for r in jobs.newest_view(spark, str(tmp_path / "out"), ["grade"]).collect()] == [2]


def test_minute_bars_drop_late_ticks(spark, tmp_path):
    src = str(tmp_path / "src")
    schema = "code string, ts timestamp, seq long, price double, volume long, amount double"
    t = lambda h, m, s=0: dt.datetime(2024, 1, 8, h, m, s)
    batches = [
        [("a", t(9, 30, 1), 1, 10.0, 5, 50.0), ("a", t(9, 30, 50), 2, 12.0, 5, 60.0), ("a", t(9, 50), 3, 11.0, 1, 11.0)],
        [("a", t(9, 51), 4, 11.0, 1, 11.0)],
        # late rows are judged by the watermark of the batch before: 09:31 is behind it now
        [("a", t(9, 31), 5, 99.0, 1, 99.0), ("a", t(10, 30), 6, 11.0, 1, 11.0)],
    ]
    for b in batches:
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(src)
    stream = jobs.file_stream(spark, src, "*.parquet", spark.createDataFrame([], schema).schema, 1)
    out = str(tmp_path / "out")
    jobs.run_available(jobs.minute_bars(stream), out)
    rows = spark.read.parquet(f"{out}/data").select(F.date_format("ts_min", "HH:mm").alias("m"), "open", "close", "volume").collect()
    assert sorted(map(tuple, rows)) == [("09:30", 10.0, 12.0, 10), ("09:50", 11.0, 11.0, 1), ("09:51", 11.0, 11.0, 1)]


def test_a_table_stream_reads_a_file_and_a_folder_of_parts(spark, tmp_path):
    from barlake.plans.catalog_streaming import _stream

    spark.range(40).repartition(3).write.parquet(str(tmp_path / "parts.parquet"))
    spark.range(40).coalesce(1).write.parquet(str(tmp_path / "one"))
    next((tmp_path / "one").glob("*.parquet")).rename(tmp_path / "file.parquet")
    for name in ("parts", "file"):
        jobs.run_available(_stream(spark, str(tmp_path), name), str(tmp_path / f"{name}-out"))
        assert spark.read.schema("id long").parquet(str(tmp_path / f"{name}-out/data")).count() == 40
