"""Streaming queries: each runs a stream over the table's files and reads the sink back."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlake.functions.numeric import dbl
from barlake.operators import lifecycle as lc
from barlake.plans.bindings import code_of, table, with_bindings
from barlake.plans.catalog_lifecycle import _ENTRY, _PATH, _at
from barlake.plans.catalog_minutes import _s, cumulative
from barlake.plans.registry import ORACLES, query
from barlake.session import materialize, scratch_dir
from barlake.streaming import jobs
from barlake.streaming import ordered as od

#: An instant after all rows: with it the input ends.
END = "9000-01-01"


def run_lifecycle(events, path, block, delay, closing=True):
    """Entry states of a stream of (entity, seq, to_state, ts) in the order of ``seq``, which rises with ``ts``."""
    names, table, legal = lc.machine(lc.ENTRY_TRANSITIONS)

    def job(where):
        return od.closed_blocks(od.with_end_marks(events, "ts", where), "entity", "ts", block, ["seq"], ["to_state"], delay)

    summary = od.machine_summary(names, table)
    view = od.run_ordered(job, "entity", "ts", summary, "state", names.index(lc.ENTRY_START), END, path, closing)
    return od.machine_view(view, names, table, legal)


def run_health(calls, path, block, delay, closing=True):
    """Cool-downs of a stream of (source, seq, ts, ok)."""

    def job(where):
        return od.closed_blocks(od.with_end_marks(calls, "ts", where), "source", "ts", block, ["ts", "seq"], ["ok"], delay)

    return od.health_view(od.run_ordered(job, "source", "ts", od.failure_summary(), "failures", 0, END, path, closing))


def run_increments(rows, path, block, delay, closing=True):
    """Bars of a stream of cumulative rows (code, trade_date, ts, price, volume, amount), a key for each code and day."""
    wide = "decimal(28,4)"
    rows = rows.select(
        F.struct("code", "trade_date").alias("who"), F.col("ts").cast("timestamp").alias("ts"),
        F.col("price").cast(wide).alias("price"), F.col("volume").cast("bigint").alias("volume"), F.col("amount").cast(wide).alias("amount"),
    )
    rows = rows.withColumn("key", F.concat_ws("|", "who.code", F.col("who.trade_date").cast("string"))).drop("who")

    def job(where):
        return od.closed_blocks(od.with_end_marks(rows, "ts", where), "key", "ts", block, ["ts"], ["price", "volume", "amount"], delay)

    view = od.run_ordered(job, "key", "ts", od.last_summary(["price", "volume", "amount"]), "last", None, END, path, closing)
    bars = od.increments_view(view, "key", "ts", "price", ["volume", "amount"])
    return bars.select(
        F.substring_index("key", "|", 1).alias("code"), F.substring_index("key", "|", -1).alias("trade_date"), F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("prev_price").alias("open"), F.greatest("prev_price", "price").alias("high"), F.least("prev_price", "price").alias("low"),
        F.col("price").alias("close"), F.col("d_volume").alias("volume"), F.col("d_amount").alias("amount"), F.col("volume").alias("cum_volume"),
    )


def _stream(spark, d, name):
    # a table is one file or a folder of part files: a file is streamed only if a pattern finds it, a pattern on names misses the parts
    return spark.readStream.schema(table(spark, d, name).schema).parquet(f"{d}/{name}.parque[t]")


def _ticks(spark, d):
    price = F.col("value").cast("decimal(12,2)")
    volume = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    return _stream(spark, d, "events").select(
        code_of((F.col("user_id") % 10)).alias("code"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("seq"),
        price.alias("price"),
        volume.alias("volume"),
        (price * volume).alias("amount"),
    )


@query(
    "strm_minutes",
    with_bindings(
        """SELECT code, CAST(ts_min AS VARCHAR) AS ts_min, CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close, volume, CAST(amount AS DOUBLE) AS amount FROM fx_minutes""",
        "fx_minutes",
    ),
)
def strm_minutes(spark, d):
    path = scratch_dir(spark, "strm-minutes")
    job = lambda: jobs.minute_bars(od.with_end_marks(_ticks(spark, d), "ts", path))
    od.run_to_end(job, "ts", END, path)
    out = spark.read.parquet(f"{path}/data")
    return out.select(
        "code", F.col("ts_min").cast("string").alias("ts_min"), *[dbl(c).alias(c) for c in ("open", "high", "low", "close")], "volume", dbl("amount").alias("amount")
    )


@query("strm_resume", with_bindings("SELECT code, count(DISTINCT seq) AS ticks FROM fx_ticks GROUP BY code", "fx_ticks"))
def strm_resume(spark, d):
    path = scratch_dir(spark, "strm-resume")
    twice = _ticks(spark, d).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    jobs.run_available(jobs.distinct_ticks(twice, ["code", "seq"]), path)
    jobs.run_available(jobs.distinct_ticks(twice, ["code", "seq"]), path)  # a restart finds nothing left to do
    return spark.read.parquet(f"{path}/data").groupBy("code").agg(F.count(F.lit(1)).alias("ticks"))


@query(
    "strm_late",
    "SELECT o_orderpriority AS grade, CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS generated_on, max_by(o_orderkey, (o_orderdate, o_orderkey)) AS run_id FROM orders GROUP BY o_orderpriority",
)
def strm_late(spark, d):
    path = scratch_dir(spark, "strm-late")
    runs = _stream(spark, d, "orders").select(
        F.col("o_orderpriority").alias("grade"), F.col("o_orderdate").alias("generated_at"), F.col("o_orderkey").alias("run_id")
    )
    jobs.run_newest(runs, path, ["grade"])
    v = jobs.newest_view(spark, path, ["grade"])
    return v.select("grade", F.to_date("generated_at").cast("string").alias("generated_on"), "run_id")


@query(
    "strm_quality",
    with_bindings(
        """WITH t AS (SELECT code, trade_date, CAST(least(greatest(m - 570, 0), 120) + least(greatest(m - 780, 0), 120) AS INT) AS i FROM fx_sticks),
g AS (SELECT *, CASE WHEN i - lag(i) OVER w > 2 OR lag(i) OVER w IS NULL THEN 1 ELSE 0 END AS b FROM t WINDOW w AS (PARTITION BY code, trade_date ORDER BY i)),
s AS (SELECT *, sum(b) OVER (PARTITION BY code, trade_date ORDER BY i ROWS UNBOUNDED PRECEDING) AS sid FROM (SELECT *, row_number() OVER (PARTITION BY code, trade_date ORDER BY i, b DESC) AS rn FROM g)),
x AS (SELECT code, CAST(trade_date AS TIMESTAMP) + to_minutes(CAST(min(i) AS INT)) AS f, CAST(trade_date AS TIMESTAMP) + to_minutes(CAST(max(i) AS INT)) AS l, count(*) AS ticks FROM
  (SELECT g.code, g.trade_date, g.i, (SELECT count(DISTINCT h.i) FROM g h WHERE h.code = g.code AND h.trade_date = g.trade_date AND h.b = 1 AND h.i <= g.i) AS sid FROM g) GROUP BY code, trade_date, sid)
SELECT code, CAST(f AS VARCHAR) AS first_ts, CAST(l AS VARCHAR) AS last_ts, ticks FROM x""",
        "fx_sticks",
    ),
)
def strm_quality(spark, d):
    path = scratch_dir(spark, "strm-quality")
    ev = _stream(spark, d, "events")
    u = F.col("user_id") % 10
    idx = F.floor((F.hour("ts") * 3600 + F.minute("ts") * 60 + F.floor(F.second("ts"))) * 242 / 86400).cast("int")
    m = F.when(idx <= 120, idx + 570).otherwise(idx - 121 + 780)
    day = F.to_date(F.date_trunc("week", "ts")).cast("timestamp_ntz")
    ticks = ev.select(
        code_of(F.when(u < 5, 0).otherwise(u)).alias("code"), (day + F.make_dt_interval(F.lit(0), F.lit(0), m)).alias("session_ts")
    )
    ticks = ticks.select("code", jobs.trading_axis(F.col("session_ts")).alias("ts"))
    od.run_to_end(lambda: jobs.activity_sessions(od.with_end_marks(ticks, "ts", path)), "ts", END, path)
    out = spark.read.parquet(f"{path}/data")
    return out.select("code", F.col("first_ts").cast("string").alias("first_ts"), F.col("last_ts").cast("string").alias("last_ts"), "ticks")


@query("strm_lifecycle", f"WITH RECURSIVE {_ENTRY} SELECT entity, seq, to_state, from_state, legal, state_after FROM rp")
def strm_lifecycle(spark, d):
    path = scratch_dir(spark, "strm-lifecycle")
    e, n = F.col("conv_id"), F.col("turn")
    jump = _at(tuple(lc.ENTRY_TRANSITIONS), (e * 7 + n) % 14)
    step = _at(_PATH, n % len(_PATH))
    ev = _stream(spark, d, "conversations").select(
        e.alias("entity"), n.alias("seq"), F.when((e + n) % 4 == 3, jump).otherwise(step).alias("to_state")
    )
    # a turn counts as a second; a block has eight turns
    ev = ev.withColumn("ts", F.timestamp_seconds("seq"))
    return run_lifecycle(ev, path, "8 seconds", "1 hour")


@query(
    "strm_health",
    with_bindings(
        """WITH r AS (SELECT *, count(CASE WHEN ok THEN 1 END) OVER (PARTITION BY source ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS g FROM fx_calls),
f AS (SELECT *, count(CASE WHEN NOT ok THEN 1 END) OVER (PARTITION BY source, g ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS failures FROM r)
SELECT source, seq, failures, CAST(ts + INTERVAL 300 SECOND AS VARCHAR) AS disabled_until FROM f WHERE NOT ok AND failures >= 3""",
        "fx_calls",
    ),
)
def strm_health(spark, d):
    path = scratch_dir(spark, "strm-health")
    calls = _stream(spark, d, "orders").select(
        F.col("o_orderpriority").alias("source"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        (F.col("o_orderstatus") != "F").alias("ok"),
    )
    return run_health(calls, path, "7 days", "1 day").withColumn("disabled_until", F.col("disabled_until").cast("string"))


@query(
    "strm_increments",
    ORACLES["min_to_ohlcv"],
)
def strm_increments(spark, d):
    """The cumulative rows of the minute feed, read as a stream."""
    path = scratch_dir(spark, "strm-increments")
    feed = materialize(spark, cumulative(spark, d), "cumulative-feed")
    rows = spark.readStream.schema(feed.schema).parquet(feed.inputFiles()[0].rsplit("/", 1)[0])
    out = run_increments(rows, path, "1 hour", "1 day")
    out = out.select("code", "trade_date", "ts", "open", "high", "low", "close", "volume", "amount", "cum_volume")
    for c in ("open", "high", "low", "close", "amount"):
        out = out.withColumn(c, dbl(c))
    return _s(out, "ts")
