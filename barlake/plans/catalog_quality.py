"""Audit and calendar queries with their check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlake.functions import session_time as st
from barlake.functions.numeric import dbl, round_dec
from barlake.operators import merges as mg
from barlake.operators import minutes as mn
from barlake.operators import quality as dq
from barlake.plans.bindings import bars, calls, code_of, dims, r2, session_bars, snapshot, table, ticks, with_bindings
from barlake.plans.catalog_merges import _CLASS, _class_sides, classification
from barlake.plans.registry import query

# -- calendar ---------------------------------------------------------------------


def _clock(spark, d):
    """Event times plus an open-day flag with a holiday."""
    return ticks(spark, d).select(
        F.col("seq"), "ts", F.when(F.to_date("ts") == F.lit("2024-01-15").cast("date"), False).alias("is_open")
    )


_OPEN = "coalesce(CASE WHEN CAST(ts AS DATE) = DATE '2024-01-15' THEN false END, isodow(ts) < 6)"
_S = "(extract(hour FROM ts) * 3600 + extract(minute FROM ts) * 60 + floor(extract(second FROM ts)))"


@query("cal_is_trading", f"SELECT event_id AS seq, {_OPEN} AS trading FROM events")
def cal_is_trading(spark, d):
    return _clock(spark, d).select("seq", st.trading_day(F.to_date("ts"), F.col("is_open")).alias("trading"))


@query("cal_session", f"SELECT event_id AS seq, {_OPEN} AND {_S} BETWEEN 33300 AND 55800 AS in_session FROM events")
def cal_session(spark, d):
    c = _clock(spark, d)
    return c.select("seq", st.in_market_session(F.col("ts"), st.trading_day(F.to_date("ts"), F.col("is_open"))).alias("in_session"))


@query(
    "cal_status",
    f"""SELECT event_id AS seq, CASE WHEN NOT {_OPEN} THEN 'non_trading_day' WHEN {_S} >= 41400 AND {_S} < 46800 THEN 'lunch_break' WHEN {_S} BETWEEN 34200 AND 54000 THEN 'live_session'
 WHEN {_S} > 54000 THEN 'post_close' ELSE 'pre_open' END AS status FROM events""",
)
def cal_status(spark, d):
    c = _clock(spark, d)
    return c.select("seq", st.session_status(F.col("ts"), st.trading_day(F.to_date("ts"), F.col("is_open"))).alias("status"))


@query(
    "cal_phase",
    f"""SELECT event_id AS seq, CASE WHEN {_S} <= 41400 THEN 'intraday_1300' WHEN {_S} < 46800 THEN 'lunch_break' WHEN {_S} < 50400 THEN 'intraday_1300' WHEN {_S} < 52200 THEN 'intraday_1400'
 WHEN {_S} < 54000 THEN 'intraday_1430' ELSE 'post_close' END AS phase FROM events""",
)
def cal_phase(spark, d):
    return ticks(spark, d).select("seq", st.session_phase(F.col("ts")).alias("phase"))


@query(
    "cal_elapsed",
    f"""SELECT event_id AS seq, CAST(CASE WHEN NOT {_OPEN} THEN 240 ELSE least(greatest(m - 570, 0), 120) + least(greatest(m - 780, 0), 120) END AS INT) AS elapsed
FROM (SELECT *, extract(hour FROM ts) * 60 + extract(minute FROM ts) AS m FROM events)""",
)
def cal_elapsed(spark, d):
    c = _clock(spark, d)
    return c.select("seq", st.elapsed_minutes(F.col("ts"), st.trading_day(F.to_date("ts"), F.col("is_open"))).alias("elapsed"))


@query(
    "cal_prev_day",
    """WITH c AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS dt FROM lineitem WHERE isodow(l_shipdate) < 6),
o AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders), p AS (SELECT d, (SELECT max(dt) FROM c WHERE dt < d) AS po FROM o)
SELECT CAST(d AS VARCHAR) AS d, CAST(po AS VARCHAR) AS prev_open, po = d - 1 AS prev_is_yesterday, CAST(d - CASE isodow(d) WHEN 1 THEN 3 WHEN 7 THEN 2 ELSE 1 END AS VARCHAR) AS prev_weekday FROM p WHERE po IS NOT NULL""",
)
def cal_prev_day(spark, d):
    cal = table(spark, d, "lineitem").select(F.col("l_shipdate").cast("date").alias("dt")).where(F.weekday("dt") < 5).distinct()
    dense = mg.dense_calendar(cal).select(F.date_add("day", 1).alias("d"), F.col("last_open").alias("prev_open"))
    o = table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    return o.join(dense, "d").select(
        F.col("d").cast("string").alias("d"),
        F.col("prev_open").cast("string").alias("prev_open"),
        (F.col("prev_open") == F.date_sub("d", 1)).alias("prev_is_yesterday"),
        dq.previous_weekday(F.col("d")).cast("string").alias("prev_weekday"),
    )


# -- snapshot audits --------------------------------------------------------------

_OBS = "2001-11-02 10:30:00"  # a Friday, in session


def _audit_rows(spark, d):
    """Snapshot with quote times in many shapes, some codes invalid, some repeated, some prices missing."""
    k = F.col("k")
    s = snapshot(spark, d)
    quote = (
        F.when(k % 8 == 0, "10:29:30")
        .when(k % 8 == 1, "10:05")
        .when(k % 8 == 2, "20011102101500")
        .when(k % 8 == 3, "2001-11-01T14:59:00")
        .when(k % 8 == 4, " ")
        .when(k % 8 == 5, "soon")
        .when(k % 8 == 6, "2001-11-02T02:20:00Z")
        .otherwise("2001-10-02 09:00:00")
    )
    rows = s.select(
        F.when(k % 13 == 5, "12x").otherwise(F.col("code")).alias("code"),
        "market",
        "name",
        F.when(k % 11 != 4, F.col("price").cast("string")).otherwise("nan").alias("price"),
        F.when(k % 9 == 1, 0.0).otherwise(dbl("volume")).alias("volume"),
        dbl("amount").alias("amount"),
        "turnover_rate",
        "volume_ratio",
        quote.alias("quote_time"),
        F.when(k % 6 == 2, "2001-11-02 10:00:00").otherwise("2001-11-02 10:25:00").alias("observed_at"),
        "source",
        "industry",
        "k",
    )
    return rows.unionByName(rows.where(k % 10 == 3))


_AUD = """a0 AS (SELECT k, CASE WHEN k % 13 = 5 THEN '12x' ELSE code END AS code, market, name, CASE WHEN k % 11 <> 4 THEN CAST(price AS DOUBLE) END AS price,
 CASE WHEN k % 9 = 1 THEN 0 ELSE CAST(volume AS DOUBLE) END AS volume, CAST(amount AS DOUBLE) AS amount, turnover_rate, volume_ratio, source, industry,
 CASE k % 8 WHEN 0 THEN TIMESTAMP '2001-11-02 10:29:30' WHEN 1 THEN TIMESTAMP '2001-11-02 10:05:00' WHEN 2 THEN TIMESTAMP '2001-11-02 10:15:00' WHEN 3 THEN TIMESTAMP '2001-11-01 14:59:00'
  WHEN 6 THEN TIMESTAMP '2001-11-02 10:20:00' WHEN 7 THEN TIMESTAMP '2001-10-02 09:00:00' END AS qt,
 ['10:29:30','10:05','20011102101500','2001-11-01T14:59:00',NULL,'soon','2001-11-02T02:20:00Z','2001-10-02 09:00:00'][k % 8 + 1] AS qtext,
 CASE WHEN k % 6 = 2 THEN TIMESTAMP '2001-11-02 10:00:00' ELSE TIMESTAMP '2001-11-02 10:25:00' END AS oa FROM fx_snapshot),
a AS (SELECT *, length(code) = 6 AS ok, TIMESTAMP '2001-11-02 10:30:00' - coalesce(qt, oa) > INTERVAL 15 MINUTE AS stale FROM (SELECT * FROM a0 UNION ALL SELECT * FROM a0 WHERE k % 10 = 3))"""


@query(
    "dq_snapshot",
    with_bindings(
        f"""WITH {_AUD}, g AS (SELECT count(*) AS total_rows, count(DISTINCT CASE WHEN ok THEN code END) AS unique_code_count, count(CASE WHEN ok THEN 1 END) - count(DISTINCT CASE WHEN ok THEN code END) AS duplicate_code_count,
 count(CASE WHEN NOT ok THEN 1 END) AS invalid_code_count, count(CASE WHEN market = 'sh' AND ok THEN 1 END) AS sh_rows, count(CASE WHEN market = 'sz' AND ok THEN 1 END) AS sz_rows, count(CASE WHEN market = 'bj' AND ok THEN 1 END) AS bj_rows,
 count(*) - count(price) AS missing_price_count, count(CASE WHEN stale THEN 1 END) AS stale_row_count, max(qtext) AS latest_quote_time FROM a)
SELECT 'live_session' AS trading_status, *, concat_ws('|', CASE WHEN sh_rows = 0 THEN 'missing_market_sh' END, CASE WHEN sz_rows = 0 THEN 'missing_market_sz' END, CASE WHEN bj_rows = 0 THEN 'missing_market_bj' END,
 CASE WHEN duplicate_code_count > 0 THEN 'duplicate_code_count=' || duplicate_code_count END, CASE WHEN invalid_code_count > 0 THEN 'invalid_code_count=' || invalid_code_count END,
 CASE WHEN missing_price_count > 0 THEN 'missing_price_count=' || missing_price_count END, CASE WHEN stale_row_count > 0 THEN 'stale_row_count=' || stale_row_count END, 'provider_error_count=2') AS coverage_gaps FROM g""",
        "fx_snapshot",
    ),
)
def dq_snapshot(spark, d):
    a = dq.snapshot_audit(_audit_rows(spark, d), _OBS, provider_errors=2)
    return a.withColumn("coverage_gaps", F.array_join("coverage_gaps", "|"))


_COV = ["price", "volume", "turnover_rate", "volume_ratio", "quote_time", "source", "industry", "is_st"]


@query(
    "dq_snapshot_fields",
    with_bindings(
        f"""WITH {_AUD}, n AS (SELECT count(*)::DOUBLE AS n FROM a), f AS (SELECT 'price' AS field, count(price) AS non_null FROM a UNION ALL SELECT 'volume', count(volume) FROM a
 UNION ALL SELECT 'turnover_rate', count(turnover_rate) FROM a UNION ALL SELECT 'volume_ratio', count(volume_ratio) FROM a UNION ALL SELECT 'quote_time', count(qtext) FROM a
 UNION ALL SELECT 'source', count(source) FROM a UNION ALL SELECT 'industry', count(industry) FROM a UNION ALL SELECT 'is_st', 0)
SELECT field, non_null, non_null / n AS coverage FROM f, n""",
        "fx_snapshot",
    ),
)
def dq_snapshot_fields(spark, d):
    return dq.field_coverage(_audit_rows(spark, d), _COV)


@query(
    "dq_snapshot_markets",
    with_bindings(
        f"""WITH {_AUD} SELECT m AS market, count(a.k) AS declared_count, count(CASE WHEN ok THEN 1 END) AS actual_count, count(DISTINCT CASE WHEN ok THEN code END) AS unique_count,
 count(CASE WHEN ok THEN 1 END) - count(DISTINCT CASE WHEN ok THEN code END) AS duplicate_count, count(a.k) - count(CASE WHEN ok THEN 1 END) AS missing_count
FROM (SELECT unnest(['sh', 'sz', 'bj']) AS m) LEFT JOIN a ON a.market = m GROUP BY m""",
        "fx_snapshot",
    ),
)
def dq_snapshot_markets(spark, d):
    return dq.market_detail(_audit_rows(spark, d))


_FRESH = """CASE k % 8 WHEN 0 THEN 'current|intraday' WHEN 1 THEN 'stale|intraday' WHEN 2 THEN 'current|intraday' WHEN 3 THEN 'stale|historical' WHEN 4 THEN 'unknown|unknown' WHEN 5 THEN 'unknown|unknown'
 WHEN 6 THEN 'current|intraday' ELSE 'stale|stale' END"""


@query(
    "dq_freshness",
    with_bindings(
        f"WITH {_AUD}, f AS (SELECT {_FRESH} AS p FROM a) SELECT split_part(p, '|', 1) AS freshness, split_part(p, '|', 2) AS quote_status, count(*) AS rows FROM f GROUP BY p", "fx_snapshot"
    ),
)
def dq_freshness(spark, d):
    return dq.freshness_summary(_audit_rows(spark, d), _OBS)


@query(
    "dq_freshness_rows",
    with_bindings(
        """SELECT code, k, 'non_trading_day' AS trading_status, CASE WHEN k % 8 IN (0, 1, 2, 6) THEN CASE WHEN k % 8 IN (0, 1) THEN 'current' ELSE 'current' END WHEN k % 8 IN (4, 5) THEN 'unknown' ELSE 'stale' END AS freshness,
 CASE WHEN k % 8 IN (0, 1, 2, 6) THEN 'historical' WHEN k % 8 IN (4, 5) THEN 'unknown' ELSE 'stale' END AS quote_status FROM (SELECT k, CASE WHEN k % 13 = 5 THEN '12x' ELSE code END AS code FROM fx_snapshot)""",
        "fx_snapshot",
    ),
)
def dq_freshness_rows(spark, d):
    # Sunday 2001-11-04: quotes of Friday count as the latest close
    rows = _audit_rows(spark, d).distinct()
    return dq.quote_freshness(rows, "2001-11-04 10:30:00").select("code", "k", "trading_status", "freshness", "quote_status")


@query(
    "dq_stale_rows",
    with_bindings(
        f"""WITH {_AUD} SELECT count(*) AS total_rows, count(CASE WHEN TIMESTAMP '2001-11-02 16:30:00' - coalesce(qt, oa) > INTERVAL 15 MINUTE AND CAST(coalesce(qt, oa) AS DATE) <> DATE '2001-11-02' THEN 1 END) AS stale_rows FROM a""",
        "fx_snapshot",
    ),
)
def dq_stale_rows(spark, d):
    return dq.stale_rows(_audit_rows(spark, d), "2001-11-02 16:30:00")


@query(
    "dq_conditions",
    with_bindings(
        f"""WITH {_AUD} SELECT 'zero_volume_with_valid_price' AS condition, code FROM a WHERE volume = 0 AND price IS NOT NULL AND ok
UNION ALL SELECT 'volume_ratio_unavailable', code FROM a WHERE price IS NOT NULL AND qtext IS NOT NULL AND volume_ratio IS NULL AND ok""",
        "fx_snapshot",
    ),
)
def dq_conditions(spark, d):
    return dq.known_conditions(_audit_rows(spark, d))


@query(
    "dq_segment_coverage",
    with_bindings(
        """WITH e AS (SELECT coalesce(market, 'none') AS segment, code, k FROM fx_dims),
c AS (SELECT segment, 'p1' AS source, 1 AS p, false AS cache, code FROM e WHERE k % 4 = 0 UNION ALL SELECT segment, 'p2', 2, false, code FROM e WHERE segment <> 'bj' AND k % 3 <> 0 UNION ALL SELECT segment, 'old', 9, true, code FROM e WHERE k % 2 = 0),
g AS (SELECT *, CASE WHEN cache THEN true ELSE n >= 13 END AS usable FROM (SELECT segment, source, p, cache, count(*) AS n FROM c GROUP BY ALL)),
b AS (SELECT segment, min_by(source, (cache, p)) AS source, min_by(n, (cache, p)) AS n, min_by(cache, (cache, p)) AS cache FROM g WHERE usable GROUP BY segment),
x AS (SELECT segment, string_agg(source || ': rows=' || n, '|' ORDER BY source || ': rows=' || n) AS errors FROM g WHERE NOT usable GROUP BY segment)
SELECT w.segment, w.expected, coalesce(b.n, 0) AS actual, greatest(w.expected - coalesce(b.n, 0), 0) AS missing, coalesce(b.source, '') AS source, coalesce(b.cache, false) AS is_stale, coalesce(x.errors, '') AS errors
FROM (SELECT segment, count(*) AS expected FROM e GROUP BY segment) w LEFT JOIN b ON b.segment = w.segment LEFT JOIN x ON x.segment = w.segment""",
        "fx_dims",
    ),
)
def dq_segment_coverage(spark, d):
    k = F.col("k")
    e = dims(spark, d).select(F.coalesce("market", F.lit("none")).alias("segment"), "code", "k")

    def feed(rows, name, p, cache):
        return rows.select("segment", F.lit(name).alias("source"), F.lit(p).alias("priority"), F.lit(cache).alias("is_cache"), "code")

    got = (
        feed(e.where(k % 4 == 0), "p1", 1, False)
        .unionByName(feed(e.where((F.col("segment") != "bj") & (k % 3 != 0)), "p2", 2, False))
        .unionByName(feed(e.where(k % 2 == 0), "old", 9, True))
    )
    out = dq.segment_coverage(e.select("segment", "code"), got, 13)
    return out.withColumn("errors", F.array_join("errors", "|"))


@query(
    "dq_live_guard",
    with_bindings(
        """SELECT count(*) AS rows, '2001-11-02 10:10:00' AS newest, CASE WHEN count(*) < 1000 THEN 'rows_below_minimum,' ELSE '' END || 'missing_market_xx,too_old' AS broken, false AS accepted FROM fx_snapshot""",
        "fx_snapshot",
    ),
)
def dq_live_guard(spark, d):
    s = snapshot(spark, d).select("market", F.when(F.col("k") % 2 == 0, "2001-11-02 10:10:00").otherwise("2001-11-02 09:50:00").alias("timestamp"))
    g = dq.live_guard(s, _OBS, 1000, ("sh", "xx"))
    return g.select("rows", F.col("newest").cast("string").alias("newest"), F.array_join("broken", ",").alias("broken"), "accepted")


_CLASSX = _CLASS.replace("sname END AS sname", "d.sname END AS sname").replace("FROM fx_dims", "FROM fx_dims d")


@query(
    "dq_class_audit",
    with_bindings(
        f"""WITH {_CLASSX}
SELECT 'total_snapshot_rows' AS metric, '' AS key, count(*) AS value FROM fx_dims UNION ALL SELECT 'duplicate_code_count', '', 0 UNION ALL SELECT 'invalid_code_count', '', count(*) FROM fx_dims WHERE k % 20 = 7
UNION ALL SELECT 'output_rows', '', count(*) FROM cls UNION ALL SELECT 'covered_count', '', count(*) FROM cls WHERE coverage_status = 'covered' UNION ALL SELECT 'missing_count', '', count(*) FROM cls WHERE coverage_status = 'missing'
UNION ALL SELECT 'industry_coverage_count', '', count(*) FROM cls WHERE industry <> '' UNION ALL SELECT 'concepts_coverage_count', '', count(*) FROM cls WHERE concepts <> '' UNION ALL SELECT 'supply_chain_coverage_count', '', count(*) FROM cls WHERE supply_chain <> ''
UNION ALL SELECT 'industry_source', industry_source, count(*) FROM cls GROUP BY industry_source UNION ALL SELECT 'concepts_source', concepts_source, count(*) FROM cls GROUP BY concepts_source UNION ALL SELECT 'supply_chain_source', supply_chain_source, count(*) FROM cls GROUP BY supply_chain_source""",
        "fx_dims",
    ),
)
def dq_class_audit(spark, d):
    return dq.classification_audit(_class_sides(spark, d)[0], classification(spark, d))


@query(
    "dq_upstream_dups",
    """SELECT count(CASE WHEN o_custkey % 9 <> 0 THEN 1 END) - count(DISTINCT CASE WHEN o_custkey % 9 <> 0 THEN o_custkey END) AS duplicates, count(CASE WHEN o_custkey % 9 = 0 THEN 1 END) AS invalid FROM orders""",
)
def dq_upstream_dups(spark, d):
    k = F.col("o_custkey")
    return dq.upstream_duplicates(
        table(spark, d, "orders").select(F.when(k % 9 == 0, "abc").otherwise(code_of(k)).alias("code"))
    )


_MQ = """CASE WHEN status = 'not_requested' THEN 'not_requested' WHEN append_error <> '' OR sequence_error <> '' THEN 'failed' WHEN status <> 'collected' THEN 'failed' WHEN actual = 0 THEN 'failed' WHEN actual < 240 * 0.2::DOUBLE THEN 'static_only'
 WHEN actual >= greatest(240 * 0.83::DOUBLE, 200) AND miss <= 40 AND brk <= 3 THEN 'full' ELSE 'partial' END"""


@query(
    "dq_minute_quality",
    with_bindings(
        f"""WITH b AS (SELECT code, trade_date, count(*) AS actual, min(m) AS lo, max(m) AS hi FROM fx_session GROUP BY code, trade_date),
n AS (SELECT b.code, b.trade_date, x.m FROM b JOIN (SELECT unnest(range(570, 901)) AS m) x ON x.m >= lo AND x.m < hi AND NOT (x.m >= 690 AND x.m < 780)),
ms AS (SELECT n.code, n.trade_date, count(*) AS miss FROM n LEFT JOIN fx_session s ON s.code = n.code AND s.trade_date = n.trade_date AND s.m = n.m WHERE s.m IS NULL GROUP BY n.code, n.trade_date),
gp AS (SELECT code, trade_date, m - lag(m) OVER (PARTITION BY code, trade_date ORDER BY m) AS g FROM fx_session),
bk AS (SELECT code, trade_date, count(CASE WHEN g > 2 AND g <> 90 THEN 1 END) AS brk FROM gp GROUP BY code, trade_date),
q AS (SELECT b.code, b.trade_date, actual, coalesce(miss, 0) AS miss, brk, CASE WHEN b.code = '000005' THEN 'error' WHEN b.code = '000006' THEN 'not_requested' ELSE 'collected' END AS status,
  CASE WHEN b.code IN ('000006', '000007') AND day(b.trade_date) % 2 = 0 THEN 'append refused' END AS append_error, CASE WHEN b.code = '000008' THEN CASE WHEN day(b.trade_date) > 20 THEN 'unreadable sequence' ELSE '' END END AS sequence_error
  FROM b JOIN bk ON bk.code = b.code AND bk.trade_date = b.trade_date LEFT JOIN ms ON ms.code = b.code AND ms.trade_date = b.trade_date)
SELECT code, CAST(trade_date AS VARCHAR) AS trade_date, actual AS actual_minutes, {_MQ} AS minute_quality FROM q""",
        "fx_session",
    ),
)
def dq_minute_quality(spark, d):
    # one audit per code: the code takes the place of the date in the sequence audit
    b = session_bars(spark, d)
    key = F.concat_ws("|", "code", F.col("trade_date").cast("string"))
    audit = mn.sequence_audit(b.withColumn("trade_date", key))
    parts = F.split("trade_date", r"\|")
    status = F.when(parts[0] == "000005", "error").when(parts[0] == "000006", "not_requested").otherwise("collected")
    day = F.dayofmonth(parts[1].cast("date"))
    errors = {
        "append_error": F.when(parts[0].isin("000006", "000007") & (day % 2 == 0), "append refused"),
        "sequence_error": F.when(parts[0] == "000008", F.when(day > 20, "unreadable sequence").otherwise("")),
    }
    q = dq.minute_quality(audit.withColumns({"status": status, **errors}))
    return q.select(parts[0].alias("code"), parts[1].alias("trade_date"), "actual_minutes", "minute_quality")


def _grade_input(spark, d):
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    pick = lambda n, *v: F.element_at(F.array(*[F.lit(x) for x in v]), (k % n % len(v) + 1).cast("int"))
    return o.select(
        k.alias("run_id"),
        pick(97, "post_close", "intraday_1300", "intraday_1400", "post_close", "lunch_break", "post_close", "weird").alias("phase"),
        pick(89, "full", "partial", "static_only", "full", "failed", "not_requested").alias("minute_quality"),
        F.when(k % 53 == 0, "partial").otherwise("ok").alias("market_status"),
        F.when(k % 13 == 0, F.array(F.lit("provider_error_count=1"), F.lit("stale_row_count=2")))
        .when(k % 13 == 1, F.array(F.lit("provider_error_count=1")))
        .otherwise(F.array().cast("array<string>"))
        .alias("coverage_gaps"),
        (F.lit(1.0) - (k % 7) / 100.0).alias("market_coverage"),
        (F.lit(100) - k % 11).alias("daily_success"),
        F.when(k % 41 == 0, 300).otherwise(100).alias("daily_total"),
        (k % 5 * 10).alias("segment_total"),
        (k % 4).alias("segment_unavailable"),
        F.when(k % 59 == 0, 0).otherwise(100).alias("class_rows"),
        (F.lit(100) - k % 25).alias("class_covered"),
        (F.lit(40) + k % 60).alias("supply_filled"),
    )


@query(
    "dq_run_grade",
    """WITH r AS (SELECT o_orderkey AS k, ['post_close','intraday_1300','intraday_1400','post_close','lunch_break','post_close','weird'][o_orderkey % 97 % 7 + 1] AS phase,
 ['full','partial','static_only','full','failed','not_requested'][o_orderkey % 89 % 6 + 1] AS mq, 1::DOUBLE - (o_orderkey % 7) / 100::DOUBLE AS cov,
 (100 - o_orderkey % 11) / CASE WHEN o_orderkey % 41 = 0 THEN 300 ELSE 100 END::DOUBLE AS dr, o_orderkey % 5 * 10 AS st, (o_orderkey % 5 * 10 - o_orderkey % 4) / nullif(o_orderkey % 5 * 10, 0)::DOUBLE AS sr,
 (100 - o_orderkey % 25) / 100::DOUBLE AS cc, (40 + o_orderkey % 60) / 100::DOUBLE AS sc FROM orders),
s AS (SELECT *, concat_ws(',', CASE WHEN cc < 0.95::DOUBLE THEN 'classification_coverage_insufficient' END, CASE WHEN sc < 0.5::DOUBLE THEN 'supply_chain_coverage_insufficient' END) AS soft,
 cov < 0.95::DOUBLE OR dr < 0.95::DOUBLE OR (st > 0 AND sr < 0.8::DOUBLE) AS thin FROM r),
g AS (SELECT k, CASE WHEN phase = 'lunch_break' THEN 'data_not_ready|session_not_tradable' WHEN phase = 'weird' THEN 'data_not_ready|invalid_phase' WHEN k % 59 = 0 THEN 'data_not_ready|classification_missing'
 WHEN mq = 'failed' THEN 'data_not_ready|minute_failed' WHEN k % 53 = 0 THEN 'data_not_ready|market_coverage_insufficient' WHEN k % 13 = 0 THEN 'partial|field_coverage_below_threshold'
 WHEN cov < 0.5::DOUBLE OR dr < 0.5::DOUBLE THEN 'data_not_ready|market_coverage_insufficient' WHEN cc < 0.8::DOUBLE THEN 'partial|classification_coverage_insufficient'
 WHEN thin AND mq = 'static_only' THEN 'partial|' || concat_ws(',', 'minute_insufficient', nullif(soft, ''), 'daily_stale') WHEN thin THEN 'partial|' || concat_ws(',', nullif(soft, ''), 'daily_stale')
 WHEN mq = 'static_only' THEN 'data_ready_static_only|' || concat_ws(',', 'minute_insufficient', nullif(soft, '')) WHEN mq = 'partial' THEN 'data_ready_static_only|' || concat_ws(',', 'minute_coverage_below_threshold', nullif(soft, ''))
 WHEN soft <> '' THEN 'partial|' || soft ELSE 'data_ready|' END AS x FROM s)
SELECT k AS run_id, split_part(x, '|', 1) AS quality_status, split_part(x, '|', 2) AS reasons FROM g""",
)
def dq_run_grade(spark, d):
    g = dq.run_grade(_grade_input(spark, d))
    return g.select("run_id", "quality_status", F.array_join("reasons", ",").alias("reasons"))


_EXP = "2001-10-30"


def _latest(spark, d):
    k = F.col("code").cast("bigint")
    per = bars(spark, d).groupBy("code").agg(F.max("dt").alias("latest_date"), F.count(F.lit(1)).alias("actual_rows"))
    return per.select(
        "code",
        F.when(k % 3 == 0, F.lit(_EXP).cast("date")).otherwise(F.col("latest_date")).alias("latest_date"),
        (F.col("actual_rows") - k % 400).alias("actual_rows"),
        (k % 7 == 1).alias("failed"),
        F.when(k % 5 == 0, "").otherwise("10:00").alias("quote_time"),
    )


_LATEST = """l AS (SELECT code, CAST(code AS BIGINT) AS k, CASE WHEN CAST(code AS BIGINT) % 3 = 0 THEN DATE '2001-10-30' ELSE max(dt) END AS latest_date, count(*) - CAST(code AS BIGINT) % 400 AS n FROM fx_bars GROUP BY code),
f AS (SELECT code, k, latest_date, k % 7 = 1 AS is_failed, latest_date <> DATE '2001-10-30' AND k % 7 <> 1 AS is_stale, n < 250 AS is_short, k % 5 = 0 AND NOT (latest_date <> DATE '2001-10-30' AND k % 7 <> 1) AS unknown_quote_time FROM l)"""


@query(
    "dq_stale_daily",
    with_bindings(f"WITH {_LATEST} SELECT code, CAST(latest_date AS VARCHAR) AS latest_date, is_failed, is_stale, is_short, unknown_quote_time FROM f", "fx_bars"),
)
def dq_stale_daily(spark, d):
    return dq.stale_daily(_latest(spark, d), _EXP).withColumn("latest_date", F.col("latest_date").cast("string"))


@query(
    "dq_stale_daily_summary",
    with_bindings(
        f"""WITH {_LATEST} SELECT count(*) AS total_stocks, count(CASE WHEN latest_date <> DATE '2001-10-30' THEN 1 END) AS stale_count, count(CASE WHEN is_stale THEN 1 END) AS stale_codes_count, count(CASE WHEN is_failed THEN 1 END) AS failed_count,
 count(CASE WHEN is_short THEN 1 END) AS short_history_count, count(CASE WHEN unknown_quote_time THEN 1 END) AS unknown_quote_time_count,
 (SELECT string_agg(code, ',' ORDER BY code) FROM (SELECT code FROM f WHERE unknown_quote_time ORDER BY code LIMIT 3)) AS unknown_quote_time_codes, count(CASE WHEN unknown_quote_time THEN 1 END) > 3 AS unknown_quote_time_codes_truncated FROM f""",
        "fx_bars",
    ),
)
def dq_stale_daily_summary(spark, d):
    s = dq.stale_daily_summary(dq.stale_daily(_latest(spark, d), _EXP), _EXP, 3)
    return s.withColumn("unknown_quote_time_codes", F.array_join("unknown_quote_time_codes", ","))


@query(
    "dq_stale_daily_dates",
    with_bindings(f"WITH {_LATEST} SELECT CAST(latest_date AS VARCHAR) AS latest_date, count(*) AS codes FROM f WHERE latest_date <> DATE '2001-10-30' GROUP BY latest_date", "fx_bars"),
)
def dq_stale_daily_dates(spark, d):
    return dq.stale_by_date(dq.stale_daily(_latest(spark, d), _EXP), _EXP).withColumn("latest_date", F.col("latest_date").cast("string"))


@query(
    "dq_degrade_flags",
    with_bindings(
        f"""WITH {_LATEST}, z AS (SELECT s.code, s.k, coalesce(f.is_stale OR f.is_failed OR f.unknown_quote_time, false) AS bad FROM fx_dims s LEFT JOIN f ON f.code = s.code)
SELECT code, bad AS is_untradable, bad OR k % 6 = 0 AS is_incomparable, k % 2 = 0 AND NOT bad AS tradable FROM z""",
        "fx_bars",
        "fx_dims",
    ),
)
def dq_degrade_flags(spark, d):
    k = F.col("k")
    s = dims(spark, d)
    snap = s.select("code", F.when(k % 2 == 0, True).alias("tradable"))
    return dq.degrade_flags(snap, dq.stale_daily(_latest(spark, d), _EXP), s.where(k % 6 == 0))


@query(
    "dq_cache_fresh",
    with_bindings(
        """WITH l AS (SELECT code, CAST(code AS BIGINT) AS k, max(dt) AS dt FROM fx_bars GROUP BY code), x AS (SELECT code, k, CASE WHEN k % 9 <> 1 THEN dt END AS dt, date_diff('day', CASE WHEN k % 9 <> 1 THEN dt END, DATE '2001-11-02') AS b FROM l),
y AS (SELECT *, coalesce(b BETWEEN 0 AND 1, false) AS fresh FROM x), z AS (SELECT *, CASE WHEN fresh AND k % 4 <> 0 THEN 'reuse' WHEN fresh THEN 'full' WHEN coalesce(b <= 5, false) THEN 'tail' ELSE 'full' END AS plan FROM y)
SELECT code, CAST(dt AS VARCHAR) AS latest_date, CAST(b AS INT) AS days_behind, fresh AS is_fresh, plan, CAST(CASE WHEN plan = 'tail' THEN b + 3 END AS INT) AS tail_days FROM z""",
        "fx_bars",
    ),
)
def dq_cache_fresh(spark, d):
    k = F.col("code").cast("bigint")
    per = bars(spark, d).groupBy("code").agg(F.max("dt").cast("string").alias("latest_date"))
    cache = per.select("code", F.when(k % 9 == 1, "never").otherwise(F.col("latest_date")).alias("latest_date"), F.when(k % 4 == 0, 100).otherwise(260).alias("requested_lookback"))
    return dq.refresh_plan(cache, _OBS, 250).withColumn("latest_date", F.col("latest_date").cast("string"))


_HEALTH = f"""h AS (SELECT source, count(CASE WHEN ok THEN 1 END) AS successes, count(CASE WHEN NOT ok THEN 1 END) AS total_failures, max_by(rows, (ts, seq)) FILTER (WHERE ok) AS last_rows,
 CAST(sum(CAST(CASE WHEN ok THEN rows END AS DECIMAL(28,10))) AS DOUBLE) / nullif(count(CASE WHEN ok THEN 1 END), 0) AS avg_rows, max((ts, seq)) FILTER (WHERE ok) AS lo, max(ts) FILTER (WHERE ok) AS ls, max(ts) FILTER (WHERE NOT ok) AS lf FROM c GROUP BY source),
r AS (SELECT c.source, count(*) AS failures, max(ts) AS lt FROM c JOIN h ON h.source = c.source WHERE NOT ok AND (lo IS NULL OR (ts, seq) > lo) GROUP BY c.source),
hh AS (SELECT h.source, successes, coalesce(failures, 0) AS failures, total_failures, coalesce(last_rows, 0) AS last_rows, {r2('coalesce(avg_rows, 0)', 4)} AS avg_rows, coalesce(failures >= 3 AND 300 - date_diff('second', lt, TIMESTAMP '2001-08-01 00:04:00') > 0, false) AS disabled,
 CASE WHEN failures >= 3 AND 300 - date_diff('second', lt, TIMESTAMP '2001-08-01 00:04:00') > 0 THEN 300 - date_diff('second', lt, TIMESTAMP '2001-08-01 00:04:00') ELSE 0 END AS cooldown_remaining_seconds, ls, lf FROM h LEFT JOIN r ON r.source = h.source)"""
_CALLS = "c AS (SELECT seq, source || CAST(seq % 40 AS VARCHAR) AS source, CASE WHEN ts >= TIMESTAMP '2001-06-01' THEN TIMESTAMP '2001-08-01 00:00:00' ELSE ts END AS ts, ok, rows FROM fx_calls)"


def _calls(spark, d):
    """Five priorities split into feeds; the last two months are pressed into one moment."""
    t = F.when(F.col("ts") >= "2001-06-01", F.lit("2001-08-01 00:00:00").cast("timestamp_ntz")).otherwise(F.col("ts").cast("timestamp_ntz"))
    return calls(spark, d).select("seq", F.concat("source", (F.col("seq") % 40).cast("string")).alias("source"), t.alias("ts"), "ok", "rows")


@query(
    "dq_source_health",
    with_bindings(
        f"""WITH {_CALLS}, {_HEALTH} SELECT source, successes, failures, total_failures, last_rows, avg_rows, disabled, CAST(cooldown_remaining_seconds AS BIGINT) AS cooldown_remaining_seconds, CAST(CAST(ls AS DATE) AS VARCHAR) AS last_success_on, CAST(CAST(lf AS DATE) AS VARCHAR) AS last_failure_on FROM hh""",
        "fx_calls",
    ),
)
def dq_source_health(spark, d):
    h = dq.source_health(_calls(spark, d), "2001-08-01 00:04:00")
    return h.withColumn("avg_rows", round_dec("avg_rows", 4)).select(
        "source", "successes", "failures", "total_failures", "last_rows", "avg_rows", "disabled", "cooldown_remaining_seconds",
        F.to_date("last_success_at").cast("string").alias("last_success_on"), F.to_date("last_failure_at").cast("string").alias("last_failure_on"),
    )


@query(
    "dq_source_order",
    with_bindings(
        f"""WITH {_CALLS}, {_HEALTH}, df AS (SELECT source, CAST(row_number() OVER (ORDER BY source DESC) AS INT) AS default_position FROM (SELECT DISTINCT source FROM c))
SELECT df.source, CAST(row_number() OVER (ORDER BY disabled, failures, default_position) AS INT) AS position, default_position FROM df JOIN hh ON hh.source = df.source""",
        "fx_calls",
    ),
)
def dq_source_order(spark, d):
    from pyspark.sql import Window

    c = _calls(spark, d)
    defaults = c.select("source").distinct().withColumn(
        "default_position", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.col("source").desc()))
    )
    return dq.source_order(dq.source_health(c, "2001-08-01 00:04:00"), defaults)


@query(
    "dq_error_summary",
    """SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'daily' WHEN o_orderkey % 3 = 1 THEN 'indicators' ELSE 'classification' END AS scope, count(*) AS failures, count(DISTINCT replace(o_orderpriority, 'x', 'x')) AS messages FROM orders WHERE o_orderstatus = 'F' GROUP BY 1""",
)
def dq_error_summary(spark, d):
    k = F.col("o_orderkey")
    scope = F.when(k % 3 == 0, "daily").when(k % 3 == 1, "indicators").otherwise("classification")
    msg = F.concat(F.when(k % 2 == 0, "no BUY ").otherwise("no sell "), F.col("o_orderpriority"))
    return dq.error_summary(table(spark, d, "orders").where("o_orderstatus = 'F'").select(scope.alias("scope"), msg.alias("message")))


@query(
    "dq_evidence_hash",
    """SELECT o_orderkey AS k, left(sha256('{"a_key": ' || o_orderkey || ', "note": ' || CASE WHEN o_orderkey % 4 = 0 THEN 'null' ELSE '"' || o_orderpriority || '"' END || ', "status": "' || o_orderstatus || '"}'), 16) AS evidence_id FROM orders""",
)
def dq_evidence_hash(spark, d):
    o = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("a_key"), F.col("o_orderstatus").alias("status"), F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority")).alias("note")
    )
    return dq.evidence_hash(o, ["status", "note", "a_key"]).select(F.col("a_key").alias("k"), "evidence_id")
