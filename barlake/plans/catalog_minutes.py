"""Minute queries and their check SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from barlake.functions.numeric import dbl
from barlake.operators import minutes as mn
from barlake.plans.bindings import code_of, r2, session_bars, session_days, session_ticks, table, with_bindings
from barlake.plans.registry import query

_D = "CAST(trade_date AS VARCHAR) AS trade_date"
_HM = "lpad(CAST(floor({0} / 60) AS INT)::VARCHAR, 2, '0') || ':' || lpad(CAST({0} % 60 AS VARCHAR), 2, '0')"


def _s(df, *times):
    """Dates and times as text so that both engines print them alike."""
    for c in ("trade_date", *times):
        df = df.withColumn(c, F.col(c).cast("string"))
    return df


def cumulative(spark, d):
    """Session bars as cumulative rows; every 37th minute counter falls back (a feed reset)."""
    w = Window.partitionBy("code", "trade_date").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    reset = F.minute("ts") % 37 == 0
    v, a = F.sum("volume").over(w), F.sum("amount").over(w)
    return session_bars(spark, d).select(
        "code",
        "trade_date",
        "ts",
        F.col("close").alias("price"),
        F.when(reset, F.floor(v / 2)).otherwise(v).cast("bigint").alias("volume"),
        a.cast("decimal(28,2)").alias("amount"),
    )


_CUM = """cum AS (SELECT code, trade_date, ts, m, close AS price,
  CAST(CASE WHEN m % 60 % 37 = 0 THEN floor(sum(volume) OVER w / 2) ELSE sum(volume) OVER w END AS BIGINT) AS volume, sum(amount) OVER w AS amount
 FROM fx_session WINDOW w AS (PARTITION BY code, trade_date ORDER BY ts))"""


@query(
    "min_to_ohlcv",
    with_bindings(
        f"""WITH {_CUM}, x AS (SELECT *, lag(price) OVER w AS op, volume - lag(volume) OVER w AS dv, amount - lag(amount) OVER w AS da
 FROM cum WINDOW w AS (PARTITION BY code, trade_date ORDER BY ts))
SELECT code, {_D}, CAST(ts AS VARCHAR) AS ts, CAST(op AS DOUBLE) AS open, CAST(greatest(op, price) AS DOUBLE) AS high,
 CAST(least(op, price) AS DOUBLE) AS low, CAST(price AS DOUBLE) AS close, dv AS volume, CAST(da AS DOUBLE) AS amount, volume AS cum_volume
FROM x WHERE dv >= 0 AND da >= 0""",
        "fx_session",
    ),
)
def min_to_ohlcv(spark, d):
    b = mn.bars_from_cumulative(cumulative(spark, d)).drop("cum_amount")
    for c in ("open", "high", "low", "close", "amount"):
        b = b.withColumn(c, dbl(c))
    return _s(b, "ts")


@query(
    "min_vwap_running",
    with_bindings(
        f"""WITH x AS (SELECT code, trade_date, ts, CAST(close AS DOUBLE) AS price,
  CAST(sum(amount) OVER u AS DOUBLE) / nullif(CAST(sum(volume) OVER u AS DOUBLE), 0) AS vwap,
  CASE WHEN m >= 780 THEN CAST(sum(CASE WHEN m >= 780 THEN amount END) OVER u AS DOUBLE) / nullif(CAST(sum(CASE WHEN m >= 780 THEN volume END) OVER u AS DOUBLE), 0) END AS anchored_vwap,
  CAST(volume - lag(volume, 3) OVER w AS DOUBLE) / nullif(CAST(lag(volume, 3) OVER w AS DOUBLE), 0) AS vol_3m_delta,
  CAST(volume - lag(volume, 5) OVER w AS DOUBLE) / nullif(CAST(lag(volume, 5) OVER w AS DOUBLE), 0) AS vol_5m_delta
 FROM fx_session WINDOW w AS (PARTITION BY code, trade_date ORDER BY ts), u AS (PARTITION BY code, trade_date ORDER BY ts ROWS UNBOUNDED PRECEDING))
SELECT code, {_D}, CAST(ts AS VARCHAR) AS ts, price, vwap, anchored_vwap, vol_3m_delta, vol_5m_delta, (price - vwap) / nullif(vwap, 0) AS price_vs_vwap FROM x""",
        "fx_session",
    ),
)
def min_vwap_running(spark, d):
    return _s(mn.running_vwap(session_bars(spark, d), 780), "ts")


_GATE = """g AS (SELECT *, m - lag(m) OVER (PARTITION BY code, trade_date ORDER BY ts) AS gap FROM fx_session),
day AS (SELECT code, trade_date, count(CASE WHEN gap > 5 AND gap <> 90 THEN 1 END) AS bad_gaps, max(m) AS last_m, sum(volume) AS v, sum(amount) AS a, count(*) AS n FROM g GROUP BY code, trade_date),
need AS (SELECT d.code, d.trade_date, x.m FROM day d JOIN (SELECT unnest(range(570, 900)) AS m) x ON x.m < least(d.last_m, 900) AND NOT (x.m >= 690 AND x.m < 780)),
mis AS (SELECT n.code, n.trade_date, count(*) AS k FROM need n LEFT JOIN fx_session s ON s.code = n.code AND s.trade_date = n.trade_date AND s.m = n.m WHERE s.m IS NULL GROUP BY n.code, n.trade_date)"""


@query(
    "min_vwap_gate",
    with_bindings(
        f"""WITH {_GATE},
q AS (SELECT day.*, coalesce(mis.k, 0) AS missing, day.bad_gaps = 0 AND coalesce(mis.k, 0) <= 10 AS ok FROM day LEFT JOIN mis ON mis.code = day.code AND mis.trade_date = day.trade_date)
SELECT q.code, CAST(q.trade_date AS VARCHAR) AS trade_date, bad_gaps, CAST(missing AS INT) AS missing_minutes, CASE WHEN ok AND v > 0 THEN CAST(a AS DOUBLE) / CAST(v AS DOUBLE) END AS vwap,
 CASE WHEN ok THEN 'minute_bars' ELSE 'unavailable' END AS vwap_source,
 CASE WHEN ok AND v > 0 THEN (CAST(s.price AS DOUBLE) - CAST(a AS DOUBLE) / CAST(v AS DOUBLE)) / (CAST(a AS DOUBLE) / CAST(v AS DOUBLE)) * 100 END AS vwap_distance_pct,
 CASE WHEN ok THEN CAST(v AS DOUBLE) END AS cum_volume, CASE WHEN ok THEN CAST(a AS DOUBLE) END AS cum_amount, CASE WHEN ok THEN n ELSE 0 END AS minute_sample_count
FROM q JOIN fx_sdays s ON s.code = q.code AND s.trade_date = q.trade_date""",
        "fx_session",
        "fx_sdays",
    ),
)
def min_vwap_gate(spark, d):
    prices = session_days(spark, d).select("code", "trade_date", "price")
    return _s(mn.gated_vwap(session_bars(spark, d), prices))


_PIV = """pv AS (SELECT * FROM (SELECT code, trade_date, ts, m, close AS price, row_number() OVER w - 1 AS sequence,
  CASE WHEN count(*) OVER l = 3 AND count(*) OVER r = 3 THEN
   CASE WHEN close > max(close) OVER l AND close > max(close) OVER r THEN 'high' WHEN close < min(close) OVER l AND close < min(close) OVER r THEN 'low' END END AS pivot_type
 FROM fx_session WINDOW w AS (PARTITION BY code, trade_date ORDER BY ts), l AS (PARTITION BY code, trade_date ORDER BY ts ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING),
  r AS (PARTITION BY code, trade_date ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING)) WHERE pivot_type IS NOT NULL)"""


@query(
    "min_pivots",
    with_bindings(
        f"WITH {_PIV} SELECT code, {_D}, CAST(ts AS VARCHAR) AS ts, CAST(price AS DOUBLE) AS price, pivot_type, CAST(sequence AS INT) AS sequence FROM pv",
        "fx_session",
    ),
)
def min_pivots(spark, d):
    return _s(mn.pivots(session_bars(spark, d)).withColumn("price", dbl("price")), "ts")


@query(
    "min_afternoon_low",
    with_bindings(
        f"""WITH {_PIV} SELECT code, {_D}, CAST(max(ts) AS VARCHAR) AS ts, CAST(max_by(price, ts) AS DOUBLE) AS price, 'low' AS pivot_type,
 CAST(max(sequence) AS INT) AS sequence FROM pv WHERE pivot_type = 'low' AND m >= 780 GROUP BY code, trade_date""",
        "fx_session",
    ),
)
def min_afternoon_low(spark, d):
    return _s(mn.afternoon_low(mn.pivots(session_bars(spark, d))).withColumn("price", dbl("price")), "ts")


@query(
    "min_open_proxy",
    with_bindings(
        f"SELECT code, {_D}, CAST(min_by(price, seq) AS DOUBLE) AS open_proxy_price FROM fx_sticks WHERE m = 570 GROUP BY code, trade_date",
        "fx_sticks",
    ),
)
def min_open_proxy(spark, d):
    return _s(mn.open_proxy(session_ticks(spark, d), "seq").withColumn("open_proxy_price", dbl("open_proxy_price")))


_TAILS = """k AS (SELECT *, row_number() OVER (PARTITION BY code, trade_date ORDER BY ts DESC) AS k FROM fx_session),
t AS (SELECT code, trade_date, count(*) AS n, CAST(sum(CASE WHEN k <= 3 THEN volume END) AS DOUBLE) AS v3, CAST(sum(CASE WHEN k <= 5 THEN volume END) AS DOUBLE) AS v5,
 CAST(sum(CASE WHEN k <= 3 THEN amount END) AS DOUBLE) AS a3, CAST(sum(CASE WHEN k <= 5 THEN amount END) AS DOUBLE) AS a5,
 CASE WHEN count(*) >= 6 THEN CAST(sum(CASE WHEN k BETWEEN 4 AND 6 THEN amount END) AS DOUBLE) END AS p3,
 max(ts) AS last_ts, CAST(max(high) AS DOUBLE) AS hi, CAST(min(low) AS DOUBLE) AS lo FROM k GROUP BY code, trade_date)"""
_PX = "SELECT code, trade_date, CAST(price AS DOUBLE) AS price, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low, CAST(pre_close AS DOUBLE) AS pre FROM fx_sdays"


@query(
    "min_facts",
    with_bindings(
        f"""WITH {_PIV}, {_TAILS}, s AS ({_PX}),
al AS (SELECT code, trade_date, CAST(max_by(price, ts) AS DOUBLE) AS ap FROM pv WHERE pivot_type = 'low' AND m >= 780 GROUP BY code, trade_date)
SELECT s.code, CAST(s.trade_date AS VARCHAR) AS trade_date, {r2('(high - price) / nullif(high, 0) * 100', 4)} AS distance_to_day_high_pct, ap AS afternoon_pivot,
 CASE WHEN n >= 3 THEN a3 END AS amount_last_3m, CASE WHEN n >= 5 THEN a5 END AS amount_last_5m,
 CASE WHEN p3 > 0 THEN {r2('(a3 - p3) / p3 * 100', 2)} END AS amount_change_3m_pct,
 coalesce(pre > 0 AND (hi >= pre * (1 + 0.2::DOUBLE) OR lo <= pre * (1 - 0.2::DOUBLE)), false) AS is_limit_touched, CAST(last_ts AS VARCHAR) AS last_tradable_time
FROM s LEFT JOIN t ON t.code = s.code AND t.trade_date = s.trade_date LEFT JOIN al ON al.code = s.code AND al.trade_date = s.trade_date""",
        "fx_session",
        "fx_sdays",
    ),
)
def min_facts(spark, d):
    return _s(mn.minute_facts(session_bars(spark, d), session_days(spark, d), 0.20), "last_tradable_time")


@query(
    "min_structure",
    with_bindings(
        f"""WITH {_TAILS}, s AS ({_PX})
SELECT s.code, CAST(s.trade_date AS VARCHAR) AS trade_date, {r2('(price - high) / nullif(high, 0) * 100', 4)} AS distance_from_high_pct,
 {r2('(price - low) / nullif(low, 0) * 100', 4)} AS distance_from_low_pct, {r2('(high - low) / nullif(pre, 0) * 100', 4)} AS amplitude_pct,
 CASE WHEN n >= 3 THEN v3 END AS volume_3m, CASE WHEN n >= 5 THEN v5 END AS volume_5m, CASE WHEN n >= 3 THEN a3 END AS amount_3m, CASE WHEN n >= 5 THEN a5 END AS amount_5m,
 CASE WHEN p3 > 0 THEN {r2('(a3 - p3) / p3', 4)} END AS amount_change_ratio
FROM s LEFT JOIN t ON t.code = s.code AND t.trade_date = s.trade_date""",
        "fx_session",
        "fx_sdays",
    ),
)
def min_structure(spark, d):
    return _s(mn.intraday_structure(session_bars(spark, d), session_days(spark, d)))


_OBS = 870  # 14:30
_MISS = """fg AS (SELECT DISTINCT code, trade_date, m + CAST(m % 17 = 3 OR m % 41 = 6 AS INT) AS m FROM fx_session),
hv AS (SELECT DISTINCT trade_date, m FROM fg),
sp AS (SELECT trade_date, min(m) AS lo, max(m) AS hi, count(*) AS actual FROM hv GROUP BY trade_date),
ms AS (SELECT sp.trade_date, x.m FROM sp JOIN (SELECT unnest(range(0, 1440)) AS m) x ON x.m >= sp.lo AND x.m < 870 AND NOT (x.m >= 690 AND x.m < 780)
  WHERE NOT EXISTS (SELECT 1 FROM hv WHERE hv.trade_date = sp.trade_date AND hv.m = x.m)),
bk AS (SELECT trade_date, m, gap FROM (SELECT trade_date, m, m - lag(m) OVER (PARTITION BY trade_date ORDER BY m) AS gap FROM hv) WHERE gap > 2 AND gap <> 90)"""


def _gappy(spark, d):
    """Every bar, but some session minutes report one minute later, so that the audits find holes."""
    m = F.hour("ts") * 60 + F.minute("ts")
    late = (m % 17 == 3) | (m % 41 == 6)
    shift = F.make_dt_interval(F.lit(0), F.lit(0), late.cast("int"))
    return session_bars(spark, d).select("code", "trade_date", (F.col("ts") + shift).alias("ts")).distinct()


@query(
    "min_audit",
    with_bindings(
        f"""WITH {_MISS},
pc AS (SELECT code, trade_date, count(*) AS n FROM fg GROUP BY code, trade_date),
cv AS (SELECT trade_date, CAST(sum(CAST(n / 210::DOUBLE AS DECIMAL(28,10))) AS DOUBLE) / count(*) AS mean, min(n / 210::DOUBLE) AS mn, max(n / 210::DOUBLE) AS mx,
 count(CASE WHEN n >= 210 * 0.95::DOUBLE THEN 1 END) AS f, count(CASE WHEN n < 210 * 0.95::DOUBLE THEN 1 END) AS p FROM pc GROUP BY trade_date)
SELECT CAST(sp.trade_date AS VARCHAR) AS trade_date, 240 AS total_expected_minutes, 210 AS expected_minutes_dynamic, actual AS actual_minutes,
 {_HM.format('lo')} AS earliest, {_HM.format('hi')} AS latest,
 (SELECT count(*) FROM ms WHERE ms.trade_date = sp.trade_date) AS missing_minute_count, (SELECT count(*) FROM bk WHERE bk.trade_date = sp.trade_date) AS continuity_break_count,
 {r2('mean', 4)} AS coverage_mean, {r2('mn', 4)} AS coverage_min, {r2('mx', 4)} AS coverage_max, f AS codes_full, p AS codes_partial
FROM sp JOIN cv ON cv.trade_date = sp.trade_date""",
        "fx_session",
    ),
)
def min_audit(spark, d):
    return _s(mn.sequence_audit(_gappy(spark, d), _OBS))


@query(
    "min_audit_periods",
    with_bindings(
        f"""WITH {_MISS}, isl AS (SELECT trade_date, m, m - row_number() OVER (PARTITION BY trade_date ORDER BY m) AS g FROM ms)
SELECT {_D}, {_HM.format('min(m)')} AS start, {_HM.format('max(m)')} AS "end", count(*) AS minutes FROM isl GROUP BY trade_date, g""",
        "fx_session",
    ),
)
def min_audit_periods(spark, d):
    return _s(mn.missing_periods(_gappy(spark, d), _OBS))


@query(
    "min_audit_breaks",
    with_bindings(
        f"WITH {_MISS} SELECT {_D}, {_HM.format('(m - gap)')} AS after, CAST(gap AS INT) AS gap_minutes FROM bk", "fx_session"
    ),
)
def min_audit_breaks(spark, d):
    return _s(mn.continuity_breaks(_gappy(spark, d)))


def _all_codes(spark, d):
    """Every code a user id can map to, plus twelve that never trade (taken from suppliers)."""
    s = table(spark, d, "supplier").select(code_of(F.col("s_suppkey")).alias("code"))
    return s.unionByName(session_ticks(spark, d).select("code")).distinct()


@query(
    "min_audit_codes",
    with_bindings(
        f"""WITH u AS (SELECT printf('%06d', CAST(s_suppkey AS BIGINT)) AS code FROM supplier UNION SELECT code FROM fx_sticks),
pc AS (SELECT code, trade_date, count(DISTINCT ts) AS n FROM fx_session GROUP BY code, trade_date UNION ALL SELECT code, NULL, 0 FROM u WHERE code NOT IN (SELECT code FROM fx_session))
SELECT code, {_D}, n AS minutes, {r2('n / 240::DOUBLE * 100', 1)} AS coverage_pct, CASE WHEN n >= 240 * 0.95::DOUBLE THEN 'full' WHEN n > 0 THEN 'partial' ELSE 'none' END AS status FROM pc""",
        "fx_session",
    ),
)
def min_audit_codes(spark, d):
    b = session_bars(spark, d)
    expected = b.select("trade_date").distinct().withColumn("expected_minutes", F.lit(240))
    have = mn.code_coverage(b, expected).drop("coverage")
    none = mn.codes_without_data(b, _all_codes(spark, d)).select(
        "code",
        F.lit(None).cast("date").alias("trade_date"),
        F.lit(0).cast("bigint").alias("minutes"),
        F.lit(0.0).alias("coverage_pct"),
        F.lit("none").alias("status"),
    )
    return _s(have.unionByName(none))


@query(
    "min_audit_market",
    with_bindings(
        f"""WITH u AS (SELECT printf('%06d', CAST(s_suppkey AS BIGINT)) AS code FROM supplier UNION SELECT code FROM fx_sticks),
pc AS (SELECT code, trade_date, count(DISTINCT ts) AS n, sum(volume) AS v FROM fx_session GROUP BY code, trade_date)
SELECT {_D}, 240 AS expected_minutes, count(*) AS codes_with_data, (SELECT count(*) FROM u) - count(*) AS codes_zero_data,
 {r2('CAST(sum(n) AS DOUBLE) / count(*) / 240 * 100', 1)} AS mean_coverage_pct, {r2('min(n / 240::DOUBLE) * 100', 1)} AS min_coverage_pct, {r2('max(n / 240::DOUBLE) * 100', 1)} AS max_coverage_pct,
 count(CASE WHEN n / 240::DOUBLE >= 0.95::DOUBLE THEN 1 END) AS codes_full, count(CASE WHEN n / 240::DOUBLE < 0.95::DOUBLE THEN 1 END) AS codes_partial, count(CASE WHEN v = 0 THEN 1 END) AS codes_zero_volume
FROM pc GROUP BY trade_date""",
        "fx_session",
    ),
)
def min_audit_market(spark, d):
    return _s(mn.collection_audit(session_bars(spark, d), _all_codes(spark, d)))


@query(
    "min_audit_stocks",
    with_bindings(
        f"""SELECT CAST(g.trade_date AS VARCHAR) AS trade_date, {_HM.format('g.m')} AS minute, count(DISTINCT s.code) AS stocks
FROM (SELECT * FROM (SELECT DISTINCT trade_date FROM fx_session), (SELECT unnest(range(570, 900)) AS m) WHERE NOT (m >= 690 AND m < 780)) g
LEFT JOIN fx_session s ON s.trade_date = g.trade_date AND s.m = g.m GROUP BY g.trade_date, g.m""",
        "fx_session",
    ),
)
def min_audit_stocks(spark, d):
    return _s(mn.stocks_per_minute(session_bars(spark, d)))


@query(
    "min_audit_last_trade",
    with_bindings(
        f"SELECT code, {_D}, CAST(max(CASE WHEN volume > 0 THEN ts END) AS VARCHAR) AS last_trade_time FROM fx_session GROUP BY code, trade_date",
        "fx_session",
    ),
)
def min_audit_last_trade(spark, d):
    return _s(mn.last_trade(session_bars(spark, d)), "last_trade_time")


@query(
    "min_watch_vwap",
    with_bindings(
        f"""SELECT code, {_D}, {r2('CAST(sum(amount) AS DOUBLE) / nullif(CAST(sum(volume) AS DOUBLE), 0)', 4)} AS full_day_vwap,
 {r2('CAST(sum(CASE WHEN m >= 780 THEN amount END) AS DOUBLE) / nullif(CAST(sum(CASE WHEN m >= 780 THEN volume END) AS DOUBLE), 0)', 4)} AS afternoon_avwap
FROM fx_session WHERE code IN (SELECT printf('%06d', CAST(n_nationkey AS BIGINT)) FROM nation WHERE n_regionkey < 3) GROUP BY code, trade_date""",
        "fx_session",
    ),
)
def min_watch_vwap(spark, d):
    watch = table(spark, d, "nation").where("n_regionkey < 3").select(
        code_of(F.col("n_nationkey")).alias("code")
    )
    return _s(mn.watch_vwap(session_bars(spark, d), watch))


@query(
    "min_early_reversal",
    with_bindings(
        f"""WITH v AS (SELECT code, trade_date, CAST(close AS DOUBLE) AS p, CAST(sum(amount) OVER u AS DOUBLE) / nullif(CAST(sum(volume) OVER u AS DOUBLE), 0) AS vw,
  row_number() OVER w - 1 AS i FROM fx_session WINDOW w AS (PARTITION BY code, trade_date ORDER BY ts), u AS (PARTITION BY code, trade_date ORDER BY ts ROWS UNBOUNDED PRECEDING)),
pos AS (SELECT code || CAST(trade_date AS VARCHAR) || f AS position_id, code, trade_date, CAST(open AS DOUBLE) AS o, CAST(pre_close AS DOUBLE) AS e, CAST(pre_close AS DOUBLE) * CAST(f AS DOUBLE) AS z
  FROM fx_sdays, (SELECT unnest(['0.9', '1.1', '3.0', '400.0']) AS f)),
a AS (SELECT p.position_id, min(v.i) AS act FROM pos p JOIN v ON v.code = p.code AND v.trade_date = p.trade_date WHERE z - e > 0 AND (v.p - e) / (z - e) >= 0.8::DOUBLE GROUP BY p.position_id),
r AS (SELECT p.position_id, p.code, p.trade_date, p.z - p.e AS span, a.act, count(*) AS n, count(CASE WHEN v.i > act AND v.i <= act + 2 AND v.p < p.o THEN 1 END) AS bo,
  count(CASE WHEN v.i > act AND v.i <= act + 2 AND v.p < v.vw THEN 1 END) AS bv
  FROM pos p JOIN v ON v.code = p.code AND v.trade_date = p.trade_date LEFT JOIN a ON a.position_id = p.position_id GROUP BY p.position_id, p.code, p.trade_date, p.z, p.e, a.act),
q AS (SELECT *, n >= 2 AND span > 0 AND act IS NOT NULL AND act + 2 < n AS active FROM r)
SELECT position_id, code, {_D}, coalesce(active AND bo >= 2 AND bv >= 2, false) AS triggered,
 CASE WHEN active THEN CASE WHEN act = 0 THEN 'gap_arrival' ELSE 'intraday_runup' END END AS activation_type, CAST(CASE WHEN active THEN act END AS INT) AS activation_minute,
 coalesce(active AND bo >= 2, false) AS below_opening_reference, coalesce(active AND bv >= 2, false) AS below_vwap,
 CASE WHEN n < 2 THEN 'insufficient_minute_data' WHEN NOT span > 0 THEN 'target_progress_denominator_invalid' WHEN act IS NULL THEN 'not_activated'
  WHEN NOT act + 2 < n THEN 'insufficient_post_activation_data' WHEN bo >= 2 AND bv >= 2 THEN 'early_target_reversal_detected' ELSE 'conditions_not_met' END AS reason
FROM q""",
        "fx_session",
        "fx_sdays",
    ),
)
def min_early_reversal(spark, d):
    factor = F.explode(F.array(*[F.lit(x) for x in ("0.9", "1.1", "3.0", "400.0")]))
    pos = session_days(spark, d).withColumn("f", factor).select(
        F.concat("code", F.col("trade_date").cast("string"), "f").alias("position_id"),
        "code",
        "trade_date",
        F.col("open").alias("opening_reference"),
        F.col("pre_close").alias("entry_price"),
        (dbl("pre_close") * dbl("f")).alias("first_zone_lower"),
    )
    bars = session_bars(spark, d)
    vw = mn.running_vwap(bars)
    return _s(mn.early_reversal(pos, vw, price="price"))


@query(
    "flt_interval",
    with_bindings(
        f"""SELECT code, {_D}, {_HM.format('m')} AS time, CAST(close AS DOUBLE) AS price, volume FROM fx_session WHERE m BETWEEN 571 AND 840""",
        "fx_session",
    ),
)
def flt_interval(spark, d):
    b = session_bars(spark, d).select(
        "code", "trade_date", F.date_format("ts", "HH:mm").alias("time"), dbl("close").alias("price"), "volume"
    )
    return _s(mn.slice_interval(b, "09:31", "14:00"))
