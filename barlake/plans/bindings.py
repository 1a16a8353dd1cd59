"""How the given tables stand in for market tables.

No market table is given, so bars come from ``lineitem`` (one security per
supplier, one bar per ship date), ticks and minutes from ``events``, reference
data from ``supplier``/``nation``/``region``, call logs from ``orders`` and
state events from ``conversations``.  Each binding exists twice: as a DataFrame
for the engine and as SQL text for the independent check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values used by queries and their checks alike.
AS_OF_DATES = ("2000-01-03", "2001-12-01")
AS_OF = "2001-12-01"
BOARD_PREFIXES = ("600", "000", "300", "301", "688", "002", "430", "920")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def code_of(c: Column) -> Column:
    """A number as a code of six digits; longer numbers keep all their digits."""
    digits = c.cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(6)), "0")


def _packed_order():
    """order (13 digits) | line (1) | part (11) | price in cents (9), as one DECIMAL(38,0)."""
    wide = lambda c: c.cast("decimal(38,0)")
    head = wide(F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    billion = F.lit("1000000000").cast("decimal(10,0)")
    tail = F.col("l_partkey").cast("decimal(11,0)") * billion
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    hundred_billion = F.lit("100000000000000000000").cast("decimal(21,0)")
    return (head.cast("decimal(16,0)") * hundred_billion + wide(tail + cents.cast("decimal(9,0)"))).cast("decimal(38,0)")


def bars(spark: SparkSession, sf_dir: str, key: str | Column = "l_suppkey", last: int | None = None) -> DataFrame:
    """Daily bars, unique per (code, dt); with ``last`` only those of each code's last dates.

    First and last trade follow (order, line, part, price).  The four keys are
    packed into one DECIMAL: a struct as ordering would force a sort-based
    aggregation, a number keeps it hash-based with a map-side combine.

    A map task keeps only the rows of the ``last`` dates that it has seen of a code
    (window group limit); they are summed up where they meet, after one shuffle.
    """
    li = table(spark, sf_dir, "lineitem").withColumns(
        {"code": code_of(F.col(key) if isinstance(key, str) else key), "dt": F.col("l_shipdate").cast("date")}
    )
    if last is not None:
        newest = Window.partitionBy("code").orderBy(F.col("dt").desc())
        li = li.withColumn("day_no", F.dense_rank().over(newest)).where(F.col("day_no") <= last)
    li = li.select(
        "code",
        "dt",
        F.col("l_extendedprice").cast("decimal(12,2)").alias("px"),
        F.col("l_quantity").cast("decimal(6,0)").alias("qty"),
        _packed_order().alias("ord"),
    )
    return li.groupBy("code", "dt").agg(
        F.min_by("px", "ord").alias("open"),
        F.max("px").alias("high"),
        F.min("px").alias("low"),
        F.max_by("px", "ord").alias("close"),
        F.sum("qty").alias("volume"),
        F.sum(F.col("px") * F.col("qty")).alias("amount"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    price = F.col("value").cast("decimal(12,2)")
    volume = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    return ev.select(
        code_of(F.col("user_id") % 10).alias("code"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("event_id").alias("seq"),
        price.alias("price"),
        volume.alias("volume"),
        (price * volume).alias("amount"),
    )


def minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minute bars, unique per (code, ts_min)."""
    return (
        ticks(spark, sf_dir)
        .groupBy("code", F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("ts_min"))
        .agg(
            F.min_by("price", "seq").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "seq").alias("close"),
            F.sum("volume").alias("volume"),
            F.sum("amount").alias("amount"),
        )
        .withColumn("trade_date", F.to_date("ts_min"))
    )


def session_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks laid onto trading sessions: a day's 24 hours map to the session minutes, weeks to dates.

    One code collects half of all ticks, so some sessions are dense and some have gaps.
    """
    # min_audit: filters copy this into code too long to compile, and Spark falls back; a shorter form compiled, but ran 4 x slower
    idx = F.floor((F.hour("ts") * 3600 + F.minute("ts") * 60 + F.floor(F.second("ts"))) * 242 / 86400).cast("int")
    u = F.col("user_id") % 10
    ev = table(spark, sf_dir, "events")
    price = F.col("value").cast("decimal(12,2)")
    volume = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    m = F.when(idx <= 120, idx + 570).otherwise(idx - 121 + 780)  # 11:30 and 15:00 included
    day = F.to_date(F.date_trunc("week", "ts"))
    return ev.select(
        F.when(u < 5, F.lit("000000")).otherwise(code_of(u)).alias("code"),
        day.alias("trade_date"),
        (day.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), m)).alias("ts"),
        F.col("event_id").alias("seq"),
        price.alias("price"),
        volume.alias("volume"),
        (price * volume).alias("amount"),
    )


def session_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session minute bars, unique per (code, trade_date, ts)."""
    return (
        session_ticks(spark, sf_dir)
        .groupBy("code", "trade_date", "ts")
        .agg(
            F.min_by("price", "seq").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "seq").alias("close"),
            F.sum("volume").alias("volume"),
            F.sum("amount").alias("amount"),
        )
    )


def session_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day snapshot of the session bars: price, open, high, low and a stand-in previous close."""
    b = session_bars(spark, sf_dir)
    return b.groupBy("code", "trade_date").agg(
        F.max_by("close", "ts").alias("price"),
        F.min_by("open", "ts").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.min_by("close", "ts").alias("pre_close"),
    )


def dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier with nation and region: name, market (two regions unmapped), industry, board."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    market = F.when(F.col("n_regionkey") == 0, "sh").when(F.col("n_regionkey") == 1, "sz").when(
        F.col("n_regionkey") == 2, "bj"
    )
    return (
        s.join(n, s.s_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select(
            code_of(F.col("s_suppkey")).alias("code"),
            F.col("s_suppkey").alias("k"),
            F.col("s_name").alias("sname"),
            market.alias("market"),
            F.col("n_name").alias("industry"),
            F.col("r_name").alias("board"),
            F.col("s_acctbal").alias("acctbal"),
        )
    )


def last_bars(b: DataFrame) -> DataFrame:
    """Last bar per code with the close before it (two rows per code are enough)."""
    w = Window.partitionBy("code").orderBy(F.col("dt").desc())
    two = b.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= 2)
    pick = lambda c, n: F.max(F.when(F.col("rn") == n, F.col(c)))
    return two.groupBy("code").agg(
        pick("dt", 1).alias("trade_date"),
        pick("close", 1).alias("price"),
        pick("close", 2).alias("pre_close"),
        *[pick(c, 1).alias(c) for c in ("open", "high", "low", "volume", "amount")],
    )


def snapshot(spark: SparkSession, sf_dir: str, daily: DataFrame | None = None, listed: DataFrame | None = None) -> DataFrame:
    """Quote snapshot: last bar joined with the reference dimensions."""
    last = last_bars(bars(spark, sf_dir, last=2) if daily is None else daily)
    d = dims(spark, sf_dir) if listed is None else listed
    price, pre = F.col("price").cast("double"), F.col("pre_close").cast("double")
    k = F.col("k")
    name = (
        F.when(k % 19 == 0, F.concat(F.lit("*ST"), F.col("sname")))
        .when(k % 23 == 0, F.concat(F.lit("ST"), F.col("sname")))
        .when(k % 29 == 0, F.concat(F.col("sname"), F.lit("退")))
        .otherwise(F.col("sname"))
    )
    prefix = F.element_at(F.array(*[F.lit(p) for p in BOARD_PREFIXES]), (k % 8 + 1).cast("int"))
    return last.join(d, "code").select(
        "code",
        "k",
        F.concat(prefix, F.lpad(k.cast("string"), F.greatest(F.length(k.cast("string")), F.lit(3)), "0")).alias("sym"),
        name.alias("name"),
        "market",
        "industry",
        "board",
        "trade_date",
        "price",
        "pre_close",
        "open",
        "high",
        "low",
        ((F.col("price") - F.col("pre_close")).cast("double") / pre * 100).alias("change_pct"),
        "volume",
        "amount",
        (F.col("volume").cast("double") / 10).alias("turnover_rate"),
        F.when(k % 31 == 0, "suspended").otherwise("feed_a").alias("source"),
        F.when(k % 7 != 0, (price * (1000 + k % 5000)).cast("double")).alias("circ_mv"),
        F.when(k % 9 != 0, (k % 40).cast("double") / 10).alias("volume_ratio"),
    )


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("seq"),
        F.col("o_orderpriority").alias("source"),
        F.col("o_orderdate").alias("ts"),
        (F.col("o_orderstatus") != "F").alias("ok"),
        F.floor("o_totalprice").cast("bigint").alias("rows"),
    )


def calm_bars(spark: SparkSession, sf_dir: str, last: int | None = None) -> DataFrame:
    """Bars whose prices move like real ones: 50 plus a part of 20,000 of the stand-in price, whole ticks of 0.01.

    Eight securities share a supplier.  The mapping never falls, so first, highest,
    lowest and last price stay what they are.  Volumes count lots of 100,000.
    """

    def calm(c: str) -> Column:
        cents = F.floor((F.col(c) * 100).cast("bigint") / 20_000) + 5000
        return (cents.cast("decimal(10,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(12,2)").alias(c)

    b = bars(spark, sf_dir, F.col("l_suppkey") * 8 + F.col("l_partkey") % 8, last)
    volume = (F.col("volume") * 100_000).cast("decimal(22,0)").alias("volume")
    b = b.select("code", "dt", *[calm(c) for c in ("open", "high", "low", "close")], volume)
    return b.withColumn("amount", (F.col("close") * F.col("volume")).cast("decimal(30,2)"))


def scan_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input of the market scan: the screening columns over the calm bars, sized like listed companies."""
    k = F.explode(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.col("k") * 8 + i))
    listed = dims(spark, sf_dir).withColumn("k", k).withColumn("code", code_of(F.col("k")))
    u = written_universe(spark, sf_dir, calm_bars, listed, 1)
    return u.withColumns({"turnover_rate": F.col("volume") / 1_000_000, "circ_mv": F.col("circ_mv") * 100_000})


def universe(
    spark: SparkSession, sf_dir: str, daily: Callable[..., DataFrame] = bars, listed: DataFrame | None = None, damping: int = 20
) -> DataFrame:
    """Screening input: snapshot, indicator record and relative strength of one as-of date.

    The stand-in prices jump far more than real ones, so changes are divided by 20.
    """
    from barlake.functions.ranking import percent_rank_average
    from barlake.operators.indicators import indicators_as_of
    from barlake.session import materialize

    rec = indicators_as_of(daily(spark, sf_dir), [AS_OF]).drop("used_rows", "first_date", "last_date", "last_close")
    # one row per security, read four times: by itself and by the ranks
    rec = materialize(spark, rec, "universe-indicators")
    rec = percent_rank_average(rec, ["as_of"], "return_20d", "rps20").drop("as_of")
    s = snapshot(spark, sf_dir, daily(spark, sf_dir, last=2), listed).withColumn("change_pct", F.col("change_pct") / damping)
    for c in ("price", "pre_close", "open", "high", "low", "volume", "amount"):
        s = s.withColumn(c, F.col(c).cast("double"))
    return s.drop("board").join(rec, "code", "left")


def written_universe(spark: SparkSession, sf_dir: str, *how) -> DataFrame:
    """``universe`` with its snapshot written once too: a screen reads it several times."""
    from barlake.session import materialize

    return materialize(spark, universe(spark, sf_dir, *how), "universe")


# --------------------------------------------------------------------------
# The same bindings as SQL text for the check.
# --------------------------------------------------------------------------

_SQL = {
    "fx_bars": """
SELECT code, dt, min_by(px, ord) AS open, max(px) AS high, min(px) AS low, max_by(px, ord) AS close,
       sum(qty) AS volume, sum(px * qty) AS amount
FROM (SELECT printf('%06d', CAST(l_suppkey AS BIGINT)) AS code, CAST(l_shipdate AS DATE) AS dt,
             CAST(l_extendedprice AS DECIMAL(12,2)) AS px, CAST(l_quantity AS DECIMAL(6,0)) AS qty,
             (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS ord FROM lineitem) t
GROUP BY code, dt""",
    "fx_pbars": """
SELECT code, dt, min_by(px, ord) AS open, max(px) AS high, min(px) AS low, max_by(px, ord) AS close,
       sum(qty) AS volume, sum(px * qty) AS amount
FROM (SELECT printf('%06d', CAST(l_partkey AS BIGINT)) AS code, CAST(l_shipdate AS DATE) AS dt,
             CAST(l_extendedprice AS DECIMAL(12,2)) AS px, CAST(l_quantity AS DECIMAL(6,0)) AS qty,
             (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS ord FROM lineitem) t
GROUP BY code, dt""",
    "fx_lbars": """
SELECT code, dt, min_by(px, ord) AS open, max(px) AS high, min(px) AS low, max_by(px, ord) AS close,
       sum(qty) AS volume, sum(px * qty) AS amount
FROM (SELECT printf('%06d', CAST(l_linenumber AS BIGINT)) AS code, CAST(l_shipdate AS DATE) AS dt,
             CAST(l_extendedprice AS DECIMAL(12,2)) AS px, CAST(l_quantity AS DECIMAL(6,0)) AS qty,
             (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS ord FROM lineitem) t
GROUP BY code, dt""",
    "fx_ticks": """
SELECT printf('%06d', CAST(user_id % 10 AS BIGINT)) AS code, ts, event_id AS seq,
       CAST(value AS DECIMAL(12,2)) AS price, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS volume,
       CAST(value AS DECIMAL(12,2)) * CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS amount
FROM events""",
    "fx_minutes": """
SELECT code, CAST(date_trunc('minute', ts) AS TIMESTAMP) AS ts_min, min_by(price, seq) AS open, max(price) AS high,
       min(price) AS low, max_by(price, seq) AS close, CAST(sum(volume) AS BIGINT) AS volume, sum(amount) AS amount,
       CAST(ts AS DATE) AS trade_date,
       CAST(extract(hour FROM date_trunc('minute', ts)) * 60 + extract(minute FROM date_trunc('minute', ts)) AS INT) AS mod
FROM fx_ticks GROUP BY code, date_trunc('minute', ts), CAST(ts AS DATE)""",
    "fx_sticks": """
SELECT code, trade_date, CAST(trade_date AS TIMESTAMP) + to_minutes(m) AS ts, m, seq, price, volume, amount FROM (
 SELECT *, CAST(CASE WHEN idx <= 120 THEN idx + 570 ELSE idx - 121 + 780 END AS INT) AS m FROM (
  SELECT CASE WHEN user_id % 10 < 5 THEN '000000' ELSE printf('%06d', CAST(user_id % 10 AS BIGINT)) END AS code,
   CAST(date_trunc('week', ts) AS DATE) AS trade_date,
   CAST(floor((extract(hour FROM ts) * 3600 + extract(minute FROM ts) * 60 + floor(extract(second FROM ts))) * 242 / 86400) AS INT) AS idx,
   event_id AS seq, CAST(value AS DECIMAL(12,2)) AS price, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS volume,
   CAST(value AS DECIMAL(12,2)) * CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS amount FROM events))""",
    "fx_session": """
SELECT code, trade_date, ts, m, min_by(price, seq) AS open, max(price) AS high, min(price) AS low, max_by(price, seq) AS close,
 CAST(sum(volume) AS BIGINT) AS volume, sum(amount) AS amount FROM fx_sticks GROUP BY code, trade_date, ts, m""",
    "fx_sdays": """
SELECT code, trade_date, max_by(close, ts) AS price, min_by(open, ts) AS open, max(high) AS high, min(low) AS low,
 min_by(close, ts) AS pre_close FROM fx_session GROUP BY code, trade_date""",
    "fx_dims": """
SELECT printf('%06d', CAST(s_suppkey AS BIGINT)) AS code, s_suppkey AS k, s_name AS sname,
       CASE n_regionkey WHEN 0 THEN 'sh' WHEN 1 THEN 'sz' WHEN 2 THEN 'bj' END AS market,
       n_name AS industry, r_name AS board, s_acctbal AS acctbal
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "fx_snapshot": """
SELECT b.code, d.k,
       ['600','000','300','301','688','002','430','920'][d.k % 8 + 1] || printf('%03d', CAST(d.k AS BIGINT)) AS sym,
       CASE WHEN d.k % 19 = 0 THEN '*ST' || d.sname WHEN d.k % 23 = 0 THEN 'ST' || d.sname
            WHEN d.k % 29 = 0 THEN d.sname || '退' ELSE d.sname END AS name,
       d.market, d.industry, d.board, b.dt AS trade_date, b.close AS price, b.pre_close, b.open, b.high, b.low,
       CAST(b.close - b.pre_close AS DOUBLE) / CAST(b.pre_close AS DOUBLE) * 100 AS change_pct, b.volume, b.amount,
       CAST(b.volume AS DOUBLE) / 10 AS turnover_rate,
       CASE WHEN d.k % 31 = 0 THEN 'suspended' ELSE 'feed_a' END AS source,
       CASE WHEN d.k % 7 <> 0 THEN CAST(b.close AS DOUBLE) * (1000 + d.k % 5000) END AS circ_mv,
       CASE WHEN d.k % 9 <> 0 THEN CAST(d.k % 40 AS DOUBLE) / 10 END AS volume_ratio
FROM (SELECT *, lag(close) OVER (PARTITION BY code ORDER BY dt) AS pre_close,
             row_number() OVER (PARTITION BY code ORDER BY dt DESC) AS rn FROM fx_bars) b
JOIN fx_dims d ON d.code = b.code WHERE b.rn = 1""",
    "fx_calls": """
SELECT o_orderkey AS seq, o_orderpriority AS source, o_orderdate AS ts, o_orderstatus <> 'F' AS ok,
       CAST(floor(o_totalprice) AS BIGINT) AS rows FROM orders""",
}
_FOLD_RSI = """list_reduce(bars, lambda a, x: {
  'i': CASE WHEN a.prev IS NULL THEN 0 ELSE a.i + 1 END, 'prev': x.c,
  'up': CASE WHEN a.prev IS NULL THEN 0::DOUBLE WHEN a.i + 1 < 14 THEN a.up + greatest(x.c - a.prev, 0)
             WHEN a.i + 1 = 14 THEN (a.up + greatest(x.c - a.prev, 0)) / 14 ELSE (a.up * 13 + greatest(x.c - a.prev, 0)) / 14 END,
  'dn': CASE WHEN a.prev IS NULL THEN 0::DOUBLE WHEN a.i + 1 < 14 THEN a.dn + greatest(a.prev - x.c, 0)
             WHEN a.i + 1 = 14 THEN (a.dn + greatest(a.prev - x.c, 0)) / 14 ELSE (a.dn * 13 + greatest(a.prev - x.c, 0)) / 14 END},
  {'i': 0, 'prev': NULL::DOUBLE, 'up': 0::DOUBLE, 'dn': 0::DOUBLE})"""
_TR = "coalesce(greatest(x.h - x.l, abs(x.h - a.prev), abs(x.l - a.prev)), x.h - x.l)"
_FOLD_ATR = f"""list_reduce(bars, lambda a, x: {{'i': a.i + 1, 'prev': x.c,
  'v': CASE WHEN a.i + 1 < 14 THEN a.v + {_TR} WHEN a.i + 1 = 14 THEN (a.v + {_TR}) / 14 ELSE (a.v * 13 + {_TR}) / 14 END}},
  {{'i': 0, 'prev': NULL::DOUBLE, 'v': 0::DOUBLE}})"""
_E12 = "CASE WHEN a.i = 0 THEN x.c ELSE x.c * (2::DOUBLE/13) + a.f * (1::DOUBLE - 2::DOUBLE/13) END"
_E26 = "CASE WHEN a.i = 0 THEN x.c ELSE x.c * (2::DOUBLE/27) + a.s * (1::DOUBLE - 2::DOUBLE/27) END"
_DIF = f"(CASE WHEN a.i + 1 >= 26 THEN ({_E12}) - ({_E26}) END)"
_DEA = f"coalesce({_DIF} * 0.2::DOUBLE + a.d * (1::DOUBLE - 0.2::DOUBLE), {_DIF})"
_FOLD_MACD = f"""list_reduce(bars, lambda a, x: {{'i': a.i + 1, 'f': {_E12}, 's': {_E26}, 'd': {_DEA},
  'h0': CASE WHEN a.i + 1 >= 34 THEN ({_DIF} - {_DEA}) * 2 END, 'h1': a.h0, 'h2': a.h1, 'h3': a.h2}},
  {{'i': 0, 'f': NULL::DOUBLE, 's': NULL::DOUBLE, 'd': NULL::DOUBLE, 'h0': NULL::DOUBLE, 'h1': NULL::DOUBLE, 'h2': NULL::DOUBLE, 'h3': NULL::DOUBLE}})"""
_MA_SQL = ", ".join(f"CASE WHEN n >= {p} THEN s{p} / {p} END AS ma{p}" for p in (5, 10, 11, 20, 23, 60))
_SQL["fx_ind"] = f"""
SELECT code, n, c1 AS last_close, {_MA_SQL},
  CASE WHEN rf.i < 14 THEN NULL WHEN rf.dn = 0 THEN CASE WHEN rf.up > 0 THEN 100::DOUBLE ELSE 50::DOUBLE END ELSE 100 - 100 / (1 + rf.up / rf.dn) END AS rsi14,
  CASE WHEN af.i >= 14 THEN af.v END AS atr14, CASE WHEN af.i >= 14 THEN af.v END / nullif(c1, 0) * 100 AS atr14_pct,
  CASE WHEN n >= 20 THEN mid + wid END AS boll_upper, CASE WHEN n >= 20 THEN mid END AS boll_middle, CASE WHEN n >= 20 THEN mid - wid END AS boll_lower,
  CASE WHEN n >= 20 THEN CASE WHEN wid = 0 THEN 0.5::DOUBLE ELSE (c1 - (mid - wid)) / ((mid + wid) - (mid - wid)) END END AS boll_position,
  (c1 - c6) / nullif(c6, 0) AS return_5d, (c1 - c11) / nullif(c11, 0) AS return_10d, (c1 - c21) / nullif(c21, 0) AS return_20d,
  CASE WHEN h1 - l1 > 0 THEN (h1 - greatest(o1, c1)) / (h1 - l1) END AS upper_shadow_ratio,
  mf.h0 - mf.h1 AS momentum_delta_1, mf.h0 - mf.h3 AS momentum_delta_3
FROM (SELECT *, s20 / 20 AS mid, 2 * sqrt(greatest(CAST(20 * CAST(q20 AS DECIMAL(30,4)) - CAST(d20 AS DECIMAL(18,2)) * CAST(d20 AS DECIMAL(18,2)) AS DOUBLE) / 380, 0)) AS wid,
   {_FOLD_RSI} AS rf, {_FOLD_ATR} AS af, {_FOLD_MACD} AS mf
 FROM (SELECT code, count(*) AS n, list({{'h': h, 'l': l, 'c': c}} ORDER BY dt) AS bars, {", ".join(f"CAST(sum(CASE WHEN k <= {p} THEN cd END) AS DOUBLE) AS s{p}" for p in (5, 10, 11, 20, 23, 60))},
   sum(CASE WHEN k <= 20 THEN cd END) AS d20, sum(CASE WHEN k <= 20 THEN CAST(cd * cd AS DECIMAL(24,4)) END) AS q20,
   {", ".join(f"max(CASE WHEN k = {p} THEN c END) AS c{p}" for p in (1, 6, 11, 21))}, max(CASE WHEN k = 1 THEN o END) AS o1, max(CASE WHEN k = 1 THEN h END) AS h1, max(CASE WHEN k = 1 THEN l END) AS l1
  FROM (SELECT code, dt, CAST(open AS DOUBLE) AS o, CAST(high AS DOUBLE) AS h, CAST(low AS DOUBLE) AS l, CAST(close AS DOUBLE) AS c, close AS cd,
     row_number() OVER (PARTITION BY code ORDER BY dt DESC) AS k FROM fx_bars WHERE dt < DATE '2001-12-01') WHERE k <= 250 GROUP BY code))"""
_SQL["fx_rps"] = """
SELECT code, CAST(2 * (rank() OVER (ORDER BY return_20d) - 1) + count(*) OVER (PARTITION BY return_20d) + 1 AS DOUBLE) / 2 / count(*) OVER () * 100 AS rps20
FROM fx_ind WHERE return_20d IS NOT NULL"""
_SQL["fx_univ"] = """
SELECT s.code, s.k, s.sym, s.name, s.market, s.industry, s.trade_date, CAST(s.price AS DOUBLE) AS price, CAST(s.pre_close AS DOUBLE) AS pre_close, CAST(s.open AS DOUBLE) AS open,
  CAST(s.high AS DOUBLE) AS high, CAST(s.low AS DOUBLE) AS low, s.change_pct / 20 AS change_pct, CAST(s.volume AS DOUBLE) AS volume, CAST(s.amount AS DOUBLE) AS amount,
  s.turnover_rate, s.source, s.circ_mv, s.volume_ratio, i.* EXCLUDE (code, n, last_close), r.rps20
FROM fx_snapshot s LEFT JOIN fx_ind i ON i.code = s.code LEFT JOIN fx_rps r ON r.code = s.code"""
_CALM = "CAST((CAST({0} * 100 AS BIGINT) // 20000 + 5000) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS {0}"
_SQL["fx_cbars"] = f"""
SELECT *, CAST(close * volume AS DECIMAL(30,2)) AS amount
FROM (SELECT code, dt, {", ".join(_CALM.format(c) for c in ("open", "high", "low", "close"))}, CAST(volume * 100000 AS DECIMAL(22,0)) AS volume
 FROM ({_SQL["fx_bars"].replace("CAST(l_suppkey AS BIGINT)", "CAST(l_suppkey * 8 + l_partkey % 8 AS BIGINT)")}))"""
_SQL["fx_cdims"] = "SELECT printf('%06d', CAST(k * 8 + i AS BIGINT)) AS code, k * 8 + i AS k, * EXCLUDE (code, k) FROM fx_dims, unnest(range(8)) t(i)"
for _name in ("snapshot", "ind", "rps", "univ"):
    _SQL[f"fx_c{_name}"] = (
        _SQL[f"fx_{_name}"].replace("fx_bars", "fx_cbars").replace("fx_snapshot", "fx_csnapshot").replace("fx_ind", "fx_cind").replace("fx_rps", "fx_crps").replace("fx_dims", "fx_cdims")
    )
_SQL["fx_cuniv"] = _SQL["fx_cuniv"].replace("s.change_pct / 20", "s.change_pct")
_SQL["fx_scan"] = "SELECT * REPLACE (volume / 1000000 AS turnover_rate, circ_mv * 100000 AS circ_mv) FROM fx_cuniv"
_NEEDS = {
    "fx_cdims": ["fx_dims"],
    "fx_cind": ["fx_cbars"],
    "fx_crps": ["fx_cind"],
    "fx_csnapshot": ["fx_cbars", "fx_cdims"],
    "fx_cuniv": ["fx_csnapshot", "fx_cind", "fx_crps"],
    "fx_scan": ["fx_cuniv"],
    "fx_ind": ["fx_bars"],
    "fx_rps": ["fx_ind"],
    "fx_univ": ["fx_snapshot", "fx_ind", "fx_rps"],
    "fx_minutes": ["fx_ticks"],
    "fx_session": ["fx_sticks"],
    "fx_sdays": ["fx_session"],
    "fx_snapshot": ["fx_bars", "fx_dims"],
}


def with_bindings(sql: str, *names: str) -> str:
    """Prefix a check query with the bindings it reads."""
    if not names:
        return sql.strip()
    order: list[str] = []

    def visit(n: str) -> None:
        for m in _NEEDS.get(n, []):
            visit(m)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    ctes = ",\n".join(f"{n} AS ({_SQL[n]})" for n in order)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def r2(expr: str, digits: int) -> str:
    """SQL text of the decimal rounding rule."""
    return f"CAST(CAST(CAST({expr} AS DECIMAL(28,10)) AS DECIMAL(28,{digits})) AS DOUBLE)"
