"""Source, sink and projection queries with their check SQL.

Raw payload tables are rendered from the given tables first (text, JSON), then
parsed back by the engine; the check SQL goes straight to the tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from barlake import schemas as S
from barlake.functions import text as tx
from barlake.functions.numeric import dbl, present, round_dec
from barlake.operators import normalize as nz
from barlake.plans.bindings import (
    bars,
    code_of,
    minutes,
    r2,
    session_bars,
    snapshot,
    table,
    with_bindings,
)
from barlake.plans.registry import query
from barlake.session import scratch_dir
from barlake.sources import documents as docs
from barlake.sources import raw_text as rt
from barlake.sources import tables as tb

# -- documents -------------------------------------------------------------------


def _documents(spark, d):
    """Bar documents of which every tenth kind is damaged in a different way."""
    good = docs.render_daily_documents(bars(spark, d), "2001-12-01", "2001-12-01T16:00:00+08:00", "feed_a")
    k = F.col("code").cast("bigint") % 10
    text = (
        F.when(k == 1, F.regexp_replace("text", '"actual_rows":', '"actual_rows":1'))
        .when(k == 2, F.regexp_replace("text", '"volume_unit":"shares",', ""))
        .when(k == 3, F.regexp_replace("text", '"date":"....-..-..","open"', '"date":"2001-01-01","open"'))
        .when(k == 4, F.lit("{broken"))
        .when(k == 5, F.regexp_replace("text", '"fetched_at":"2001-12-01T16:00:00[+]08:00"', '"fetched_at":"2001-12-01T16:00:00"'))
        .when(k == 6, F.regexp_replace("text", '"close":[0-9.E]+', '"close":null'))
        .otherwise(F.col("text"))
    )
    return good.select("code", text.alias("text"))


_DOC_TAIL = """t AS (SELECT * FROM (SELECT *, CAST(code AS BIGINT) % 10 AS kk, row_number() OVER (PARTITION BY code ORDER BY dt DESC) AS k FROM fx_bars) WHERE k <= 260)"""


@query(
    "src_daily_docs",
    with_bindings(
        f"""WITH {_DOC_TAIL}
SELECT code, CASE WHEN max(kk) = 1 THEN 'metadata' WHEN max(kk) = 2 THEN 'schema' WHEN max(kk) = 3 AND count(*) > 1 THEN 'dates' WHEN max(kk) = 3 THEN 'metadata'
  WHEN max(kk) = 4 THEN 'unreadable' WHEN max(kk) = 5 THEN 'metadata' WHEN max(kk) = 6 THEN 'rows' END AS problem,
 CASE WHEN max(kk) NOT IN (1,2,3,4,5,6) THEN count(*) END AS bars, CASE WHEN max(kk) NOT IN (1,2,3,4,5,6) THEN CAST(max(dt) AS VARCHAR) END AS last_date,
 CASE WHEN max(kk) NOT IN (1,2,3,4,5,6) THEN {r2('CAST(sum(close) AS DOUBLE)', 2)} END AS close_sum
FROM t GROUP BY code""",
        "fx_bars",
    ),
)
def src_daily_docs(spark, d):
    parsed = docs.parse_daily_documents(_documents(spark, d))
    # one document per code: its bars are summed up where it was parsed
    bar = lambda name, kind: F.col(f"r.{name}").cast(kind)
    return docs.document_rows(parsed, "code", "problem").groupBy("code", "problem").agg(
        F.nullif(F.count("r"), F.lit(0)).alias("bars"),
        F.max(bar("date", "date")).cast("string").alias("last_date"),
        round_dec(F.sum(bar("close", "decimal(18,4)")), 2).alias("close_sum"),
    )


@query(
    "src_daily_docs_lenient",
    with_bindings(
        f"""WITH {_DOC_TAIL} SELECT code, CASE WHEN max(kk) = 3 AND count(*) > 1 THEN 'dates' WHEN max(kk) = 4 THEN 'unreadable' END AS problem FROM t GROUP BY code""",
        "fx_bars",
    ),
)
def src_daily_docs_lenient(spark, d):
    return docs.parse_daily_documents(_documents(spark, d), strict=False).select("code", "problem")


@query(
    "src_snapshot_docs",
    with_bindings(
        """SELECT sym AS code, name, CAST(price AS DOUBLE) AS price FROM fx_snapshot WHERE k % 13 <> 0 AND regexp_full_match(sym, '[489][0-9]{5}')""",
        "fx_snapshot",
    ),
)
def src_snapshot_docs(spark, d):
    row = F.struct(F.col("sym").alias("code"), "name", dbl("price").alias("price"))
    text = F.when(F.col("k") % 13 == 0, "{oops").otherwise(F.to_json(F.struct(F.array(row).alias("rows"))))
    raw = snapshot(spark, d).select(text.alias("text"))
    return docs.second_market_rows(raw, "struct<code:string,name:string,price:double>")


@query(
    "src_csv",
    """SELECT printf('%06d', CAST(p_partkey AS BIGINT)) AS code, p_name AS name, p_brand AS brand, p_type AS kind FROM part WHERE p_partkey % 10 <> 3""",
)
def src_csv(spark, d):
    p = table(spark, d, "part")
    body = F.concat_ws(",", code_of(F.col("p_partkey")), "p_name", "p_brand", "p_type")
    line = F.when(F.col("p_partkey") % 10 == 3, F.concat(F.lit("# "), body)).otherwise(body)
    header = F.concat(F.lit("﻿"), F.lit("code,name,brand,kind"))
    lines = p.select(F.explode(F.when(F.col("p_partkey") == 0, F.array(header, line)).otherwise(F.array(line))).alias("line"))
    return tb.parse_csv_lines(lines, ["code", "name", "brand", "kind"])


@query(
    "src_minutes",
    with_bindings(
        """SELECT code, CAST(trade_date AS VARCHAR) AS trade_date, CAST(ts_min AS VARCHAR) AS ts_min, CAST(close AS DOUBLE) AS close, volume FROM fx_minutes
WHERE trade_date = DATE '2024-01-10' AND code IN (SELECT printf('%06d', CAST(n_nationkey AS BIGINT)) FROM nation WHERE n_regionkey < 3)""",
        "fx_minutes",
    ),
)
def src_minutes(spark, d):
    codes = table(spark, d, "nation").where("n_regionkey < 3").select(
        code_of(F.col("n_nationkey")).alias("code")
    )
    out = tb.load_minutes(minutes(spark, d), "2024-01-10", codes)
    return out.select(
        "code",
        F.col("trade_date").cast("string").alias("trade_date"),
        F.col("ts_min").cast("string").alias("ts_min"),
        dbl("close").alias("close"),
        "volume",
    )


def _watchlists(spark, d):
    """One watchlist document per customer with three codes; some are unreadable."""
    c = table(spark, d, "customer")
    k = F.col("c_custkey")
    stock = lambda x: F.struct(code_of(x).alias("code"), F.lit("n").alias("name"))
    doc = F.struct(
        F.col("c_mktsegment").alias("strategy_profile_id"),
        F.lit("2.0").alias("strategy_version"),
        F.array(stock(k % 100), stock(k % 37), stock(k % 1000 + 1)).alias("stocks"),
    )
    return c.select(F.when(k % 11 == 0, "[]x").otherwise(F.to_json(doc)).alias("text"))


_WATCH = """wl AS (SELECT c_mktsegment AS strategy_profile_id, printf('%06d', CAST(unnest([c_custkey % 100, c_custkey % 37, c_custkey % 1000 + 1]) AS BIGINT)) AS code
 FROM customer WHERE c_custkey % 11 <> 0)"""


@query("src_json_artifacts", f"WITH {_WATCH} SELECT strategy_profile_id, code, '2.0' AS strategy_version, count(*) AS n FROM wl GROUP BY ALL")
def src_json_artifacts(spark, d):
    rows = docs.watchlist_rows(_watchlists(spark, d))
    return rows.groupBy("strategy_profile_id", "code", "strategy_version").agg(F.count(F.lit(1)).alias("n"))


@query(
    "src_calendar",
    """WITH c AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS dt FROM lineitem WHERE l_orderkey % 5 <> 1)
SELECT CAST(dt AS VARCHAR) AS dt, CAST(lag(dt) OVER (ORDER BY dt) AS VARCHAR) AS prev_open, CAST(row_number() OVER (ORDER BY dt) AS INT) AS seq FROM c""",
)
def src_calendar(spark, d):
    text = F.col("l_shipdate").cast("date").cast("string")
    damaged = F.when(F.col("l_orderkey") % 5 == 1, F.regexp_replace(text, "-0", "-")).otherwise(text)
    # damaged dates are either too short or turned into words
    damaged = F.when((F.col("l_orderkey") % 5 == 1) & (F.length(damaged) == 10), "not a date").otherwise(damaged)
    cal = tb.trading_calendar(table(spark, d, "lineitem").select(damaged.alias("trade_date")))
    return cal.select(*[F.col(c).cast("string").alias(c) for c in ("dt", "prev_open")], "seq")


@query(
    "src_universe",
    "SELECT DISTINCT printf('%06d', CAST(o_custkey AS BIGINT)) AS code FROM orders WHERE o_orderstatus = 'O'",
)
def src_universe(spark, d):
    o = table(spark, d, "orders")
    m = o.select(
        code_of(F.col("o_custkey")).alias("code"),
        F.when(F.col("o_orderstatus") == "O", "active").otherwise("suspended").alias("status"),
    )
    return tb.universe(m, include_suspended=False)


# -- raw text --------------------------------------------------------------------


def _tilde_text(spark, d):
    """Tilde payloads: per security an outdated quote followed by the current one."""
    s = snapshot(spark, d)
    k = F.col("k")

    def body(price):
        blank = lambda n: F.lit("~" * (n - 1))  # noqa: E731  (n empty fields in a row)
        slash = F.concat_ws("/", F.lit("1"), F.lit("2"), F.col("amount").cast("string"))
        return F.concat_ws(
            "~",
            F.lit("1"),
            F.concat(F.lit(" "), F.col("name")),
            F.col("code"),
            price,
            F.coalesce(F.col("pre_close").cast("string"), F.lit("")),
            F.col("open").cast("string"),
            blank(24),  # fields 6-29
            F.when(k % 3 == 0, "20011130150003").otherwise("15:00:03"),
            F.lit(""),
            F.lit("x"),  # field 32 is not a number
            F.col("high").cast("string"),
            F.col("low").cast("string"),
            F.when(k % 2 == 0, slash).otherwise("n/a"),
            F.col("volume").cast("string"),
            F.col("volume").cast("string"),
            F.lit("1.5"),
            blank(9),  # fields 39-47
        )

    cd = F.col("code")
    entry = lambda p: F.concat(F.lit("v_bj"), cd, F.lit('="'), body(p), F.lit('";\n'))
    now = F.when(k % 17 == 0, "0.00").otherwise(F.col("price").cast("string"))
    return s.select(k.alias("seq"), F.concat(entry(F.lit("1.25")), entry(now)).alias("text"))


@query(
    "src_raw_quotes",
    with_bindings(
        """SELECT code, name, CASE WHEN k % 17 = 0 THEN 1.25::DOUBLE ELSE CAST(price AS DOUBLE) END AS price,
 coalesce(CAST(pre_close AS DOUBLE), 0) AS pre_close, 0::DOUBLE AS change_pct, CAST(high AS DOUBLE) AS high, CAST(volume * 100 AS DOUBLE) AS volume,
 CASE WHEN k % 2 = 0 THEN CAST(amount AS DOUBLE) ELSE CAST(volume AS DOUBLE) * 10000 END AS amount, 1.5::DOUBLE AS turnover_rate, 0::DOUBLE AS pe_ratio,
 CASE WHEN k % 3 = 0 THEN '2001-11-30T15:00:03' ELSE '15:00:03' END AS quote_time, 'bj' AS market FROM fx_snapshot""",
        "fx_snapshot",
    ),
)
def src_raw_quotes(spark, d):
    q = rt.parse_tilde_quotes(_tilde_text(spark, d))
    return q.select(
        "code", "name", "price", "pre_close", "change_pct", "high", "volume", "amount", "turnover_rate", "pe_ratio",
        "quote_time", "market",
    )


@query(
    "src_raw_quotes_comma",
    with_bindings(
        """SELECT code, name, CAST(price AS DOUBLE) AS price, 2.5::DOUBLE AS change_pct, CAST(volume * 100 AS DOUBLE) AS volume,
 CAST(amount AS DOUBLE) AS amount, 0::DOUBLE AS turnover_rate, 'comma_feed' AS source, 'bj' AS market FROM fx_snapshot WHERE k % 5 <> 2""",
        "fx_snapshot",
    ),
)
def src_raw_quotes_comma(spark, d):
    s = snapshot(spark, d)
    cd = F.col("code")
    price = F.when(F.col("k") % 5 == 2, "-").otherwise(F.col("price").cast("string"))
    body = F.concat_ws(
        ",", "name", F.lit(""), F.lit(""), price, F.lit("2.5"), F.lit(""), F.lit(""), F.lit(""),
        F.col("volume").cast("string"), F.col("amount").cast("string"),
    )
    raw = s.select(F.col("k").alias("seq"), F.concat(F.lit("var hq_str_bj"), cd, F.lit('="'), body, F.lit('";')).alias("text"))
    return rt.parse_comma_quotes(raw)


def _minute_lines(spark, d):
    """Text lines of session bars: each minute twice (the second wins), plus damaged kinds."""
    b = session_bars(spark, d)
    hm = F.date_format("ts", "HHmm")
    mm = F.minute("ts")
    price = F.col("close").cast("string")
    good = F.concat_ws(" ", hm, price, F.col("volume").cast("string"), F.col("amount").cast("string"))
    line = (
        F.when(mm % 10 == 3, F.concat_ws(" ", hm, price))
        .when(mm % 10 == 5, F.concat_ws(" ", F.lit("2561"), price, F.lit("1"), F.lit("1")))
        .when(mm % 10 == 6, F.concat_ws(" ", hm, F.lit("NaN"), F.lit("1"), F.lit("1")))
        .when(mm % 10 == 7, F.concat_ws(" ", hm, price, F.lit("-1"), F.lit("1")))
        .otherwise(good)
    )
    early = F.concat_ws(" ", hm, F.lit("0.01"), F.lit("0"), F.lit("0"))
    m = F.hour("ts") * 60 + F.minute("ts")
    two = F.array(
        F.struct((m * 2).alias("line_no"), early.alias("line")), F.struct((m * 2 + 1).alias("line_no"), line.alias("line"))
    )
    return b.select("code", "trade_date", F.explode(two).alias("x")).select("code", "trade_date", "x.*")


@query(
    "src_raw_minutes",
    with_bindings(
        """SELECT code, CAST(trade_date AS VARCHAR) AS trade_date, strftime(ts, '%H:%M') AS time,
 CASE WHEN m % 10 IN (3,5,6,7) THEN 0.01::DOUBLE ELSE CAST(close AS DOUBLE) END AS price, CASE WHEN m % 10 IN (3,5,6,7) THEN 0::DOUBLE ELSE CAST(volume AS DOUBLE) END AS volume,
 CASE WHEN m % 10 IN (3,5,6,7) THEN 0::DOUBLE ELSE CAST(amount AS DOUBLE) END AS amount FROM fx_session""",
        "fx_session",
    ),
)
def src_raw_minutes(spark, d):
    out = rt.parse_minute_lines(_minute_lines(spark, d), ["code", "trade_date"])
    return out.withColumn("trade_date", F.col("trade_date").cast("string"))


@query(
    "src_label_from_html",
    """SELECT page_id, trim(regexp_extract(html, '<title[^>]*>([^<]+)', 1)) AS label FROM pages WHERE trim(regexp_extract(html, '<title[^>]*>([^<]+)', 1)) <> ''""",
)
def src_label_from_html(spark, d):
    return rt.extract_label(table(spark, d, "pages"), "html", r"<title[^>]*>([^<]+)").select("page_id", "label")


def _master_raw(spark, d):
    o = table(spark, d, "orders")
    c = F.col("o_custkey")
    code = F.concat(F.substring(F.lit("60304892"), (c % 8 + 1).cast("int"), F.lit(1)), F.lpad(c.cast("string"), F.greatest(F.length(c.cast("string")), F.lit(5)), "0"))
    suffix = F.element_at(F.array(F.lit(".SZ"), F.lit(".SH"), F.lit(".BJ"), F.lit("")), (c % 4 + 1).cast("int"))
    last = F.when(F.col("o_orderkey") % 7 == 0, "soon").when(F.col("o_orderkey") % 7 == 1, None).otherwise(
        F.col("o_orderdate").cast("date").cast("string")
    )
    return o.select(
        F.col("o_orderkey").alias("seq"),
        F.concat(code, suffix).alias("secucode"),
        code.alias("security_code"),
        F.col("o_orderpriority").alias("name"),
        F.lit("1995-01-01").alias("listing_date"),
        last.alias("max_trade_date"),
    )


_MASTER = """mr AS (SELECT o_orderkey AS seq, substring('60304892', CAST(o_custkey % 8 + 1 AS INT), 1) || printf('%05d', CAST(o_custkey AS BIGINT)) AS code,
  ['.SZ','.SH','.BJ',''][o_custkey % 4 + 1] AS sfx, o_orderpriority AS name,
  CASE WHEN o_orderkey % 7 = 0 THEN 'soon' WHEN o_orderkey % 7 = 1 THEN '' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS last_trade_date FROM orders),
master AS (SELECT code, name, CASE sfx WHEN '.SZ' THEN 'sz' WHEN '.SH' THEN 'sh' WHEN '.BJ' THEN 'bj' ELSE
   CASE WHEN left(code, 1) = '6' THEN 'sh' WHEN left(code, 1) IN ('0', '3') THEN 'sz' WHEN left(code, 1) IN ('4', '8', '9') THEN 'bj' ELSE '' END END AS market,
  '1995-01-01' AS listing_date, last_trade_date,
  CASE WHEN TRY_CAST(last_trade_date AS DATE) >= DATE '2000-06-01' THEN 'active' WHEN TRY_CAST(last_trade_date AS DATE) IS NOT NULL THEN 'suspended' ELSE 'unknown' END AS status
 FROM mr QUALIFY row_number() OVER (PARTITION BY code ORDER BY seq DESC) = 1)"""


@query("src_master_rows", f"WITH {_MASTER} SELECT * FROM master")
def src_master_rows(spark, d):
    return rt.parse_master_rows(_master_raw(spark, d), "2000-06-01")


def _kline_text(spark, d):
    """Array documents of all bars per security; some rows are too short, some lack the amount."""
    tail = bars(spark, d)
    k = F.dayofmonth("dt")
    full = F.array(*[F.col(c).cast("string") for c in ("dt", "open", "close", "high", "low", "volume", "amount")])
    row = F.when(k % 9 == 4, F.slice(full, 1, 5)).when(k % 9 == 5, F.slice(full, 1, 6)).otherwise(full)
    arr = F.array_sort(F.collect_list(F.struct("dt", row.alias("r"))))  # one bar per trading day at most
    return tail.groupBy("code").agg(F.to_json(F.transform(arr, lambda x: x["r"])).alias("text"))


@query(
    "src_kline_rows",
    with_bindings(
        """WITH t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY dt DESC) AS k FROM fx_bars) WHERE day(dt) % 9 <> 4),
u AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY dt DESC) AS j FROM t)
SELECT code, CAST(dt AS VARCHAR) AS dt, CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close,
 CAST(volume * 100 AS DOUBLE) AS volume, CASE WHEN day(dt) % 9 <> 5 THEN CAST(amount AS DOUBLE) END AS amount FROM u WHERE j <= 30""",
        "fx_bars",
    ),
)
def src_kline_rows(spark, d):
    out = rt.parse_kline_arrays(_kline_text(spark, d), keep=20)
    return out.withColumn("dt", F.col("dt").cast("string"))


@query(
    "src_kline_objects",
    with_bindings(
        """WITH t AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY dt DESC) AS k FROM fx_bars)
SELECT code, CAST(dt AS VARCHAR) AS dt, CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close,
 CAST(volume AS DOUBLE) AS volume, CASE WHEN day(dt) % 9 <> 5 THEN CAST(amount AS DOUBLE) END AS amount FROM t WHERE k <= 40""",
        "fx_bars",
    ),
)
def src_kline_objects(spark, d):
    tail = bars(spark, d)
    day = F.dayofmonth("dt")
    dt = F.col("dt").cast("string")
    row = F.struct(
        F.when(day % 2 == 0, dt).alias("day"),
        F.when(day % 2 == 1, dt).alias("date"),
        *[F.col(c).cast("string").alias(c) for c in ("open", "high", "low", "close", "volume")],
        F.when(day % 9 != 5, F.col("amount").cast("string")).alias("amount"),
    )
    text = tail.groupBy("code").agg(F.to_json(F.collect_list(row)).alias("text"))  # one bar per trading day at most, unordered
    out = rt.parse_kline_objects(text, keep=40)
    return out.withColumn("dt", F.col("dt").cast("string"))


# -- sinks -----------------------------------------------------------------------


@query(
    "snk_tables",
    with_bindings(
        """SELECT CAST(trade_date AS VARCHAR) AS trade_date, count(*) AS rows, CAST(sum(price) AS DOUBLE) AS price_sum FROM fx_snapshot GROUP BY trade_date""",
        "fx_snapshot",
    ),
)
def snk_tables(spark, d):
    path = scratch_dir(spark, "run")
    s = snapshot(spark, d).select("code", dbl("price").alias("price"), "trade_date").withColumn("run_id", F.lit(1))
    s = s.repartition("trade_date")  # one file per date instead of one per task and date
    tb.write_run(s, path)
    tb.write_run(s, path)  # a rerun replaces its own partitions
    back = spark.read.parquet(path)
    return back.groupBy(F.col("trade_date").cast("string").alias("trade_date")).agg(
        F.count(F.lit(1)).alias("rows"), dbl(F.sum(F.col("price").cast("decimal(18,2)"))).alias("price_sum")
    )


@query(
    "snk_manifest",
    with_bindings(
        """SELECT 'market_snapshot' AS artifact, count(*) AS rows, true AS hashed FROM fx_snapshot
UNION ALL SELECT 'market_counts', count(DISTINCT coalesce(market, '-')), true FROM fx_snapshot""",
        "fx_snapshot",
    ),
)
def snk_manifest(spark, d):
    path = scratch_dir(spark, "manifest")
    s = snapshot(spark, d).select("code", "market", dbl("price").alias("price"))
    s.write.parquet(f"{path}/market_snapshot")
    s.groupBy("market").count().write.csv(f"{path}/market_counts", header=True)
    rows = (
        spark.read.parquet(f"{path}/market_snapshot")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("artifact", F.lit("market_snapshot"))
        .unionByName(
            spark.read.csv(f"{path}/market_counts", header=True)
            .agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("artifact", F.lit("market_counts"))
        )
    )
    m = tb.manifest(spark, path, rows)
    return m.groupBy("artifact", "rows").agg(F.min(F.length("sha256") == 64).alias("hashed"))


def _runs(spark, d):
    o = table(spark, d, "orders")
    grade = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "data_ready")
        .when(F.col("o_orderpriority").isin("2-HIGH", "3-MEDIUM"), "data_ready_static_only")
        .otherwise("partial")
    )
    return o.select(
        F.col("o_orderkey").alias("run_id"),
        F.col("o_orderdate").alias("generated_at"),
        F.to_date("o_orderdate").alias("run_date"),
        grade.alias("quality_status"),
        (F.col("o_orderstatus") != "F").alias("has_snapshot"),
    )


@query(
    "snk_latest",
    """WITH p AS (SELECT o_orderkey AS id, o_orderdate AS ts, CASE o_orderpriority WHEN '1-URGENT' THEN 2 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 1 ELSE 0 END AS g FROM orders),
q AS (SELECT 'any' AS pointer, * FROM p UNION ALL SELECT 'static', * FROM p WHERE g >= 1 UNION ALL SELECT 'full', * FROM p WHERE g = 2)
SELECT pointer, max_by(id, (ts, id)) AS run_id, CAST(CAST(max(ts) AS DATE) AS VARCHAR) AS generated_at FROM q GROUP BY pointer""",
)
def snk_latest(spark, d):
    return tb.latest_pointers(_runs(spark, d)).select(
        "pointer", "run_id", F.to_date("generated_at").cast("string").alias("generated_at")
    )


@query(
    "snk_latest_run_lookup",
    """SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS run_date, o_orderkey AS run_id FROM orders WHERE o_orderstatus <> 'F' ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC LIMIT 1""",
)
def snk_latest_run_lookup(spark, d):
    return tb.latest_run_with_snapshot(_runs(spark, d)).select(F.col("run_date").cast("string").alias("run_date"), "run_id")


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_DICT_COLS = {
    "code", "name", "market", "price", "pre_close", "open", "high", "low", "change_pct", "volume", "amount",
    "turnover_rate", "volume_ratio", "circ_mv", "source", "industry", "board",
}


@query(
    "snk_field_dictionary",
    with_bindings(
        " UNION ALL ".join(
            f"SELECT {_sql_text(c)} AS field, {_sql_text(t)} AS description, "
            + (f"(SELECT count({c}) FROM fx_snapshot)" if c in _DICT_COLS else "0")
            + " AS present"
            for c, t in S.SNAPSHOT_FIELDS.items()
        ),
        "fx_snapshot",
    ),
)
def snk_field_dictionary(spark, d):
    return tb.field_dictionary(snapshot(spark, d))


# -- projections -----------------------------------------------------------------


@query(
    "prj_provider_schema",
    with_bindings(
        """SELECT code, name, CASE WHEN k % 5 <> 1 THEN CAST(price AS DOUBLE) END AS price, change_pct, CAST(amount AS DOUBLE) AS amount, circ_mv, industry FROM fx_snapshot""",
        "fx_snapshot",
    ),
)
def prj_provider_schema(spark, d):
    s = snapshot(spark, d)
    vendor = s.select(
        F.col("code").alias("代码"),
        F.col("name").alias("名称"),
        F.when(F.col("k") % 5 == 1, "-").otherwise(F.col("price").cast("string")).alias("最新价"),
        F.col("change_pct").cast("string").alias("涨跌幅"),
        F.col("amount").cast("string").alias("成交额"),
        F.col("circ_mv").alias("流通市值"),
        F.col("industry").alias("所属行业"),
    )
    return nz.provider_schema(vendor, "akshare_em")


_VENDORS = ("efinance", "akshare_em", "sina", "em_datacenter", "tushare")


@query(
    "prj_provider_tables",
    with_bindings(
        " UNION ALL ".join(
            f"SELECT '{v}' AS vendor, code, name, CAST(price AS DOUBLE) AS price, CAST(amount AS DOUBLE) AS amount, "
            f"circ_mv FROM fx_snapshot WHERE k % {len(_VENDORS)} = {i}"
            for i, v in enumerate(_VENDORS)
        ),
        "fx_snapshot",
    ),
)
def prj_provider_tables(spark, d):
    """A part of the snapshot in each vendor's own columns (the last alias of each), normalised and put together."""
    s = snapshot(spark, d)
    parts = []
    for i, vendor in enumerate(_VENDORS):
        names = nz.PROVIDER_ALIASES[vendor]
        shown = s.where(F.col("k") % len(_VENDORS) == i).select(
            *[F.col(c).cast("string").alias(names[c][-1]) for c in ("code", "name", "price", "amount", "circ_mv")]
        )
        parts.append(nz.provider_schema(shown, vendor).withColumn("vendor", F.lit(vendor)))
    both = parts[0]
    for more in parts[1:]:
        both = both.unionByName(more)
    return both


@query(
    "prj_history_schema",
    with_bindings(
        """WITH l AS (SELECT printf('%06d', CAST(l_suppkey AS BIGINT)) AS code, CAST(l_shipdate AS DATE) AS dt, l_extendedprice AS close, l_quantity AS volume,
  (l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity) AS seq FROM lineitem WHERE l_orderkey % 7 <> 2 AND l_orderkey % 7 <> 3),
u AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY code, dt ORDER BY seq DESC) = 1)
SELECT code, CAST(dt AS VARCHAR) AS dt, NULL::DOUBLE AS open, close, volume FROM u QUALIFY row_number() OVER (PARTITION BY code ORDER BY dt DESC) <= 100""",
    ),
)
def prj_history_schema(spark, d):
    li = table(spark, d, "lineitem")
    k = F.col("l_orderkey") % 7
    raw = li.select(
        code_of(F.col("l_suppkey")).alias("code"),
        F.when(k == 2, "bad day").otherwise(F.col("l_shipdate").cast("date").cast("string")).alias("日期"),
        F.when(k == 3, "--").otherwise(F.col("l_extendedprice").cast("string")).alias("收盘"),
        F.col("l_quantity").cast("string").alias("成交量"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity").alias("seq"),
    )
    out = nz.bar_schema(raw, 100, "seq")
    return out.select("code", F.col("dt").cast("string").alias("dt"), "open", "close", "volume")


@query(
    "prj_snapshot_output",
    with_bindings(
        """WITH q AS (SELECT k AS seq, CASE WHEN k % 11 = 0 THEN 'X' || sym WHEN k % 6 = 1 THEN '0' || substr(sym, 2) ELSE sym END AS full_code, * FROM fx_snapshot),
f AS (SELECT CASE WHEN left(full_code, 1) = '0' THEN ltrim(full_code, '0') ELSE full_code END AS shown, * FROM q),
r AS (SELECT CASE WHEN regexp_full_match(shown, '[0-9]{1,6}') THEN lpad(shown, 6, '0') ELSE shown END AS c, * FROM f),
v AS (SELECT * FROM r WHERE regexp_full_match(c, '[0-9]{6}') AND left(c, 1) IN ('6','0','3','4','8','9')
  QUALIFY row_number() OVER (PARTITION BY c ORDER BY seq DESC) = 1)
SELECT c AS code, CASE WHEN left(c, 1) = '6' THEN 'sh' WHEN left(c, 1) IN ('0', '3') THEN 'sz' ELSE 'bj' END AS market, name, CAST(price AS DOUBLE) AS price,
 'a, b' AS concepts, '10:00' AS quote_time, 'T' AS observed_at,
 CASE WHEN k % 3 = 0 THEN 'own' WHEN c IN (SELECT c FROM r WHERE k % 2 = 0) THEN 'prim' WHEN c IN (SELECT c FROM r WHERE k % 5 = 0) THEN 'refx' ELSE 'refdef' END AS source
FROM v""",
        "fx_snapshot",
    ),
)
def prj_snapshot_output(spark, d):
    k = F.col("k")
    raw_code = (
        F.when(k % 11 == 0, F.concat(F.lit("X"), F.col("sym")))
        .when(k % 6 == 1, F.concat(F.lit("0"), F.substring(F.col("sym"), F.lit(2), F.length("sym"))))
        .otherwise(F.col("sym"))
    )
    # leading zeros get lost in some feeds
    shown = F.when(raw_code.startswith("0") & (k % 11 != 0), F.regexp_replace(raw_code, "^0+", "")).otherwise(raw_code)
    base = snapshot(spark, d).select(
        shown.alias("code"),
        "name",
        F.col("price").cast("string").alias("price"),
        F.array(F.lit(" a"), F.lit(""), F.lit("b ")).alias("concepts"),
        F.lit(" 10:00").alias("ticktime"),
        F.when(k % 3 == 0, "own").otherwise(" ").alias("source"),
        k.alias("seq"),
    )
    primary = base.where(k_even("seq"))
    reference = base.where(F.col("seq") % 5 == 0).withColumn("source", F.lit("refx"))
    out = nz.snapshot_output(base, "T", primary, reference, "prim", "refdef", "seq")
    return out.select("code", "market", "name", "price", "concepts", "quote_time", "observed_at", "source")


def k_even(c):
    return F.col(c) % 2 == 0


@query(
    "prj_code_norm",
    """WITH r AS (SELECT p_partkey AS k, CASE p_partkey % 7 WHEN 0 THEN CAST(p_partkey AS VARCHAR) || '.0' WHEN 1 THEN 'sh' || printf('%06d', CAST(p_partkey AS BIGINT))
  WHEN 2 THEN ' ' || p_partkey || ' ' WHEN 3 THEN 'nan' WHEN 4 THEN p_name WHEN 5 THEN '12' || printf('%06d', CAST(p_partkey AS BIGINT)) END AS raw FROM part)
SELECT k, CASE k % 7 WHEN 3 THEN '' WHEN 4 THEN raw WHEN 6 THEN '' ELSE printf('%06d', CAST(k % 1000000 AS BIGINT)) END AS daily,
 CASE k % 7 WHEN 1 THEN raw WHEN 3 THEN 'nan' WHEN 4 THEN raw WHEN 6 THEN '' ELSE printf('%06d', CAST(k % 1000000 AS BIGINT)) END AS live FROM r""",
)
def prj_code_norm(spark, d):
    p = table(spark, d, "part")
    k = F.col("p_partkey")
    padded = code_of(k)
    raw = (
        F.when(k % 7 == 0, F.concat(k.cast("string"), F.lit(".0")))
        .when(k % 7 == 1, F.concat(F.lit("sh"), padded))
        .when(k % 7 == 2, F.concat(F.lit(" "), k.cast("string"), F.lit(" ")))
        .when(k % 7 == 3, "nan")
        .when(k % 7 == 4, F.col("p_name"))
        .when(k % 7 == 5, F.concat(F.lit("12"), padded))
    )
    return p.select(k.alias("k"), tx.normalize_code(raw).alias("daily"), tx.normalize_live_code(raw).alias("live"))


@query(
    "prj_market",
    """WITH c AS (SELECT o_orderkey AS k, printf('%06d', CAST(o_orderkey * 7919 % 1000000 AS BIGINT)) AS code FROM orders),
m AS (SELECT *, CASE WHEN left(code, 1) = '6' THEN 'sh' WHEN left(code, 1) IN ('0', '3') THEN 'sz' WHEN left(code, 1) IN ('4', '8', '9') THEN 'bj' END AS market,
 left(code, 1) IN ('4', '8') OR left(code, 3) = '920' AS second, left(code, 1) IN ('6', '9', '5') AS first FROM c)
SELECT k, code, market, coalesce(market, '') || code AS symbol, CASE WHEN second THEN 'bj' WHEN first THEN 'sh' ELSE 'sz' END || code AS prefix_symbol,
 code || CASE WHEN second THEN '.BJ' WHEN first THEN '.SH' ELSE '.SZ' END AS suffix_symbol, CASE WHEN NOT second THEN CASE WHEN first THEN 'sh.' ELSE 'sz.' END || code END AS dot_symbol,
 CASE WHEN left(code, 3) = '399' THEN 'sz' ELSE 'sh' END || code AS index_symbol FROM m""",
)
def prj_market(spark, d):
    o = table(spark, d, "orders")
    code = code_of((F.col("o_orderkey") * 7919 % 1000000))
    c = o.select(F.col("o_orderkey").alias("k"), code.alias("code"))
    return c.select(
        "k",
        "code",
        tx.market_of("code").alias("market"),
        tx.market_symbol("code").alias("symbol"),
        tx.vendor_symbol("code", "prefix").alias("prefix_symbol"),
        tx.vendor_symbol("code", "suffix").alias("suffix_symbol"),
        tx.vendor_symbol("code", "dot").alias("dot_symbol"),
        tx.index_symbol("code").alias("index_symbol"),
    )


@query(
    "prj_board",
    """WITH c AS (SELECT o_orderkey AS k, printf('%06d', CAST(o_orderkey * 7919 % 1000000 AS BIGINT)) AS code FROM orders)
SELECT k, CASE WHEN left(code, 1) IN ('4', '8', '9') THEN '北交所' WHEN left(code, 3) = '688' THEN '科创板' WHEN left(code, 3) IN ('300', '301') THEN '创业板' WHEN left(code, 3) = '002' THEN '中小板' ELSE '主板' END AS board FROM c""",
)
def prj_board(spark, d):
    o = table(spark, d, "orders")
    code = code_of((F.col("o_orderkey") * 7919 % 1000000))
    return o.select(F.col("o_orderkey").alias("k"), tx.board_of(code).alias("board"))


@query(
    "prj_segment_universe",
    """SELECT DISTINCT printf('%06d', CAST(o_custkey * 7919 % 1000000 AS BIGINT)) AS code FROM orders WHERE left(printf('%06d', CAST(o_custkey * 7919 % 1000000 AS BIGINT)), 1) IN ('4', '8', '9')""",
)
def prj_segment_universe(spark, d):
    o = table(spark, d, "orders")
    return nz.segment_universe(o.select((F.col("o_custkey") * 7919 % 1000000).cast("string").alias("code")))


@query(
    "prj_segment_check",
    """SELECT count(*) AS rows, count(DISTINCT c_custkey) AS distinct_codes, count(CASE WHEN c_custkey % 50 = 0 THEN 1 END) AS invalid,
 count(CASE WHEN c_custkey % 50 = 0 THEN 1 END) = 0 AND count(*) = count(DISTINCT c_custkey) AS valid FROM customer""",
)
def prj_segment_check(spark, d):
    k = F.col("c_custkey")
    code = code_of(k)
    return nz.universe_check(
        table(spark, d, "customer").select(F.when(k % 50 == 0, F.concat(code, F.lit("x"))).otherwise(code).alias("code"))
    )


@query(
    "prj_units",
    with_bindings(
        """SELECT code, CAST(volume * CASE WHEN k % 2 = 0 THEN 100 ELSE 1 END AS DOUBLE) AS volume, CAST(amount AS DOUBLE) * 1000 AS amount, circ_mv * 10000 AS circ_mv FROM fx_snapshot""",
        "fx_snapshot",
    ),
)
def prj_units(spark, d):
    s = snapshot(spark, d).withColumn("unit", F.when(F.col("k") % 2 == 0, "lots").otherwise("shares"))
    out = nz.convert_units(s, {"volume": "unit", "amount": "thousand_yuan", "circ_mv": "ten_thousand_yuan"})
    return out.select("code", "volume", "amount", "circ_mv")


@query(
    "prj_labels",
    """SELECT p_partkey AS k, CASE WHEN p_partkey % 9 = 0 THEN '' ELSE p_name || ',' || p_brand || ',' || p_type END AS label,
 CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE p_name || ', ' || p_brand END AS listed FROM part""",
)
def prj_labels(spark, d):
    k = F.col("p_partkey")
    raw = F.when(k % 9 == 0, " <NA> ").otherwise(
        F.concat(F.lit("  "), F.col("p_name"), F.lit(" 、 "), F.col("p_brand"), F.when(k % 2 == 0, "；").otherwise(" | "), F.col("p_type"))
    )
    arr = F.array(F.concat(F.lit(" "), F.col("p_name")), F.when(k % 3 == 0, F.lit(" ")).otherwise(F.col("p_brand")), F.lit(None).cast("string"))
    return table(spark, d, "part").select(k.alias("k"), tx.label_text(raw).alias("label"), tx.list_text(arr).alias("listed"))


@query(
    "prj_present",
    """SELECT c_custkey AS k, c_custkey % 6 >= 4 AS has_value FROM customer""",
)
def prj_present(spark, d):
    k = F.col("c_custkey")
    raw = F.when(k % 6 == 0, " NaN").when(k % 6 == 1, "None ").when(k % 6 == 2, "").when(k % 6 == 3, None).otherwise(F.col("c_name"))
    return table(spark, d, "customer").select(k.alias("k"), present(raw).alias("has_value"))


_TERMS = "candidate|recommend|buy|sell|signal|score|rank|probability|候选|推荐|买入|卖出|信号|评分|排名|概率"
_SPACES = " || ".join(f"chr({ord(ch)})" for ch in tx.WHITESPACE)


@query(
    "prj_neutral_text",
    f"""WITH t AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN ' BuySignal 推荐: ' || text || ' Score' ELSE text END AS text FROM documents),
c AS (SELECT doc_id, regexp_replace(trim(text, {_SPACES}), '{_TERMS}', 'data', 'gi') AS x FROM t)
SELECT doc_id, md5(x) AS digest, length(x) AS n FROM c""",
)
def prj_neutral_text(spark, d):
    t = table(spark, d, "documents")
    text = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit(" BuySignal 推荐: "), F.col("text"), F.lit(" Score"))).otherwise(F.col("text"))
    clean = tx.neutral_text(text)
    return t.select("doc_id", F.md5(clean.cast("binary")).alias("digest"), F.length(clean).cast("bigint").alias("n"))


@query(
    "prj_neutral_columns",
    f"""SELECT o_orderkey AS k, regexp_replace(trim(o_orderpriority || ' BuySignal', {_SPACES}), '{_TERMS}', 'data', 'gi') AS "data", regexp_replace(o_clerk, '{_TERMS}', 'data', 'gi') AS data_2,
 o_totalprice AS data_3, o_orderdate AS note_data FROM (SELECT o_orderkey, o_orderpriority, 'SCORE ' || o_orderstatus AS o_clerk, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate FROM orders)""",
)
def prj_neutral_columns(spark, d):
    """Clashing names get numbers, text columns are cleaned, others stay."""
    o = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.concat("o_orderpriority", F.lit(" BuySignal")).alias("score"),
        F.concat(F.lit("SCORE "), F.col("o_orderstatus")).alias(" Score"),
        F.col("o_totalprice").alias("SCORE "),
        F.to_date("o_orderdate").cast("string").alias("note_Score"),
    )
    return tx.neutral_columns(o)


@query(
    "prj_required_columns",
    """SELECT * FROM (VALUES ('absent_column', 'absent'), ('void', 'all_null')) t(column_name, problem)
WHERE (SELECT count(*) FROM customer) > 0""",
)
def prj_required_columns(spark, d):
    c = table(spark, d, "customer").withColumn("void", F.when(F.col("c_custkey") < 0, 1))
    return tb.missing_columns(c, ["c_name", "c_acctbal", "void", "absent_column"]).withColumnRenamed("column", "column_name")


@query(
    "prj_nonfinite_null",
    """SELECT s_suppkey AS k, CASE WHEN s_suppkey % 4 = 3 THEN s_acctbal END AS value FROM supplier""",
)
def prj_nonfinite_null(spark, d):
    k = F.col("s_suppkey")
    v = (
        F.when(k % 4 == 0, F.lit(float("nan")))
        .when(k % 4 == 1, F.lit(float("inf")))
        .when(k % 4 == 2, F.lit(float("-inf")))
        .otherwise(F.col("s_acctbal"))
    )
    return nz.strict_numbers(table(spark, d, "supplier").select(k.alias("k"), v.alias("value")))


# -- validation ------------------------------------------------------------------


def _requests(spark, d):
    """One request document per customer; kinds 1..15 break one rule each."""
    c = table(spark, d, "customer")
    k = F.col("c_custkey")
    kind = k % 17
    code = lambda x: F.concat(F.lit('"'), code_of(x), F.lit('"'))
    codes = (
        F.when(kind == 4, F.lit(""))
        .when(kind == 5, F.lit('"12345"'))
        .when(kind == 6, F.concat_ws(",", code(k), code(k)))
        .otherwise(F.concat_ws(",", code(k), code(k + 1)))
    )
    daily = F.concat(
        F.lit('"daily":{"lookback":'),
        F.when(kind == 8, "251").otherwise("60"),
        F.when(kind == 9, ',"fields":["ma","volume"]').otherwise(',"fields":["ma","rsi"]'),
        F.when(kind == 10, ',"x":1').otherwise(""),
        F.lit("}"),
    )
    minute = F.concat(
        F.lit('"minute":{"date":"'),
        F.when(kind == 11, "2024-01-09").otherwise("2024-01-10"),
        F.lit('","start":"'),
        F.when(kind == 12, "9:30").otherwise("09:30"),
        F.lit('","end":"'),
        F.when(kind == 13, "09:00").otherwise("10:00"),
        F.when(kind == 14, '","fields":[]').otherwise('","fields":["vwap"]'),
        F.when(kind == 15, ',"y":1').otherwise(""),
        F.lit("}"),
    )
    text = F.when(kind == 1, "{").otherwise(
        F.concat(
            F.lit('{"schema_version":'),
            F.when(kind == 3, "2").otherwise("1"),
            F.lit(',"request_id":"'),
            F.when(kind == 16, " ").otherwise(k.cast("string")),
            F.lit('","codes":['),
            codes,
            F.lit("]"),
            F.when(kind == 2, ',"extra":1').otherwise(""),
            F.when(kind != 7, F.concat(F.lit(","), daily, F.lit(","), minute)).otherwise(""),
            F.lit("}"),
        )
    )
    return c.select(k.alias("k"), text.alias("text"))


@query(
    "flt_request_validate",
    """SELECT c_custkey AS k, CASE c_custkey % 17 WHEN 1 THEN 'unreadable' WHEN 2 THEN 'unknown_key' WHEN 3 THEN 'schema_version' WHEN 4 THEN 'codes_empty' WHEN 5 THEN 'code_format'
 WHEN 6 THEN 'code_duplicate' WHEN 7 THEN 'no_scope' WHEN 8 THEN 'daily_lookback' WHEN 9 THEN 'daily_fields' WHEN 10 THEN 'daily_unknown_key' WHEN 11 THEN 'minute_date' WHEN 12 THEN 'minute_time'
 WHEN 13 THEN 'minute_order' WHEN 14 THEN 'minute_fields' WHEN 15 THEN 'minute_unknown_key' WHEN 16 THEN 'request_id' ELSE '' END AS problem FROM customer""",
)
def flt_request_validate(spark, d):
    v = nz.validate_requests(_requests(spark, d), "2024-01-10")
    # an unreadable document breaks every rule; its first error names the cause
    first = F.when(F.array_contains("errors", "unreadable"), "unreadable").when(
        F.array_contains("errors", "minute_time") & F.array_contains("errors", "minute_order"), "minute_time"
    ).otherwise(F.array_join("errors", ","))
    return v.select("k", first.alias("problem"))


def _records(spark, d):
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    blank = lambda n, v: F.when(k % n == 0, "").when(k % n == 1, None).otherwise(v)
    return o.select(
        k.alias("k"),
        k.cast("string").alias("decision_id"),
        blank(5, F.lit("p1")).alias("strategy_profile_id"),
        F.when(k % 13 == 0, "legacy").otherwise("2.0.0").alias("strategy_version"),
        blank(7, F.lit("1.6.0")).alias("lifecycle_contract_version"),
        F.lit("2.0.0").alias("schema_version"),
        blank(11, F.lit("2.0.0")).alias("execution_rule_version"),
        F.lit("2.0.0").alias("skill_version"),
        code_of((k % 1000)).alias("code"),
        F.col("o_orderdate").cast("string").alias("timestamp"),
        F.lit("snapshot").alias("action"),
        F.lit("unassessed").alias("state_before"),
        F.col("o_orderstatus").alias("state_after"),
    )


@query(
    "flt_record_validate",
    """WITH r AS (SELECT o_orderkey AS k, o_orderkey % 5 < 2 AS a, o_orderkey % 7 < 2 AS b, o_orderkey % 11 < 2 AS c, o_orderkey % 13 = 0 AS l FROM orders)
SELECT k, concat_ws(',', CASE WHEN a THEN 'empty_field:strategy_profile_id' END, CASE WHEN b THEN 'empty_field:lifecycle_contract_version' END, CASE WHEN c THEN 'empty_field:execution_rule_version' END, 'missing_field:reason_code') AS schema_errors,
 concat_ws(',', CASE WHEN a THEN 'strategy_profile_id' END, CASE WHEN b THEN 'lifecycle_contract_version' END, CASE WHEN c THEN 'execution_rule_version' END) AS missing_versions,
 concat_ws(',', CASE WHEN a THEN 'strategy_profile_id' END, CASE WHEN l THEN 'strategy_version' END, CASE WHEN b THEN 'lifecycle_contract_version' END, CASE WHEN c THEN 'execution_rule_version' END) AS unversioned,
 l OR a::INT + b::INT + c::INT >= 2 AS is_legacy, CASE WHEN a OR b OR c THEN 'legacy_compatible' ELSE 'fully_compatible' END AS migration_status FROM r""",
)
def flt_record_validate(spark, d):
    v = nz.validate_records(_records(spark, d))
    j = lambda c: F.array_join(c, ",").alias(c)
    return v.select("k", j("schema_errors"), j("missing_versions"), j("unversioned"), "is_legacy", "migration_status")

