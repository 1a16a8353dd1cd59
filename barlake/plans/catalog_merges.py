"""Join and merge queries with their check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlake.functions.numeric import dbl
from barlake.operators import indicators as ind
from barlake.operators import merges as mg
from barlake.plans.bindings import AS_OF, bars, code_of, dims, minutes, snapshot, table, with_bindings
from barlake.plans.catalog_indicators import _ATR_FOLD, _RSI_FOLD, _macd_fold
from barlake.plans.catalog_minutes import _CUM, cumulative
from barlake.plans.catalog_sources import _MASTER, _WATCH, _master_raw, _runs, _watchlists
from barlake.plans.registry import query
from barlake.session import materialize
from barlake.sources import documents as docs
from barlake.sources import raw_text as rt


def _live(spark, d):
    """First part of the snapshot as live quotes: some values missing, some codes unpadded, some twice."""
    s = snapshot(spark, d)
    k = F.col("k")
    live = s.where(k % 4 != 0).select(
        k.alias("seq"),
        F.when(k % 3 == 0, F.concat(F.regexp_replace("code", "^0+(?=.)", ""), F.lit(".0"))).otherwise(F.col("code")).alias("code"),
        "name",
        dbl("price").alias("price"),
        F.when(k % 5 != 1, F.col("turnover_rate")).alias("turnover_rate"),
        F.when(k % 6 == 1, "nan").when(k % 6 == 2, " ").otherwise(F.col("industry")).alias("industry"),
    )
    again = live.where(F.col("seq") % 8 == 1).select((F.col("seq") - 1000000).alias("seq"), "code", "name", F.lit(0.5).alias("price"), "turnover_rate", "industry")
    return live.unionByName(again)


def _reference(spark, d):
    s = snapshot(spark, d)
    return s.where(F.col("k") % 2 == 0).select(
        F.col("k").alias("seq"),
        "code",
        "name",
        (dbl("price") + 1).alias("price"),
        (F.col("turnover_rate") + 1).alias("turnover_rate"),
        F.concat(F.lit("R-"), F.col("industry")).alias("industry"),
        "circ_mv",
    )


@query(
    "jn_live_reference",
    with_bindings(
        """SELECT code, name, CASE WHEN k % 4 <> 0 THEN CAST(price AS DOUBLE) ELSE CAST(price AS DOUBLE) + 1 END AS price,
 CASE WHEN k % 4 <> 0 AND k % 5 <> 1 THEN turnover_rate WHEN k % 2 = 0 THEN turnover_rate + 1 END AS turnover_rate,
 CASE WHEN k % 4 <> 0 AND k % 6 NOT IN (1, 2) THEN industry WHEN k % 2 = 0 THEN 'R-' || industry END AS industry,
 CASE WHEN k % 2 = 0 THEN circ_mv END AS circ_mv, 'sz' || code AS symbol FROM fx_snapshot WHERE k % 4 <> 0 OR k % 2 = 0""",
        "fx_snapshot",
    ).replace("'sz' || code", "CASE WHEN left(code, 1) IN ('0', '3') THEN 'sz' WHEN left(code, 1) = '6' THEN 'sh' WHEN left(code, 1) IN ('4', '8', '9') THEN 'bj' ELSE '' END || code"),
)
def jn_live_reference(spark, d):
    return mg.live_with_reference(_live(spark, d), _reference(spark, d), "seq")


@query(
    "jn_bse_merge",
    with_bindings(
        """WITH a AS (SELECT code, market, name, 0 AS o FROM fx_snapshot WHERE k % 3 <> 0), b AS (SELECT code, 'bj' AS market, name || '!' AS name, 1 AS o FROM fx_snapshot WHERE k % 2 = 0 OR k % 3 = 0)
SELECT code, market, name FROM (SELECT * FROM a UNION ALL SELECT * FROM b) QUALIFY row_number() OVER (PARTITION BY code ORDER BY o DESC) = 1""",
        "fx_snapshot",
    ),
)
def jn_bse_merge(spark, d):
    s = snapshot(spark, d)
    a = s.where(F.col("k") % 3 != 0).select("code", "market", "name")
    b = s.where("k % 2 = 0 OR k % 3 = 0").select("code", F.concat("name", F.lit("!")).alias("name"))
    return mg.segment_merge(a, b).select("code", "market", "name")


def _refresh(spark, d):
    s = snapshot(spark, d)
    cached = s.select(F.col("k").alias("seq"), "code", "industry", F.lit(1.0).alias("price"), "volume_ratio", F.lit("old").alias("source"))
    quotes = s.where(F.col("k") % 10 != 3).select(
        "code", F.when(F.col("k") % 10 == 4, 0.0).otherwise(dbl("price")).alias("price"), F.lit("new").alias("source")
    )
    return cached, mg.refresh_segment(cached, quotes, "seq")


@query(
    "jn_refresh_segment",
    with_bindings("SELECT code, industry, CAST(price AS DOUBLE) AS price, 'new' AS source FROM fx_snapshot WHERE k % 10 NOT IN (3, 4)", "fx_snapshot"),
)
def jn_refresh_segment(spark, d):
    return _refresh(spark, d)[1]


@query(
    "jn_refresh_expectation",
    with_bindings(
        """SELECT count(*) AS cached_rows, count(CASE WHEN k % 10 NOT IN (3, 4) THEN 1 END) AS refreshed_rows, greatest(5, CAST(floor(count(*) * 0.98::DOUBLE) AS BIGINT)) AS required_rows,
 count(CASE WHEN k % 10 NOT IN (3, 4) THEN 1 END) >= greatest(5, CAST(floor(count(*) * 0.98::DOUBLE) AS BIGINT)) AS accepted FROM fx_snapshot""",
        "fx_snapshot",
    ),
)
def jn_refresh_expectation(spark, d):
    cached, fresh = _refresh(spark, d)
    return mg.refresh_expectation(cached, fresh, 5)


@query(
    "jn_carry_forward",
    with_bindings(
        """SELECT code, CASE WHEN k % 3 = 0 THEN 0 ELSE CAST(volume AS DOUBLE) END AS volume, CASE WHEN k % 3 = 0 THEN '' ELSE '10:00' END AS quote_time, CASE WHEN k % 3 = 0 THEN coalesce(CASE WHEN k % 2 = 0 THEN source END, 'suspended') ELSE source END AS source,
 k % 3 = 0 AS is_carried FROM fx_snapshot""",
        "fx_snapshot",
    ),
)
def jn_carry_forward(spark, d):
    s = snapshot(spark, d).select("code", "k", dbl("volume").alias("volume"), F.lit("10:00").alias("quote_time"), "source")
    cur = s.where(F.col("k") % 3 != 0)
    prev = s.where("k % 5 <> 0 OR k % 3 = 0").withColumn("source", F.when(F.col("k") % 2 == 0, F.col("source")))
    return mg.carry_forward(cur.drop("k"), prev.drop("k"), "T").drop("observed_at")


def _class_sides(spark, d):
    s = dims(spark, d)
    k = F.col("k")
    ts = lambda n: F.concat(F.lit("2024-01-"), F.lpad((k % n + 1).cast("string"), 2, "0"), F.lit(" 10:00:00"))
    snap = s.select(
        k.alias("seq"),
        F.when(k % 20 == 7, "bad").otherwise(F.col("code")).alias("code"),
        F.when(k % 3 == 0, "nan").otherwise(F.col("sname")).alias("name"),
        F.when(k % 2 == 0, F.col("industry")).otherwise("<NA>").alias("industry"),
        F.when(k % 5 == 0, F.concat(F.col("industry"), F.lit("、"), F.col("board"))).alias("concepts"),
        F.when(k % 6 == 0, "x").otherwise(ts(9)).alias("updated_at"),
    )
    existing = s.where(k % 4 != 1).select(
        k.alias("seq"),
        "code",
        F.concat(F.lit("E"), F.col("sname")).alias("name"),
        F.concat(F.lit("E-"), F.col("industry")).alias("industry"),
        F.when(k % 8 == 0, "ec | ed").alias("concepts"),
        F.when(k % 12 == 0, "esc").alias("supply_chain"),
        F.when(k % 7 != 0, "mapfile").alias("source"),
        ts(13).alias("updated_at"),
    )
    supply = s.where(k % 3 == 1).select(
        k.alias("seq"), "code", F.lit("S-ind").alias("industry"), F.lit("").alias("concepts"), F.lit("t1;t2").alias("supply_chain")
    )
    return snap, existing, supply


_CLASS = """s AS (SELECT k, code, CASE WHEN k % 3 <> 0 THEN sname END AS sname, CASE WHEN k % 2 = 0 THEN industry END AS si, CASE WHEN k % 5 = 0 THEN industry || ',' || board END AS sc,
  CASE WHEN k % 6 <> 0 THEN '2024-01-' || lpad(CAST(k % 9 + 1 AS VARCHAR), 2, '0') || ' 10:00:00' END AS st,
  k % 4 <> 1 AS ein, CASE WHEN k % 4 <> 1 THEN 'E' || sname END AS en, CASE WHEN k % 4 <> 1 THEN 'E-' || industry END AS ei, CASE WHEN k % 4 <> 1 AND k % 8 = 0 THEN 'ec,ed' END AS ec,
  CASE WHEN k % 4 <> 1 AND k % 12 = 0 THEN 'esc' END AS es, CASE WHEN k % 4 <> 1 AND k % 7 <> 0 THEN 'mapfile' END AS esrc, CASE WHEN k % 4 <> 1 THEN '2024-01-' || lpad(CAST(k % 13 + 1 AS VARCHAR), 2, '0') || ' 10:00:00' END AS et,
  k % 3 = 1 AS uin, CASE WHEN k % 3 = 1 THEN 'S-ind' END AS ui, CASE WHEN k % 3 = 1 THEN 't1,t2' END AS us FROM fx_dims WHERE k % 20 <> 7),
cls AS (SELECT code, coalesce(sname, en, '') AS name, coalesce(si, ei, ui, '') AS industry, coalesce(sc, ec, '') AS concepts, coalesce(es, us, '') AS supply_chain,
 CASE WHEN si IS NOT NULL THEN 'snapshot' WHEN ei IS NOT NULL THEN 'existing_map' WHEN ui IS NOT NULL THEN 'supply_chain_file' ELSE 'empty' END AS industry_source,
 CASE WHEN sc IS NOT NULL THEN 'snapshot' WHEN ec IS NOT NULL THEN 'existing_map' ELSE 'empty' END AS concepts_source,
 CASE WHEN es IS NOT NULL THEN 'existing_map' WHEN us IS NOT NULL THEN 'supply_chain_file' ELSE 'empty' END AS supply_chain_source,
 CASE WHEN ein THEN coalesce(esrc, 'provider') WHEN uin THEN 'supply_chain_file' ELSE 'provider' END AS source, coalesce(greatest(st, et), '') AS updated_at,
 CASE WHEN coalesce(si, ei, ui, sc, ec) IS NOT NULL THEN 'covered' ELSE 'missing' END AS coverage_status FROM s)"""


def classification(spark, d):
    return mg.classification_map(*_class_sides(spark, d), "seq")


@query("jn_classification", with_bindings(f"WITH {_CLASS.replace('sname END AS sname', 'd.sname END AS sname').replace('FROM fx_dims', 'FROM fx_dims d')} SELECT * FROM cls", "fx_dims"))
def jn_classification(spark, d):
    return classification(spark, d)


@query(
    "jn_class_enrich",
    with_bindings(
        f"""WITH {_CLASS.replace('sname END AS sname', 'd.sname END AS sname').replace('FROM fx_dims', 'FROM fx_dims d')}
SELECT p.code, CASE WHEN p.k % 3 = 0 THEN nullif(c.industry, '') ELSE p.industry END AS industry, CASE WHEN p.k % 3 = 1 THEN 'own' ELSE nullif(c.concepts, '') END AS concepts
FROM fx_dims p LEFT JOIN cls c ON c.code = p.code""",
        "fx_dims",
    ),
)
def jn_class_enrich(spark, d):
    k = F.col("k")
    s = dims(spark, d).select(
        "code", F.when(k % 3 == 0, "None").otherwise(F.col("industry")).alias("industry"), F.when(k % 3 == 1, "own").otherwise("").alias("concepts")
    )
    return mg.enrich_classification(s, classification(spark, d))


@query(
    "jn_class_accumulate",
    with_bindings(
        """SELECT code, CASE WHEN k % 3 = 0 THEN industry ELSE 'N-' || industry END AS industry FROM fx_dims""", "fx_dims"
    ),
)
def jn_class_accumulate(spark, d):
    s = dims(spark, d)
    old = s.where(F.col("k") % 3 == 0).select("code", "industry")
    new = s.where("k % 3 <> 0 OR k % 2 = 0").select(F.col("k").alias("seq"), "code", F.concat(F.lit("N-"), F.col("industry")).alias("industry"))
    twice = new.unionByName(new.select((F.col("seq") + 1000000).alias("seq"), "code", F.lit("late").alias("industry")))
    return mg.insert_only(old, twice, "seq")


@query(
    "jn_class_coverage",
    with_bindings(
        "SELECT count(*) AS snapshot_codes, count(CASE WHEN k % 9 <> 1 THEN 1 END) AS covered, CASE WHEN count(CASE WHEN k % 9 = 1 THEN 1 END) = 0 THEN 'full' ELSE 'partial' END AS coverage_status FROM fx_dims",
        "fx_dims",
    ),
)
def jn_class_coverage(spark, d):
    s = dims(spark, d)
    return mg.classification_coverage(s.where(F.col("k") % 9 != 1), s)


@query(
    "jn_supply_chain",
    """WITH e AS (SELECT p_brand AS theme, printf('%06d', CAST(p_partkey AS BIGINT)) AS code, p_type AS role FROM part WHERE p_partkey % 2 = 0),
n AS (SELECT 'T' || p_size AS theme, printf('%06d', CAST(p_partkey AS BIGINT)) AS code, '' AS role FROM part WHERE p_partkey % 2 = 1 OR p_partkey % 5 = 0)
SELECT * FROM e UNION ALL SELECT * FROM n WHERE code NOT IN (SELECT code FROM e)""",
)
def jn_supply_chain(spark, d):
    p = table(spark, d, "part")
    code = code_of(F.col("p_partkey")).alias("code")
    old = p.where("p_partkey % 2 = 0").select(F.col("p_brand").alias("theme"), code, F.col("p_type").alias("role"))
    new = p.where("p_partkey % 2 = 1 OR p_partkey % 5 = 0").select(F.col("p_partkey").alias("seq"), F.concat(F.lit("T"), F.col("p_size").cast("string")).alias("theme"), code)
    return mg.supply_chain_merge(old, new, "seq")


@query(
    "jn_master_merge",
    f"""WITH {_MASTER} SELECT code, name, status FROM master UNION ALL
SELECT DISTINCT printf('%06d', CAST(c_custkey AS BIGINT)), 'old', 'unknown' FROM customer WHERE printf('%06d', CAST(c_custkey AS BIGINT)) NOT IN (SELECT code FROM master)""",
)
def jn_master_merge(spark, d):
    new = rt.parse_master_rows(_master_raw(spark, d), "2000-06-01").withColumn("seq", F.lit(0))
    old = table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("code"), F.lit("old").alias("name"), F.lit("unknown").alias("status"), F.col("c_custkey").alias("seq")
    )
    return mg.master_merge(old, new, "seq").select("code", "name", "status")


@query("jn_uncovered", with_bindings("SELECT code FROM fx_dims WHERE k % 9 = 1", "fx_dims"))
def jn_uncovered(spark, d):
    s = dims(spark, d)
    return mg.uncovered_codes(s, s.where(F.col("k") % 9 != 1))


def _industry_runs(spark, d):
    """Eight past runs with falling coverage (the newest ones are too thin)."""
    s = dims(spark, d)
    runs = s.select("code", "k", "industry", F.explode(F.sequence(F.lit(1), F.lit(8))).alias("run_id"))
    keep = F.col("k") % 8 < 9 - F.col("run_id")
    return runs.select("run_id", "code", F.when(keep, F.concat(F.col("run_id").cast("string"), F.lit(":"), F.col("industry"))).otherwise(" ").alias("industry"))


@query(
    "jn_industry_backfill",
    with_bindings(
        """WITH r AS (SELECT x.run_id, d.code, CASE WHEN d.k % 8 < 9 - x.run_id THEN x.run_id || ':' || d.industry END AS industry FROM fx_dims d, (SELECT unnest(range(1, 9)) AS run_id) x),
c AS (SELECT run_id, count(industry) / count(*)::DOUBLE AS share FROM r GROUP BY run_id), b AS (SELECT max(run_id) AS run_id FROM (SELECT * FROM c ORDER BY run_id DESC LIMIT 6) WHERE share >= 0.5::DOUBLE)
SELECT d.code, coalesce(r.industry, CASE WHEN d.k % 3 = 0 THEN d.industry ELSE '' END) AS industry, CAST(b.run_id AS VARCHAR) AS industry_origin FROM fx_dims d, b LEFT JOIN r ON r.code = d.code AND r.run_id = b.run_id""",
        "fx_dims",
    ),
)
def jn_industry_backfill(spark, d):
    s = dims(spark, d).select("code", F.when(F.col("k") % 3 == 0, F.col("industry")).otherwise("").alias("industry"))
    return mg.industry_backfill(s, _industry_runs(spark, d)).select("code", "industry", "industry_origin")


@query(
    "jn_indicator_merge",
    with_bindings(
        """WITH t AS (SELECT code, close, row_number() OVER (PARTITION BY code ORDER BY dt DESC) AS k FROM fx_bars WHERE dt < DATE '2001-12-01')
SELECT s.code, s.name, (SELECT CAST(sum(close) AS DOUBLE) / 20 FROM t WHERE t.code = s.code AND k <= 20 HAVING count(*) = 20) AS ma20, s.turnover_rate,
 CASE WHEN s.k % 4 <> 2 THEN (SELECT CAST(max(close) AS DOUBLE) FROM t WHERE t.code = s.code AND k = 1) END AS turnover_rate_ind FROM fx_snapshot s""",
        "fx_snapshot",
    ).replace("HAVING count(*) = 20) AS ma20", "HAVING count(*) = 20) AS ma20x").replace("(SELECT CAST(sum(close) AS DOUBLE) / 20 FROM t WHERE t.code = s.code AND k <= 20 HAVING count(*) = 20) AS ma20x", "CASE WHEN s.k % 4 <> 2 THEN (SELECT CASE WHEN count(*) = 20 THEN CAST(sum(close) AS DOUBLE) / 20 END FROM t WHERE t.code = s.code AND k <= 20) END AS ma20"),
)
def jn_indicator_merge(spark, d):
    s = snapshot(spark, d)
    rec = ind.indicators_as_of(bars(spark, d), ["2001-12-01"]).where(F.col("code").cast("bigint") % 4 != 2)
    rec = rec.withColumn("turnover_rate", F.col("last_close"))
    out = mg.add_indicators(s, rec, ["ma20", "turnover_rate"])
    return out.select("code", "name", "ma20", "turnover_rate", "turnover_rate_ind")


@query(
    "jn_three_way_snapshot",
    with_bindings(
        """SELECT s.code AS symbol, CASE WHEN s.k % 4 <> 1 THEN s.name END AS name, CAST(s.amount AS DOUBLE) * 1000 AS amount, CASE WHEN s.k % 3 <> 0 THEN s.circ_mv * 10000 END AS circ_mv FROM fx_snapshot s""",
        "fx_snapshot",
    ),
)
def jn_three_way_snapshot(spark, d):
    s = snapshot(spark, d).withColumn("ts_code", F.concat("code", F.lit(".SZ")))
    k = F.col("k")
    daily = s.select("ts_code", "amount")
    basics = s.where(k % 3 != 0).select("ts_code", "circ_mv", F.col("circ_mv").alias("total_mv"))
    stocks = s.where(k % 4 != 1).select("ts_code", "name", F.when(k % 2 == 0, F.col("code")).alias("symbol"))
    return mg.three_way_snapshot(daily, basics, stocks).select("symbol", "name", "amount", "circ_mv")


_ADJ = """fac AS (SELECT code, dt, CASE WHEN day(dt) % 3 <> 0 THEN 1 + (year(dt) - 1994) * 0.1::DOUBLE END AS f FROM fx_bars WHERE day(dt) % 5 <> 0),
lst AS (SELECT code, max_by(f, dt) AS last FROM fac WHERE f IS NOT NULL GROUP BY code),
j AS (SELECT b.code, b.dt, CAST(b.close AS DOUBLE) AS c, CAST(b.open AS DOUBLE) AS o, first_value(f.f IGNORE NULLS) OVER (PARTITION BY b.code ORDER BY b.dt ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS f
  FROM fx_bars b LEFT JOIN fac f ON f.code = b.code AND f.dt = b.dt)"""


@query(
    "jn_adjust",
    with_bindings(
        f"""WITH {_ADJ} SELECT j.code, CAST(j.dt AS VARCHAR) AS dt, o * f / last AS qfq_open, c * f / last AS qfq_close, c * f AS hfq_close FROM j LEFT JOIN lst ON lst.code = j.code""",
        "fx_bars",
    ),
)
def jn_adjust(spark, d):
    b = bars(spark, d)
    day = F.dayofmonth("dt")
    fac = b.where(day % 5 != 0).select("code", "dt", F.when(day % 3 != 0, 1 + (F.year("dt") - 1994) * 0.1).alias("factor"))
    both = mg.adjust_prices_both(b, fac)
    return both.select("code", F.col("dt").cast("string").alias("dt"), "qfq_open", "qfq_close", "hfq_close")


@query(
    "jn_bars_upsert",
    with_bindings(
        """WITH a AS (SELECT code, dt, CAST(close AS DOUBLE) AS close, 0 AS o FROM fx_bars WHERE dt < DATE '2001-01-01' UNION ALL SELECT code, dt, CAST(close AS DOUBLE) + 1, 1 FROM fx_bars WHERE dt >= DATE '2000-06-01'),
u AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY code, dt ORDER BY o DESC) = 1)
SELECT code, CAST(dt AS VARCHAR) AS dt, close FROM u QUALIFY row_number() OVER (PARTITION BY code ORDER BY dt DESC) <= 260""",
        "fx_bars",
    ),
)
def jn_bars_upsert(spark, d):
    b = bars(spark, d).select("code", "dt", dbl("close").alias("close"))
    old = b.where(F.col("dt") < "2001-01-01")
    tail = b.where(F.col("dt") >= "2000-06-01").withColumn("close", F.col("close") + 1)
    return mg.upsert_bars(old, tail, 260).withColumn("dt", F.col("dt").cast("string"))


@query(
    "jn_minutes_upsert",
    with_bindings(
        """SELECT code, CAST(ts_min AS VARCHAR) AS ts, CASE WHEN mod % 2 = 1 OR mod % 3 = 0 THEN CAST(close AS DOUBLE) + 1 ELSE CAST(close AS DOUBLE) END AS price FROM fx_minutes""",
        "fx_minutes",
    ),
)
def jn_minutes_upsert(spark, d):
    m = minutes(spark, d).select("code", F.col("ts_min").alias("ts"), dbl("close").alias("price"), (F.hour("ts_min") * 60 + F.minute("ts_min")).alias("m"))
    old = m.where(F.col("m") % 2 == 0).select("code", "ts", "price", F.lit(5).alias("seq"))
    new = m.where("m % 2 = 1 OR m % 3 = 0").select("code", "ts", (F.col("price") + 1).alias("price"), F.lit(2).alias("seq"))
    first = m.where("m % 2 = 1 OR m % 3 = 0").select("code", "ts", (F.col("price") + 9).alias("price"), F.lit(1).alias("seq"))
    out = mg.upsert_minutes(old, new.unionByName(first), "seq")
    return out.select("code", F.col("ts").cast("string").alias("ts"), "price")


@query(
    "jn_resume_pending",
    """SELECT printf('%06d', CAST(c_custkey AS BIGINT)) AS code, CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS priority FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')""",
)
def jn_resume_pending(spark, d):
    c = table(spark, d, "customer").withColumn("code", code_of(F.col("c_custkey")))
    done = table(spark, d, "orders").where("o_orderstatus = 'O'").select(code_of(F.col("o_custkey")).alias("code"))
    return mg.pending_codes(c, done.distinct(), c.where("c_mktsegment = 'BUILDING'"))


@query(
    "jn_listing_days",
    """SELECT printf('%06d', CAST(c_custkey AS BIGINT)) AS code, CASE WHEN c_custkey % 4 = 0 THEN date_diff('day', DATE '1996-01-01' + CAST(c_custkey % 2000 AS INT), DATE '2001-12-01') END AS listed_days FROM customer""",
)
def jn_listing_days(spark, d):
    k = F.col("c_custkey")
    c = table(spark, d, "customer").select(code_of(k).alias("code"), "c_custkey")
    ld = F.date_add(F.lit("1996-01-01").cast("date"), (k % 2000).cast("int")).cast("string")
    m = c.where(k % 4 != 1).select("code", F.when(k % 4 == 2, "").when(k % 4 == 3, "unknown").otherwise(F.concat(ld, F.lit(" 00:00:00"))).alias("listing_date"))
    return mg.listing_days(c.select("code"), m, "2001-12-01").withColumn("listed_days", F.col("listed_days").cast("bigint"))


@query(
    "jn_watchlist",
    with_bindings(
        f"""WITH {_WATCH} SELECT code, true AS found, name FROM fx_snapshot WHERE code IN (SELECT code FROM wl)
UNION ALL SELECT DISTINCT code, false, NULL FROM wl WHERE code NOT IN (SELECT code FROM fx_snapshot)""",
        "fx_snapshot",
    ),
)
def jn_watchlist(spark, d):
    s = snapshot(spark, d)
    watch = docs.watchlist_rows(_watchlists(spark, d))
    hit = mg.watchlist_members(s, watch).select("code", F.lit(True).alias("found"), "name")
    return hit.unionByName(mg.watchlist_missing(s, watch).select("code", F.lit(False).alias("found"), F.lit(None).cast("string").alias("name")))


@query(
    "jn_asof_trading_day",
    """WITH c AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS dt FROM lineitem WHERE dayofweek(l_shipdate) NOT IN (0, 6) AND day(l_shipdate) <> 13),
o AS (SELECT o_orderkey AS k, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INT)) AS ts FROM orders),
s AS (SELECT DISTINCT CAST(ts AS DATE) AS d0 FROM o), days AS (SELECT d0 AS dd FROM s UNION SELECT d0 - 1 FROM s),
r AS (SELECT dd, (SELECT max(dt) FROM c WHERE dt <= dd) AS lo FROM days)
SELECT k, CAST(coalesce(a.lo, CAST(ts AS DATE)) AS VARCHAR) AS latest_trading_day, CAST(CASE WHEN (a.lo = CAST(ts AS DATE) OR a.lo IS NULL AND dayofweek(ts) NOT IN (0, 6)) AND hour(ts) >= 15 THEN CAST(ts AS DATE) ELSE coalesce(b.lo, CAST(ts AS DATE) - 1) END AS VARCHAR) AS effective_daily_date
FROM o JOIN r a ON a.dd = CAST(ts AS DATE) JOIN r b ON b.dd = CAST(ts AS DATE) - 1""",
)
def jn_asof_trading_day(spark, d):
    cal = (
        table(spark, d, "lineitem")
        .select(F.col("l_shipdate").cast("date").alias("dt"))
        .where((F.weekday("dt") < 5) & (F.dayofmonth("dt") != 13))
        .distinct()
    )
    o = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("k"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"))).alias("ts"),
    )
    out = mg.as_of_trading_day(o, "ts", mg.dense_calendar(cal))
    return out.select("k", *[F.col(c).cast("string").alias(c) for c in ("latest_trading_day", "effective_daily_date")])


def _snapshots(spark, d):
    r = _runs(spark, d)
    o = table(spark, d, "orders")
    return o.select(
        F.col("o_custkey").alias("key"),
        F.col("o_orderkey").alias("snapshot_id"),
        (F.col("o_orderstatus") == "O").alias("is_live"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
        F.col("o_orderdate").alias("created_at"),
        F.when(F.col("o_orderkey") % 6 == 0, 0).otherwise(100).alias("rows"),
        (F.col("o_orderkey") % 5 != 0).alias("complete"),
    ), r


@query(
    "jn_last_good",
    """WITH u AS (SELECT o_custkey AS key, o_orderkey AS id, o_orderstatus = 'O' AS live, CAST(left(o_orderpriority, 1) AS INT) AS p, o_orderdate AS ts, greatest(date_diff('second', o_orderdate, TIMESTAMP '2001-12-01 12:00:00') / 3600::DOUBLE, 0) AS age
 FROM orders WHERE o_orderkey % 6 <> 0 AND o_orderkey % 5 <> 0)
SELECT key, id AS snapshot_id, NOT live AS fallback_used, CASE WHEN NOT live THEN round(age, 4) END AS stale_age_hours FROM u WHERE live OR age <= 30000
QUALIFY row_number() OVER (PARTITION BY key ORDER BY live DESC, CASE WHEN live THEN p END NULLS LAST, ts DESC, id DESC) = 1""",
)
def jn_last_good(spark, d):
    return mg.last_good_snapshot(_snapshots(spark, d)[0], ["key"], "2001-12-01 12:00:00", 30000)


@query(
    "jn_last_good_reuse",
    """SELECT o_custkey AS key, CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS created_on, coalesce(CAST(max(o_orderdate) AS DATE) = DATE '2001-07-31', false) AS reuse FROM orders GROUP BY o_custkey""",
)
def jn_last_good_reuse(spark, d):
    r = mg.reusable_snapshot(_snapshots(spark, d)[0], ["key"], "2001-07-31 00:10:00", 15)
    return r.select("key", F.to_date("created_at").cast("string").alias("created_on"), "reuse")


def _asks(spark, d):
    """A request per customer: two of thirteen codes, every set of fields, lookbacks from 1 to 250, minutes of five dates."""
    k = F.col("c_custkey")
    day = F.date_add(F.lit("2024-01-08").cast("date"), (k % 5 * 7).cast("int")).cast("string")
    low = 570 + k % 7 * 20
    hhmm = lambda m: F.concat_ws(":", F.lpad(F.floor(m / 60).cast("string"), 2, "0"), F.lpad((m % 60).cast("string"), 2, "0"))

    def some(names):
        bits = (k % 2 ** len(names)).cast("int")
        return F.array_compact(F.array(*[F.when(F.shiftright(bits, i) % 2 == 1, F.lit(n)) for i, n in enumerate(names)]))

    daily = F.struct((k % 250 + 1).cast("int").alias("lookback"), some(("raw", "ma", "rsi", "macd", "atr")).alias("fields"))
    minute = F.struct(day.alias("date"), hhmm(low).alias("start"), hhmm(low + k % 11 * 17).alias("end"), some(("raw", "vwap")).alias("fields"))
    return table(spark, d, "customer").select(
        k.cast("string").alias("request_id"),
        F.array(code_of(k % 12), code_of(k % 12 + 1)).alias("codes"),
        F.when(k % 3 != 0, daily).alias("daily"),
        F.when(k % 4 != 1, minute).alias("minute"),
    )


def _fulfilled(spark, d, today=None, **shown):
    asks = _asks(spark, d)
    # a code counts once, so the list is written: its size then decides how bars are narrowed down, before they are summed up
    codes = materialize(spark, asks.select(F.explode("codes").alias("code")).distinct(), "request-codes")
    b = bars(spark, d).join(codes, "code", "left_semi")
    rec = ind.indicators_as_of(b, [AS_OF])
    tail = ind.cutoff(b, [AS_OF])
    cum = cumulative(spark, d).select(
        "code", F.col("trade_date").alias("date"), (F.hour("ts") * 60 + F.minute("ts")).alias("minute"), dbl("price").alias("price"), "volume", "amount"
    )
    return mg.fulfil_requests(asks, rec, tail, cum, today, **shown)


_ASKED = lambda scope, names, n: f"(CAST(k % {2 ** len(names)} AS INT) >> {names.index(n)}) % 2 = 1"
_D, _M = ("raw", "ma", "rsi", "macd", "atr"), ("raw", "vwap")
_AVGS = ", ".join(f"CASE WHEN count(*) >= {p} THEN CAST(sum(CASE WHEN k <= {p} THEN close END) AS DOUBLE) / {p} END AS ma{p}" for p in (5, 10, 20, 60, 120, 250))
_SHOWN = ", ".join(f"CASE WHEN {_ASKED('daily', _D, 'ma')} THEN ma{p} END AS ma{p}" for p in (5, 10, 20, 60, 120, 250))


def _fulfil_sql(day: str) -> str:
    return f"""{_CUM},
rq AS (SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS request_id, printf('%06d', CAST(unnest([c_custkey % 12, c_custkey % 12 + 1]) AS BIGINT)) AS code, CAST(c_custkey % 250 + 1 AS INT) AS lookback,
 DATE '2024-01-08' + CAST(c_custkey % 5 * 7 AS INT) AS day, 570 + c_custkey % 7 * 20 AS low, 570 + c_custkey % 7 * 20 + c_custkey % 11 * 17 AS high FROM customer),
t AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY dt DESC) AS k FROM fx_bars WHERE dt < DATE '{AS_OF}'),
s0 AS (SELECT code, count(*) AS n, {_AVGS}, max(CASE WHEN k = 1 THEN CAST(close AS DOUBLE) END) AS c1,
  list({{'h': CAST(high AS DOUBLE), 'l': CAST(low AS DOUBLE), 'c': CAST(close AS DOUBLE)}} ORDER BY dt) AS bars,
  list(CAST(dt AS VARCHAR) || '=' || CAST(close AS VARCHAR) ORDER BY dt) AS tail FROM t WHERE k <= 250 GROUP BY code),
s1 AS (SELECT *, {_RSI_FOLD} AS rf, {_macd_fold()} AS mf, {_ATR_FOLD} AS af FROM s0),
s2 AS (SELECT *, CASE WHEN rf.i < 14 THEN NULL WHEN rf.dn = 0 THEN CASE WHEN rf.up > 0 THEN 100::DOUBLE ELSE 50::DOUBLE END ELSE 100 - 100 / (1 + rf.up / rf.dn) END AS rsi,
  CASE WHEN mf.i >= 34 THEN mf.dea END AS dea, CASE WHEN af.i >= 14 THEN af.v END AS atr FROM s1),
mv AS (SELECT request_id, rq.code, count(*) AS n, max_by(volume, m) AS v, max_by(amount, m) AS a, string_agg(m || '=' || CAST(volume AS VARCHAR), ',' ORDER BY m) AS raw
  FROM rq JOIN cum ON cum.code = rq.code AND cum.trade_date = rq.day AND m BETWEEN low AND high WHERE k % 4 <> 1 AND {day} GROUP BY request_id, rq.code),
ff AS (SELECT request_id, rq.code, 'daily' AS scope, s2.code IS NOT NULL AS ok, coalesce(n, 0) AS rows, {_SHOWN},
  CASE WHEN {_ASKED('daily', _D, 'rsi')} THEN rsi END AS rsi14, CASE WHEN {_ASKED('daily', _D, 'macd')} THEN mf.dif END AS macd_dif, CASE WHEN {_ASKED('daily', _D, 'macd')} THEN dea END AS macd_dea,
  CASE WHEN {_ASKED('daily', _D, 'macd')} THEN mf.h0 END AS macd_hist, CASE WHEN {_ASKED('daily', _D, 'atr')} THEN atr END AS atr14, CASE WHEN {_ASKED('daily', _D, 'atr')} THEN atr / nullif(c1, 0) * 100 END AS atr14_pct,
  CASE WHEN {_ASKED('daily', _D, 'raw')} THEN array_to_string(tail[greatest(len(tail) - lookback, 0) + 1:], ',') END AS daily_raw, NULL::DOUBLE AS vwap, NULL::VARCHAR AS minute_raw,
  CASE WHEN s2.code IS NULL THEN 'daily data unavailable' END AS error FROM rq LEFT JOIN s2 ON s2.code = rq.code WHERE k % 3 <> 0
 UNION ALL SELECT rq.request_id, rq.code, 'minute', mv.code IS NOT NULL, coalesce(n, 0), {", ".join(["NULL"] * 13)}, CASE WHEN {_ASKED('minute', _M, 'vwap')} THEN CAST(a AS DOUBLE) / nullif(CAST(v AS DOUBLE), 0) END,
  CASE WHEN {_ASKED('minute', _M, 'raw')} THEN raw END, CASE WHEN NOT ({day}) THEN 'minute request date does not match current date' WHEN mv.code IS NULL THEN 'no minute rows in requested interval' END
  FROM rq LEFT JOIN mv ON mv.request_id = rq.request_id AND mv.code = rq.code WHERE k % 4 <> 1)"""


def _answers(spark, d, today=None):
    """Arrays as text: date=close and minute=volume."""
    daily = lambda r: F.concat_ws("=", r["dt"].cast("string"), r["close"].cast("string"))
    minute = lambda r: F.concat_ws("=", r["minute"].cast("string"), r["volume"].cast("string"))
    df = _fulfilled(spark, d, today, bar_as=daily, minute_as=minute)
    return df.withColumns({"daily_raw": F.array_join("daily_raw", ","), "minute_raw": F.array_join("minute_raw", ",")})


@query("jn_request_fulfil", with_bindings(f"WITH {_fulfil_sql('true')} SELECT * FROM ff", "fx_bars", "fx_session"))
def jn_request_fulfil(spark, d):
    """Requests for any date."""
    return _answers(spark, d)


@query("jn_request_today", with_bindings(f"""WITH {_fulfil_sql("day = DATE '2024-01-15'")} SELECT * FROM ff""", "fx_bars", "fx_session"))
def jn_request_today(spark, d):
    """The same requests where only one date is current."""
    return _answers(spark, d, "2024-01-15")


@query(
    "jn_request_audit",
    with_bindings(
        f"WITH {_fulfil_sql('true')} SELECT request_id, scope, count(*) AS requested, count(CASE WHEN ok THEN 1 END) AS success, count(CASE WHEN NOT ok THEN 1 END) AS failed, CAST(sum(rows) AS BIGINT) AS rows FROM ff GROUP BY request_id, scope",
        "fx_bars",
        "fx_session",
    ),
)
def jn_request_audit(spark, d):
    return mg.request_audit(_fulfilled(spark, d))
