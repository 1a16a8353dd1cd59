"""Cross-section queries and their check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlake.functions.numeric import round_dec
from barlake.operators import crosssection as cs
from barlake.operators import indicators as ind
from barlake.plans.bindings import bars, dims, r2, snapshot, with_bindings
from barlake.plans.registry import query


@query(
    "agg_rps20",
    with_bindings(
        """WITH r AS (SELECT code, dt, (CAST(close AS DOUBLE) - lag(CAST(close AS DOUBLE), 20) OVER w) / nullif(lag(CAST(close AS DOUBLE), 20) OVER w, 0) AS ret
 FROM fx_bars WINDOW w AS (PARTITION BY code ORDER BY dt)),
k AS (SELECT code, dt, ret, rank() OVER (PARTITION BY dt ORDER BY ret) - 1 AS below, count(*) OVER (PARTITION BY dt, ret) AS cnt, count(*) OVER (PARTITION BY dt) AS n
 FROM r WHERE ret IS NOT NULL)
SELECT r.code, CAST(r.dt AS VARCHAR) AS dt, r.ret AS return_20d, CAST(2 * below + cnt + 1 AS DOUBLE) / 2 / n * 100 AS rps20
FROM r LEFT JOIN k ON k.code = r.code AND k.dt = r.dt""",
        "fx_bars",
    ),
)
def agg_rps20(spark, d):
    h = ind.indicators_history(bars(spark, d)).select("code", "dt", "return_20d")
    return cs.relative_strength(h, ["dt"]).select("code", F.col("dt").cast("string").alias("dt"), "return_20d", "rps20")


_METRICS = f"""count(*) AS total, count(CASE WHEN change_pct > 0 THEN 1 END) AS advance_count,
 count(CASE WHEN change_pct < 0 THEN 1 END) AS decline_count, count(CASE WHEN change_pct = 0 THEN 1 END) AS unchanged_count,
 {r2("CAST(sum(CAST(change_pct AS DECIMAL(28,10))) AS DOUBLE) / nullif(count(change_pct), 0)", 4)} AS avg_change_pct,
 {r2("median(change_pct)", 4)} AS median_change_pct, {r2("CAST(sum(amount) AS DOUBLE)", 2)} AS total_amount,
 {r2("CAST(sum(CAST(turnover_rate AS DECIMAL(28,10))) AS DOUBLE) / nullif(count(turnover_rate), 0)", 4)} AS avg_turnover_rate"""


@query(
    "agg_breadth",
    with_bindings(
        f"""WITH x AS (
 SELECT 'full_market' AS dimension, 'all' AS key, {_METRICS} FROM fx_snapshot
 UNION ALL SELECT 'market', market, {_METRICS} FROM fx_snapshot WHERE market IS NOT NULL GROUP BY market
 UNION ALL SELECT 'board', board, {_METRICS} FROM fx_snapshot WHERE board IS NOT NULL GROUP BY board
 UNION ALL SELECT 'industry', industry, {_METRICS} FROM fx_snapshot WHERE industry <> '' GROUP BY industry)
SELECT * FROM x
UNION ALL SELECT 'market', m, 0, 0, 0, 0, NULL, NULL, NULL, NULL FROM (SELECT unnest(['sh','sz','bj']) AS m)
 WHERE m NOT IN (SELECT key FROM x WHERE dimension = 'market')""",
        "fx_snapshot",
    ),
)
def agg_breadth(spark, d):
    return cs.market_breadth(snapshot(spark, d))


@query(
    "agg_industry",
    with_bindings(
        f"""SELECT industry, count(*) AS component_count, count(CASE WHEN c > 0 THEN 1 END) AS advance_count,
 count(CASE WHEN c < 0 THEN 1 END) AS decline_count, {r2("count(CASE WHEN c > 0 THEN 1 END)::DOUBLE / count(*)", 4)} AS advance_ratio,
 {r2("CAST(sum(CAST(c AS DECIMAL(28,10))) AS DOUBLE) / count(*)", 4)} AS avg_change_pct, {r2("CAST(sum(amount) AS DOUBLE)", 2)} AS total_amount,
 {r2("CAST(sum(CAST(turnover_rate AS DECIMAL(28,10))) AS DOUBLE) / count(turnover_rate)", 4)} AS avg_turnover
FROM (SELECT *, coalesce(change_pct, 0) AS c FROM fx_snapshot WHERE industry IS NOT NULL AND price IS NOT NULL) GROUP BY industry""",
        "fx_snapshot",
    ),
)
def agg_industry(spark, d):
    return cs.industry_aggregate(snapshot(spark, d))


@query(
    "agg_industry_ma",
    with_bindings(
        f"""WITH t AS (SELECT code, close, row_number() OVER (PARTITION BY code ORDER BY dt DESC) AS k FROM fx_bars WHERE dt < DATE '2001-12-01'),
m AS (SELECT code, CASE WHEN count(*) >= 5 THEN CAST(sum(CASE WHEN k <= 5 THEN close END) AS DOUBLE) / 5 END AS ma5,
  CASE WHEN count(*) >= 10 THEN CAST(sum(CASE WHEN k <= 10 THEN close END) AS DOUBLE) / 10 END AS ma10,
  CASE WHEN count(*) >= 20 THEN CAST(sum(CASE WHEN k <= 20 THEN close END) AS DOUBLE) / 20 END AS ma20 FROM t GROUP BY code)
SELECT s.industry, count(*) AS total,
 count(CASE WHEN CAST(price AS DOUBLE) > ma5 THEN 1 END) AS above_ma5, {r2("count(CASE WHEN CAST(price AS DOUBLE) > ma5 THEN 1 END)::DOUBLE / count(*)", 4)} AS above_ma5_pct,
 count(CASE WHEN CAST(price AS DOUBLE) > ma10 THEN 1 END) AS above_ma10, {r2("count(CASE WHEN CAST(price AS DOUBLE) > ma10 THEN 1 END)::DOUBLE / count(*)", 4)} AS above_ma10_pct,
 count(CASE WHEN CAST(price AS DOUBLE) > ma20 THEN 1 END) AS above_ma20, {r2("count(CASE WHEN CAST(price AS DOUBLE) > ma20 THEN 1 END)::DOUBLE / count(*)", 4)} AS above_ma20_pct
FROM fx_snapshot s LEFT JOIN m ON m.code = s.code WHERE trim(s.industry) <> '' GROUP BY s.industry""",
        "fx_snapshot",
    ),
)
def agg_industry_ma(spark, d):
    rec = ind.indicators_as_of(bars(spark, d), ["2001-12-01"])
    return cs.industry_ma_distribution(snapshot(spark, d), rec)


_INDCHG = """ic AS (SELECT coalesce(industry, '未知') AS industry,
  CAST(sum(CAST(change_pct AS DECIMAL(28,10))) AS DOUBLE) / count(change_pct) AS industry_chg
  FROM fx_snapshot GROUP BY 1 HAVING count(change_pct) > 0)"""


@query(
    "agg_industry_change",
    with_bindings(
        f"""WITH {_INDCHG}
SELECT 'top' AS side, CAST(row_number() OVER (ORDER BY industry_chg DESC, industry) AS INT) AS position, industry, {r2('industry_chg', 6)} AS industry_chg FROM ic QUALIFY position <= 5
UNION ALL
SELECT 'bottom', CAST(row_number() OVER (ORDER BY industry_chg, industry DESC) AS INT) AS position, industry, {r2('industry_chg', 6)} AS industry_chg FROM ic QUALIFY position <= 5""",
        "fx_snapshot",
    ),
)
def agg_industry_change(spark, d):
    return cs.industry_extremes(snapshot(spark, d)).withColumn("industry_chg", round_dec("industry_chg", 6))


@query(
    "agg_market_mode",
    with_bindings(
        """WITH v AS (SELECT count(*) AS n, count(CASE WHEN change_pct > 0 THEN 1 END) / count(*)::DOUBLE AS r, median(change_pct) AS m FROM fx_snapshot WHERE change_pct IS NOT NULL)
SELECT n AS valid_rows, r AS advance_ratio, m AS market_median,
 CASE WHEN r < 0.45::DOUBLE THEN 'weak' WHEN r > 0.6::DOUBLE THEN 'strong' ELSE 'normal' END AS mode,
 CASE WHEN r < 0.45::DOUBLE THEN 45 ELSE 40 END AS min_score, CASE WHEN r > 0.6::DOUBLE THEN 2 ELSE 1 END AS max_tail_risk FROM v""",
        "fx_snapshot",
    ),
)
def agg_market_mode(spark, d):
    return cs.market_mode(snapshot(spark, d))


@query(
    "agg_market_counts",
    with_bindings(
        """WITH c AS (SELECT count(CASE WHEN left(sym, 1) = '6' THEN 1 END) AS sh, count(CASE WHEN left(sym, 1) IN ('0', '3') THEN 1 END) AS sz,
 count(CASE WHEN left(sym, 1) IN ('4', '8', '9') THEN 1 END) AS bj FROM fx_snapshot)
SELECT *, 'sh:' || sh || ',sz:' || sz || ',bj:' || bj AS coverage_text FROM c""",
        "fx_snapshot",
    ),
)
def agg_market_counts(spark, d):
    return cs.market_counts(snapshot(spark, d), "sym")


@query(
    "agg_trigger_signal",
    with_bindings(
        """SELECT count(*) AS rows_found, max(change_pct) AS change_pct, max(CAST(price AS DOUBLE)) AS price,
 coalesce(bool_or(change_pct <= -1), false) AS triggered FROM fx_snapshot WHERE code = '000005'""",
        "fx_snapshot",
    ),
)
def agg_trigger_signal(spark, d):
    return cs.trigger_signal(snapshot(spark, d), "000005")


@query(
    "agg_crowding",
    with_bindings(
        f"""WITH c AS (SELECT code, dt, amount, (CAST(close AS DOUBLE) - lag(CAST(close AS DOUBLE)) OVER w) / nullif(lag(CAST(close AS DOUBLE)) OVER w, 0) AS chg
 FROM fx_bars WINDOW w AS (PARTITION BY code ORDER BY dt)),
g AS (SELECT industry, dt, count(chg) AS n, count(CASE WHEN chg > 0 THEN 1 END) / nullif(count(chg), 0)::DOUBLE AS advance_ratio,
  CAST(sum(CAST(chg AS DECIMAL(28,10))) AS DOUBLE) / nullif(count(chg), 0) AS avg_change_pct, CAST(sum(amount) AS DOUBLE) AS amount
 FROM c JOIN fx_dims d ON d.code = c.code GROUP BY industry, dt),
m AS (SELECT *, median(amount) OVER (PARTITION BY industry ORDER BY dt ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS med FROM g)
SELECT industry, CAST(dt AS VARCHAR) AS dt, advance_ratio, {r2('avg_change_pct', 6)} AS avg_change_pct, med AS amount_median_20d,
 amount / greatest(coalesce(med, 0), 1) AS amount_ratio,
 coalesce(advance_ratio >= 0.85::DOUBLE AND avg_change_pct >= 0.04::DOUBLE AND amount / greatest(coalesce(med, 0), 1) >= 1.5::DOUBLE, false) AS industry_crowding
FROM m""",
        "fx_bars",
        "fx_dims",
    ),
)
def agg_crowding(spark, d):
    days = cs.industry_days(bars(spark, d), dims(spark, d))
    out = cs.industry_crowding(days)
    return out.withColumn("dt", F.col("dt").cast("string")).withColumn(
        "avg_change_pct", round_dec("avg_change_pct", 6)
    )


@query(
    "agg_report_counts",
    with_bindings(
        """WITH l AS (SELECT b.code, CAST(max(dt) AS VARCHAR) AS latest_date, max(d.market) AS source,
  CASE WHEN count(*) < 300 THEN 'short' ELSE 'ok' END AS status FROM fx_bars b JOIN fx_dims d ON d.code = b.code GROUP BY b.code)
SELECT 'latest_date' AS dimension, latest_date AS key, count(*) AS n FROM l GROUP BY latest_date
UNION ALL SELECT 'source', source, count(*) FROM l WHERE source IS NOT NULL GROUP BY source
UNION ALL SELECT 'status', status, count(*) FROM l GROUP BY status""",
        "fx_bars",
        "fx_dims",
    ),
)
def agg_report_counts(spark, d):
    per_code = (
        bars(spark, d)
        .groupBy("code")
        .agg(F.max("dt").alias("latest_date"), F.when(F.count(F.lit(1)) < 300, "short").otherwise("ok").alias("status"))
    )
    rep = per_code.join(dims(spark, d).select("code", F.col("market").alias("source")), "code")
    return cs.report_counts(rep, ["latest_date", "source", "status"])
