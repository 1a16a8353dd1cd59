"""Screening queries and their check SQL."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from barlake.functions.numeric import round_dec
from barlake.operators import crosssection as cs
from barlake.operators import indicators as ind
from barlake.operators import merges as mg
from barlake.operators import screening as sc
from barlake.plans.bindings import AS_OF, bars, code_of, r2, scan_universe, snapshot, table, with_bindings, written_universe
from barlake.plans.registry import query
from barlake.session import materialize


def _trad(spark, d, quotes=None):
    s = (written_universe(spark, d) if quotes is None else quotes).withColumn("listing_date", F.when(F.col("k") % 5 != 0, F.date_sub(F.lit("2001-12-01").cast("date"), (F.col("k") % 300).cast("int")).cast("string")))
    t = sc.tradability(s, "sym")
    return mg.listing_days(t.drop("listing_date"), s.select("code", "listing_date"), "2001-12-01")


_LIM = "CASE WHEN st THEN 0.05::DOUBLE WHEN board = '北交所' THEN 0.3::DOUBLE WHEN board IN ('科创板', '创业板') THEN 0.2::DOUBLE ELSE 0.1::DOUBLE END"
_TRAD = f"""tr AS (SELECT *, pre_close > 0 AND price >= {r2(f'pre_close * (1 + {_LIM})', 2)} - 0.001::DOUBLE AS up, pre_close > 0 AND price <= {r2(f'pre_close * (1 - {_LIM})', 2)} + 0.001::DOUBLE AS dn
 FROM (SELECT *, CASE WHEN left(sym, 1) IN ('4', '9') THEN '北交所' WHEN left(sym, 3) = '688' THEN '科创板' WHEN left(sym, 3) IN ('300', '301') THEN '创业板' WHEN left(sym, 3) = '002' THEN '中小板' ELSE '主板' END AS board,
  k % 19 = 0 OR k % 23 = 0 AS st, k % 19 = 0 AS delist, k % 31 = 0 AS susp, CASE WHEN k % 5 <> 0 THEN k % 300 END AS listed_days FROM fx_univ)),
hard AS (SELECT * REPLACE (coalesce(industry, '未知') AS industry) FROM tr WHERE NOT st AND NOT delist AND NOT susp AND k % 29 <> 0 AND coalesce(change_pct, 0) < 9.9::DOUBLE AND coalesce(change_pct, 0) > -9.9::DOUBLE
 AND coalesce(market, '') <> 'bj' AND volume > 0 AND (listed_days IS NULL OR listed_days >= 60)),
liq AS (SELECT * FROM hard WHERE amount >= 300000 AND circ_mv >= 20000000 AND turnover_rate BETWEEN 0.5 AND 15),
trd AS (SELECT * FROM (SELECT *, ma5 > ma10 AND ma10 > ma20 AS trend_near, ma5 > ma10 AND ma10 > ma20 AND ma20 > ma60 AS trend_aligned FROM liq
 WHERE ma5 IS NOT NULL AND ma10 IS NOT NULL AND ma20 IS NOT NULL AND ma60 IS NOT NULL AND rsi14 IS NOT NULL AND atr14_pct IS NOT NULL AND boll_position IS NOT NULL)),
ic AS (SELECT industry, CAST(sum(CAST(change_pct AS DECIMAL(28,10))) AS DOUBLE) / count(change_pct) AS industry_chg FROM hard GROUP BY industry HAVING count(change_pct) > 0)"""


@query(
    "scr_tradability",
    with_bindings(f"WITH {_TRAD} SELECT code, board, st AS is_st, delist AS delist_risk, susp AS is_suspended, CAST(listed_days AS BIGINT) AS listed_days, coalesce(up, false) AS is_limit_up, coalesce(dn, false) AS is_limit_down FROM tr", "fx_univ"),
)
def scr_tradability(spark, d):
    return _trad(spark, d).select("code", "board", "is_st", "delist_risk", "is_suspended", F.col("listed_days").cast("bigint").alias("listed_days"), "is_limit_up", "is_limit_down")


def _hard(spark, d, t=None):
    return sc.hard_filter(_trad(spark, d) if t is None else t)


def _liq(df):
    return sc.liquidity_filter(df, 300_000, 20_000_000)


@query("scr_hard_filter", with_bindings(f"WITH {_TRAD} SELECT code, industry, change_pct FROM hard", "fx_univ"))
def scr_hard_filter(spark, d):
    return _hard(spark, d).select("code", "industry", "change_pct")


@query("scr_liquidity", with_bindings(f"WITH {_TRAD} SELECT code, amount, circ_mv, turnover_rate FROM liq", "fx_univ"))
def scr_liquidity(spark, d):
    return _liq(_hard(spark, d)).select("code", "amount", "circ_mv", "turnover_rate")


@query("scr_trend", with_bindings(f"WITH {_TRAD.replace('FROM liq', 'FROM tr')} SELECT code, trend_near, trend_aligned FROM trd", "fx_univ"))
def scr_trend(spark, d):
    return sc.trend_flags(written_universe(spark, d)).select("code", "trend_near", "trend_aligned")


# scores, risk tags and zones are shown for every security, not only for the survivors
_SCORE = f"""sx AS (SELECT u.*, ic.industry_chg, coalesce(ma5 > ma10 AND ma10 > ma20, false) AS near, coalesce(ma5 > ma10 AND ma10 > ma20 AND ma20 > ma60, false) AS al,
  rsi14 BETWEEN 45 AND 65 AS hl, rsi14 BETWEEN 40 AND 70 AS okk, volume_ratio BETWEEN 1.2::DOUBLE AND 3 AS vg, volume_ratio >= 0.8::DOUBLE AND volume_ratio < 1.2::DOUBLE AS vn,
  change_pct BETWEEN 0.5 AND 5 AS cm, change_pct >= -1 AND change_pct < 0.5 AS cf, volume > 0 AND price > amount / nullif(volume, 0) AS av
 FROM tr u LEFT JOIN ic ON ic.industry = u.industry),
sy AS (SELECT *, CASE WHEN al THEN 20 WHEN near THEN 10 ELSE 0 END + CASE WHEN hl THEN 15 WHEN okk THEN 8 ELSE 0 END + CASE WHEN vg THEN 15 WHEN vn THEN 5 ELSE 0 END + CASE WHEN cm THEN 10 WHEN cf THEN 5 ELSE 0 END
  + CASE WHEN av THEN 10 ELSE 0 END + CASE WHEN industry_chg > 0 THEN 10 ELSE 0 END + CASE WHEN return_20d > 0 THEN 10 WHEN return_20d > -0.05::DOUBLE THEN 5 ELSE 0 END AS opportunity_score,
  concat_ws('|', CASE WHEN al THEN 'trend_full' WHEN near THEN 'trend_partial' END, CASE WHEN hl THEN format('rsi_healthy({{:.0f}})', rsi14) WHEN okk THEN format('rsi_ok({{:.0f}})', rsi14) END,
   CASE WHEN vg THEN format('vr_good({{:.1f}})', volume_ratio) WHEN vn THEN format('vr_normal({{:.1f}})', volume_ratio) END, CASE WHEN cm THEN format('chg_moderate({{:+.1f}}%)', change_pct) WHEN cf THEN format('chg_flat({{:+.1f}}%)', change_pct) END,
   CASE WHEN av THEN 'above_vwap' END, CASE WHEN industry_chg > 0 THEN format('ind_sync({{:+.1f}}%)', industry_chg) WHEN industry_chg <= 0 THEN format('ind_weak({{:+.1f}}%)', industry_chg) END,
   CASE WHEN return_20d > 0 THEN format('ret20_pos({{:+.1f}}%)', return_20d * 100) WHEN return_20d > -0.05::DOUBLE THEN 'ret20_flat' END) AS opportunity_tags,
  concat_ws('|', CASE WHEN atr14_pct > 6 THEN 'high_atr' END, CASE WHEN boll_position > 0.95::DOUBLE THEN 'boll_overbought' END, CASE WHEN turnover_rate > 10 THEN 'high_turnover' END, CASE WHEN upper_shadow_ratio > 0.5 THEN 'long_upper_shadow' END) AS tail_risk_tags,
  coalesce(atr14_pct > 6, false)::INT + coalesce(boll_position > 0.95::DOUBLE, false)::INT + coalesce(turnover_rate > 10, false)::INT + coalesce(upper_shadow_ratio > 0.5, false)::INT AS tail_risk_count,
  CASE WHEN atr14 > 0 THEN atr14 ELSE price * 0.02::DOUBLE END AS ax, coalesce(boll_lower, price * 0.95::DOUBLE) AS lx, coalesce(boll_upper, price * 1.05::DOUBLE) AS ux FROM sx),
z1 AS (SELECT *, {r2('greatest(price - ax * 0.5, lx)', 2)} AS buy_low, {r2('price - ax * 0.1::DOUBLE', 2)} AS buy_high, {r2('ux * 0.99::DOUBLE', 2)} AS sell1_low, {r2('ux', 2)} AS sell1_high FROM sy),
z2 AS (SELECT *, {r2('(buy_high + ax * 0.3::DOUBLE) * 1.005::DOUBLE', 2)} AS chase_line, {r2('buy_low - ax * 0.5', 2)} AS protect, {r2('sell1_high + ax * 0.3::DOUBLE', 2)} AS sell2_low, {r2('sell1_high + ax * 0.8::DOUBLE', 2)} AS sell2_high FROM z1),
z3 AS (SELECT *, CASE WHEN buy_high - protect > 0 THEN {r2('(sell1_low - buy_high) / nullif(buy_high - protect, 0)', 2)} ELSE 0 END AS rr_ratio, {r2('ax', 3)} AS atr FROM z2)"""


def _scored(spark, d, t=None):
    t = _trad(spark, d) if t is None else t
    chg = cs.industry_change(sc.hard_filter(t))
    near = (F.col("ma5") > F.col("ma10")) & (F.col("ma10") > F.col("ma20"))
    t = t.withColumns({"trend_near": near, "trend_aligned": near & (F.col("ma20") > F.col("ma60"))}).join(chg, "industry", "left")
    return sc.scan_zones(sc.scan_tail_risk(sc.opportunity_score(t)))


@query("scr_opportunity", with_bindings(f"WITH {_TRAD}, {_SCORE} SELECT code, opportunity_score, opportunity_tags FROM z3", "fx_univ"))
def scr_opportunity(spark, d):
    return _scored(spark, d).select("code", "opportunity_score", F.array_join("opportunity_tags", "|").alias("opportunity_tags"))


@query("scr_tail_risk", with_bindings(f"WITH {_TRAD}, {_SCORE} SELECT code, tail_risk_tags, tail_risk_count FROM z3", "fx_univ"))
def scr_tail_risk(spark, d):
    return _scored(spark, d).select("code", F.array_join("tail_risk_tags", "|").alias("tail_risk_tags"), "tail_risk_count")


_ZONES = ("buy_low", "buy_high", "chase_line", "protect", "sell1_low", "sell1_high", "sell2_low", "sell2_high", "rr_ratio", "atr")


@query("scr_zones", with_bindings(f"WITH {_TRAD}, {_SCORE} SELECT code, {', '.join(_ZONES)} FROM z3", "fx_univ"))
def scr_zones(spark, d):
    return _scored(spark, d).select("code", *_ZONES)


# the scan itself: every filter before the scores, the thresholds of the rules
_SCAN = (
    _TRAD.replace("FROM fx_univ", "FROM fx_scan").replace("amount >= 300000 AND circ_mv >= 20000000", "amount >= 50000000 AND circ_mv >= 3000000000")
    + ", " + _SCORE.replace("FROM tr u LEFT JOIN", "FROM (SELECT * FROM trd WHERE trend_near) u LEFT JOIN")
)
_SELECT = """md AS (SELECT count(CASE WHEN change_pct > 0 THEN 1 END) / count(*)::DOUBLE AS r FROM hard WHERE change_pct IS NOT NULL),
cd AS (SELECT z3.* FROM z3, md WHERE opportunity_score >= CASE WHEN r < 0.45::DOUBLE THEN 45 ELSE 40 END AND tail_risk_count <= CASE WHEN r > 0.6::DOUBLE THEN 2 ELSE 1 END AND rr_ratio >= 1.5::DOUBLE AND industry_chg > 0),
of AS (SELECT code, CAST(row_number() OVER (ORDER BY opportunity_score DESC, code) AS INT) AS position FROM cd WHERE opportunity_score >= 55 AND tail_risk_count = 0 QUALIFY position <= 20),
wt AS (SELECT code, CAST(row_number() OVER (ORDER BY opportunity_score DESC, code) AS INT) AS position FROM cd WHERE code NOT IN (SELECT code FROM of) QUALIFY position <= 15),
sel AS (SELECT cd.code, opportunity_score, tail_risk_count, rr_ratio, CASE WHEN of.code IS NOT NULL THEN 'official' WHEN wt.code IS NOT NULL THEN 'watch' ELSE 'other' END AS list, coalesce(of.position, wt.position) AS position,
 of.code IS NOT NULL AND opportunity_score >= 85 AS fast_entry FROM cd LEFT JOIN of ON of.code = cd.code LEFT JOIN wt ON wt.code = cd.code)"""


def _scan(spark, d):
    return sc.market_scan(_trad(spark, d, scan_universe(spark, d)), partial(materialize, spark))


@query("scr_select", with_bindings(f"WITH {_SCAN}, {_SELECT} SELECT * FROM sel", "fx_scan"))
def scr_select(spark, d):
    chosen, _ = _scan(spark, d)
    return chosen.select("code", "opportunity_score", "tail_risk_count", "rr_ratio", "list", "position", "fast_entry")


@query(
    "scr_funnel",
    with_bindings(
        f"""WITH {_SCAN}, {_SELECT} SELECT (SELECT count(*) FROM tr) AS initial, (SELECT count(*) FROM hard) AS after_hard, (SELECT count(*) FROM liq) AS after_liquidity,
 (SELECT count(*) FROM trd) AS with_indicators, (SELECT count(*) FROM trd WHERE trend_near) AS after_trend, count(*) AS candidates,
 count(CASE WHEN list = 'official' THEN 1 END) AS official, count(CASE WHEN list = 'watch' THEN 1 END) AS watch FROM sel""",
        "fx_scan",
    ),
)
def scr_funnel(spark, d):
    return _scan(spark, d)[1]


# -- first generation ---------------------------------------------------------------

_V1 = f"""w AS (SELECT code, k, name, coalesce(price, 0) AS price, coalesce(high, 0) AS high, coalesce(low, 0) AS low, coalesce(open, 0) AS open, coalesce(change_pct, 0) AS chg, coalesce(volume_ratio, 0) AS vr, coalesce(turnover_rate, 0) AS tor, industry, trade_date,
  coalesce(ma5, 0) AS ma5, coalesce(ma10, 0) AS ma10, coalesce(ma20, 0) AS ma20, coalesce(ma60, 0) AS ma60, ma11, ma23, coalesce(rsi14, 0) AS rsi, coalesce(atr14, 0) AS atr, coalesce(atr14_pct, 0) AS atrp, coalesce(boll_upper, 0) AS bu, coalesce(boll_middle, 0) AS bm, coalesce(boll_lower, 0) AS bl,
  coalesce(return_5d, 0) AS r5, coalesce(return_20d, 0) AS r20, coalesce(rps20, 0) AS rps, coalesce(momentum_delta_1, 0) AS d1, coalesce(momentum_delta_3, 0) AS d3 FROM fx_univ),
v AS (SELECT *, ma5 > 0 AND ma5 > ma10 AND ma10 > ma20 AND ma20 > ma60 AS ta, CASE WHEN bm > 0 THEN least(ma5, bm) ELSE ma5 END AS ba, CASE WHEN bm > 0 THEN greatest(ma5, bm) ELSE ma10 END AS bb, CASE WHEN bu > 0 THEN bu ELSE price * 1.05::DOUBLE END AS sl FROM w),
v1 AS (SELECT *, CASE WHEN high > sl THEN high ELSE sl * 1.02::DOUBLE END AS su, CASE WHEN bl > 0 AND ma20 > 0 THEN least(ma20, bl) ELSE price * 0.95::DOUBLE END AS pp,
  CASE WHEN ta THEN 30 ELSE 0 END + CASE WHEN rsi BETWEEN 40 AND 70 THEN 20 ELSE 0 END + CASE WHEN vr > 1.5::DOUBLE THEN 15 WHEN vr > 0.8::DOUBLE THEN 5 ELSE 0 END + CASE WHEN chg BETWEEN 2 AND 7 THEN 15 WHEN chg > 0 AND chg < 2 THEN 5 ELSE 0 END
   + CASE WHEN rps >= 80 THEN 10 WHEN rps >= 50 THEN 5 ELSE 0 END + CASE WHEN r5 > 0 THEN 5 ELSE 0 END + CASE WHEN r20 > 0 THEN 5 ELSE 0 END AS score,
  (rsi > 80)::INT + (chg > 9)::INT + (price < ma20 AND ma20 > 0)::INT + (tor > 20)::INT AS trc FROM v),
v2 AS (SELECT *, CASE WHEN score >= 60 THEN 'strong' WHEN score >= 40 THEN 'moderate' WHEN score >= 20 THEN 'weak' ELSE 'poor' END AS q, CASE WHEN trc >= 3 THEN 'high' WHEN trc >= 1 THEN 'medium' ELSE 'low' END AS tl FROM v1),
v3 AS (SELECT *, CASE WHEN q IN ('strong', 'moderate') THEN CASE WHEN tl <> 'high' THEN 'can_enter_candidate' ELSE 'conditional_watch' END ELSE 'reject' END AS decision,
  {r2('least(ba, bb)', 2)} AS b1, {r2('greatest(ba, bb)', 2)} AS b2, {r2('sl', 2)} AS s1, {r2('su', 2)} AS s2, {r2('(sl + su) / 2', 2)} AS sc, {r2('pp', 2)} AS prot,
  {r2('CASE WHEN high > 0 AND low > 0 AND price > 0 THEN price / ((high + low + price) / 3) ELSE 1 END', 4)} AS vp FROM v2)"""


@query(
    "scr_v1",
    with_bindings(
        f"WITH {_V1} SELECT code, decision, score AS op_score, q AS opportunity_quality, tl AS tail_risk, trc AS tr_count, b1 AS buy_lower, b2 AS buy_upper, s1 AS sell_lower, s2 AS sell_upper, sc AS sell_center, prot AS protection_price, ta AS trend_aligned, vp AS vwap_position, chg > 0 AS industry_sync_ok FROM v3",
        "fx_univ",
    ),
)
def scr_v1(spark, d):
    c = lambda p, n: F.col(f"computed.{p}").alias(n)
    return sc.first_record(written_universe(spark, d)).select(
        "code", c("dual_axis_decision", "decision"), c("op_score", "op_score"), c("opportunity_quality", "opportunity_quality"), c("tail_risk", "tail_risk"), c("tr_count", "tr_count"),
        c("buy_zone.first_lower", "buy_lower"), c("buy_zone.first_upper", "buy_upper"), c("sell_zone.first_lower", "sell_lower"), c("sell_zone.first_upper", "sell_upper"),
        c("sell_zone.first_center", "sell_center"), c("protection_price", "protection_price"), c("trend_aligned", "trend_aligned"), c("vwap_position", "vwap_position"), c("industry_sync_ok", "industry_sync_ok"),
    )


@query(
    "scr_v1_review",
    with_bindings(
        f"""WITH {_V1}, p AS (SELECT *, row_number() OVER (PARTITION BY decision ORDER BY score DESC, code) AS rn, vp > 1 AND vr > 1.2::DOUBLE AND chg > 0 AND ta AND rsi BETWEEN 40 AND 70 AS ok,
 CASE WHEN price - prot > 0 THEN {r2('(sc - price) / nullif(price - prot, 0)', 2)} ELSE 0 END AS rr FROM v3)
SELECT code, decision, CAST(CASE WHEN rn <= CASE decision WHEN 'can_enter_candidate' THEN 1 WHEN 'conditional_watch' THEN 2 ELSE 0 END THEN rn END AS INT) AS position, vp > 1 AS vwap_ok, vr > 1.2::DOUBLE AS volume_ok,
 CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END AS verdict, rr AS reward_risk_ratio, CASE WHEN rr >= 1.2::DOUBLE THEN 'OK' ELSE 'LOW' END AS rr_verdict FROM p""",
        "fx_univ",
    ),
)
def scr_v1_review(spark, d):
    r = sc.first_review(sc.first_record(written_universe(spark, d)))
    return r.select("code", "decision", "position", F.col("checks.vwap_position").alias("vwap_ok"), F.col("checks.volume_ratio").alias("volume_ok"), "verdict", "reward_risk_ratio", "rr_verdict")


# -- second generation --------------------------------------------------------------


def _v2_input(spark, d):
    """Universe with minute references: stand-ins derived from the bars, absent for some codes."""
    k = F.col("k")
    u = sc.tradability(written_universe(spark, d), "sym")
    return u.withColumns(
        {
            "full_day_vwap": F.when(k % 4 != 0, F.col("amount") / F.col("volume")),
            "afternoon_avwap": F.when(k % 3 != 0, (F.col("high") + F.col("low")) / 2),
            "named_pivot": F.when(k % 5 != 0, F.col("high")),
            "afternoon_swing_low": F.when(k % 6 != 0, F.col("low") * 0.9),
        }
    )


def _v2(spark, d):
    u = _v2_input(spark, d)
    return sc.second_record(u, _industries(u), sc.market_veto(u))


def _industries(u):
    return cs.industry_aggregate(u)


_DF = lambda x: f"(CAST(floor(CAST({x} AS DECIMAL(28,10)) * 100) AS DOUBLE) / 100)"
_DC = lambda x: f"(CAST(ceil(CAST({x} AS DECIMAL(28,10)) * 100) AS DOUBLE) / 100)"
_V2 = f"""{_V1},
x0 AS (SELECT v3.*, u.volume AS vol, u.amount AS amt, u.change_pct AS chgraw, k19.st, k19.susp, CASE WHEN v3.k % 4 <> 0 THEN u.amount / u.volume END AS fdv, CASE WHEN v3.k % 3 <> 0 THEN (u.high + u.low) / 2 END AS pm, CASE WHEN v3.k % 5 <> 0 THEN u.high END AS piv,
  CASE WHEN v3.k % 6 <> 0 THEN u.low * 0.9::DOUBLE END AS sw FROM v3 JOIN fx_univ u ON u.code = v3.code JOIN (SELECT code, k % 19 = 0 OR k % 23 = 0 AS st, k % 31 = 0 AS susp FROM fx_univ) k19 ON k19.code = v3.code),
ia AS (SELECT industry, count(*) AS n, {r2("count(CASE WHEN coalesce(change_pct, 0) > 0 THEN 1 END)::DOUBLE / count(*)", 4)} AS ar, {r2("CAST(sum(CAST(coalesce(change_pct, 0) AS DECIMAL(28,10))) AS DOUBLE) / count(*)", 4)} AS av FROM fx_univ WHERE industry IS NOT NULL AND price IS NOT NULL GROUP BY industry),
mv AS (SELECT count(CASE WHEN change_pct > 0 THEN 1 END) / greatest(count(*), 1)::DOUBLE AS mar FROM fx_univ),
x1 AS (SELECT x0.*, mar, mar < 0.35::DOUBLE AS veto, CASE WHEN bu > bl AND bu > 0 THEN (price - bl) / nullif(bu - bl, 0) ELSE 0.5 END AS bp,
  high <> low AND (high - greatest(open, price)) / nullif(high - low, 0) >= 0.35::DOUBLE AS ls, {r2('CASE WHEN high = low THEN 0 ELSE (high - greatest(open, price)) / nullif(high - low, 0) END', 4)} AS sr,
  CASE WHEN ia.n IS NOT NULL THEN coalesce(ia.n >= 20 AND ar >= 0.5 AND av > 0, false) ELSE chg > 0 END AS sync, CASE WHEN ia.n IS NULL THEN 'own_change' WHEN ia.n >= 20 THEN 'industry' ELSE 'too_few_members' END AS basis
  FROM x0 CROSS JOIN mv LEFT JOIN ia ON ia.industry = x0.industry),
x2 AS (SELECT *, coalesce(CASE WHEN ma11 > 0 THEN ma11 END, price) AS m11, coalesce(CASE WHEN ma23 > 0 THEN ma23 END, price) AS m23, coalesce(ls, false) AS lsx FROM x1),
x3 AS (SELECT *, concat_ws('; ', CASE WHEN NOT (price > m11 AND m11 >= m23) THEN 'price_not_above_ma_sequence' END, CASE WHEN rps < 70 THEN format('rps20_below_70 ({{:.1f}})', rps) END, CASE WHEN NOT (d1 > 0 AND d3 > 0) THEN 'momentum_not_improving' END,
  CASE WHEN rsi >= 78 OR (rsi >= 75 AND bp >= 0.95::DOUBLE) THEN 'overheated' END, CASE WHEN lsx THEN 'terminal_distribution_risk' END) AS tr1,
  concat_ws('; ', CASE WHEN NOT price > m23 THEN 'price_not_above_ma23' END, CASE WHEN r20 < 0.08::DOUBLE THEN format('return_20d_below_8pct ({{:.2f}}%)', r20 * 100) END, CASE WHEN lsx THEN 'terminal_distribution_risk' END) AS pr0,
  coalesce(CASE WHEN low > 0 THEN low END / nullif(fdv, 0) - 1 >= -0.015::DOUBLE AND CASE WHEN low > 0 THEN low END >= m23 - 0.1::DOUBLE * atr, false) AS bnd FROM x2),
x4 AS (SELECT *, CASE WHEN pr0 = '' AND NOT bnd THEN 'pullback_boundary_failed' ELSE pr0 END AS pr1 FROM x3),
x5 AS (SELECT *, CASE WHEN tr1 = '' THEN 'trend_continuation' WHEN pr1 = '' THEN 'strong_pullback_reclaim' END AS pc, CASE WHEN NOT sync AND score >= 60 THEN greatest(score - 15, 55) ELSE score END AS ops,
  concat_ws(',', CASE WHEN rsi > 80 THEN 'rsi_overbought' END, CASE WHEN chg > 9 THEN 'change_excessive_9pct' END, CASE WHEN price < ma20 AND ma20 > 0 THEN 'below_ma20' END, CASE WHEN tor > 20 THEN 'turnover_high' END, CASE WHEN atrp >= 4 THEN 'high_atr_warning' END,
   CASE WHEN lsx THEN 'long_upper_shadow' END, CASE WHEN lsx THEN 'repeated_upper_shadow' END) AS flags,
  (rsi > 80)::INT + (chg > 9)::INT + (price < ma20 AND ma20 > 0)::INT + (tor > 20)::INT + (atrp >= 4)::INT + lsx::INT * 2 AS tcount FROM x4),
x6 AS (SELECT *, CASE WHEN ops >= 60 THEN 'strong' WHEN ops >= 40 THEN 'moderate' WHEN ops >= 20 THEN 'weak' ELSE 'poor' END AS q2, CASE WHEN tcount >= 3 THEN 'high' WHEN tcount >= 1 THEN 'medium' ELSE 'low' END AS t2 FROM x5),
x7 AS (SELECT *, CASE WHEN lsx OR veto THEN 'reject' WHEN q2 IN ('strong', 'moderate') AND t2 IN ('low', 'medium') THEN 'can_enter_candidate' WHEN q2 IN ('strong', 'moderate') THEN 'conditional_watch' WHEN q2 = 'weak' AND t2 = 'low' THEN 'conditional_watch' ELSE 'reject' END AS dec2,
  CASE WHEN lsx THEN 'terminal_distribution_risk' WHEN veto THEN 'market_veto' ELSE '' END AS rc,
  coalesce(CASE WHEN pc = 'trend_continuation' THEN greatest(fdv, pm, piv) WHEN pc = 'strong_pullback_reclaim' THEN greatest(fdv, piv) END, price * 0.998::DOUBLE) AS trg,
  greatest(CASE WHEN bl > 0 AND ma20 > 0 THEN greatest(ma20, bl) ELSE price * 0.95::DOUBLE END, CASE WHEN sw > 0 THEN sw END) AS sup FROM x6),
x8 AS (SELECT *, {_DF('least(trg * 1.015::DOUBLE, price + 0.15::DOUBLE * atr)')} AS nc, {_DC('greatest(trg, price - 0.10::DOUBLE * atr)')} AS zl FROM x7),
x9 AS (SELECT *, {_DF('least(nc, price + least(0.15::DOUBLE * atr, price * 0.005::DOUBLE))')} AS zu FROM x8),
y1 AS (SELECT *, zu + 0.75::DOUBLE * atr AS f1, zu + 1.25::DOUBLE * atr AS f2 FROM x9),
y2 AS (SELECT *, {_DC('f1 - 0.05::DOUBLE * atr')} AS fl, {_DF('f1 + 0.05::DOUBLE * atr')} AS fu, {_DC('f2 - 0.05::DOUBLE * atr')} AS gl, {_DF('f2 + 0.05::DOUBLE * atr')} AS gu FROM y1),
y3 AS (SELECT *, fl <= zu AS inside, NOT fl <= zu AND gl > fu AS second, {_DF('least(greatest(sup - 0.15::DOUBLE * atr, zu - 0.80::DOUBLE * atr), zl - 0.02::DOUBLE)')} AS prp, zu * 100 AS bamt, fl * 100 AS samt FROM y2),
y4 AS (SELECT *, greatest(bamt * 0.0003::DOUBLE, 5) AS bc, greatest(samt * 0.0003::DOUBLE, 5) AS scm, samt * 0.0005::DOUBLE AS stp, bamt * 0.00001::DOUBLE AS bt, samt * 0.00001::DOUBLE AS stt FROM y3),
fin AS (SELECT *, bc + scm + stp + bt + stt AS cost, CASE WHEN NOT (st OR susp) AND pc IS NOT NULL THEN 'deep_watch' ELSE 'rejected' END AS es FROM y4)"""


@query("scr_context", with_bindings(f"WITH {_V2} SELECT code, ta AS ctx_trend_aligned, bp AS ctx_boll_position FROM fin", "fx_univ"))
def scr_context(spark, d):
    return sc.daily_context(_v2_input(spark, d)).select("code", "ctx_trend_aligned", "ctx_boll_position")


@query("scr_upper_shadow", with_bindings(f"WITH {_V2} SELECT code, sr AS day_shadow_ratio, lsx AS long_upper_shadow FROM fin", "fx_univ"))
def scr_upper_shadow(spark, d):
    return sc.upper_shadow(written_universe(spark, d)).select("code", "day_shadow_ratio", F.coalesce("long_upper_shadow", F.lit(False)).alias("long_upper_shadow"))


@query(
    "scr_channels",
    with_bindings(f"WITH {_V2} SELECT code, CASE WHEN tr1 = '' THEN 'pass' ELSE tr1 END AS trend_reason, CASE WHEN pr1 = '' THEN 'pass' ELSE pr1 END AS pullback_reason, 'research_only; production_buyable=false' AS momentum_reason, pc AS primary_channel FROM fin", "fx_univ"),
)
def scr_channels(spark, d):
    r = sc.channels(sc.upper_shadow(sc.daily_context(_v2_input(spark, d))))
    reason = lambda i: F.col("channels")[i]["reason"]
    return r.select("code", reason(0).alias("trend_reason"), reason(1).alias("pullback_reason"), reason(2).alias("momentum_reason"), "primary_channel")


@query(
    "scr_dual_axis",
    with_bindings(f"WITH {_V2} SELECT code, ops AS op_score, q2 AS opportunity_quality, t2 AS tail_risk, flags AS tr_flags, tcount AS tr_count, dec2 AS decision, rc AS reason_code FROM fin", "fx_univ"),
)
def scr_dual_axis(spark, d):
    return _v2(spark, d).select("code", "op_score", "opportunity_quality", "tail_risk", F.array_join("tr_flags", ",").alias("tr_flags"), "tr_count", "decision", "reason_code")


@query(
    "scr_dual_axis_detail",
    with_bindings(
        f"""WITH {_V2} SELECT code, concat_ws(' | ', CASE WHEN ta THEN 'trend_aligned' ELSE 'trend_not_aligned' END, CASE WHEN rsi BETWEEN 40 AND 70 THEN format('rsi_healthy({{:.0f}})', rsi) WHEN rsi < 30 THEN format('rsi_oversold({{:.0f}})', rsi) WHEN rsi > 80 THEN format('rsi_overbought({{:.0f}})', rsi) END,
 CASE WHEN vr > 1.5::DOUBLE THEN format('volume_high({{:.1f}}x)', vr) WHEN vr > 0.8::DOUBLE THEN format('volume_normal({{:.1f}}x)', vr) ELSE format('volume_low({{:.1f}}x)', vr) END,
 CASE WHEN chg BETWEEN 2 AND 7 THEN format('change_moderate({{:+.1f}}%)', chg) WHEN chg > 0 AND chg < 2 THEN format('change_slight({{:+.1f}}%)', chg) WHEN chg > 7 THEN format('change_excessive({{:+.1f}}%)', chg) END,
 CASE WHEN rps >= 80 THEN format('rps_strong({{:.0f}})', floor(rps + 0.5)) WHEN rps >= 50 THEN format('rps_medium({{:.0f}})', floor(rps + 0.5)) END, CASE WHEN r5 > 0 THEN 'return_5d_positive' END, CASE WHEN r20 > 0 THEN 'return_20d_positive' END, CASE WHEN NOT sync THEN 'industry_sync_failed' END) AS op_detail FROM fin""",
        "fx_univ",
    ),
)
def scr_dual_axis_detail(spark, d):
    # whole ranks round half-up, in the check too
    return _v2(spark, d).select("code", "op_detail")


@query("scr_industry_sync", with_bindings(f"WITH {_V2} SELECT code, sync AS industry_sync_pass, basis AS industry_sync_basis FROM fin", "fx_univ"))
def scr_industry_sync(spark, d):
    u = written_universe(spark, d)
    return sc.industry_sync(u, cs.industry_aggregate(u)).select("code", F.coalesce("industry_sync_pass", F.lit(False)).alias("industry_sync_pass"), "industry_sync_basis")


@query("scr_market_veto", with_bindings("WITH m AS (SELECT count(CASE WHEN change_pct > 0 THEN 1 END) / greatest(count(*), 1)::DOUBLE AS r FROM fx_snapshot) SELECT r AS market_advance_ratio, r < 0.35::DOUBLE AS market_veto FROM m", "fx_snapshot"))
def scr_market_veto(spark, d):
    return sc.market_veto(snapshot(spark, d))


@query("scr_trigger_support", with_bindings(f"WITH {_V2} SELECT code, trg AS trigger_reference, sup AS structural_support FROM fin", "fx_univ"))
def scr_trigger_support(spark, d):
    return _v2(spark, d).select("code", "trigger_reference", "structural_support")


@query("scr_buy_zone", with_bindings(f"WITH {_V2} SELECT code, nc AS no_chase_price, zl AS buy_lower, zu AS buy_upper, zl > zu AS buy_zone_empty, price > nc AS above_no_chase FROM fin", "fx_univ"))
def scr_buy_zone(spark, d):
    return _v2(spark, d).select("code", "no_chase_price", "buy_lower", "buy_upper", "buy_zone_empty", "above_no_chase")


@query(
    "scr_sell_zones",
    with_bindings(f"WITH {_V2} SELECT code, fl AS sell1_lower, fu AS sell1_upper, f1 AS sell1_center, CASE WHEN inside THEN 'sell_zone_inside_buy_zone' END AS sell_zone_error, second AS sell2_available, CASE WHEN second THEN gl END AS sell2_lower, CASE WHEN second THEN gu END AS sell2_upper FROM fin", "fx_univ"),
)
def scr_sell_zones(spark, d):
    return _v2(spark, d).select("code", "sell1_lower", "sell1_upper", "sell1_center", "sell_zone_error", "sell2_available", "sell2_lower", "sell2_upper")


@query("scr_protection", with_bindings(f"WITH {_V2} SELECT code, prp AS protection_price, prp < zl AS protection_ok, CASE WHEN prp < zl THEN '' ELSE 'protection_not_constructible' END AS protection_reason FROM fin", "fx_univ"))
def scr_protection(spark, d):
    return _v2(spark, d).select("code", "protection_price", "protection_ok", "protection_reason")


_FEES = ("buy_commission", "sell_commission", "stamp_tax", "total_cost", "net_profit", "net_loss")


@query(
    "scr_fees",
    with_bindings(
        f"WITH {_V2} SELECT code, {r2('bc', 6)} AS buy_commission, {r2('scm', 6)} AS sell_commission, {r2('stp', 6)} AS stamp_tax, {r2('cost', 6)} AS total_cost, {r2('(fl - zu) * 100 - cost', 6)} AS net_profit, {r2('(zu - fl) * 100 - cost', 6)} AS net_loss FROM fin", "fx_univ"
    ),
)
def scr_fees(spark, d):
    return _v2(spark, d).select("code", *[round_dec(c, 6).alias(c) for c in _FEES])


_V2OUT = f"""SELECT code, dec2 AS decision, ops AS op_score, pc AS primary_channel, zl AS buy_lower, zu AS buy_upper, fl AS sell_lower, prp AS protection_price, {r2('(fl - zu) * 100 - cost', 6)} AS net_profit, es AS entry_state,
 left(sha256('watchlist_t1_v1|' || code || '|' || CAST(trade_date AS VARCHAR)), 12) AS decision_id FROM fin"""


@query("scr_v2", with_bindings(f"WITH {_V2} {_V2OUT}", "fx_univ"))
def scr_v2(spark, d):
    n = sc.second_nested(_v2(spark, d))
    c = lambda p, a: F.col(f"computed_v2.{p}").alias(a)
    return n.select(
        "code", c("dual_axis.decision", "decision"), c("dual_axis.op_score", "op_score"), c("primary_channel", "primary_channel"), c("buy_zone.lower", "buy_lower"), c("buy_zone.upper", "buy_upper"),
        c("sell_zone.first_lower", "sell_lower"), c("protection.price", "protection_price"), round_dec("computed_v2.fees.net_profit", 6).alias("net_profit"), c("entry_state", "entry_state"), c("decision_id", "decision_id"),
    )


@query(
    "scr_v2_summary",
    with_bindings(f"WITH {_V2} SELECT count(*) AS total, count(CASE WHEN dec2 = 'can_enter_candidate' THEN 1 END) AS candidates, count(CASE WHEN dec2 = 'conditional_watch' THEN 1 END) AS conditional, count(CASE WHEN dec2 = 'reject' THEN 1 END) AS rejected FROM fin", "fx_univ"),
)
def scr_v2_summary(spark, d):
    return sc.second_summary(sc.second_nested(_v2(spark, d)))


@query(
    "scr_v2_review",
    with_bindings(
        f"""WITH {_V2}, z AS (SELECT code, dec2 AS decision, ops AS op_score, concat_ws(',', CASE WHEN zl > zu THEN 'buy_zone' END, CASE WHEN price > nc THEN 'no_chase' END, CASE WHEN NOT prp < zl THEN 'protection' END, CASE WHEN NOT sync THEN 'industry_sync' END,
 CASE WHEN NOT ta THEN 'trend' END, CASE WHEN NOT rsi BETWEEN 40 AND 70 THEN 'rsi' END) AS failed_checks FROM fin) SELECT *, CASE WHEN failed_checks = '' THEN 'PASS' ELSE 'FAIL' END AS verdict FROM z""",
        "fx_univ",
    ),
)
def scr_v2_review(spark, d):
    return sc.second_review(sc.second_nested(_v2(spark, d))).withColumn("failed_checks", F.array_join("failed_checks", ","))


@query(
    "scr_substitutes",
    """WITH c AS (SELECT c_mktsegment AS profile, c_nationkey AS day, printf('%06d', CAST(c_custkey AS BIGINT)) AS code, ['strong','moderate','weak','poor','?'][c_custkey % 5 + 1] AS q, ['low','medium','high','?'][c_custkey % 4 + 1] AS t,
 CASE WHEN c_custkey % 7 <> 0 THEN floor(c_acctbal / 1000) END AS rr FROM customer)
SELECT profile, day, code, CAST(row_number() OVER (PARTITION BY profile, day ORDER BY CASE q WHEN 'strong' THEN 3 WHEN 'moderate' THEN 2 WHEN 'weak' THEN 1 ELSE 0 END DESC, CASE t WHEN 'low' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END, coalesce(rr, 0) DESC, code) AS INT) AS position FROM c""",
)
def scr_substitutes(spark, d):
    k = F.col("c_custkey")
    word = lambda n, *v: F.element_at(F.array(*[F.lit(x) for x in v]), (k % n + 1).cast("int"))
    c = table(spark, d, "customer").select(
        F.col("c_mktsegment").alias("profile"),
        F.col("c_nationkey").alias("day"),
        code_of(k).alias("code"),
        word(5, "strong", "moderate", "weak", "poor", "?").alias("opportunity_quality"),
        word(4, "low", "medium", "high", "?").alias("tail_risk"),
        F.when(k % 7 != 0, F.floor(F.col("c_acctbal") / 1000)).alias("reward_risk_ratio"),
    )
    return sc.rank_substitutes(c, ["profile", "day"]).select("profile", "day", "code", "position")


@query(
    "scr_indicator_batch",
    with_bindings(f"WITH {_TRAD} SELECT i.code, i.ma5, i.rsi14, i.atr14 FROM fx_ind i WHERE i.code IN (SELECT code FROM liq)", "fx_univ"),
)
def scr_indicator_batch(spark, d):
    survivors = _liq(_hard(spark, d)).select("code")
    wanted = bars(spark, d).join(survivors, "code", "left_semi")
    return ind.indicators_as_of(wanted, [AS_OF]).select("code", "ma5", "rsi14", "atr14")


_V1_SCHEMA = """code string, name string, daily struct<rsi14:double>, computed struct<dual_axis_decision:string,opportunity_quality:string,tail_risk:string,op_score:int,tr_count:int,
 buy_zone:struct<first_lower:double,first_upper:double>,sell_zone:struct<first_lower:double,first_upper:double,first_center:double>,protection_price:double,trend_aligned:boolean,industry_sync_ok:boolean>"""


@query(
    "scr_migrate",
    with_bindings(
        f"""WITH {_V1} SELECT code, CASE WHEN k % 4 = 0 THEN 'reject' ELSE decision END AS decision, CASE WHEN k % 4 = 0 THEN 'poor' ELSE q END AS opportunity_quality, CASE WHEN k % 4 <> 0 AND ta THEN 'trend_continuation' END AS primary_channel,
 CASE WHEN k % 4 = 0 THEN 0 ELSE b1 END AS buy_lower, CASE WHEN k % 4 = 0 THEN 0 ELSE prot END AS protection_price, CASE WHEN k % 4 <> 0 AND decision = 'can_enter_candidate' THEN 'deep_watch' ELSE 'rejected' END AS entry_state, 'migrated_' || code AS decision_id FROM v3""",
        "fx_univ",
    ),
)
def scr_migrate(spark, d):
    rec = sc.first_record(written_universe(spark, d))
    full = F.struct("code", "name", F.struct(F.col("rsi14")).alias("daily"), "computed")
    bare = F.struct("code", "name")
    raw = rec.select(F.when(F.col("k") % 4 == 0, F.to_json(bare)).otherwise(F.to_json(full)).alias("text"))
    c = lambda p, a: F.col(f"computed_v2.{p}").alias(a)
    return sc.migrate_records(raw, _V1_SCHEMA).select(
        "code", c("dual_axis.decision", "decision"), c("dual_axis.opportunity_quality", "opportunity_quality"), c("primary_channel", "primary_channel"), c("buy_zone.lower", "buy_lower"),
        c("protection.price", "protection_price"), c("entry_state", "entry_state"), c("decision_id", "decision_id"),
    )
