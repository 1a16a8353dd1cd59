"""Tradability, filters, scores, price zones and reviews as column transforms.

All inputs are one row per security and date, so nothing here needs a window
except the final rankings.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.functions.numeric import (
    count_if,
    dbl,
    flag_list,
    null0,
    num,
    points,
    round_dec,
    tick_ceil,
    tick_floor,
)
from barlake.functions.ranking import attach_row, binned_row_number, leading_bytes
from barlake.functions.text import BOARD_BSE, BOARD_CHINEXT, BOARD_STAR, board_of
from barlake.operators.crosssection import industry_change, market_mode

# Name patterns, price limits, liquidity limits, fee rates, zone factors.
ST_NAME = r"(?i)\*?ST|退市|PT"
DELIST_NAME = r"(?i)\*ST|退市|PT"
BOARD_LIMITS = {BOARD_BSE: 0.30, BOARD_STAR: 0.20, BOARD_CHINEXT: 0.20}
DEFAULT_LIMIT, ST_LIMIT = 0.10, 0.05
MIN_AMOUNT, MIN_CIRC_MV, TURNOVER_RANGE = 50_000_000, 3_000_000_000, (0.5, 15.0)
COMMISSION, MIN_COMMISSION, STAMP_TAX, TRANSFER = 0.0003, 5.0, 0.0005, 0.00001
TICK = 0.01
NO_INDUSTRY = "未知"
QUALITY_RANK = {"strong": 3, "moderate": 2, "weak": 1, "poor": 0}
RISK_RANK = {"low": 0, "medium": 1, "high": 2}


def zero(c: str) -> Column:
    """Missing number counts as 0."""
    return F.coalesce(dbl(c), F.lit(0.0))


def yes(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


# -- tradability and filters ------------------------------------------------------


def limit_pct(board: Column, is_st: Column) -> Column:
    value = F.lit(DEFAULT_LIMIT)
    for name, pct in BOARD_LIMITS.items():
        value = F.when(board == name, pct).otherwise(value)
    return F.when(is_st, ST_LIMIT).otherwise(value)


def tradability(df: DataFrame, code: str = "code") -> DataFrame:
    """Board, ST / delisting / suspension flags and limit-up / limit-down state.

    A carried-forward row (``is_carried``) counts as suspended.
    """
    has = set(df.columns)
    name = F.coalesce(F.col("name"), F.lit("")) if "name" in has else F.lit("")
    suspended = F.lower(F.coalesce("source", F.lit(""))) == "suspended" if "source" in has else F.lit(False)
    if "is_carried" in has:
        suspended = suspended | yes(F.col("is_carried"))
    staged = df.withColumns(
        {
            "board": board_of(code),
            "is_st": name.rlike(ST_NAME),
            "delist_risk": name.rlike(DELIST_NAME),
            "is_suspended": suspended,
        }
    )
    lim = limit_pct(F.col("board"), F.col("is_st"))
    p, pc = num("price"), num("pre_close")
    up = p >= round_dec(pc * (1 + lim), 2) - 0.001
    down = p <= round_dec(pc * (1 - lim), 2) + 0.001
    return staged.withColumns({"is_limit_up": yes((pc > 0) & up), "is_limit_down": yes((pc > 0) & down)})


def passes_hard(df: DataFrame, max_change: float = 9.9, min_days: int = 60) -> Column:
    """Not ST, suspended, delisting, near its limit, on the second market, untraded or newly listed."""
    has = set(df.columns)

    def flag(c: str) -> Column:
        return yes(F.col(c)) if c in has else F.lit(False)

    name = F.coalesce("name", F.lit(""))
    chg = F.coalesce(num("change_pct"), F.lit(0.0))
    keep = (
        ~(flag("is_st") | flag("is_suspended") | flag("delist_risk"))
        & ~F.upper(name).contains("ST")
        & ~name.contains("退")
        & (chg < max_change)
        & (chg > -max_change)
        & (F.coalesce("market", F.lit("")) != "bj")
        & (F.coalesce(num("volume"), F.lit(0.0)) > 0)
    )
    if "listed_days" in has:
        keep = keep & (F.col("listed_days").isNull() | (F.col("listed_days") >= min_days))
    return keep


def hard_filter(df: DataFrame, max_change: float = 9.9, min_days: int = 60) -> DataFrame:
    """Drop ST, suspended, delisting, near-limit, second-market, untraded and newly listed rows."""
    out = df.where(passes_hard(df, max_change, min_days))
    industry = F.coalesce("industry", F.lit(NO_INDUSTRY)) if "industry" in df.columns else F.lit(NO_INDUSTRY)
    return out.withColumn("industry", industry)


def is_liquid(
    min_amount: float = MIN_AMOUNT, min_circ_mv: float = MIN_CIRC_MV, turnover: tuple[float, float] = TURNOVER_RANGE
) -> Column:
    return (num("amount") >= min_amount) & (num("circ_mv") >= min_circ_mv) & num("turnover_rate").between(*turnover)


def liquidity_filter(
    df: DataFrame, min_amount: float = MIN_AMOUNT, min_circ_mv: float = MIN_CIRC_MV, turnover: tuple[float, float] = TURNOVER_RANGE
) -> DataFrame:
    return df.where(is_liquid(min_amount, min_circ_mv, turnover))


TREND_NEEDS = ("ma5", "ma10", "ma20", "ma60", "rsi14", "atr14_pct", "boll_position")


def rising_averages() -> Column:
    return (F.col("ma5") > F.col("ma10")) & (F.col("ma10") > F.col("ma20"))


def trend_flags(df: DataFrame) -> DataFrame:
    """Rows with all indicators; ``trend_near`` MA5>MA10>MA20, ``trend_aligned`` also MA20>MA60."""
    near = rising_averages()
    return df.dropna(subset=list(TREND_NEEDS)).withColumns(
        {"trend_near": near, "trend_aligned": near & (F.col("ma20") > F.col("ma60"))}
    )


# -- scan scores --------------------------------------------------------------------


def _fmt(pattern: str, c: Column) -> Column:
    """Text with one number (``%.1f`` or ``%+.1f``, any digits), rounded by its exact binary value, ties to even.

    ``format_string`` rounds the shortest decimal half-up: 53.15, which is a little less in binary, would become 53.2.
    """
    before, sign, digits, after = re.fullmatch(r"(.*)%(\+?)\.(\d)f(.*)", pattern).groups()
    number = "0." + "0" * int(digits) if digits != "0" else "0"
    shape = f"+{number};-{number}" if sign else number
    return F.concat(F.lit(before), F.call_function("format_number", c, F.lit(shape)), F.lit(after.replace("%%", "%")))


def opportunity_score(df: DataFrame) -> DataFrame:
    """Points and tags for trend, RSI, volume ratio, change, VWAP, industry and 20-day return."""
    rsi, vr, chg, ret = (dbl(c) for c in ("rsi14", "volume_ratio", "change_pct", "return_20d"))
    healthy, okay = rsi.between(45, 65), rsi.between(40, 70)
    good, normal = vr.between(1.2, 3.0), (vr >= 0.8) & (vr < 1.2)
    moderate, flat = chg.between(0.5, 5.0), (chg >= -1.0) & (chg < 0.5)
    above = (dbl("volume") > 0) & (dbl("price") > dbl("amount") / null0(dbl("volume")))
    sync = dbl("industry_chg")
    aligned, near = yes(F.col("trend_aligned")), yes(F.col("trend_near"))
    score = points(
        (aligned, 20),
        (~aligned & near, 10),
        (healthy, 15),
        (~healthy & okay, 8),
        (good, 15),
        (~good & normal, 5),
        (moderate, 10),
        (~moderate & flat, 5),
        (above, 10),
        (sync > 0, 10),
        (ret > 0, 10),
        (~(ret > 0) & (ret > -0.05), 5),
    )
    tags = flag_list(
        (aligned, "trend_full"),
        (~aligned & near, "trend_partial"),
        (healthy, _fmt("rsi_healthy(%.0f)", rsi)),
        (~healthy & okay, _fmt("rsi_ok(%.0f)", rsi)),
        (good, _fmt("vr_good(%.1f)", vr)),
        (~good & normal, _fmt("vr_normal(%.1f)", vr)),
        (moderate, _fmt("chg_moderate(%+.1f%%)", chg)),
        (~moderate & flat, _fmt("chg_flat(%+.1f%%)", chg)),
        (above, "above_vwap"),
        (sync > 0, _fmt("ind_sync(%+.1f%%)", sync)),
        (sync <= 0, _fmt("ind_weak(%+.1f%%)", sync)),
        (ret > 0, _fmt("ret20_pos(%+.1f%%)", ret * 100)),
        (~(ret > 0) & (ret > -0.05), "ret20_flat"),
    )
    return df.withColumns({"opportunity_score": score, "opportunity_tags": tags})


def scan_tail_risk(df: DataFrame) -> DataFrame:
    tags = flag_list(
        (dbl("atr14_pct") > 6.0, "high_atr"),
        (dbl("boll_position") > 0.95, "boll_overbought"),
        (dbl("turnover_rate") > 10.0, "high_turnover"),
        (dbl("upper_shadow_ratio") > 0.5, "long_upper_shadow"),
    )
    return df.withColumn("tail_risk_tags", tags).withColumn("tail_risk_count", F.size("tail_risk_tags"))


def scan_zones(df: DataFrame) -> DataFrame:
    """Buy / chase / protection / two sell levels and reward-to-risk from price, ATR and Bollinger bands."""
    price = dbl("price")
    atr = F.when(dbl("atr14") > 0, dbl("atr14")).otherwise(price * 0.02)
    lower = F.coalesce(dbl("boll_lower"), price * 0.95)
    upper = F.coalesce(dbl("boll_upper"), price * 1.05)
    s = df.withColumns({"_atr": atr, "_up": upper, "_lo": lower})
    a = F.col("_atr")
    s = s.withColumns(
        {
            "buy_low": round_dec(F.greatest(price - a * 0.5, F.col("_lo")), 2),
            "buy_high": round_dec(price - a * 0.1, 2),
            "sell1_low": round_dec(F.col("_up") * 0.99, 2),
            "sell1_high": round_dec("_up", 2),
        }
    )
    s = s.withColumns(
        {
            "chase_line": round_dec((F.col("buy_high") + a * 0.3) * 1.005, 2),
            "protect": round_dec(F.col("buy_low") - a * 0.5, 2),
            "sell2_low": round_dec(F.col("sell1_high") + a * 0.3, 2),
            "sell2_high": round_dec(F.col("sell1_high") + a * 0.8, 2),
        }
    )
    risk = F.col("buy_high") - F.col("protect")
    reward = F.col("sell1_low") - F.col("buy_high")
    return s.withColumns(
        {"rr_ratio": F.when(risk > 0, round_dec(reward / null0(risk), 2)).otherwise(0.0), "atr": round_dec("_atr", 3)}
    ).drop("_atr", "_up", "_lo")


def candidates(scored: DataFrame, mode: DataFrame, min_rr: float = 1.5) -> DataFrame:
    """Scored rows within the market mode's thresholds (one row) in an industry that rises."""
    one = mode.select("min_score", "max_tail_risk")
    cand = attach_row(scored, one).where(
        (F.col("opportunity_score") >= F.col("min_score"))
        & (F.col("tail_risk_count") <= F.col("max_tail_risk"))
        & (F.col("rr_ratio") >= min_rr)
        & (F.col("industry_chg") > 0)
    )
    return cand.select(*scored.columns)


def short_lists(cand: DataFrame, official_score: int = 55, top: int = 20, watch: int = 15, fast: int = 85) -> DataFrame:
    """Candidates with their list: official (the best ``top`` without tail risk), watch (the next ``watch``), other.

    Positions are numbered only within the two short lists; the candidates
    themselves are never sorted as a whole.  ``cand`` is read three times and
    should be a table.
    """
    order = [F.col("opportunity_score").desc(), F.col("code")]

    def first(df: DataFrame, n: int, name: str) -> DataFrame:
        short = df.select("code", "opportunity_score").orderBy(*order).limit(n)
        w = Window.partitionBy(F.lit(name)).orderBy(*order)  # at most n rows
        return short.select("code", F.lit(name).alias("list"), F.row_number().over(w).alias("position"))

    good = (F.col("opportunity_score") >= official_score) & (F.col("tail_risk_count") == 0)
    official = first(cand.where(good), top, "official")
    rest = cand.join(official.select("code"), "code", "left_anti")
    lists = official.unionByName(first(rest, watch, "watch"))
    return cand.join(F.broadcast(lists), "code", "left").select(  # at most top + watch rows
        *[c for c in cand.columns],
        F.coalesce("list", F.lit("other")).alias("list"),
        "position",
        F.coalesce((F.col("list") == "official") & (F.col("opportunity_score") >= fast), F.lit(False)).alias("fast_entry"),
    )


def scan_scores(df: DataFrame, base: DataFrame) -> DataFrame:
    """Trend filter, industry change of the filtered market, scores, risk tags and zones."""
    chg = industry_change(base)
    trend = trend_flags(df).where(F.col("trend_near")).join(chg, "industry", "left")
    return scan_zones(scan_tail_risk(opportunity_score(trend)))


#: What the steps of a scan after the hard filter read.
SCAN_COLUMNS = (
    "code name industry price change_pct volume amount turnover_rate circ_mv volume_ratio ma5 ma10 ma20 ma60 rsi14 atr14 atr14_pct "
    "boll_position boll_upper boll_lower upper_shadow_ratio return_5d return_20d"
).split()


def market_scan(quotes: DataFrame, stage: Callable[[DataFrame, str], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(candidates with their lists, rows after each step as one row) of a scan over tradable quotes with indicators.

    ``stage(frame, name)`` writes a table and reads it back.  There are two: the
    quotes with the verdict of the hard filter, and the candidates.  Everything
    else starts from one of them, so each step is planned and run once however
    many results read it.
    """
    table = stage(quotes.select(*SCAN_COLUMNS, yes(passes_hard(quotes)).alias("passes_hard")), "scan-quotes")
    hard = table.where("passes_hard").withColumn("industry", F.coalesce("industry", F.lit(NO_INDUSTRY)))
    scored = scan_scores(liquidity_filter(hard), hard)
    chosen = short_lists(stage(candidates(scored, market_mode(hard)), "scan-candidates"))
    liquid = F.col("passes_hard") & is_liquid()
    complete = liquid & reduce(Column.__and__, [F.col(c).isNotNull() for c in TREND_NEEDS])
    steps = table.agg(
        F.count(F.lit(1)).alias("initial"),
        count_if(F.col("passes_hard")).alias("after_hard"),
        count_if(liquid).alias("after_liquidity"),
        count_if(complete).alias("with_indicators"),
        count_if(complete & rising_averages()).alias("after_trend"),
    )
    lists = chosen.agg(
        F.count(F.lit(1)).alias("candidates"), count_if(F.col("list") == "official").alias("official"), count_if(F.col("list") == "watch").alias("watch")
    )
    return chosen, attach_row(steps, lists)


# -- first-generation record ----------------------------------------------------------


def first_record(df: DataFrame) -> DataFrame:
    """First-generation score, quality, tail risk, decision and zones as a ``computed`` struct."""
    price, high, low, chg, vr, tor = (zero(c) for c in ("price", "high", "low", "change_pct", "volume_ratio", "turnover_rate"))
    ma5, ma10, ma20, ma60, rsi = (zero(c) for c in ("ma5", "ma10", "ma20", "ma60", "rsi14"))
    up, mid, lo = (zero(c) for c in ("boll_upper", "boll_middle", "boll_lower"))
    r5, r20, rps = (zero(c) for c in ("return_5d", "return_20d", "rps20"))
    trend = (ma5 > 0) & (ma5 > ma10) & (ma10 > ma20) & (ma20 > ma60)
    a = F.when(mid > 0, F.least(ma5, mid)).otherwise(ma5)
    b = F.when(mid > 0, F.greatest(ma5, mid)).otherwise(ma10)
    sell_low = F.when(up > 0, up).otherwise(price * 1.05)
    sell_up = F.when(high > sell_low, high).otherwise(sell_low * 1.02)
    protect = F.when((lo > 0) & (ma20 > 0), F.least(ma20, lo)).otherwise(price * 0.95)
    healthy, mod, slight = rsi.between(40, 70), chg.between(2, 7), (chg > 0) & (chg < 2)
    score = points(
        (trend, 30), (healthy, 20), (vr > 1.5, 15), ((vr <= 1.5) & (vr > 0.8), 5), (mod, 15), (slight, 5),
        (rps >= 80, 10), ((rps >= 50) & (rps < 80), 5), (r5 > 0, 5), (r20 > 0, 5),
    )
    quality = quality_of(score)
    tr = points((rsi > 80, 1), (chg > 9, 1), ((price < ma20) & (ma20 > 0), 1), (tor > 20, 1))
    risk = F.when(tr >= 3, "high").when(tr >= 1, "medium").otherwise("low")
    good = quality.isin("strong", "moderate")
    decision = F.when(good & (risk != "high"), "can_enter_candidate").when(good, "conditional_watch").otherwise("reject")
    approx = (high + low + price) / 3
    position = F.when((high > 0) & (low > 0) & (price > 0), price / null0(approx)).otherwise(1.0)
    return df.withColumn(
        "computed",
        F.struct(
            decision.alias("dual_axis_decision"),
            score.alias("op_score"),
            quality.alias("opportunity_quality"),
            risk.alias("tail_risk"),
            tr.alias("tr_count"),
            F.struct(round_dec(F.least(a, b), 2).alias("first_lower"), round_dec(F.greatest(a, b), 2).alias("first_upper")).alias("buy_zone"),
            F.struct(
                round_dec(sell_low, 2).alias("first_lower"),
                round_dec(sell_up, 2).alias("first_upper"),
                round_dec((sell_low + sell_up) / 2, 2).alias("first_center"),
            ).alias("sell_zone"),
            round_dec(protect, 2).alias("protection_price"),
            trend.alias("trend_aligned"),
            round_dec(position, 4).alias("vwap_position"),
            (chg > 0).alias("industry_sync_ok"),
            round_dec(zero("atr14"), 2).alias("atr14"),
            round_dec(zero("atr14_pct"), 2).alias("atr14_pct"),
        ),
    )


def first_review(records: DataFrame) -> DataFrame:
    """Position in the decision's list (1 candidate, 2 conditional shown), the five checks and reward / risk."""
    c = F.col("computed")
    rsi, vr, price = zero("rsi14"), zero("volume_ratio"), zero("price")
    shown = F.when(c["dual_axis_decision"] == "can_enter_candidate", 1).when(c["dual_axis_decision"] == "conditional_watch", 2).otherwise(0)
    w = Window.partitionBy("_decision").orderBy(F.col("_score").desc(), "code")
    # only the first two per decision get a position, so the group is cut before the shuffle
    ranked = records.select("code", c["dual_axis_decision"].alias("_decision"), c["op_score"].alias("_score"))
    ranked = ranked.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= 2).select("code", F.col("_rn").alias("position"))
    checks = F.struct(
        (c["vwap_position"] > 1.0).alias("vwap_position"),
        (vr > 1.2).alias("volume_ratio"),
        c["industry_sync_ok"].alias("industry_sync"),
        c["trend_aligned"].alias("trend_aligned"),
        rsi.between(40, 70).alias("rsi_range"),
    )
    reward = c["sell_zone"]["first_center"] - price
    risk = price - c["protection_price"]
    rr = F.when(risk > 0, round_dec(reward / null0(risk), 2)).otherwise(0.0)
    out = records.join(ranked, "code", "left")
    every = checks["vwap_position"] & checks["volume_ratio"] & checks["industry_sync"] & checks["trend_aligned"] & checks["rsi_range"]
    return out.select(
        "code",
        c["dual_axis_decision"].alias("decision"),
        F.when(F.col("position") <= shown, F.col("position")).alias("position"),
        checks.alias("checks"),
        F.when(every, "PASS").otherwise("FAIL").alias("verdict"),
        rr.alias("reward_risk_ratio"),
        F.when(rr >= 1.20, "OK").otherwise("LOW").alias("rr_verdict"),
    )


def quality_of(score: Column) -> Column:
    return F.when(score >= 60, "strong").when(score >= 40, "moderate").when(score >= 20, "weak").otherwise("poor")


# -- second-generation parts -----------------------------------------------------------


def daily_context(df: DataFrame) -> DataFrame:
    """trend_aligned and the Bollinger position of the current price."""
    ma5, ma10, ma20, ma60 = (zero(c) for c in ("ma5", "ma10", "ma20", "ma60"))
    up, lo = zero("boll_upper"), zero("boll_lower")
    pos = F.when((up > lo) & (up > 0), (zero("price") - lo) / null0(up - lo)).otherwise(0.5)
    return df.withColumns(
        {"ctx_trend_aligned": (ma5 > 0) & (ma5 > ma10) & (ma10 > ma20) & (ma20 > ma60), "ctx_boll_position": pos}
    )


def upper_shadow(df: DataFrame) -> DataFrame:
    """Day's upper shadow ratio (0 when flat) and the long flag (>= 0.35)."""
    h, low, o, c = (zero(x) for x in ("high", "low", "open", "price"))
    ratio = F.when(h == low, 0.0).otherwise((h - F.greatest(o, c)) / null0(h - low))
    return df.withColumns({"day_shadow_ratio": round_dec(ratio, 4), "long_upper_shadow": (h != low) & (ratio >= 0.35)})


def industry_sync(df: DataFrame, industries: DataFrame, min_members: int = 20) -> DataFrame:
    """Industry breadth >= 50 % and rising mean; without industry data the own change decides."""
    agg = industries.select("industry", "component_count", F.col("advance_ratio").alias("industry_advance_ratio"), F.col("avg_change_pct").alias("_avg"))
    j = df.join(agg, "industry", "left")
    known = F.col("component_count").isNotNull()
    enough = F.col("component_count") >= min_members
    ok = F.when(known, enough & (F.col("industry_advance_ratio") >= 0.5) & (F.col("_avg") > 0)).otherwise(zero("change_pct") > 0)
    basis = F.when(~known, "own_change").when(enough, "industry").otherwise("too_few_members")
    return j.withColumns({"industry_sync_pass": ok, "industry_sync_basis": basis}).drop("_avg", "component_count")


def market_veto(snapshot: DataFrame, floor: float = 0.35) -> DataFrame:
    """One row: advance ratio of the full market and whether it vetoes every entry."""
    agg = snapshot.agg(F.count(F.lit(1)).alias("_n"), count_if(dbl("change_pct") > 0).alias("_adv"))
    ratio = F.col("_adv") / F.greatest(F.col("_n"), F.lit(1))
    return agg.select(ratio.alias("market_advance_ratio"), (ratio < floor).alias("market_veto"))


CHANNELS = ("trend_continuation", "strong_pullback_reclaim", "high_momentum", "sector_reversal_challenger")


def channels(df: DataFrame) -> DataFrame:
    """Array of channel results and the first passed, buyable one as ``primary_channel``.

    Reads price, ma11, ma23, rsi14, rps20, momentum deltas, ctx_boll_position,
    return_20d, atr14, low, full_day_vwap and long_upper_shadow.
    """
    price = zero("price")
    ma11 = F.when(dbl("ma11") > 0, dbl("ma11")).otherwise(price)
    ma23 = F.when(dbl("ma23") > 0, dbl("ma23")).otherwise(price)
    rsi, rps, ret, atr = (zero(c) for c in ("rsi14", "rps20", "return_20d", "atr14"))
    improving = (zero("momentum_delta_1") > 0) & (zero("momentum_delta_3") > 0)
    repeated = F.col("long_upper_shadow")
    hot = (rsi >= 78) | ((rsi >= 75) & (F.col("ctx_boll_position") >= 0.95))
    trend_reasons = flag_list(
        (~((price > ma11) & (ma11 >= ma23)), "price_not_above_ma_sequence"),
        (rps < 70, _fmt("rps20_below_70 (%.1f)", rps)),
        (~improving, "momentum_not_improving"),
        (hot, "overheated"),
        (repeated, "terminal_distribution_risk"),
    )
    low = F.when(dbl("low") > 0, dbl("low"))
    depth = low / null0(dbl("full_day_vwap")) - 1
    boundary = yes((depth >= -0.015) & (low >= ma23 - 0.10 * atr))
    base_reasons = flag_list(
        (~(price > ma23), "price_not_above_ma23"),
        (ret < 0.08, _fmt("return_20d_below_8pct (%.2f%%)", ret * 100)),
        (repeated, "terminal_distribution_risk"),
    )
    pull_reasons = F.when((F.size(base_reasons) == 0) & ~boundary, F.array(F.lit("pullback_boundary_failed"))).otherwise(base_reasons)

    def entry(name: str, reasons: Column | None, buyable: bool, note: str = "") -> Column:
        passed = F.lit(False) if reasons is None else F.size(reasons) == 0
        text = F.lit(note) if reasons is None else F.when(passed, "pass").otherwise(F.array_join(reasons, "; "))
        return F.struct(
            F.lit(name).alias("channel"), passed.alias("passed"), F.lit(buyable).alias("production_buyable"), text.alias("reason")
        )

    results = F.array(
        entry(CHANNELS[0], trend_reasons, True),
        entry(CHANNELS[1], pull_reasons, True),
        entry(CHANNELS[2], None, False, "research_only; production_buyable=false"),
        entry(CHANNELS[3], None, False, "shadow_only; contract_not_verified"),
    )
    staged = df.withColumns({"channels": results, "pullback_depth": depth})
    first = F.get(F.filter("channels", lambda c: c["passed"] & c["production_buyable"]), F.lit(0))
    return staged.withColumn("primary_channel", first["channel"])


def dual_axis(df: DataFrame, high_atr_threshold: float = 4.0) -> DataFrame:
    """Opportunity score and quality, tail-risk flags and level, decision and reason.

    ``atr14_pct`` is in percent, and so is the threshold.
    """
    has = set(df.columns)
    rsi, vr, chg, rps, r5, r20 = (zero(c) for c in ("rsi14", "volume_ratio", "change_pct", "rps20", "return_5d", "return_20d"))
    price, ma20, tor, atrp = (zero(c) for c in ("price", "ma20", "turnover_rate", "atr14_pct"))
    trend, sync = yes(F.col("ctx_trend_aligned")), yes(F.col("industry_sync_pass"))
    healthy, mod, slight = rsi.between(40, 70), chg.between(2, 7), (chg > 0) & (chg < 2)
    raw = points(
        (trend, 30), (healthy, 20), (vr > 1.5, 15), ((vr <= 1.5) & (vr > 0.8), 5), (mod, 15), (slight, 5),
        (rps >= 80, 10), ((rps >= 50) & (rps < 80), 5), (r5 > 0, 5), (r20 > 0, 5),
    )
    score = F.when(~sync & (raw >= 60), F.greatest(raw - 15, F.lit(55))).otherwise(raw)
    detail = flag_list(
        (trend, "trend_aligned"),
        (~trend, "trend_not_aligned"),
        (healthy, _fmt("rsi_healthy(%.0f)", rsi)),
        (rsi < 30, _fmt("rsi_oversold(%.0f)", rsi)),
        (rsi > 80, _fmt("rsi_overbought(%.0f)", rsi)),
        (vr > 1.5, _fmt("volume_high(%.1fx)", vr)),
        ((vr <= 1.5) & (vr > 0.8), _fmt("volume_normal(%.1fx)", vr)),
        (vr <= 0.8, _fmt("volume_low(%.1fx)", vr)),
        (mod, _fmt("change_moderate(%+.1f%%)", chg)),
        (slight, _fmt("change_slight(%+.1f%%)", chg)),
        (chg > 7, _fmt("change_excessive(%+.1f%%)", chg)),
        # whole ranks round half-up
        (rps >= 80, F.format_string("rps_strong(%.0f)", rps)),
        ((rps >= 50) & (rps < 80), F.format_string("rps_medium(%.0f)", rps)),
        (r5 > 0, "return_5d_positive"),
        (r20 > 0, "return_20d_positive"),
        (~sync, "industry_sync_failed"),
    )

    def opt(c: str) -> Column:
        return yes(F.col(c)) if c in has else F.lit(False)

    cross = atrp >= F.col("atr14_pct_cross_p80") if "atr14_pct_cross_p80" in has else F.lit(False)
    gap = dbl("overnight_gap_p90") >= 0.04 if "overnight_gap_p90" in has else F.lit(False)
    shadow = F.col("long_upper_shadow")
    # the day's long shadow stands for the repeated one unless the history flag is given
    repeated = opt("repeated_flag") if "repeated_flag" in has else shadow
    flags = flag_list(
        (rsi > 80, "rsi_overbought"),
        (chg > 9, "change_excessive_9pct"),
        ((price < ma20) & (ma20 > 0), "below_ma20"),
        (tor > 20, "turnover_high"),
        ((atrp >= high_atr_threshold) | yes(cross), "high_atr_warning"),
        (yes(gap), "overnight_gap_warning"),
        (shadow, "long_upper_shadow"),
        (repeated, "repeated_upper_shadow"),
        (opt("industry_crowding"), "industry_crowding"),
        (opt("limit_proximity"), "limit_proximity"),
    )
    veto = opt("market_veto")
    protect_ok = yes(F.col("protection_constructible")) if "protection_constructible" in has else F.lit(True)
    sell_ok = yes(F.col("sell_zone_constructible")) if "sell_zone_constructible" in has else F.lit(True)
    staged = df.withColumns(
        {
            "op_score": score,
            "op_detail": F.array_join(detail, " | "),
            "tr_flags": flags,
            "opportunity_quality": quality_of(score),
            "tr_count": F.size(flags),
        }
    )
    n = F.col("tr_count")
    staged = staged.withColumn("tail_risk", F.when(n >= 3, "high").when(n >= 1, "medium").otherwise("low"))
    blocked = repeated | veto | ~protect_ok | ~sell_ok
    return staged.withColumns(
        {
            "decision": F.when(blocked, "reject").otherwise(decision_matrix("opportunity_quality", "tail_risk")),
            "reason_code": F.when(repeated, "terminal_distribution_risk")
            .when(veto, "market_veto")
            .when(~protect_ok, "protection_not_constructible")
            .when(~sell_ok, "sell_zone_inside_buy_zone")
            .otherwise(""),
        }
    )


def decision_matrix(quality: str, risk: str) -> Column:
    """Quality x risk to decision (4 x 3 cases)."""
    q, r = F.col(quality), F.col(risk)
    good = q.isin("strong", "moderate")
    return (
        F.when(good & r.isin("low", "medium"), "can_enter_candidate")
        .when(good & (r == "high"), "conditional_watch")
        .when((q == "weak") & (r == "low"), "conditional_watch")
        .otherwise("reject")
    )


# -- prices ---------------------------------------------------------------------------


def trigger_and_support(df: DataFrame) -> DataFrame:
    """Trigger price by primary channel and structural support (missing references are skipped)."""
    price, ma20, lo = zero("price"), zero("ma20"), zero("boll_lower")
    vwap, pm, pivot = dbl("full_day_vwap"), dbl("afternoon_avwap"), dbl("named_pivot")
    ch = F.col("primary_channel")
    ref = F.when(ch == CHANNELS[0], F.greatest(vwap, pm, pivot)).when(ch.isin(CHANNELS[1], CHANNELS[3]), F.greatest(vwap, pivot))
    base = F.when((lo > 0) & (ma20 > 0), F.greatest(ma20, lo)).otherwise(price * 0.95)
    swing = F.when(dbl("afternoon_swing_low") > 0, dbl("afternoon_swing_low"))
    return df.withColumns({"trigger_reference": F.coalesce(ref, price * 0.998), "structural_support": F.greatest(base, swing)})


def buy_zone(df: DataFrame, tick: float = TICK) -> DataFrame:
    trig, close, atr = dbl("trigger_reference"), zero("price"), zero("atr14")
    chase = tick_floor(F.least(trig * 1.015, close + 0.15 * atr), tick)
    s = df.withColumns({"no_chase_price": chase, "buy_lower": tick_ceil(F.greatest(trig, close - 0.10 * atr), tick)})
    upper = tick_floor(F.least(F.col("no_chase_price"), close + F.least(0.15 * atr, close * 0.005)), tick)
    s = s.withColumn("buy_upper", upper)
    return s.withColumns(
        {"buy_zone_empty": F.col("buy_lower") > F.col("buy_upper"), "above_no_chase": close > F.col("no_chase_price")}
    )


def sell_zones(df: DataFrame, tick: float = TICK) -> DataFrame:
    """Two sell zones around +0.75 and +1.25 ATR, capped by optional resistances."""
    has = set(df.columns)
    top, atr = dbl("buy_upper"), zero("atr14")

    def center(factor: float, cap: str) -> Column:
        c = top + factor * atr
        return F.least(c, dbl(cap)) if cap in has else c

    s = df.withColumns({"sell1_center": center(0.75, "resistance_1"), "_c2": center(1.25, "resistance_2")})
    s = s.withColumns(
        {
            "sell1_lower": tick_ceil(F.col("sell1_center") - 0.05 * atr, tick),
            "sell1_upper": tick_floor(F.col("sell1_center") + 0.05 * atr, tick),
            "_l2": tick_ceil(F.col("_c2") - 0.05 * atr, tick),
            "_u2": tick_floor(F.col("_c2") + 0.05 * atr, tick),
        }
    )
    inside = F.col("sell1_lower") <= F.col("buy_upper")
    second = ~inside & (F.col("_l2") > F.col("sell1_upper"))
    return s.withColumns(
        {
            "sell_zone_error": F.when(inside, "sell_zone_inside_buy_zone"),
            "sell2_available": second,
            "sell2_lower": F.when(second, F.col("_l2")),
            "sell2_upper": F.when(second, F.col("_u2")),
            "sell2_center": F.when(second, F.col("_c2")),
        }
    ).drop("_c2", "_l2", "_u2")


def protection(df: DataFrame, tick: float = TICK) -> DataFrame:
    atr = zero("atr14")
    raw = F.greatest(dbl("structural_support") - 0.15 * atr, dbl("buy_upper") - 0.80 * atr)
    price = tick_floor(F.least(raw, dbl("buy_lower") - 2 * tick), tick)
    s = df.withColumn("protection_price", price)
    ok = F.col("protection_price") < F.col("buy_lower")
    return s.withColumns({"protection_ok": ok, "protection_reason": F.when(ok, "").otherwise("protection_not_constructible")})


def fees(df: DataFrame, buy: str, sell: str, quantity: int = 100) -> DataFrame:
    """Commissions (minimum 5), stamp tax, transfer fees and the net result of one round trip."""
    b, s = dbl(buy) * quantity, dbl(sell) * quantity
    d = df.withColumns(
        {
            "buy_commission": F.greatest(b * COMMISSION, F.lit(MIN_COMMISSION)),
            "sell_commission": F.greatest(s * COMMISSION, F.lit(MIN_COMMISSION)),
            "stamp_tax": s * STAMP_TAX,
            "buy_transfer": b * TRANSFER,
            "sell_transfer": s * TRANSFER,
        }
    )
    total = F.col("buy_commission") + F.col("sell_commission") + F.col("stamp_tax") + F.col("buy_transfer") + F.col("sell_transfer")
    d = d.withColumn("total_cost", total)
    return d.withColumns(
        {
            "net_profit": (dbl(sell) - dbl(buy)) * quantity - F.col("total_cost"),
            "net_loss": (dbl(buy) - dbl(sell)) * quantity - F.col("total_cost"),
        }
    )


def second_record(df: DataFrame, industries: DataFrame, veto: DataFrame, profile: str = "watchlist_t1_v1") -> DataFrame:
    """All second-generation parts of a snapshot row joined with indicators and minute references.

    ``df`` brings the snapshot, the indicator record, rps20 and (optional
    values of) full_day_vwap, afternoon_avwap, named_pivot and
    afternoon_swing_low; ``veto`` is the one-row market veto.
    """
    s = industry_sync(upper_shadow(daily_context(df)), industries)
    s = attach_row(s, veto)
    s = dual_axis(channels(s))
    s = protection(sell_zones(buy_zone(trigger_and_support(s))))
    s = fees(s, "buy_upper", "sell1_lower")
    blocked = yes(F.col("is_st")) | yes(F.col("is_suspended"))
    state = F.when(~blocked & F.col("primary_channel").isNotNull(), "deep_watch").otherwise("rejected")
    reason = F.when(blocked, "st_or_suspended").when(F.col("primary_channel").isNotNull(), "channel_pass").otherwise("no_channel_pass")
    ident = F.left(F.sha2(F.concat_ws("|", F.lit(profile), "code", F.col("trade_date").cast("string")), 256), F.lit(12))
    return s.withColumns({"entry_state": state, "entry_reason": reason, "decision_id": ident, "strategy_profile_id": F.lit(profile)})


def second_nested(rec: DataFrame) -> DataFrame:
    """The record in its nested document layout."""
    f = F.col
    pick = lambda *cs: F.struct(*[f(c) if isinstance(c, str) else c for c in cs])
    return rec.select(
        "code",
        "name",
        pick(
            F.lit("2.0.0").alias("formula_version"),
            "decision_id",
            "strategy_profile_id",
            "channels",
            "primary_channel",
            pick("decision", "opportunity_quality", "tail_risk", "op_score", "op_detail", "tr_count", "tr_flags", "reason_code").alias("dual_axis"),
            pick(
                f("buy_lower").alias("lower"), f("buy_upper").alias("upper"), "no_chase_price", "trigger_reference",
                f("buy_zone_empty").alias("empty"), f("above_no_chase").alias("confirmation_above_no_chase"),
            ).alias("buy_zone"),
            pick(
                f("sell1_lower").alias("first_lower"), f("sell1_upper").alias("first_upper"), f("sell1_center").alias("first_center"),
                f("sell2_lower").alias("second_lower"), f("sell2_upper").alias("second_upper"), f("sell2_center").alias("second_center"),
                f("sell2_available").alias("second_available"), f("sell_zone_error").alias("error"),
            ).alias("sell_zone"),
            pick(
                f("protection_price").alias("price"), f("protection_ok").alias("constructible"), "structural_support",
                f("protection_reason").alias("reason"),
            ).alias("protection"),
            pick("total_cost", "net_profit", "net_loss").alias("fees"),
            pick(f("industry_sync_pass").alias("pass"), f("industry_sync_basis").alias("detail")).alias("industry_sync"),
            pick(f("market_veto").alias("veto"), f("market_advance_ratio").alias("advance_ratio")).alias("market"),
            "entry_state",
            pick(
                f("ctx_trend_aligned").alias("trend_aligned"), f("ctx_boll_position").alias("boll_position"), zero("rsi14").alias("rsi14"),
                zero("atr14").alias("atr14"), zero("rps20").alias("rps20"), zero("return_20d").alias("return_20d"),
            ).alias("daily_context"),
        ).alias("computed_v2"),
    )


def second_summary(nested: DataFrame) -> DataFrame:
    d = F.col("computed_v2.dual_axis.decision")
    return nested.agg(
        F.count(F.lit(1)).alias("total"),
        count_if(d == "can_enter_candidate").alias("candidates"),
        count_if(d == "conditional_watch").alias("conditional"),
        count_if(d == "reject").alias("rejected"),
    )


def second_review(nested: DataFrame) -> DataFrame:
    """Six checks and the verdict per record; order within a decision is (op_score desc, code)."""
    c = F.col("computed_v2")
    checks = F.struct(
        (~yes(c["buy_zone"]["empty"])).alias("buy_zone"),
        (~yes(c["buy_zone"]["confirmation_above_no_chase"])).alias("no_chase"),
        yes(c["protection"]["constructible"]).alias("protection"),
        yes(c["industry_sync"]["pass"]).alias("industry_sync"),
        yes(c["daily_context"]["trend_aligned"]).alias("trend"),
        c["daily_context"]["rsi14"].between(40, 70).alias("rsi"),
    )
    names = ("buy_zone", "no_chase", "protection", "industry_sync", "trend", "rsi")
    failed = flag_list(*[(~checks[n], n) for n in names])
    return nested.select(
        "code",
        c["dual_axis"]["decision"].alias("decision"),
        c["dual_axis"]["op_score"].alias("op_score"),
        failed.alias("failed_checks"),
        F.when(F.size(failed) == 0, "PASS").otherwise("FAIL").alias("verdict"),
    ).orderBy("decision", F.col("op_score").desc(), "code")


def _rank(c: str, table: dict[str, int], unknown: int) -> Column:
    value = F.lit(unknown)
    for k, v in table.items():
        value = F.when(F.col(c) == k, v).otherwise(value)
    return value


def rank_substitutes(df: DataFrame, keys: list[str], top: int | None = None) -> DataFrame:
    """Candidates of one profile and date: quality down, tail risk up, reward / risk down, code up.

    Unknown words rank worst.  ``top`` limits the report, and with it the rows
    that reach the ordering task of a group; a full ranking is numbered in bins.
    """
    quality, risk = _rank("opportunity_quality", QUALITY_RANK, 0), _rank("tail_risk", RISK_RANK, 2)
    ratio, code = F.coalesce(dbl("reward_risk_ratio"), F.lit(0.0)), F.coalesce("code", F.lit("999999"))
    order = [quality.desc(), risk.asc(), ratio.desc(), code]
    if top is not None:
        ranked = df.withColumn("position", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        return ranked.where(F.col("position") <= top)
    # the words make a class, a falling ratio a rising number between 0 and 1
    lead = (max(QUALITY_RANK.values()) - quality) * len(RISK_RANK) + risk + (F.lit(0.5) - F.atan(ratio) / F.pi())
    return binned_row_number(df, keys, lead, leading_bytes(code), order, "position")


def migrate_records(raw: DataFrame, schema: str) -> DataFrame:
    """First-generation JSON records (text) to the second layout with its defaults."""
    rec = F.from_json("text", schema)
    r = raw.select(rec.alias("r")).select("r.*")
    c, d = F.col("computed"), F.col("daily")
    trend = yes(c["trend_aligned"])
    decision = F.coalesce(c["dual_axis_decision"], F.lit("reject"))

    def channel(name: str, passed: Column, buyable: bool, reason: str) -> Column:
        return F.struct(
            F.lit(name).alias("channel"), passed.alias("passed"), F.lit(buyable).alias("production_buyable"), F.lit(reason).alias("reason")
        )

    no = F.lit(False)
    chans = F.array(
        channel(CHANNELS[0], trend, True, "migrated_from_v1"),
        channel(CHANNELS[1], no, True, "not_evaluated_in_v1"),
        channel(CHANNELS[2], no, False, "research_only"),
        channel(CHANNELS[3], no, False, "shadow_only"),
    )
    num0 = lambda x: F.coalesce(x.cast("double"), F.lit(0.0))
    return r.select(
        "code",
        "name",
        F.struct(
            F.lit("2.0.0-legacy-migration").alias("formula_version"),
            F.concat(F.lit("migrated_"), F.coalesce("code", F.lit("unknown"))).alias("decision_id"),
            F.lit("legacy").alias("strategy_version"),
            chans.alias("channels"),
            F.when(trend, CHANNELS[0]).alias("primary_channel"),
            F.struct(
                decision.alias("decision"),
                F.coalesce(c["opportunity_quality"], F.lit("poor")).alias("opportunity_quality"),
                F.coalesce(c["tail_risk"], F.lit("low")).alias("tail_risk"),
                F.coalesce(c["op_score"], F.lit(0)).alias("op_score"),
                F.coalesce(c["tr_count"], F.lit(0)).alias("tr_count"),
                F.lit("migrated_from_v1").alias("reason_code"),
            ).alias("dual_axis"),
            F.struct(
                num0(c["buy_zone"]["first_lower"]).alias("lower"),
                num0(c["buy_zone"]["first_upper"]).alias("upper"),
                num0(c["buy_zone"]["first_upper"]).alias("no_chase_price"),
                no.alias("empty"),
            ).alias("buy_zone"),
            F.struct(
                c["sell_zone"]["first_lower"].alias("first_lower"), c["sell_zone"]["first_upper"].alias("first_upper"), no.alias("second_available")
            ).alias("sell_zone"),
            F.struct(num0(c["protection_price"]).alias("price"), F.lit(True).alias("constructible")).alias("protection"),
            yes(c["industry_sync_ok"]).alias("industry_sync_pass"),
            F.when(decision == "can_enter_candidate", "deep_watch").otherwise("rejected").alias("entry_state"),
            num0(d["rsi14"]).alias("rsi14"),
        ).alias("computed_v2"),
        F.lit("legacy_migrated").alias("migration_status"),
    )
