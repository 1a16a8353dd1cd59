"""Intraday minute operators.

Input rows are minute bars unique per (code, trade_date, ts): at most one row
per minute, so every window partitioned by (code, trade_date) holds at most
1,440 rows however large the table is.  ``ts`` is exchange-local TIMESTAMP_NTZ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.functions import session_time as st
from barlake.functions.numeric import count_if, dbl, null0, round_dec
from barlake.functions.ranking import attach_row, latest_per_key

DAY = ["code", "trade_date"]


def _by_time() -> Window:
    return Window.partitionBy(*DAY).orderBy("ts")


def _gap_minutes(a: Column, b: Column) -> Column:
    """Minutes from a to b on the same day."""
    return (st.second_of_day(b) - st.second_of_day(a)) / 60.0


def exact(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(28,4)")


def slice_interval(df: DataFrame, start: str, end: str, time: str = "time") -> DataFrame:
    """Inclusive HH:MM range."""
    return df.where(F.col(time).between(start, end))


def bars_from_cumulative(rows: DataFrame, start_minute: int = st.OPEN) -> DataFrame:
    """Cumulative rows to per-minute bars.

    Volume and amount are differences to the previous row; a negative
    difference drops the bar; the first row of a day only seeds.  The start
    filter comes after differencing so that the first bar keeps its base.
    """
    w = _by_time()
    prev = lambda c: F.lag(c).over(w)
    staged = rows.select(
        *DAY,
        "ts",
        prev("price").alias("open"),
        F.col("price").alias("close"),
        (F.col("volume") - prev("volume")).alias("dv"),
        (F.col("amount") - prev("amount")).alias("da"),
        F.col("volume").alias("cum_volume"),
        F.col("amount").alias("cum_amount"),
    )
    keep = (F.col("dv") >= 0) & (F.col("da") >= 0) & (st.minute_of_day("ts") >= start_minute)
    return staged.where(keep).select(
        *DAY,
        "ts",
        "open",
        F.greatest("open", "close").alias("high"),
        F.least("open", "close").alias("low"),
        "close",
        F.col("dv").alias("volume"),
        F.col("da").alias("amount"),
        "cum_volume",
        "cum_amount",
    )


def running_vwap(bars: DataFrame, anchor_minute: int | None = None, price: str = "close") -> DataFrame:
    """Running VWAP, VWAP from an anchor time, 3- and 5-bar volume change, price against VWAP."""
    w = _by_time()
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    total_v, total_a = F.sum(exact("volume")).over(upto), F.sum(exact("amount")).over(upto)
    after = st.minute_of_day("ts") >= (anchor_minute if anchor_minute is not None else 24 * 60)
    anchored_v = F.sum(F.when(after, exact("volume"))).over(upto)
    anchored_a = F.sum(F.when(after, exact("amount"))).over(upto)

    def change(n: int) -> Column:
        old = F.lag(dbl("volume"), n).over(w)
        return (dbl("volume") - old) / null0(old)

    staged = bars.select(
        *DAY,
        "ts",
        dbl(price).alias("price"),
        (dbl(total_a) / null0(dbl(total_v))).alias("vwap"),
        F.when(after, dbl(anchored_a) / null0(dbl(anchored_v))).alias("anchored_vwap"),
        change(3).alias("vol_3m_delta"),
        change(5).alias("vol_5m_delta"),
    )
    return staged.withColumn("price_vs_vwap", (F.col("price") - F.col("vwap")) / null0(F.col("vwap")))


def gated_vwap(
    bars: DataFrame, prices: DataFrame, max_gap: int = 5, max_missing: int = 10, label: str = "minute_bars"
) -> DataFrame:
    """Day VWAP per code, withheld when the minute series has a gap or too many holes.

    A gap of exactly the lunch break is allowed.  Missing minutes are counted
    in closed form: trading minutes before the last bar less the distinct bar
    minutes among them.
    """
    lunch = st.LUNCH_END - st.LUNCH_START
    gap = _gap_minutes(F.lag("ts").over(_by_time()), F.col("ts"))
    staged = bars.select(*DAY, "ts", "volume", "amount", gap.alias("gap"), st.minute_of_day("ts").alias("m"))
    last = F.max("m")
    day = staged.groupBy(*DAY).agg(
        count_if((F.col("gap") > max_gap) & (F.col("gap") != lunch)).alias("bad_gaps"),
        last.alias("last_m"),
        # the last bar closes the expected range, so its own minute does not count
        F.collect_set("m").alias("ms"),  # at most 1,440 small integers
        F.sum(exact("volume")).alias("v"),
        F.sum(exact("amount")).alias("a"),
        F.count(F.lit(1)).alias("n"),
    )
    end = F.least(F.col("last_m"), F.lit(st.CLOSE))
    seen = F.size(F.filter("ms", lambda m: st.in_session(m) & (m < end)))
    day = day.withColumn("missing_minutes", st.minute_index(end) - seen)
    ok = (F.col("bad_gaps") == 0) & (F.col("missing_minutes") <= max_missing)
    vw = F.when(ok & (F.col("v") > 0), dbl("a") / dbl("v"))
    price = dbl("price")
    joined = prices.join(day, DAY, "left")
    return joined.select(
        *DAY,
        "bad_gaps",
        "missing_minutes",
        vw.alias("vwap"),
        F.when(ok, label).otherwise("unavailable").alias("vwap_source"),
        ((price - vw) / vw * 100).alias("vwap_distance_pct"),
        F.when(ok, dbl("v")).alias("cum_volume"),
        F.when(ok, dbl("a")).alias("cum_amount"),
        F.when(ok, F.col("n")).when(F.col("n").isNotNull(), F.lit(0)).alias("minute_sample_count"),
    )


def pivots(bars: DataFrame, window: int = 3, price: str = "close") -> DataFrame:
    """Swing highs and lows: strictly above / below all of ``window`` bars on each side."""
    w = _by_time()
    left, right = w.rowsBetween(-window, -1), w.rowsBetween(1, window)
    p = F.col(price)
    staged = bars.select(
        *DAY,
        "ts",
        p.alias("price"),
        (F.row_number().over(w) - 1).alias("sequence"),
        F.max(p).over(left).alias("lmax"),
        F.min(p).over(left).alias("lmin"),
        F.max(p).over(right).alias("rmax"),
        F.min(p).over(right).alias("rmin"),
        (F.count(p).over(left) + F.count(p).over(right)).alias("cnt"),
    ).where(F.col("cnt") == 2 * window)
    high = (F.col("price") > F.col("lmax")) & (F.col("price") > F.col("rmax"))
    low = (F.col("price") < F.col("lmin")) & (F.col("price") < F.col("rmin"))
    kind = F.when(high, "high").when(low, "low")
    return staged.select(*DAY, "ts", "price", kind.alias("pivot_type"), "sequence").where(
        F.col("pivot_type").isNotNull()
    )


def afternoon_low(pivot_rows: DataFrame, start_minute: int = st.LUNCH_END) -> DataFrame:
    """Latest low pivot at or after the given minute, per code and day."""
    lows = pivot_rows.where((F.col("pivot_type") == "low") & (st.minute_of_day("ts") >= start_minute))
    return latest_per_key(lows, DAY, [F.col("ts").desc()]).drop("_rn")


def open_proxy(rows: DataFrame, order: str, price: str = "price", minute: int = st.OPEN) -> DataFrame:
    """First price seen in the opening minute, by ingest order."""
    first = rows.where((st.minute_of_day("ts") == minute) & F.col(price).isNotNull())
    return first.groupBy(*DAY).agg(F.min_by(price, order).alias("open_proxy_price"))


def _tail_sums(bars: DataFrame) -> DataFrame:
    """Per code and day: sums over the last 3, last 5 and the 3 before, one pass."""
    w = Window.partitionBy(*DAY).orderBy(F.col("ts").desc())
    num = bars.withColumn("k", F.row_number().over(w))
    k = F.col("k")
    vol, amt = exact(F.coalesce("volume", F.lit(0))), exact(F.coalesce("amount", F.lit(0)))
    n = F.count(F.lit(1))

    def part(cond: Column, what: Column, need: int) -> Column:
        return F.when(n >= need, dbl(F.sum(F.when(cond, what))))

    return num.groupBy(*DAY).agg(
        n.alias("minutes"),
        part(k <= 3, vol, 3).alias("volume_3m"),
        part(k <= 5, vol, 5).alias("volume_5m"),
        part(k <= 3, amt, 3).alias("amount_3m"),
        part(k <= 5, amt, 5).alias("amount_5m"),
        part((k > 3) & (k <= 6), amt, 6).alias("amount_prev_3m"),
        F.max("ts").alias("last_tradable_time"),
        F.max(dbl("high")).alias("minute_high"),
        F.min(dbl("low")).alias("minute_low"),
    )


def minute_facts(bars: DataFrame, snapshot: DataFrame, limit: Column | float = 0.10) -> DataFrame:
    """Objective facts per code and day added to the day's snapshot.

    ``snapshot`` gives price, high and pre_close per code and day; ``limit`` is
    the daily price limit of the board.
    """
    tail = _tail_sums(bars)
    low = afternoon_low(pivots(bars)).select(*DAY, dbl("price").alias("afternoon_pivot"))
    lim = F.lit(limit) if isinstance(limit, float) else limit
    pre = dbl("pre_close")
    prev = F.col("amount_prev_3m")
    touched = (F.col("minute_high") >= pre * (1 + lim)) | (F.col("minute_low") <= pre * (1 - lim))
    return (
        snapshot.join(tail, DAY, "left")
        .join(low, DAY, "left")
        .select(
            *DAY,
            round_dec((dbl("high") - dbl("price")) / null0(dbl("high")) * 100, 4).alias("distance_to_day_high_pct"),
            "afternoon_pivot",
            F.col("amount_3m").alias("amount_last_3m"),
            F.col("amount_5m").alias("amount_last_5m"),
            F.when(prev > 0, round_dec((F.col("amount_3m") - prev) / prev * 100, 2)).alias("amount_change_3m_pct"),
            F.coalesce((pre > 0) & touched, F.lit(False)).alias("is_limit_touched"),
            "last_tradable_time",
        )
    )


def intraday_structure(bars: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Distance from high / low, amplitude, recent volume and amount, amount change ratio."""
    price, high, low, pre = (dbl(c) for c in ("price", "high", "low", "pre_close"))
    prev = F.col("amount_prev_3m")
    return snapshot.join(_tail_sums(bars), DAY, "left").select(
        *DAY,
        round_dec((price - high) / null0(high) * 100, 4).alias("distance_from_high_pct"),
        round_dec((price - low) / null0(low) * 100, 4).alias("distance_from_low_pct"),
        round_dec((high - low) / null0(pre) * 100, 4).alias("amplitude_pct"),
        "volume_3m",
        "volume_5m",
        "amount_3m",
        "amount_5m",
        F.when(prev > 0, round_dec((F.col("amount_3m") - prev) / prev, 4)).alias("amount_change_ratio"),
    )


# -- sequence audits ---------------------------------------------------------


def _distinct_minutes(bars: DataFrame) -> DataFrame:
    """(trade_date, m): at most 1,440 rows per date."""
    return bars.select("trade_date", st.minute_of_day("ts").alias("m")).distinct()


def _observed(observed_minute: int | None, first: Column, last: Column) -> tuple[Column, Column]:
    """Dynamic expected range and audit end for a clock minute (or the data's own range)."""
    if observed_minute is None:
        return st.expected_minutes(first, last), last
    end = st.LUNCH_START if st.LUNCH_START <= observed_minute < st.LUNCH_END else observed_minute
    return st.expected_minutes(F.lit(st.OPEN), F.lit(end)), F.lit(min(observed_minute, st.CLOSE))


def missing_minutes(bars: DataFrame, observed_minute: int | None = None) -> DataFrame:
    """Trading minutes from the first bar to the audit end that no security has, per date."""
    have = _distinct_minutes(bars)
    span = have.groupBy("trade_date").agg(F.min("m").alias("lo"), F.max("m").alias("hi"))
    _, end = _observed(observed_minute, F.col("lo"), F.col("hi"))
    spine = span.select("trade_date", F.explode(F.sequence("lo", F.greatest(end, F.col("lo")))).alias("m"), end.alias("e"))
    lunch = (F.col("m") >= st.LUNCH_START) & (F.col("m") < st.LUNCH_END)
    spine = spine.where((F.col("m") < F.col("e")) & ~lunch).drop("e")
    return spine.join(have, ["trade_date", "m"], "left_anti")


def missing_periods(bars: DataFrame, observed_minute: int | None = None) -> DataFrame:
    """Consecutive missing clock minutes merged into periods, with their real length."""
    w = Window.partitionBy("trade_date").orderBy("m")  # at most 1,440 rows per date
    miss = missing_minutes(bars, observed_minute)
    return (
        miss.withColumn("island", F.col("m") - F.row_number().over(w))
        .groupBy("trade_date", "island")
        .agg(F.min("m").alias("a"), F.max("m").alias("b"), F.count(F.lit(1)).alias("minutes"))
        .select("trade_date", st.hhmm(F.col("a")).alias("start"), st.hhmm(F.col("b")).alias("end"), "minutes")
    )


def continuity_breaks(bars: DataFrame, max_gap: int = 2, lunch_exempt: bool = True) -> DataFrame:
    """Steps between observed minutes longer than ``max_gap``, lunch excepted."""
    w = Window.partitionBy("trade_date").orderBy("m")
    gap = F.col("m") - F.lag("m").over(w)
    rows = _distinct_minutes(bars).select("trade_date", (F.col("m") - gap).alias("after_m"), gap.alias("gap"))
    cond = F.col("gap") > max_gap
    if lunch_exempt:
        cond = cond & (F.col("gap") != st.LUNCH_END - st.LUNCH_START)
    return rows.where(cond).select("trade_date", st.hhmm(F.col("after_m")).alias("after"), F.col("gap").alias("gap_minutes"))


def codes_without_data(bars: DataFrame, codes: DataFrame) -> DataFrame:
    """Codes of the universe that have no bar at all."""
    return codes.select("code").distinct().join(bars.select("code"), "code", "left_anti")


def code_coverage(bars: DataFrame, expected: DataFrame) -> DataFrame:
    """Distinct minutes and coverage per code and date; ``expected`` has (trade_date, expected_minutes)."""
    per = bars.groupBy(*DAY).agg(F.count_distinct("ts").alias("minutes"))
    total = F.greatest(F.col("expected_minutes"), F.lit(1))
    return per.join(expected, "trade_date").select(
        *DAY,
        "minutes",
        (F.col("minutes") / total).alias("coverage"),
        round_dec(F.col("minutes") / total * 100, 1).alias("coverage_pct"),
        F.when(F.col("minutes") >= total * 0.95, "full").when(F.col("minutes") > 0, "partial").otherwise("none").alias("status"),
    )


def sequence_audit(bars: DataFrame, observed_minute: int | None = None) -> DataFrame:
    """One audit row per trade date over all securities."""
    have = _distinct_minutes(bars)
    span = have.groupBy("trade_date").agg(
        F.min("m").alias("lo"), F.max("m").alias("hi"), F.count(F.lit(1)).alias("actual_minutes")
    )
    dynamic, _ = _observed(observed_minute, F.col("lo"), F.col("hi"))
    span = span.withColumn("expected_minutes_dynamic", dynamic)
    miss = missing_minutes(bars, observed_minute).groupBy("trade_date").agg(F.count(F.lit(1)).alias("miss"))
    brk = continuity_breaks(bars).groupBy("trade_date").agg(F.count(F.lit(1)).alias("brk"))
    expected = span.select("trade_date", F.col("expected_minutes_dynamic").alias("expected_minutes"))
    cov = (
        code_coverage(bars, expected)
        .groupBy("trade_date")
        .agg(
            F.sum(F.col("coverage").cast("decimal(28,10)")).alias("_cs"),
            F.count(F.lit(1)).alias("_n"),
            F.min("coverage").alias("_mn"),
            F.max("coverage").alias("_mx"),
            count_if(F.col("status") == "full").alias("codes_full"),
            count_if(F.col("status") == "partial").alias("codes_partial"),
        )
    )
    zero = F.lit(0)
    return (
        span.join(cov, "trade_date", "left")
        .join(miss, "trade_date", "left")
        .join(brk, "trade_date", "left")
        .select(
            "trade_date",
            F.lit(st.DAY_MINUTES).alias("total_expected_minutes"),
            "expected_minutes_dynamic",
            "actual_minutes",
            st.hhmm(F.col("lo")).alias("earliest"),
            st.hhmm(F.col("hi")).alias("latest"),
            F.coalesce("miss", zero).alias("missing_minute_count"),
            F.coalesce("brk", zero).alias("continuity_break_count"),
            round_dec(dbl("_cs") / F.col("_n"), 4).alias("coverage_mean"),
            round_dec("_mn", 4).alias("coverage_min"),
            round_dec("_mx", 4).alias("coverage_max"),
            "codes_full",
            "codes_partial",
        )
    )


def collection_expected(phase: str, start_minute: int, end_minute: int) -> int:
    """Expected bar count of a collection run."""
    if phase == "post_close":
        return st.DAY_MINUTES
    if start_minute == st.OPEN:
        return (st.LUNCH_START - st.OPEN) + max(end_minute - st.LUNCH_END, 0)
    lunch = max(min(end_minute, st.LUNCH_END) - max(start_minute, st.LUNCH_START), 0) if start_minute < 720 else 0
    return end_minute - start_minute - lunch


def collection_audit(
    bars: DataFrame,
    codes: DataFrame,
    phase: str = "post_close",
    start_minute: int = st.OPEN,
    observed_minute: int | None = None,
) -> DataFrame:
    """Per-date collection audit: coverage distribution, zero-data and zero-volume codes."""
    end = st.CLOSE
    if observed_minute is not None and st.OPEN <= observed_minute < st.CLOSE:
        end = observed_minute
    total = max(collection_expected(phase, start_minute, end), 1)
    per = bars.groupBy(*DAY).agg(
        F.count_distinct("ts").alias("n"), F.sum(exact("volume")).alias("v")
    )
    cov = F.col("n") / F.lit(total)
    # codes without data = universe less its members that have data; no code x date grid is built
    universe = codes.select("code").distinct()
    size = universe.agg(F.count(F.lit(1)).alias("_universe"))
    per = per.join(universe.withColumn("_known", F.lit(True)), "code", "left")
    agg = (
        per.groupBy("trade_date")
        .agg(
            F.count(F.lit(1)).alias("codes_with_data"),
            F.count("_known").alias("_hit"),
            round_dec(F.sum("n") / F.count(F.lit(1)) / total * 100, 1).alias("mean_coverage_pct"),
            round_dec(F.min(cov) * 100, 1).alias("min_coverage_pct"),
            round_dec(F.max(cov) * 100, 1).alias("max_coverage_pct"),
            count_if(cov >= 0.95).alias("codes_full"),
            count_if(cov < 0.95).alias("codes_partial"),
            count_if(F.col("v") == 0).alias("codes_zero_volume"),
        )
    )
    return attach_row(agg, size).select(
        "trade_date",
        F.lit(total).alias("expected_minutes"),
        "codes_with_data",
        (F.col("_universe") - F.col("_hit")).alias("codes_zero_data"),
        "mean_coverage_pct",
        "min_coverage_pct",
        "max_coverage_pct",
        "codes_full",
        "codes_partial",
        "codes_zero_volume",
    )


def stocks_per_minute(bars: DataFrame, start_minute: int = st.OPEN, end_minute: int = st.CLOSE) -> DataFrame:
    """Securities with a bar in each expected minute of each date, zero included."""
    lunch = lambda m: (m >= st.LUNCH_START) & (m < st.LUNCH_END)
    grid = bars.select("trade_date").distinct().select(
        "trade_date", F.explode(F.sequence(F.lit(start_minute), F.lit(end_minute - 1))).alias("m")
    )
    grid = grid.where(~lunch(F.col("m")))
    have = bars.select("trade_date", "code", st.minute_of_day("ts").alias("m")).groupBy("trade_date", "m").agg(
        F.count_distinct("code").alias("stocks")
    )
    return grid.join(have, ["trade_date", "m"], "left").select(
        "trade_date", st.hhmm(F.col("m")).alias("minute"), F.coalesce("stocks", F.lit(0)).alias("stocks")
    )


def last_trade(bars: DataFrame) -> DataFrame:
    """Latest minute with volume per code and date; NULL when the code never traded."""
    return bars.groupBy(*DAY).agg(F.max(F.when(F.col("volume") > 0, F.col("ts"))).alias("last_trade_time"))


def watch_vwap(bars: DataFrame, watch: DataFrame) -> DataFrame:
    """Full-day and afternoon VWAP of watched codes, four decimals."""
    pm = st.minute_of_day("ts") >= st.LUNCH_END
    v, a = F.sum(exact("volume")), F.sum(exact("amount"))
    pv, pa = F.sum(F.when(pm, exact("volume"))), F.sum(F.when(pm, exact("amount")))
    return (
        bars.join(watch.select("code").distinct(), "code", "left_semi")
        .groupBy(*DAY)
        .agg(
            round_dec(dbl(a) / null0(dbl(v)), 4).alias("full_day_vwap"),
            round_dec(dbl(pa) / null0(dbl(pv)), 4).alias("afternoon_avwap"),
        )
    )


def early_reversal(
    positions: DataFrame, bars: DataFrame, activation: float = 0.80, confirm: int = 2, price: str = "close"
) -> DataFrame:
    """Early target reached, then ``confirm`` bars in a row below both the open reference and VWAP.

    ``positions``: code, trade_date, opening_reference, entry_price, first_zone_lower.
    ``bars``: minute bars with a running ``vwap`` column.
    """
    num = bars.select(
        *DAY, dbl(price).alias("p"), dbl("vwap").alias("vw"), (F.row_number().over(_by_time()) - 1).alias("i")
    )
    span = dbl("first_zone_lower") - dbl("entry_price")
    joined = positions.join(num, DAY, "left").withColumn("span", span)
    reached = (F.col("span") > 0) & ((F.col("p") - dbl("entry_price")) / null0(F.col("span")) >= activation)
    first = F.min(F.when(reached, F.col("i"))).over(Window.partitionBy("position_id"))
    joined = joined.withColumn("act", first)
    after = (F.col("i") > F.col("act")) & (F.col("i") <= F.col("act") + confirm)
    agg = joined.groupBy("position_id", *DAY).agg(
        F.count("i").alias("n"),
        F.max("span").alias("span"),
        F.max("act").alias("act"),
        count_if(after & (F.col("p") < dbl("opening_reference"))).alias("below_open"),
        count_if(after & (F.col("p") < F.col("vw"))).alias("below_vwap"),
    )
    enough = F.col("act") + confirm < F.col("n")
    active = (F.col("n") >= 2) & (F.col("span") > 0) & F.col("act").isNotNull() & enough
    bo, bv = F.col("below_open") >= confirm, F.col("below_vwap") >= confirm
    return agg.select(
        "position_id",
        *DAY,
        F.coalesce(active & bo & bv, F.lit(False)).alias("triggered"),
        F.when(active, F.when(F.col("act") == 0, "gap_arrival").otherwise("intraday_runup")).alias("activation_type"),
        F.when(active, F.col("act")).cast("int").alias("activation_minute"),
        F.coalesce(active & bo, F.lit(False)).alias("below_opening_reference"),
        F.coalesce(active & bv, F.lit(False)).alias("below_vwap"),
        F.when(F.col("n") < 2, "insufficient_minute_data")
        .when(~(F.col("span") > 0), "target_progress_denominator_invalid")
        .when(F.col("act").isNull(), "not_activated")
        .when(~enough, "insufficient_post_activation_data")
        .when(bo & bv, "early_target_reversal_detected")
        .otherwise("conditions_not_met")
        .alias("reason"),
    )
