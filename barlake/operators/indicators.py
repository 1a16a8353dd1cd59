"""Daily technical indicators.

Two modes share one definition of every indicator.

* ``indicators_as_of``: one row per (code, as_of) from at most the last 250 bars
  before each as-of date.  The bar limit is a ``row_number() <= 250`` filter,
  which Spark applies in each map task before the shuffle, so the state per
  group is bounded whatever the history length.
* ``indicators_history``: one row per bar.  Moving sums are differences of
  running exact sums (whole price units), so each bar costs the same for MA5 and
  MA250 and the result does not depend on summation order.

Bars are unique per (code, dt): a code can never hold more rows than there are
calendar days, which bounds the per-code window.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.functions.numeric import dbl, dec, null0, safe_div
from barlake.functions.ranking import latest_per_key

# Indicator periods.
MA_PERIODS = (5, 10, 11, 20, 23, 60, 120, 250)
RETURN_PERIODS = (5, 10, 20)
MAX_BARS = 250
WILDER = 14
BOLL_N, BOLL_K = 20, 2
REPEAT_WINDOW, REPEAT_MIN, REPEAT_RATIO = 5, 3, 0.6


# -- shared expressions -----------------------------------------------------


def _and(conds: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


PRICE_UNIT = 1_000_000


def price_units(c: Column | str) -> Column:
    """Price in whole millionths, so that moving sums are exact BIGINT sums."""
    return F.round(dbl(c) * PRICE_UNIT).cast("bigint")


def mean_price(units: Column, n: Column | int) -> Column:
    return units.cast("double") / PRICE_UNIT / n


def sample_std(n: int, total: Column, squares: Column) -> Column:
    """Sample standard deviation from exact decimal sums."""
    s1 = total.cast("decimal(18,4)")
    s2 = squares.cast("decimal(34,8)") * F.lit(n).cast("decimal(2,0)")
    spread = dbl(s2 - s1 * s1) / (n * (n - 1))
    return F.sqrt(F.greatest(spread, F.lit(0.0)))


def bollinger(prefix: str, close: Column, total: Column, squares: Column, ok: Column) -> list[Column]:
    mid = dbl(total) / BOLL_N
    width = sample_std(BOLL_N, total, squares) * BOLL_K
    upper, lower = mid + width, mid - width
    pos = F.when(upper == lower, F.lit(0.5)).otherwise((close - lower) / null0(upper - lower))
    return [
        F.when(ok, e).alias(prefix + name)
        for e, name in ((upper, "upper"), (mid, "middle"), (lower, "lower"), (pos, "position"))
    ]


def shadow_ratio(o: Column, h: Column, low: Column, c: Column, which: str) -> Column:
    span = h - low
    body = h - F.greatest(o, c) if which == "upper" else F.least(o, c) - low
    # greatest/least skip NULLs, so require both ends of the body
    return F.when((span > 0) & o.isNotNull() & c.isNotNull(), body / span)


def overheated(rsi: Column, position: Column) -> Column:
    return (rsi > 70) & (position > 0.8)


# -- recursive indicators as bounded folds ----------------------------------


def rsi_fold(series: Column, n: int = WILDER) -> Column:
    """Wilder RSI over an ordered array of structs with field ``c``."""

    def step(acc, x):
        d = x["c"] - acc["prev"]
        gain, loss = F.greatest(d, F.lit(0.0)), F.greatest(-d, F.lit(0.0))
        i = acc["i"] + 1

        def smooth(old, new):
            return (
                F.when(acc["prev"].isNull(), F.lit(0.0))
                .when(i < n, old + new)
                .when(i == n, (old + new) / n)
                .otherwise((old * (n - 1) + new) / n)
            )

        return F.struct(
            F.when(acc["prev"].isNull(), F.lit(0)).otherwise(i).alias("i"),
            x["c"].alias("prev"),
            smooth(acc["up"], gain).alias("up"),
            smooth(acc["dn"], loss).alias("dn"),
        )

    start = F.struct(
        F.lit(0).alias("i"), F.lit(None).cast("double").alias("prev"), F.lit(0.0).alias("up"), F.lit(0.0).alias("dn")
    )

    def finish(acc):
        flat = F.when(acc["up"] > 0, 100.0).otherwise(50.0)
        value = F.when(acc["dn"] == 0, flat).otherwise(100.0 - 100.0 / (1.0 + acc["up"] / null0(acc["dn"])))
        return F.when(acc["i"] >= n, value)

    return F.aggregate(series, start, step, finish)


def macd_fold(series: Column) -> Column:
    """Struct(dif, dea, hist, hist_1, hist_3) of the last element; EMA seeded by the first close."""
    none = F.lit(None).cast("double")

    def ema(alpha, old, new):
        return new * F.lit(alpha) + old * F.lit(1.0 - alpha)

    def settled(acc):
        """dif, dea and histogram of the last element: read off its averages, so a step works each average out once."""
        dif = F.when(acc["i"] >= 26, acc["fast"] - acc["slow"])
        dea = F.coalesce(ema(0.2, acc["dea"], dif), dif)
        return dif, dea, F.when(acc["i"] >= 34, (dif - dea) * 2)

    def step(acc, x):
        _, dea, hist = settled(acc)
        return F.struct(
            (acc["i"] + 1).alias("i"),
            F.when(acc["i"] == 0, x["c"]).otherwise(ema(2.0 / 13.0, acc["fast"], x["c"])).alias("fast"),
            F.when(acc["i"] == 0, x["c"]).otherwise(ema(2.0 / 27.0, acc["slow"], x["c"])).alias("slow"),
            dea.alias("dea"),
            hist.alias("h1"),
            acc["h1"].alias("h2"),
            acc["h2"].alias("h3"),
        )

    start = F.struct(F.lit(0).alias("i"), *[none.alias(n) for n in ("fast", "slow", "dea", "h1", "h2", "h3")])

    def finish(acc):
        dif, dea, hist = settled(acc)
        return F.struct(
            dif.alias("dif"),
            F.when(acc["i"] >= 34, dea).alias("dea"),
            hist.alias("hist"),
            acc["h1"].alias("hist_1"),
            acc["h3"].alias("hist_3"),
        )

    return F.aggregate(series, start, step, finish)


def atr_fold(series: Column, n: int = WILDER) -> Column:
    """Wilder ATR over an ordered array of structs with h, l, c (all present)."""

    def step(acc, x):
        i = acc["i"] + 1
        span = x["h"] - x["l"]
        true_range = F.when(acc["prev"].isNull(), span).otherwise(
            F.greatest(span, F.abs(x["h"] - acc["prev"]), F.abs(x["l"] - acc["prev"]))
        )
        value = (
            F.when(i < n, acc["v"] + true_range)
            .when(i == n, (acc["v"] + true_range) / n)
            .otherwise((acc["v"] * (n - 1) + true_range) / n)
        )
        return F.struct(i.alias("i"), x["c"].alias("prev"), value.alias("v"))

    start = F.struct(F.lit(0).alias("i"), F.lit(None).cast("double").alias("prev"), F.lit(0.0).alias("v"))
    return F.aggregate(series, start, step, lambda acc: F.when(acc["i"] >= n, acc["v"]))


# -- as-of mode -------------------------------------------------------------


def cutoff(bars: DataFrame, as_of: Sequence[str], keep: int = MAX_BARS) -> DataFrame:
    """The last ``keep`` bars strictly before each as-of date; ``k`` = 1 is the newest."""
    days = [F.lit(d).cast("date") for d in as_of]
    # no as-of date reads later bars; said on its own, this reaches the scan
    past = bars.where(F.col("dt") < (F.greatest(*days) if len(days) > 1 else days[0]))
    spread = past.withColumn("as_of", F.explode(F.array(*days))).where(F.col("dt") < F.col("as_of"))
    return latest_per_key(spread, ["code", "as_of"], [F.col("dt").desc()], keep, "k")


def indicators_as_of(bars: DataFrame, as_of: Sequence[str], keep: int = MAX_BARS) -> DataFrame:
    """The full indicator record per (code, as_of).

    Unused columns are pruned by the optimizer, so callers select what they need.
    """
    tail = cutoff(bars, as_of, keep).withColumnRenamed("k", "bar_no")
    w = Window.partitionBy("code", "as_of").orderBy(F.col("dt").desc())
    rows = (
        tail.where(F.col("close").isNotNull())
        .withColumn("k", F.row_number().over(w))
        .withColumn("_c", dec("close"))
        .withColumn("_u", price_units("close"))
        .select("*", *[dbl(x).alias(f"_{x}") for x in ("open", "high", "low", "close")])
    )
    k, c = F.col("k"), F.col("_close")

    def newest(n: int, what: Column) -> Column:
        return F.when(k <= n, what)

    def at(n: int, what: Column) -> Column:
        return F.max(F.when(k == n, what))

    upper = shadow_ratio(F.col("_open"), F.col("_high"), F.col("_low"), c, "upper")
    lower = shadow_ratio(F.col("_open"), F.col("_high"), F.col("_low"), c, "lower")
    bar = F.struct("dt", F.col("_high").alias("h"), F.col("_low").alias("l"), c.alias("c"))
    agg = rows.groupBy("code", "as_of").agg(
        F.count(F.lit(1)).cast("bigint").alias("used_rows"),
        F.min("dt").alias("first_date"),
        F.max("dt").alias("last_date"),
        at(1, c).alias("last_close"),
        *[F.sum(newest(p, F.col("_u"))).alias(f"_s{p}") for p in MA_PERIODS],
        F.sum(newest(BOLL_N, F.col("_c"))).alias("_d20"),
        F.sum(newest(BOLL_N, F.col("_c") * F.col("_c"))).alias("_q20"),
        *[at(p + 1, c).alias(f"_c{p}") for p in RETURN_PERIODS],
        at(1, upper).alias("upper_shadow_ratio"),
        at(1, lower).alias("lower_shadow_ratio"),
        F.count(newest(REPEAT_WINDOW, upper)).alias("_valid5"),
        F.count(newest(REPEAT_WINDOW, F.when(upper > REPEAT_RATIO, 1))).alias("_long5"),
        F.max(newest(20, F.col("_high"))).alias("_hi20"),
        F.min(newest(20, F.col("_low"))).alias("_lo20"),
        F.count(newest(20, F.col("_high"))).alias("_nhi"),
        F.count(newest(20, F.col("_low"))).alias("_nlo"),
        F.sort_array(F.collect_list(bar)).alias("_bars"),  # at most `keep` elements
    )
    n = F.col("used_rows")
    full = F.filter(F.col("_bars"), lambda b: b["h"].isNotNull() & b["l"].isNotNull())
    agg = agg.select(
        "*",
        rsi_fold(F.col("_bars")).alias("rsi14"),
        macd_fold(F.col("_bars")).alias("_macd"),
        atr_fold(full).alias("atr14"),
        *bollinger("boll_", F.col("last_close"), F.col("_d20"), F.col("_q20"), n >= BOLL_N),
    )
    hist, hist1, hist3 = (F.col(f"_macd.{x}") for x in ("hist", "hist_1", "hist_3"))
    last = F.col("last_close")
    return agg.select(
        "code",
        "as_of",
        "used_rows",
        "first_date",
        "last_date",
        "last_close",
        *[F.when(n >= p, mean_price(F.col(f"_s{p}"), p)).alias(f"ma{p}") for p in MA_PERIODS],
        "rsi14",
        F.col("_macd.dif").alias("macd_dif"),
        F.col("_macd.dea").alias("macd_dea"),
        hist.alias("macd_hist"),
        (hist - hist1).alias("momentum_delta_1"),
        (hist - hist3).alias("momentum_delta_3"),
        # unknown unless both deltas are known
        F.when((hist - hist1).isNotNull() & (hist - hist3).isNotNull(), (hist > hist1) & (hist > hist3)).alias(
            "momentum_improving"
        ),
        "atr14",
        (F.col("atr14") / null0(last) * 100).alias("atr14_pct"),
        "boll_upper",
        "boll_middle",
        "boll_lower",
        "boll_position",
        *[((last - F.col(f"_c{p}")) / null0(F.col(f"_c{p}"))).alias(f"return_{p}d") for p in RETURN_PERIODS],
        "upper_shadow_ratio",
        "lower_shadow_ratio",
        F.when(F.col("_nhi") >= 20, F.col("_hi20")).alias("high_20d"),
        F.when(F.col("_nlo") >= 20, F.col("_lo20")).alias("low_20d"),
        F.when(F.col("_valid5") == REPEAT_WINDOW, F.col("_long5") >= REPEAT_MIN).alias("repeated_upper_shadow"),
        overheated(F.col("rsi14"), F.col("boll_position")).alias("overheated"),
    )


def indicator_meta(bars: DataFrame, as_of: Sequence[str], calculated_at: str) -> DataFrame:
    """Row counts and date range per (code, as_of), and whether today's open session is included."""
    dates = F.array(*[F.lit(d).cast("date") for d in as_of])
    now = F.lit(calculated_at).cast("timestamp_ntz")
    before = F.col("dt") < F.col("as_of")
    kept = (
        cutoff(bars, as_of)
        .groupBy("code", "as_of")
        .agg(F.min("dt").alias("first_date"), F.max("dt").alias("last_date"))
    )
    counts = (
        bars.withColumn("as_of", F.explode(dates))
        .groupBy("code", "as_of")
        .agg(
            F.count(F.lit(1)).alias("input_rows"),
            F.max("dt").alias("last_trade_date"),
            F.count(F.when(before, 1)).alias("_kept"),
        )
    )
    cut = F.col("_kept") < F.col("input_rows")
    return counts.join(kept, ["code", "as_of"], "left").select(
        "code",
        "as_of",
        "input_rows",
        "last_trade_date",
        F.when(cut, F.col("input_rows")).alias("truncated_from"),
        F.when(cut, F.col("_kept")).alias("truncated_to"),
        "first_date",
        "last_date",
        ((F.col("last_trade_date") == F.to_date(now)) & (F.hour(now) < 15)).alias("includes_intraday_today"),
    )


# -- history mode -----------------------------------------------------------


def indicators_history(bars: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Moving-window indicators for every bar (value known at that bar's close); ``carry`` columns come along."""
    by_code = Window.partitionBy("code").orderBy("dt")
    running = by_code.rowsBetween(Window.unboundedPreceding, 0)

    def last_rows(n: int):
        return by_code.rowsBetween(-(n - 1), 0)

    c = dec("close")
    close = dbl("close")
    base = bars.where(F.col("close").isNotNull()).select(
        "code",
        "dt",
        close.alias("close"),
        *[dbl(x).alias(x) for x in ("open", "high", "low")],
        *carry,
        F.row_number().over(by_code).alias("bar_no"),
        F.sum(price_units("close")).over(running).alias("_units"),
        F.sum(c).over(running).alias("_sum"),
        F.sum(c * c).over(running).alias("_sq"),
    )

    def moving(name: str, n: int) -> Column:
        # before bar n there is nothing to subtract
        return F.col(name) - F.coalesce(F.lag(name, n).over(by_code), F.lit(0))

    upper = shadow_ratio(F.col("open"), F.col("high"), F.col("low"), F.col("close"), "upper")
    lower = shadow_ratio(F.col("open"), F.col("high"), F.col("low"), F.col("close"), "lower")
    staged = base.select(
        "code",
        "dt",
        "close",
        "bar_no",
        *carry,
        *[moving("_units", p).alias(f"_s{p}") for p in MA_PERIODS],
        moving("_sum", BOLL_N).alias("_d20"),
        moving("_sq", BOLL_N).alias("_q20"),
        *[F.lag("close", p).over(by_code).alias(f"_c{p}") for p in RETURN_PERIODS],
        upper.alias("upper_shadow_ratio"),
        lower.alias("lower_shadow_ratio"),
        F.count(upper).over(last_rows(REPEAT_WINDOW)).alias("_valid5"),
        F.count(F.when(upper > REPEAT_RATIO, 1)).over(last_rows(REPEAT_WINDOW)).alias("_long5"),
        F.max("high").over(last_rows(20)).alias("_hi20"),
        F.min("low").over(last_rows(20)).alias("_lo20"),
        F.count("high").over(last_rows(20)).alias("_nhi"),
        F.count("low").over(last_rows(20)).alias("_nlo"),
    )
    n = F.col("bar_no")
    return staged.select(
        "code",
        "dt",
        "close",
        "bar_no",
        *carry,
        *[F.when(n >= p, mean_price(F.col(f"_s{p}"), p)).alias(f"ma{p}") for p in MA_PERIODS],
        *bollinger("boll_", F.col("close"), F.col("_d20"), F.col("_q20"), n >= BOLL_N),
        *[
            ((F.col("close") - F.col(f"_c{p}")) / null0(F.col(f"_c{p}"))).alias(f"return_{p}d")
            for p in RETURN_PERIODS
        ],
        "upper_shadow_ratio",
        "lower_shadow_ratio",
        F.when(F.col("_nhi") >= 20, F.col("_hi20")).alias("high_20d"),
        F.when(F.col("_nlo") >= 20, F.col("_lo20")).alias("low_20d"),
        F.when(F.col("_valid5") == REPEAT_WINDOW, F.col("_long5") >= REPEAT_MIN).alias("repeated_upper_shadow"),
    )


# -- volume and index indicators -------------------------------------------


def vwap(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sum(amount) / sum(volume) over rows where both are present."""
    both = F.col("volume").isNotNull() & F.col("amount").isNotNull()
    return df.groupBy(*keys).agg(
        safe_div(
            dbl(F.sum(F.when(both, dec("amount", 30, 4)))), dbl(F.sum(F.when(both, dec("volume", 22, 4))))
        ).alias("vwap")
    )


def average_volume(bars: DataFrame, before: str, n: int = 5) -> DataFrame:
    """Mean of the last ``n`` positive volumes before a date; codes with fewer are absent."""
    usable = bars.where((F.col("volume") > 0) & (F.col("dt") < F.lit(before).cast("date")))
    last = latest_per_key(usable, ["code"], [F.col("dt").desc()], n)
    return (
        last.groupBy("code")
        .agg(F.sum(dec("volume")).alias("_s"), F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") == n)
        .select("code", (dbl("_s") / n).alias("avg5_volume"))
    )


def volume_ratio(snapshot: DataFrame, avg5: DataFrame, elapsed: Column, day_minutes: int = 240) -> DataFrame:
    """Volume against the five-day mean, scaled to the elapsed part of the session."""
    from barlake.functions.numeric import round_dec

    joined = snapshot.drop("volume_ratio").join(avg5, "code", "left")
    vol, avg = dbl("volume"), F.col("avg5_volume")
    usable = (vol > 0) & (avg > 0)
    ratio = F.when(usable & (elapsed >= day_minutes), vol / avg).when(
        usable & (elapsed > 0), vol / null0(avg * (elapsed / F.lit(float(day_minutes))))
    )
    return joined.select(
        *[x for x in joined.columns],
        round_dec(ratio, 4).alias("volume_ratio"),
        F.lit(5).alias("volume_ratio_window"),
        F.when(elapsed >= day_minutes, "full_day_vs_prev_5d")
        .otherwise("intraday_pace_vs_prev_5d")
        .alias("volume_ratio_method"),
        elapsed.cast("int").alias("elapsed_trade_minutes"),
    )


def index_indicators(bars: DataFrame, live: DataFrame | None = None, min_rows: int = 5) -> DataFrame:
    """Latest row per index with MA5/10/20/60 (60 shrinks to what exists), returns and a live overlay.

    ``live`` may give code, price, change_pct, quote_time for the current session.
    """
    tail = latest_per_key(bars.where(F.col("close").isNotNull()), ["code"], [F.col("dt").desc()], MAX_BARS, "k")
    k, c = F.col("k"), dbl("close")

    def at(n: int, what: Column) -> Column:
        return F.max(F.when(k == n, what))

    agg = tail.groupBy("code").agg(
        F.count(F.lit(1)).alias("_n"),
        at(1, F.col("dt")).alias("dt"),
        *[at(1, dbl(x)).alias(x) for x in ("open", "high", "low", "close", "volume", "amount")],
        at(2, c).alias("pre_close"),
        *[F.sum(F.when(k <= p, price_units("close"))).alias(f"_s{p}") for p in (5, 10, 20, 60)],
        *[at(p + 1, c).alias(f"_c{p}") for p in RETURN_PERIODS],
    )
    n = F.col("_n")
    out = agg.where(n >= min_rows).select(
        "code",
        "dt",
        "open",
        "high",
        "low",
        "close",
        "pre_close",
        ((F.col("close") - F.col("pre_close")) / null0(F.col("pre_close")) * 100).alias("pct_chg"),
        "volume",
        "amount",
        *[F.when(n >= p, mean_price(F.col(f"_s{p}"), p)).alias(f"ma{p}") for p in (5, 10, 20)],
        mean_price(F.col("_s60"), F.least(n, F.lit(60))).alias("ma60"),
        *[((F.col("close") - F.col(f"_c{p}")) / null0(F.col(f"_c{p}"))).alias(f"return_{p}d") for p in RETURN_PERIODS],
    )
    if live is None:
        return out.select(
            "*",
            F.col("close").alias("intraday_price"),
            F.col("pct_chg").alias("intraday_change_pct"),
            F.col("dt").cast("string").alias("quote_time"),
        )
    lv = live.select(
        "code",
        F.col("price").alias("_p"),
        F.col("change_pct").alias("_chg"),
        F.col("quote_time").alias("_qt"),
    )
    return out.join(lv, "code", "left").select(
        *out.columns,
        F.coalesce("_p", "close").alias("intraday_price"),
        F.coalesce("_chg", "pct_chg").alias("intraday_change_pct"),
        F.coalesce(F.col("_qt"), F.col("dt").cast("string")).alias("quote_time"),
    )


def history_quality(bars: DataFrame, lookback: int = 250, min_rows: int = 50) -> DataFrame:
    """Row count per code with the insufficient / short history flags."""
    n = F.col("actual_rows")
    return (
        bars.groupBy("code")
        .agg(F.least(F.count(F.lit(1)), F.lit(lookback)).alias("actual_rows"))
        .select(
            "code",
            "actual_rows",
            (n < min_rows).alias("insufficient"),
            F.when(n < lookback, "short_history").alias("reason"),
        )
    )


def indicator_coverage(indicators: DataFrame, fields: Sequence[str]) -> DataFrame:
    """How many records have any / all / none of the indicator values."""
    some = F.coalesce(*[F.col(f).cast("string") for f in fields]).isNotNull()
    every = _and([F.col(f).isNotNull() for f in fields])
    return indicators.agg(
        F.count(F.lit(1)).alias("records"),
        F.count(F.when(some, 1)).alias("any_valid"),
        F.count(F.when(every, 1)).alias("all_valid"),
        F.count(F.when(~some, 1)).alias("all_empty"),
    )


def overnight_gap(bars: DataFrame, min_gaps: int = 60, warn: float = 0.04, keep: int = MAX_BARS) -> DataFrame:
    """90th-percentile overnight gap per code: the element at floor(n * 0.9) of the sorted gaps."""
    from barlake.functions.numeric import round_dec

    tail = latest_per_key(bars, ["code"], [F.col("dt").desc()], keep + 1)
    w = Window.partitionBy("code").orderBy("dt")
    gaps = tail.select(
        "code", (dbl("open") / null0(F.lag(dbl("close")).over(w)) - 1).alias("gap")
    ).where(F.col("gap").isNotNull())
    agg = gaps.groupBy("code").agg(F.array_sort(F.collect_list("gap")).alias("g"))  # at most `keep`
    n = F.size("g")
    p90 = F.when(n >= min_gaps, F.get(F.col("g"), F.floor(n * 0.9).cast("int")))
    return agg.select(
        "code",
        n.cast("bigint").alias("gaps"),
        round_dec(p90, 4).alias("overnight_gap_p90"),
        F.coalesce(p90 >= warn, F.lit(False)).alias("overnight_gap_warning"),
        F.when(n >= min_gaps, "ok").otherwise("history_insufficient").alias("status"),
    )
