"""Confirmation, race of price barriers, constrained selection and position size.

Minute bars are unique per (code, trade_date, ts), so a day has at most 1,440 of
them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.functions import session_time as st
from barlake.functions.numeric import dbl
from barlake.functions.ranking import latest_per_key
from barlake.operators.minutes import DAY, exact
from barlake.operators.screening import COMMISSION, MIN_COMMISSION, STAMP_TAX, TRANSFER

# Confirmation contract, number of picks.
CONFIRM_MINUTES, ACTIVITY_RATIO, BASE_MINUTES, CONFIRM_CUTOFF = 3, 0.9, 15, 14 * 60 + 35
MAX_PICKS = 3
LOT = 100
#: Minutes of a bin of the barrier race.
BIN_MINUTES = 30


# -- three-minute confirmation -------------------------------------------------------


def confirmations(bars: DataFrame, triggers: DataFrame) -> DataFrame:
    """Every minute that could complete a confirmation, with the parts of the rule and the verdict.

    ``triggers``: code, trade_date, trigger.  The minute and the two before it
    follow each other without a hole; the activity is compared with the median of
    all sums of three successive minutes that end within the 15 minutes before.
    """
    # 11:30 and 13:00 follow each other
    m = st.minute_of_day("ts")
    idx = F.when(m <= st.LUNCH_START, m - st.OPEN).otherwise(m - st.LUNCH_END + st.LUNCH_START - st.OPEN + 1)
    by_row, by_minute = Window.partitionBy(*DAY).orderBy("ts"), Window.partitionBy(*DAY).orderBy("i")
    three = by_row.rowsBetween(-(CONFIRM_MINUTES - 1), 0)
    n = CONFIRM_MINUTES
    staged = bars.select(*DAY, "ts", dbl("close").alias("close"), "volume", exact("amount").alias("amount"), idx.alias("i"))
    staged = staged.select(
        "*",
        ((F.count(F.lit(1)).over(three) == n) & (F.col("i") - F.min("i").over(three) == n - 1)).alias("_whole"),
        F.sum("amount").over(three).alias("amount_3m"),
        F.min("close").over(three).alias("low_close"),
        F.first("close").over(three).alias("first_close"),
        (F.min("volume").over(three) > 0).alias("_traded"),
        (F.min("amount").over(three) > 0).alias("_paid"),
    )
    # sums that end before the confirmation begins and begin within the base minutes: at most 13
    base = by_minute.rangeBetween(-BASE_MINUTES, -n)
    sums = F.collect_list(F.when(F.col("_whole"), F.col("amount_3m"))).over(base)
    staged = staged.withColumn("_base", F.sort_array(sums)).where(F.col("_whole"))
    size = F.size("_base")
    low, high = F.floor((size - 1) / 2).cast("int"), F.floor(size / 2).cast("int")
    median = F.when(size > 0, (dbl(F.get("_base", low)) + dbl(F.get("_base", high))) / 2)
    rows = staged.join(triggers, DAY).withColumns({"base_median": median, "amount_3m": dbl("amount_3m")})
    parts = {
        "holds_trigger": F.col("low_close") >= dbl("trigger"),
        "in_time": st.minute_of_day("ts") <= CONFIRM_CUTOFF,
        "traded": F.col("_traded") & F.col("_paid"),
        "not_falling": F.col("close") >= F.col("first_close"),
        "active": F.coalesce(F.col("amount_3m") >= F.col("base_median") * ACTIVITY_RATIO, F.lit(False)),
    }
    rows = rows.withColumns(parts)
    passed = reduce(Column.__and__, [F.col(p) for p in parts])
    return rows.select(*DAY, "ts", "amount_3m", "base_median", *parts, passed.alias("confirmed"))


def first_confirmation(checked: DataFrame) -> DataFrame:
    """The earliest confirmation of a code and day."""
    return checked.where("confirmed").groupBy(*DAY).agg(F.min("ts").alias("confirmed_at"))


# -- race of barriers ----------------------------------------------------------------


def first_passages(plans: DataFrame, bars: DataFrame, upper: Mapping[str, str], lower: Mapping[str, str]) -> DataFrame:
    """(plan, <name>_at ...): when the bars after the entry first reach each barrier, NULL if they never do.

    ``plans``: plan, code, trade_date, entry_ts and the barrier columns; ``upper`` and
    ``lower`` map names to columns: an upper barrier is reached by a high at or above
    it, a lower one by a low at or below it.  Bins of minutes carry their extremes;
    a plan reads single minutes only in the bin of its entry and in the first later
    bin that reaches a barrier.
    """
    first_bin = lambda c: F.floor(st.minute_of_day(c) / BIN_MINUTES)
    minute = bars.select(*DAY, "ts", dbl("high").alias("high"), dbl("low").alias("low"), first_bin("ts").alias("bin"))
    bins = minute.groupBy(*DAY, "bin").agg(F.max("high").alias("high"), F.min("low").alias("low"))
    hit = {n: F.col("high") >= dbl(c) for n, c in upper.items()} | {n: F.col("low") <= dbl(c) for n, c in lower.items()}
    own = plans.withColumn("_bin", first_bin("entry_ts"))
    later = own.join(bins, DAY).where(F.col("bin") > F.col("_bin"))
    # the first later bin of each barrier
    firsts = later.groupBy("plan").agg(*[F.min(F.when(h, F.col("bin"))).alias(f"_b_{n}") for n, h in hit.items()])
    reads = own.join(firsts, "plan", "left")
    reads = reads.withColumn("bin", F.explode(F.array_distinct(F.array_compact(F.array("_bin", *[f"_b_{n}" for n in hit])))))
    near = reads.join(minute, [*DAY, "bin"]).where(F.col("ts") > F.col("entry_ts"))
    times = near.groupBy("plan").agg(*[F.min(F.when(h, F.col("ts"))).alias(f"{n}_at") for n, h in hit.items()])
    return plans.select("plan").join(times, "plan", "left")


def race_label(target: Column, stop: Column) -> Column:
    """Which of two barriers came first; both in one bar cannot be told apart."""
    return (
        F.when(target.isNull() & stop.isNull(), "neither")
        .when(stop.isNull() | (target < stop), "first_zone_before_protection")
        .when(target.isNull() | (stop < target), "protection_before_first_zone")
        .otherwise("same_bar")
    )


# -- picks ---------------------------------------------------------------------------


def actionable(ranked: DataFrame, keys: Sequence[str], group: str, position: str = "position", most: int = MAX_PICKS) -> DataFrame:
    """``label`` of every ranked candidate: the first ``most``, of each group only its best, are actionable.

    Taking the best of every group and then the first of these is what a greedy
    pass down the ranking takes.
    """
    best = latest_per_key(ranked, [*keys, group], [F.col(position)], 1).drop("_rn")
    picks = latest_per_key(best, list(keys), [F.col(position)], most, "pick").select(*keys, position, "pick")
    rows = ranked.join(picks, [*keys, position], "left")
    return rows.withColumn("label", F.when(F.col("pick").isNotNull(), "actionable_candidate").otherwise("conditional_watch"))


# -- position size -------------------------------------------------------------------


def trade_cost(buy: Column, sell: Column, quantity: Column) -> Column:
    """All fees of a round trip; commissions have a minimum for each order."""
    b, s = buy * quantity, sell * quantity
    return F.greatest(b * COMMISSION, F.lit(MIN_COMMISSION)) + F.greatest(s * COMMISSION, F.lit(MIN_COMMISSION)) + s * STAMP_TAX + (b + s) * TRANSFER


def position_size(df: DataFrame, steps: int = 20) -> DataFrame:
    """The largest number of shares, in lots of 100, that keeps every limit, with cost and losses at that number.

    ``df``: entry, protection, limit_down (prices), max_capital, max_loss, max_stress
    (amounts).  Capital, planned loss and loss at the price limit all grow with the
    number, though not in proportion (minimum commissions), so the number is found
    lot by lot from its highest binary digit down; at most 2 ** ``steps`` - 1 lots.
    """
    entry, stop, floor_ = dbl("entry"), dbl("protection"), dbl("limit_down")

    def amounts(shares: Column) -> tuple[Column, Column, Column]:
        loss = lambda price: (entry - price) * shares + trade_cost(entry, price, shares)
        capital = entry * shares + F.greatest(entry * shares * COMMISSION, F.lit(MIN_COMMISSION)) + entry * shares * TRANSFER
        return capital, loss(stop), loss(floor_)

    def fits(lots: Column) -> Column:
        limits = (dbl("max_capital"), dbl("max_loss"), dbl("max_stress"))
        return reduce(Column.__and__, [a <= m for a, m in zip(amounts(lots * LOT), limits, strict=True)])

    digits = F.array(*[F.lit(2**k) for k in range(steps - 1, -1, -1)])
    lots = F.aggregate(digits, F.lit(0), lambda have, add: F.when(F.coalesce(fits(have + add), F.lit(False)), have + add).otherwise(have))
    rows = df.withColumn("shares", (lots * LOT).cast("bigint"))
    capital, loss, stress = amounts(F.col("shares"))
    taken = F.col("shares") > 0
    return rows.withColumns(
        {n: F.when(taken, a).otherwise(0.0) for n, a in (("capital", capital), ("planned_loss", loss), ("stress_loss", stress))}
    )
