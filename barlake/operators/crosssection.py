"""Cross-sectional ranks, breadth and industry aggregates.

Sums go through DECIMAL so that results do not depend on partial-aggregate
order.  Medians and percentile ranks use the binned positions of
``functions.ranking`` instead of one window per date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.functions.numeric import count_if, dbl, null0, round_dec
from barlake.functions.ranking import attach_row, exact_median, percent_rank_average
from barlake.functions.text import MARKETS, market_of


def exact_sum(c: Column | str, scale: int = 10) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return dbl(F.sum(c.cast(f"decimal(28,{scale})")))


def exact_avg(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return exact_sum(c) / null0(F.count(c))


def relative_strength(df: DataFrame, keys: Sequence[str], value: str = "return_20d", out: str = "rps20") -> DataFrame:
    """Percentile rank (ties averaged, 0-100) of ``value`` among the rows of one date."""
    return percent_rank_average(df, list(keys), value, out)


def market_breadth(snapshot: DataFrame) -> DataFrame:
    """Long table (dimension, key, metrics) for full market, market, board and industry.

    The three markets are always present, with zero counts when empty.
    """

    def member(dim: str, key: Column) -> Column:
        return F.struct(F.lit(dim).alias("dimension"), key.cast("string").alias("key"))

    expanded = snapshot.select(
        dbl("change_pct").alias("chg"),
        F.col("amount"),
        dbl("turnover_rate").alias("turnover"),
        F.explode(
            F.array(
                member("full_market", F.lit("all")),
                member("market", F.col("market")),
                member("board", F.col("board")),
                member("industry", F.col("industry")),
            )
        ).alias("m"),
    ).select("m.dimension", "m.key", "chg", "amount", "turnover")
    expanded = expanded.where(
        F.col("key").isNotNull()
        & ((F.col("dimension") != "industry") | (F.col("key") != ""))
        & ((F.col("dimension") != "market") | F.col("key").isin(*MARKETS))
    )
    keys = ["dimension", "key"]
    agg = expanded.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"),
        count_if(F.col("chg") > 0).alias("advance_count"),
        count_if(F.col("chg") < 0).alias("decline_count"),
        count_if(F.col("chg") == 0).alias("unchanged_count"),
        round_dec(exact_avg("chg"), 4).alias("avg_change_pct"),
        round_dec(exact_sum("amount", 4), 2).alias("total_amount"),
        round_dec(exact_avg("turnover"), 4).alias("avg_turnover_rate"),
    )
    med = exact_median(expanded, keys, "chg", "_med")
    joined = agg.join(med, keys, "left")
    always = F.array(
        member("full_market", F.lit("all")), *[member("market", F.lit(m)) for m in MARKETS]
    )
    fixed = snapshot.sparkSession.range(1).select(F.explode(always).alias("m")).select("m.*")  # four rows
    joined = joined.join(fixed, keys, "full_outer")
    zero = ["total", "advance_count", "decline_count", "unchanged_count"]
    return joined.select(
        *keys,
        *[F.coalesce(c, F.lit(0)).alias(c) for c in zero],
        "avg_change_pct",
        round_dec("_med", 4).alias("median_change_pct"),
        "total_amount",
        "avg_turnover_rate",
    )


def industry_aggregate(snapshot: DataFrame) -> DataFrame:
    """Members, advancers, decliners, mean change (missing counts as 0), amount and turnover per industry."""
    chg = F.coalesce(dbl("change_pct"), F.lit(0.0))
    n = F.col("component_count")
    agg = (
        snapshot.where(F.col("industry").isNotNull() & F.col("price").isNotNull())
        .groupBy("industry")
        .agg(
            F.count(F.lit(1)).alias("component_count"),
            count_if(chg > 0).alias("advance_count"),
            count_if(chg < 0).alias("decline_count"),
            exact_avg(chg).alias("_avg"),
            round_dec(exact_sum("amount", 4), 2).alias("total_amount"),
            round_dec(exact_avg(dbl("turnover_rate")), 4).alias("avg_turnover"),
        )
    )
    return agg.select(
        "industry",
        "component_count",
        "advance_count",
        "decline_count",
        round_dec(F.col("advance_count") / n, 4).alias("advance_ratio"),
        round_dec("_avg", 4).alias("avg_change_pct"),
        "total_amount",
        "avg_turnover",
    )


def industry_ma_distribution(snapshot: DataFrame, indicators: DataFrame) -> DataFrame:
    """Members of each industry above MA5/10/20, as count and share of all members."""
    ma = indicators.select("code", *[dbl(f"ma{p}").alias(f"ma{p}") for p in (5, 10, 20)])
    rows = (
        snapshot.where(F.trim("industry") != "")
        .select("code", "industry", dbl("price").alias("price"))
        .join(ma, "code", "left")
    )
    agg = rows.groupBy("industry").agg(
        F.count(F.lit(1)).alias("total"),
        *[count_if(F.col("price") > F.col(f"ma{p}")).alias(f"above_ma{p}") for p in (5, 10, 20)],
    )
    return agg.select(
        "industry",
        "total",
        *[
            c
            for p in (5, 10, 20)
            for c in (
                F.col(f"above_ma{p}"),
                round_dec(F.col(f"above_ma{p}") / F.col("total"), 4).alias(f"above_ma{p}_pct"),
            )
        ],
    )


def industry_change(snapshot: DataFrame) -> DataFrame:
    """Mean change per industry (industries without any value are absent)."""
    name = F.coalesce(F.col("industry"), F.lit("未知"))
    return (
        snapshot.groupBy(name.alias("industry"))
        .agg(exact_avg(dbl("change_pct")).alias("industry_chg"))
        .where(F.col("industry_chg").isNotNull())
    )


def industry_extremes(snapshot: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` strongest and weakest industries with their position."""
    avg = industry_change(snapshot)

    def side(name: str, order: list[Column]) -> DataFrame:
        top = avg.orderBy(*order).limit(k)  # at most k rows reach the numbering below
        return top.select(
            F.lit(name).alias("side"),
            F.row_number().over(Window.partitionBy(F.lit(name)).orderBy(*order)).alias("position"),
            "industry",
            "industry_chg",
        )

    high = [F.col("industry_chg").desc(), F.col("industry")]
    low = [F.col("industry_chg").asc(), F.col("industry").desc()]
    return side("top", high).unionByName(side("bottom", low))


def market_mode(snapshot: DataFrame) -> DataFrame:
    """One row: advance ratio, median change, mode and the thresholds the mode implies."""
    valid = snapshot.select(dbl("change_pct").alias("chg")).where(F.col("chg").isNotNull())
    one = valid.agg(F.count(F.lit(1)).alias("valid_rows"), count_if(F.col("chg") > 0).alias("advancers"))
    med = exact_median(valid, [], "chg", "market_median")
    ratio = F.col("advancers") / null0(F.col("valid_rows"))
    both = attach_row(one, med)
    return both.select(
        "valid_rows",
        ratio.alias("advance_ratio"),
        "market_median",
        F.when(ratio < 0.45, "weak").when(ratio > 0.60, "strong").otherwise("normal").alias("mode"),
        F.when(ratio < 0.45, 45).otherwise(40).alias("min_score"),
        F.when(ratio > 0.60, 2).otherwise(1).alias("max_tail_risk"),
    )


def market_counts(df: DataFrame, code: str = "code") -> DataFrame:
    """Rows per market by code prefix in one row, with the coverage text."""
    m = market_of(code)
    agg = df.agg(*[count_if(m == x).alias(x) for x in MARKETS])
    text = F.concat_ws(",", *[F.concat(F.lit(x + ":"), F.col(x).cast("string")) for x in MARKETS])
    return agg.select(*MARKETS, text.alias("coverage_text"))


def trigger_signal(snapshot: DataFrame, code: str, threshold: float = -1.0) -> DataFrame:
    """State of one watched security: change, price, whether change <= threshold."""
    hit = snapshot.where(F.col("code") == code)
    return hit.agg(
        F.count(F.lit(1)).alias("rows_found"),
        F.max(dbl("change_pct")).alias("change_pct"),
        F.max(dbl("price")).alias("price"),
        F.coalesce(F.max(dbl("change_pct") <= threshold), F.lit(False)).alias("triggered"),
    )


def industry_days(bars: DataFrame, industries: DataFrame) -> DataFrame:
    """Industry-day table: members, advance ratio, mean change (fraction), amount."""
    w = Window.partitionBy("code").orderBy("dt")
    prev = F.lag(dbl("close")).over(w)
    chg = bars.select("code", "dt", "amount", ((dbl("close") - prev) / null0(prev)).alias("chg"))
    joined = chg.join(industries.select("code", "industry"), "code")
    return (
        joined.groupBy("industry", "dt")
        .agg(
            F.count("chg").alias("members"),
            count_if(F.col("chg") > 0).alias("adv"),
            exact_avg("chg").alias("avg_change_pct"),
            exact_sum("amount", 4).alias("amount"),
        )
        .select(
            "industry",
            "dt",
            "members",
            (F.col("adv") / null0(F.col("members"))).alias("advance_ratio"),
            "avg_change_pct",
            "amount",
        )
    )


def industry_crowding(days: DataFrame, lookback: int = 20) -> DataFrame:
    """Crowded when breadth >= 0.85, mean change >= 4 % and amount >= 1.5 x its 20-day median.

    The table has one row per industry and date, so the window is bounded by the calendar.
    """
    w = Window.partitionBy("industry").orderBy("dt").rowsBetween(-lookback, -1)
    past = F.array_sort(F.collect_list("amount").over(w))  # at most `lookback` numbers
    n = F.size(past)
    mid = (F.get(past, F.floor((n - 1) / 2).cast("int")) + F.get(past, F.floor(n / 2).cast("int"))) / 2
    staged = days.withColumn("amount_median_20d", F.when(n > 0, mid))
    ratio = F.col("amount") / F.greatest(F.coalesce(F.col("amount_median_20d"), F.lit(0.0)), F.lit(1.0))
    crowded = (F.col("advance_ratio") >= 0.85) & (F.col("avg_change_pct") >= 0.04) & (ratio >= 1.5)
    return staged.select(
        "industry",
        "dt",
        "advance_ratio",
        "avg_change_pct",
        "amount_median_20d",
        ratio.alias("amount_ratio"),
        F.coalesce(crowded, F.lit(False)).alias("industry_crowding"),
    )


def report_counts(report: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Counts per value of each report column, as one long table (dimension, key, n)."""
    pairs = F.array(*[F.struct(F.lit(x).alias("dimension"), F.col(x).cast("string").alias("key")) for x in dims])
    return (
        report.select(F.explode(pairs).alias("p"))
        .select("p.*")
        .where(F.col("key").isNotNull())
        .groupBy("dimension", "key")
        .agg(F.count(F.lit(1)).alias("n"))
    )
