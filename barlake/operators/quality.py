"""Data-quality audits.  Everything is an aggregate with a map-side part or a row-wise rule."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.functions import session_time as st
from barlake.functions.numeric import blank_to_null, count_if, dbl, flag_list, null0, num, present
from barlake.functions.ranking import attach_row
from barlake.functions.text import CODE_PATTERN, MARKETS, neutral_text

# Audited columns and limits.
AUDITED_FIELDS = (
    "price", "pre_close", "open", "high", "low", "change_pct", "volume", "amount", "turnover_rate", "volume_ratio",
    "total_mv", "circ_mv", "pe_ratio", "pb_ratio", "quote_time", "source", "trade_date", "market", "name", "code",
    "board", "is_st", "is_suspended", "delist_risk", "listed_days", "industry", "concepts",
)
STALE_MINUTES = 15
CONDITION_FIELDS = ("price", "volume", "amount", "turnover_rate", "quote_time", "source")


def valid_code(c: Column | str) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.trim(x).rlike(CODE_PATTERN), F.lit(False))


# -- quote times and freshness --------------------------------------------------


def quote_timestamp(text: Column, observed: Column) -> Column:
    """Exchange-local time of a quote text.

    Clock times take the observation date, fourteen digits are a full stamp,
    anything else must be an ISO date or time; a text with a zone is moved to
    UTC+8.
    """
    t = F.trim(text)
    day = F.to_date(observed).cast("string")
    clock = F.concat(day, F.lit(" "), t).try_cast("timestamp_ntz")
    digits = F.regexp_replace(t, r"^(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)$", "$1-$2-$3 $4:$5:$6")
    zoned = t.try_cast("timestamp")
    local = F.lit("1970-01-01 08:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.unix_seconds(zoned)
    )
    return (
        F.when(t.rlike(r"^\d{1,2}:\d{1,2}(:\d{1,2})?$"), clock)
        .when(t.rlike(r"^\d{14}$"), digits.try_cast("timestamp_ntz"))
        .when(t.rlike(r"^\d{4}-\d{1,2}-\d{1,2}.*(Z|[+-]\d{2}:?\d{2})$") & t.contains(":"), local)
        .when(t.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), t.try_cast("timestamp_ntz"))
    )


def previous_weekday(d: Column) -> Column:
    """Latest weekday before a date; a calendar's ``prev_open`` replaces it where one exists."""
    return F.date_sub(d, F.when(F.weekday(d) == 0, 3).when(F.weekday(d) == 6, 2).otherwise(1))


def quote_freshness(df: DataFrame, observed_at: str, trading: bool | None = None, prev_open: str | None = None) -> DataFrame:
    """Rows with ``freshness`` (current/stale/unknown) and ``quote_status``."""
    obs = st.ntz(observed_at)
    status = st.session_status(obs, None if trading is None else F.lit(trading))
    prev = previous_weekday(F.to_date(obs)) if prev_open is None else F.lit(prev_open).cast("date")
    rows = df.withColumn("_q", quote_timestamp(F.col("quote_time"), obs)).withColumn("trading_status", status)
    qd, od, s = F.to_date("_q"), F.to_date(obs), F.col("trading_status")
    today, before = qd == od, qd == prev
    age = (F.unix_timestamp(obs.cast("timestamp")) - F.unix_timestamp(F.col("_q").cast("timestamp"))) / 60.0
    pair = (
        F.when(F.col("_q").isNull(), "unknown|unknown")
        .when(s == "non_trading_day", F.when(today | before, "current|historical").otherwise("stale|stale"))
        .when(
            s.isin("pre_open", "lunch_break"),
            F.when(today, "current|intraday").when(before, "current|historical").otherwise("stale|stale"),
        )
        .when(s == "post_close", F.when(today, "current|final").otherwise("stale|stale"))
        .when(today, F.when(age <= STALE_MINUTES, "current|intraday").otherwise("stale|intraday"))
        .otherwise(F.when(before, "stale|historical").otherwise("stale|stale"))
    )
    parts = F.split(pair, r"\|")
    return rows.withColumns({"freshness": parts[0], "quote_status": parts[1]}).drop("_q")


def freshness_summary(df: DataFrame, observed_at: str, **kw) -> DataFrame:
    return quote_freshness(df, observed_at, **kw).groupBy("freshness", "quote_status").agg(F.count(F.lit(1)).alias("rows"))


def is_stale_row(observed_at: str, trading: bool | None = None) -> Column:
    """Older than 15 minutes; after close, at lunch and on closed days rows of the same day are exempt."""
    obs = st.ntz(observed_at)
    row_time = F.coalesce(quote_timestamp(F.col("quote_time"), obs), F.col("observed_at").try_cast("timestamp_ntz"))
    age = (F.unix_timestamp(obs.cast("timestamp")) - F.unix_timestamp(row_time.cast("timestamp"))) / 60.0
    status = st.session_status(obs, None if trading is None else F.lit(trading))
    exempt = status.isin("post_close", "lunch_break", "non_trading_day") & (F.to_date(row_time) == F.to_date(obs))
    return F.coalesce((age > STALE_MINUTES) & ~exempt, F.lit(False))


def stale_rows(df: DataFrame, observed_at: str, trading: bool | None = None) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"), count_if(is_stale_row(observed_at, trading)).alias("stale_rows"))


# -- snapshot audit -------------------------------------------------------------


def known_conditions(df: DataFrame) -> DataFrame:
    """(condition, code): zero volume with a price, and a volume ratio missing although all else is there."""
    cols = set(df.columns)
    there = [present(c) if c in cols else F.lit(False) for c in CONDITION_FIELDS]
    others = there[0]
    for c in there[1:]:
        others = others & c
    ratio = present("volume_ratio") if "volume_ratio" in cols else F.lit(False)
    flags = flag_list(
        ((num("volume") == 0) & num("price").isNotNull(), "zero_volume_with_valid_price"),
        (others & ~ratio, "volume_ratio_unavailable"),
    )
    return df.where(valid_code("code")).select(F.explode(flags).alias("condition"), "code")


def field_coverage(df: DataFrame, fields: Sequence[str] = AUDITED_FIELDS) -> DataFrame:
    """(field, non_null, coverage) from one pass over the table."""
    have = [f for f in fields if f in df.columns]
    agg = df.agg(F.count(F.lit(1)).alias("_n"), *[count_if(present(f)).alias(f) for f in have])
    entries = F.array(
        *[
            F.struct(F.lit(f).alias("field"), (F.col(f) if f in have else F.lit(0).cast("bigint")).alias("non_null"))
            for f in fields
        ]
    )
    return agg.select("_n", F.explode(entries).alias("e")).select(
        "e.field",
        "e.non_null",
        F.when(F.col("_n") > 0, F.col("e.non_null") / F.col("_n")).otherwise(0.0).alias("coverage"),
    )


def market_detail(df: DataFrame) -> DataFrame:
    """Declared, actual, unique, duplicate and missing rows per expected market (one pass, no join)."""
    m = F.lower(F.trim("market"))
    ok = valid_code("code")
    agg = df.agg(
        *[count_if(m == x).alias(f"{x}_declared") for x in MARKETS],
        *[count_if((m == x) & ok).alias(f"{x}_actual") for x in MARKETS],
        *[F.count_distinct(F.when((m == x) & ok, F.col("code"))).alias(f"{x}_unique") for x in MARKETS],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(x).alias("market"),
                F.col(f"{x}_declared").alias("declared_count"),
                F.col(f"{x}_actual").alias("actual_count"),
                F.col(f"{x}_unique").alias("unique_count"),
                (F.col(f"{x}_actual") - F.col(f"{x}_unique")).alias("duplicate_count"),
                (F.col(f"{x}_declared") - F.col(f"{x}_actual")).alias("missing_count"),
            )
            for x in MARKETS
        ]
    )
    return agg.select(F.explode(rows).alias("r")).select("r.*")


def snapshot_audit(df: DataFrame, observed_at: str, provider_errors: int = 0, trading: bool | None = None) -> DataFrame:
    """Headline counts of a snapshot and the ordered list of coverage gaps."""
    m = F.lower(F.trim("market"))
    ok = valid_code("code")
    agg = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct(F.when(ok, F.col("code"))).alias("unique_code_count"),
        count_if(ok).alias("_ok"),
        count_if(~ok).alias("invalid_code_count"),
        *[count_if((m == x) & ok).alias(f"{x}_rows") for x in MARKETS],
        count_if(num("price").isNull()).alias("missing_price_count"),
        count_if(is_stale_row(observed_at, trading)).alias("stale_row_count"),
        F.max(blank_to_null("quote_time")).alias("latest_quote_time"),
    ).withColumn("duplicate_code_count", F.col("_ok") - F.col("unique_code_count"))

    def counted(name: str) -> tuple[Column, Column]:
        return F.col(name) > 0, F.concat(F.lit(name + "="), F.col(name).cast("string"))

    gaps = flag_list(
        *[(F.col(f"{x}_rows") == 0, f"missing_market_{x}") for x in MARKETS],
        *[counted(n) for n in ("duplicate_code_count", "invalid_code_count", "missing_price_count", "stale_row_count")],
        (F.lit(provider_errors > 0), f"provider_error_count={provider_errors}"),
    )
    status = st.session_status(st.ntz(observed_at), None if trading is None else F.lit(trading))
    return agg.select(
        status.alias("trading_status"),
        "total_rows",
        "unique_code_count",
        "duplicate_code_count",
        "invalid_code_count",
        *[f"{x}_rows" for x in MARKETS],
        "missing_price_count",
        "stale_row_count",
        "latest_quote_time",
        gaps.alias("coverage_gaps"),
    )


def upstream_duplicates(df: DataFrame) -> DataFrame:
    """Duplicate and invalid code counts of a raw input."""
    ok = valid_code("code")
    return df.agg(count_if(ok).alias("_ok"), F.count_distinct(F.when(ok, F.col("code"))).alias("_u"), count_if(~ok).alias("invalid")).select(
        (F.col("_ok") - F.col("_u")).alias("duplicates"), "invalid"
    )


def segment_coverage(expected: DataFrame, collected: DataFrame, min_rows: int = 200) -> DataFrame:
    """Chosen source per segment: first live one with enough rows, else the stale cache.

    ``expected``: segment, code.  ``collected``: segment, source, priority, is_cache, code.
    """
    want = expected.groupBy("segment").agg(F.count_distinct("code").alias("expected"))
    got = collected.groupBy("segment", "source", "priority", "is_cache").agg(F.count_distinct("code").alias("n"))
    usable = F.when(F.col("is_cache"), F.col("n") > 0).otherwise(F.col("n") >= min_rows)
    order = F.struct(F.col("is_cache"), F.col("priority"))
    best = got.groupBy("segment").agg(
        F.min_by(F.when(usable, F.struct("source", "n", "is_cache")), F.when(usable, order)).alias("b"),
        F.array_sort(F.collect_list(F.when(~usable, F.concat(F.col("source"), F.lit(": rows="), F.col("n").cast("string"))))).alias("errors"),
    )
    actual = F.coalesce(F.col("b.n"), F.lit(0))
    return want.join(best, "segment", "left").select(
        "segment",
        "expected",
        actual.alias("actual"),
        F.greatest(F.col("expected") - actual, F.lit(0)).alias("missing"),
        F.coalesce("b.source", F.lit("")).alias("source"),
        F.coalesce("b.is_cache", F.lit(False)).alias("is_stale"),
        F.coalesce("errors", F.array().cast("array<string>")).alias("errors"),
    )


def live_guard(df: DataFrame, observed_at: str, min_rows: int, markets: Sequence[str], max_age: float = 15.0, trading: bool | None = None) -> DataFrame:
    """One row of rule results for a live snapshot; ``accepted`` when none is broken."""
    obs = st.ntz(observed_at)
    ts = F.col("timestamp").try_cast("timestamp_ntz")
    agg = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.max(ts).alias("newest"),
        *[count_if(F.col("market") == m).alias(f"_{m}") for m in markets],
    )
    session = st.in_market_session(obs, None if trading is None else F.lit(trading))
    age = (F.unix_timestamp(obs.cast("timestamp")) - F.unix_timestamp(F.col("newest").cast("timestamp"))) / 60.0
    broken = flag_list(
        (F.col("rows") < min_rows, "rows_below_minimum"),
        *[(F.col(f"_{m}") == 0, f"missing_market_{m}") for m in markets],
        (F.col("newest").isNull(), "no_valid_timestamp"),
        (session & (F.to_date("newest") != F.to_date(obs)), "wrong_date"),
        (session & (age > max_age), "too_old"),
    )
    return agg.select("rows", "newest", broken.alias("broken"), (F.size(broken) == 0).alias("accepted"))


def classification_audit(snapshot: DataFrame, classification: DataFrame) -> DataFrame:
    """Long table (metric, key, value) of coverage, sources and snapshot code problems."""
    ok = valid_code("code")
    codes = snapshot.agg(
        F.count(F.lit(1)).alias("total_snapshot_rows"),
        (count_if(ok) - F.count_distinct(F.when(ok, F.col("code")))).alias("duplicate_code_count"),
        count_if(~ok).alias("invalid_code_count"),
    )
    fields = ("industry", "concepts", "supply_chain")
    cov = classification.agg(
        F.count(F.lit(1)).alias("output_rows"),
        count_if(F.col("coverage_status") == "covered").alias("covered_count"),
        count_if(F.col("coverage_status") == "missing").alias("missing_count"),
        *[count_if(F.col(f) != "").alias(f"{f}_coverage_count") for f in fields],
    )

    def long(df: DataFrame) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.lit("").alias("key"), F.col(c).alias("value")) for c in df.columns])
        return df.select(F.explode(pairs).alias("p")).select("p.*")

    sources = classification.select(
        F.explode(F.array(*[F.struct(F.lit(f"{f}_source").alias("metric"), F.col(f"{f}_source").alias("key")) for f in fields])).alias("p")
    ).groupBy("p.metric", "p.key").agg(F.count(F.lit(1)).alias("value"))
    return long(codes).unionByName(long(cov)).unionByName(sources)


# -- run grading ----------------------------------------------------------------


def minute_quality(audit: DataFrame) -> DataFrame:
    """full / partial / static_only / failed / not_requested per minute audit row.

    ``append_error`` and ``sequence_error`` (texts, both optional) fail a run that
    was requested, whatever its minutes look like.
    """
    errors = [F.coalesce(F.col(c), F.lit("")) != "" for c in ("append_error", "sequence_error") if c in audit.columns]
    broken = reduce(Column.__or__, errors, F.lit(False))
    a, e = F.col("actual_minutes"), F.col("total_expected_minutes")
    miss, brk = F.col("missing_minute_count"), F.col("continuity_break_count")
    grade = (
        F.when(F.coalesce(F.col("status"), F.lit("not_requested")) == "not_requested", "not_requested")
        .when(broken, "failed")
        .when(F.col("status") != "collected", "failed")
        .when(a.isNull(), "partial")
        .when(a == 0, "failed")
        .when(a < e * 0.20, "static_only")
        .when((a >= F.greatest(e * 0.83, F.lit(200.0))) & (miss <= 40) & (brk <= 3), "full")
        .otherwise("partial")
    )
    return audit.withColumn("minute_quality", grade)


def run_grade(runs: DataFrame) -> DataFrame:
    """Quality status with ordered reasons per run.

    Columns read: phase, minute_quality, market_status, coverage_gaps (array),
    market_coverage, daily_success, daily_total, segment_total,
    segment_unavailable, class_rows, class_covered, supply_filled.
    """
    phases = [p for p in st.PHASES if p != "lunch_break"]
    static = F.col("minute_quality") == "static_only"
    critical_gap = F.exists("coverage_gaps", lambda g: ~g.startswith("provider_error_count"))
    daily_rate = F.col("daily_success") / F.greatest(F.col("daily_total"), F.lit(1))
    seg = F.col("segment_total")
    seg_rate = F.when(seg > 0, (seg - F.col("segment_unavailable")) / seg).otherwise(1.0)
    class_cov = F.col("class_covered") / F.greatest(F.col("class_rows"), F.lit(1))
    supply_cov = F.col("supply_filled") / F.greatest(F.col("class_rows"), F.lit(1))
    cov = F.col("market_coverage")
    soft = flag_list(
        (class_cov < 0.95, "classification_coverage_insufficient"),
        (supply_cov < 0.5, "supply_chain_coverage_insufficient"),
    )
    thin = (cov < 0.95) | (daily_rate < 0.95) | ((seg > 0) & (seg_rate < 0.8))

    def result(status: str, *reasons: Column | str) -> Column:
        parts = [F.array(F.lit(r)) if isinstance(r, str) else r for r in reasons] or [F.array().cast("array<string>")]
        return F.struct(F.lit(status).alias("quality_status"), F.concat(*parts).alias("reasons"))

    grade = (
        F.when(F.col("phase") == "lunch_break", result("data_not_ready", "session_not_tradable"))
        .when(~F.col("phase").isin(*phases), result("data_not_ready", "invalid_phase"))
        .when(F.coalesce(F.col("class_rows"), F.lit(0)) == 0, result("data_not_ready", "classification_missing"))
        .when(F.col("minute_quality") == "failed", result("data_not_ready", "minute_failed"))
        .when(F.col("market_status") == "partial", result("data_not_ready", "market_coverage_insufficient"))
        .when(critical_gap, result("partial", "field_coverage_below_threshold"))
        .when((cov < 0.5) | (daily_rate < 0.5), result("data_not_ready", "market_coverage_insufficient"))
        .when(class_cov < 0.8, result("partial", "classification_coverage_insufficient"))
        .when(thin & static, result("partial", "minute_insufficient", soft, "daily_stale"))
        .when(thin, result("partial", soft, "daily_stale"))
        .when(static, result("data_ready_static_only", "minute_insufficient", soft))
        .when(F.col("minute_quality") == "partial", result("data_ready_static_only", "minute_coverage_below_threshold", soft))
        .when(F.size(soft) > 0, result("partial", soft))
        .otherwise(result("data_ready"))
    )
    return runs.withColumn("_g", grade).select(*runs.columns, "_g.quality_status", "_g.reasons")


def stale_daily(latest: DataFrame, expected_date: str, min_rows: int = 250) -> DataFrame:
    """Per code: ``latest_date``, ``actual_rows``, ``failed``, ``quote_time`` to the audit categories."""
    failed = F.coalesce(F.col("failed"), F.lit(False))
    stale = F.coalesce(F.col("latest_date") != F.lit(expected_date).cast("date"), F.lit(False))
    return latest.select(
        "code",
        "latest_date",
        failed.alias("is_failed"),
        (stale & ~failed).alias("is_stale"),
        F.coalesce(F.col("actual_rows") < min_rows, F.lit(False)).alias("is_short"),
        (blank_to_null("quote_time").isNull() & ~(stale & ~failed)).alias("unknown_quote_time"),
    )


def stale_daily_summary(audited: DataFrame, expected_date: str, sample: int = 50) -> DataFrame:
    """One row of counts, plus the first ``sample`` codes with unknown quote time (a report field)."""
    unknown = F.col("unknown_quote_time")
    one = audited.agg(
        F.count(F.lit(1)).alias("total_stocks"),
        count_if(F.col("latest_date") != F.lit(expected_date).cast("date")).alias("stale_count"),
        count_if(F.col("is_stale")).alias("stale_codes_count"),
        count_if(F.col("is_failed")).alias("failed_count"),
        count_if(F.col("is_short")).alias("short_history_count"),
        count_if(unknown).alias("unknown_quote_time_count"),
    )
    first = audited.where(unknown).select("code").orderBy("code").limit(sample)
    names = first.agg(F.array_sort(F.collect_list("code")).alias("unknown_quote_time_codes"))  # at most `sample`
    return attach_row(one, names).withColumn(
        "unknown_quote_time_codes_truncated", F.col("unknown_quote_time_count") > sample
    )


def stale_by_date(audited: DataFrame, expected_date: str) -> DataFrame:
    rows = audited.where(F.col("latest_date") != F.lit(expected_date).cast("date"))
    return rows.groupBy("latest_date").agg(F.count(F.lit(1)).alias("codes"))


def degrade_flags(snapshot: DataFrame, audited: DataFrame, insufficient: DataFrame) -> DataFrame:
    """is_untradable / is_incomparable; an existing ``tradable`` flag is AND-ed with the first."""
    bad = audited.select("code", (F.col("is_stale") | F.col("is_failed") | F.col("unknown_quote_time")).alias("_bad"))
    thin = insufficient.select("code").distinct().withColumn("_thin", F.lit(True))
    j = snapshot.join(bad, "code", "left").join(thin, "code", "left")
    no = F.coalesce("_bad", F.lit(False))
    out = j.withColumns({"is_untradable": no, "is_incomparable": no | F.coalesce("_thin", F.lit(False))})
    if "tradable" in snapshot.columns:
        out = out.withColumn("tradable", F.coalesce("tradable", F.lit(False)) & ~no)
    return out.drop("_bad", "_thin")


def refresh_plan(cache: DataFrame, observed_at: str, lookback: int, trading: bool | None = None, close_hour: int = 15, tail_days: int = 5) -> DataFrame:
    """Freshness of cached bars and the plan reuse / tail / full per code.

    ``cache``: code, latest_date (text or date), requested_lookback.
    """
    obs = st.ntz(observed_at)
    latest = F.col("latest_date").try_cast("date")
    behind = F.datediff(F.to_date(obs), latest)
    open_day = st.trading_day(F.to_date(obs), None if trading is None else F.lit(trading))
    limit = F.when(~open_day, 2).when(F.hour(obs) >= close_hour, 0).otherwise(1)
    fresh = F.coalesce(behind.between(0, limit), F.lit(False))
    enough = F.coalesce(F.col("requested_lookback") >= lookback, F.lit(False))
    plan = (
        F.when(fresh & enough, "reuse")
        .when(fresh, "full")
        .when(F.coalesce(behind <= tail_days, F.lit(False)), "tail")
        .otherwise("full")
    )
    return cache.select(
        "code", latest.alias("latest_date"), behind.alias("days_behind"), fresh.alias("is_fresh"), plan.alias("plan"),
        F.when(plan == "tail", behind + 3).alias("tail_days"),
    )


#: A call log is merged by these units of time, then over all time: no row gathers more than a day's minutes or a year's days.
HEALTH_LEVELS = ("minute", "day", "year", None)


def _run_after_success(items: Column) -> Column:
    """(has, tail, last) of summaries in order: any success, failures after the last one, rows of the last one."""
    kind = "struct<has:boolean,tail:bigint,last:bigint>"

    def step(acc: Column, x: Column) -> Column:
        return F.struct(
            (acc["has"] | x["has"]).alias("has"),
            F.when(x["has"], x["tail"]).otherwise(acc["tail"] + x["tail"]).alias("tail"),
            F.when(x["has"], x["last"]).otherwise(acc["last"]).alias("last"),
        ).cast(kind)

    init = F.struct(F.lit(False).alias("has"), F.lit(0).alias("tail"), F.lit(None).alias("last")).cast(kind)
    return F.aggregate(items, init, step)


def source_health(calls: DataFrame, now: str, threshold: int = 3, cooldown: int = 300) -> DataFrame:
    """Health per source from a call log (source, ts, seq, ok, rows), read once.

    Failures after the last success compose: of two neighbouring stretches of the
    log the later one decides if it has a success, else the failures add up.  So
    the log is reduced minute by minute and the minutes' summaries are merged
    level by level; a source that owns most of the log is spread over its minutes.
    """
    ok = F.coalesce("ok", F.lit(False))
    level = calls.select(
        "source",
        F.col("ts").alias("at"),
        F.struct(F.col("ts").cast("timestamp_ntz").alias("t"), F.col("seq").cast("bigint").alias("n")).alias("o"),
        F.struct(ok.alias("has"), F.when(ok, 0).otherwise(1).cast("bigint").alias("tail"), F.when(ok, F.col("rows")).cast("bigint").alias("last")).alias("s"),
        F.when(ok, 1).otherwise(0).cast("bigint").alias("successes"),
        F.when(~ok, 1).otherwise(0).cast("bigint").alias("total_failures"),
        F.when(ok, F.col("rows")).cast("decimal(28,10)").alias("sum_rows"),
        F.when(ok & F.col("rows").isNotNull(), 1).otherwise(0).cast("bigint").alias("n_rows"),
        F.when(ok, F.col("ts")).alias("last_success_at"),
        F.when(~ok, F.col("ts")).alias("last_failure_at"),
    )
    for unit in HEALTH_LEVELS:
        keys = ["source"] if unit is None else ["source", F.date_trunc(unit, "at").alias("at")]
        level = (
            level.groupBy(*keys)
            .agg(
                F.array_sort(F.collect_list(F.struct("o", "s"))).alias("items"),
                *[F.sum(c).alias(c) for c in ("successes", "total_failures", "sum_rows", "n_rows")],
                *[F.max(c).alias(c) for c in ("last_success_at", "last_failure_at")],
            )
            .withColumns({"s": _run_after_success(F.transform("items", lambda x: x["s"])), "o": F.element_at("items", -1)["o"]})
            .drop("items")
        )
    t = st.ntz(now)
    failures = F.col("s.tail")
    # the last failures in a row include the latest one
    left = cooldown - (F.unix_timestamp(t.cast("timestamp")) - F.unix_timestamp(F.col("last_failure_at").cast("timestamp")))
    off = (failures >= threshold) & (left > 0)
    return level.select(
        "source",
        "successes",
        failures.alias("failures"),
        "total_failures",
        F.coalesce("s.last", F.lit(0)).alias("last_rows"),
        F.coalesce(dbl(F.col("sum_rows")) / null0(F.col("n_rows")), F.lit(0.0)).alias("avg_rows"),
        F.coalesce(off, F.lit(False)).alias("disabled"),
        F.when(off, left).otherwise(0).cast("bigint").alias("cooldown_remaining_seconds"),
        "last_success_at",
        "last_failure_at",
    )


def source_order(health: DataFrame, defaults: DataFrame) -> DataFrame:
    """Sources with their position: enabled first, fewer failures first, then the default order.

    The table has one row per source, a short list.
    """
    from pyspark.sql import Window

    j = defaults.join(health.select("source", "disabled", "failures"), "source", "left")
    w = Window.partitionBy(F.lit(1)).orderBy(
        F.coalesce("disabled", F.lit(False)), F.coalesce("failures", F.lit(0)), "default_position"
    )
    return j.select("source", F.row_number().over(w).alias("position"), "default_position")


def error_summary(errors: DataFrame) -> DataFrame:
    """Failures per scope and the number of distinct neutral messages."""
    return errors.groupBy("scope").agg(
        F.count(F.lit(1)).alias("failures"), F.count_distinct(neutral_text("message")).alias("messages")
    )


def evidence_hash(df: DataFrame, columns: Sequence[str], out: str = "evidence_id") -> DataFrame:
    """First 16 hex digits of the SHA-256 of the record as JSON with sorted keys."""

    def item(c: str) -> Column:
        js = F.to_json(F.struct(F.col(c).alias("v")), {"ignoreNullFields": "false"})
        return F.concat(F.lit(f'"{c}": '), F.regexp_extract(js, r'^\{"v":(.*)\}$', 1))

    body = F.concat(F.lit("{"), F.concat_ws(", ", *[item(c) for c in sorted(columns)]), F.lit("}"))
    return df.withColumn(out, F.left(F.sha2(body, 256), F.lit(16)))


