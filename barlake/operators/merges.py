"""Joins and merges with source priority.

Every join is an equi-join.  Both sides are reduced to one row per key before
joining (with an explicit ingest order), so no key can multiply.  No join hint
is used: whether a side is broadcast follows from its measured size (AQE).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.functions.numeric import blank_to_null, dbl, null0, num
from barlake.functions.ranking import attach_row, latest_per_key
from barlake.functions.session_time import is_weekday
from barlake.functions.text import (
    CODE_PATTERN,
    label_text,
    market_order,
    market_symbol,
    normalize_live_code,
    pad_code,
    plain_text,
)
from barlake.schemas import REFERENCE_FIELDS


def keep_last(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    return latest_per_key(df, list(keys), [F.col(seq).desc()]).drop("_rn")


def keep_first(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    return latest_per_key(df, list(keys), [F.col(seq).asc()]).drop("_rn")


def _filled(df: DataFrame, c: str) -> Column:
    """Column value, with blank text of string columns treated as missing."""
    return blank_to_null(c) if dict(df.dtypes)[c] == "string" else F.col(c)


def live_with_reference(live: DataFrame, reference: DataFrame, seq: str, fields: Sequence[str] = REFERENCE_FIELDS) -> DataFrame:
    """Live quotes win; slower fields are filled from the reference; reference-only codes are appended."""
    clean = lambda df: keep_last(
        df.withColumn("code", normalize_live_code("code")).where(F.col("code") != ""), ["code"], seq
    ).drop(seq)
    lv, rf = clean(live), clean(reference)
    fill = [c for c in fields if c in rf.columns]
    out_cols = [c for c in lv.columns if c != "code"] + [c for c in fill if c not in lv.columns]
    r = rf.select("code", *[F.col(c).alias(f"_r_{c}") for c in out_cols if c in rf.columns], F.lit(True).alias("_in_ref"))
    joined = lv.withColumn("_in_live", F.lit(True)).join(r, "code", "full_outer")

    def value(c: str) -> Column:
        ref = F.col(f"_r_{c}") if c in rf.columns else F.lit(None)
        if c not in lv.columns:
            return ref
        if c in fill:
            return F.coalesce(_filled(lv, c), ref)
        return F.when(F.col("_in_live"), F.col(c)).otherwise(ref)

    return joined.select("code", *[value(c).alias(c) for c in out_cols], market_symbol("code").alias("symbol"))


def segment_merge(main: DataFrame, segment: DataFrame, market: str = "bj") -> DataFrame:
    """Main market rows and an independently collected segment; the segment wins, market order."""
    seg = segment.withColumn("code", pad_code("code")).withColumn("market", F.lit(market))
    both = main.withColumn("_o", F.lit(0)).unionByName(seg.withColumn("_o", F.lit(1)), allowMissingColumns=True)
    merged = keep_last(both, ["code"], "_o").drop("_o")
    return merged.orderBy(market_order("market"), "code")


def refresh_segment(
    cached: DataFrame, quotes: DataFrame, seq: str, stale: Sequence[str] = ("source", "quote_time", "ticktime", "volume_ratio", "observed_at", "timestamp")
) -> DataFrame:
    """New quotes of a known universe: slow attributes from the cached row, live fields from the quote."""
    base = keep_last(cached.withColumn("code", normalize_live_code("code")), ["code"], seq)
    base = base.drop(seq, *[c for c in stale if c in base.columns])
    live = quotes.where(F.col("price") > 0)
    keep = [c for c in base.columns if c != "code" and c not in live.columns]
    return base.select("code", *keep).join(live, "code")


def refresh_expectation(cached: DataFrame, refreshed: DataFrame, min_rows: int, share: float = 0.98) -> DataFrame:
    """One row: cached, refreshed and required rows, and whether the refresh is accepted."""
    a = cached.agg(F.count_distinct("code").alias("cached_rows"))
    b = refreshed.agg(F.count(F.lit(1)).alias("refreshed_rows"))
    need = F.greatest(F.lit(min_rows), F.floor(F.col("cached_rows") * share)).cast("bigint")
    return attach_row(a, b).select(
        "cached_rows", "refreshed_rows", need.alias("required_rows"), (F.col("refreshed_rows") >= need).alias("accepted")
    )


def carry_forward(current: DataFrame, previous: DataFrame, observed_at: str) -> DataFrame:
    """Previous rows whose code is gone stay with zero volume and a blank quote time, flagged ``is_carried``."""
    prev = previous.withColumn("code", pad_code("code"))
    gone = prev.join(current.select("code"), "code", "left_anti")
    gone = gone.withColumns(
        {
            "volume": F.lit(0.0),
            "quote_time": F.lit(""),
            "observed_at": F.lit(observed_at),
            "source": F.coalesce(F.col("source"), F.lit("suspended")) if "source" in prev.columns else F.lit("suspended"),
            "is_carried": F.lit(True),
        }
    )
    return current.withColumn("is_carried", F.lit(False)).unionByName(gone, allowMissingColumns=True)


# -- classification -------------------------------------------------------------

_CLASS_FIELDS = ("industry", "concepts", "supply_chain")


def classification_map(
    snapshot: DataFrame, existing: DataFrame, supply: DataFrame, seq: str, default_source: str = "provider"
) -> DataFrame:
    """Per field the first non-empty of snapshot, existing map, supply-chain file, with its origin.

    The first valid row per code counts on every side; ``updated_at`` is the
    newest over all rows of snapshot and existing map.
    """

    def side(df: DataFrame, p: str) -> DataFrame:
        valid = df.withColumn("code", plain_text("code")).where(F.col("code").rlike(CODE_PATTERN))
        first = keep_first(valid, ["code"], seq)
        cols = [c for c in ("name", *_CLASS_FIELDS, "source") if c in first.columns]
        return first.select("code", F.lit(True).alias(f"{p}_in"), *[blank_to_null(c).alias(f"{p}_{c}") for c in cols])

    s, e, u = side(snapshot, "s"), side(existing, "e"), side(supply, "u")
    stamp = (
        snapshot.select("code", "updated_at")
        .unionByName(existing.select("code", "updated_at"))
        .withColumn("code", plain_text("code"))
        .withColumn("_t", F.col("updated_at").try_cast("timestamp_ntz"))
        .where(F.col("_t").isNotNull())
        .groupBy("code")
        .agg(F.max_by("updated_at", "_t").alias("updated_at"))
    )
    j = s.join(e, "code", "left").join(u, "code", "left").join(stamp, "code", "left")

    def pick(p: str, f: str) -> Column:
        return F.col(f"{p}_{f}") if f"{p}_{f}" in j.columns else F.lit(None).cast("string")

    out: list[Column] = [F.col("code"), F.coalesce(pick("s", "name"), pick("e", "name"), F.lit("")).alias("name")]
    for f in _CLASS_FIELDS:
        v = F.coalesce(pick("s", f), pick("e", f), pick("u", f), F.lit(""))
        out.append((v if f == "industry" else label_text(v)).alias(f))
    for f in _CLASS_FIELDS:
        out.append(
            F.when(pick("s", f).isNotNull(), "snapshot")
            .when(pick("e", f).isNotNull(), "existing_map")
            .when(pick("u", f).isNotNull(), "supply_chain_file")
            .otherwise("empty")
            .alias(f"{f}_source")
        )
    covered = F.coalesce(*[pick(p, f) for f in ("industry", "concepts") for p in ("s", "e", "u")]).isNotNull()
    out += [
        F.when(F.col("e_in"), F.coalesce(pick("e", "source"), F.lit(default_source)))
        .when(F.col("u_in"), "supply_chain_file")
        .otherwise(default_source)
        .alias("source"),
        F.coalesce("updated_at", F.lit("")).alias("updated_at"),
        F.when(covered, "covered").otherwise("missing").alias("coverage_status"),
    ]
    return j.select(*out)


def enrich_classification(snapshot: DataFrame, classification: DataFrame, fields: Sequence[str] = ("industry", "concepts")) -> DataFrame:
    """Blank snapshot fields filled from the classification map."""
    c = classification.select("code", *[blank_to_null(f).alias(f"_c_{f}") for f in fields])
    j = snapshot.join(c, "code", "left")
    return j.withColumns({f: F.coalesce(blank_to_null(f), F.col(f"_c_{f}")) for f in fields}).drop(*[f"_c_{f}" for f in fields])


def insert_only(existing: DataFrame, new: DataFrame, seq: str, keys: Sequence[str] = ("code",)) -> DataFrame:
    """Existing rows stay as they are; of the new rows the first per key fills the gaps."""
    fresh = keep_first(new, keys, seq).drop(seq).join(existing.select(*keys).distinct(), list(keys), "left_anti")
    return existing.unionByName(fresh, allowMissingColumns=True)


def classification_coverage(classification: DataFrame, snapshot: DataFrame) -> DataFrame:
    """One row: whether every snapshot code is classified, with the counts behind it."""
    codes = snapshot.select("code").distinct()
    hit = codes.join(classification.select("code").distinct().withColumn("_h", F.lit(True)), "code", "left")
    agg = hit.agg(F.count(F.lit(1)).alias("snapshot_codes"), F.count("_h").alias("covered"))
    return agg.select("*", F.when(F.col("covered") == F.col("snapshot_codes"), "full").otherwise("partial").alias("coverage_status"))


def supply_chain_merge(existing: DataFrame, new: DataFrame, seq: str) -> DataFrame:
    """Theme edges; the key is the code, so a code keeps its first theme.  Ordered by theme, code."""
    merged = insert_only(existing, new, seq)
    return merged.fillna("").orderBy("theme", "code")


def master_merge(existing: DataFrame, new: DataFrame, seq: str) -> DataFrame:
    """New rows plus the old codes that disappeared."""
    n = keep_first(new.withColumn("code", pad_code("code")), ["code"], seq).drop(seq)
    old = keep_first(existing.withColumn("code", pad_code("code")), ["code"], seq).drop(seq)
    return n.unionByName(old.join(n.select("code"), "code", "left_anti"), allowMissingColumns=True)


def uncovered_codes(snapshot: DataFrame, classification: DataFrame) -> DataFrame:
    return snapshot.select("code").distinct().join(classification.select("code"), "code", "left_anti").orderBy("code")


def industry_backfill(snapshot: DataFrame, runs: DataFrame, min_share: float = 0.5, tries: int = 6) -> DataFrame:
    """Industry from the newest of the last ``tries`` runs with enough coverage, when the snapshot lacks it.

    ``runs``: run_id, code, industry.  The result carries ``industry_origin``.
    """
    filled = F.avg(F.when(blank_to_null("industry").isNotNull(), 1.0).otherwise(0.0))
    own = snapshot.agg(filled.alias("_own"))  # one row
    per_run = runs.groupBy("run_id").agg(filled.alias("_share"))
    recent = per_run.orderBy(F.col("run_id").desc()).limit(tries)
    chosen = recent.where(F.col("_share") >= min_share).agg(F.max("run_id").alias("run_id"))
    mapping = runs.join(chosen, "run_id", "left_semi")
    mapping = mapping.groupBy("code").agg(F.min(blank_to_null("industry")).alias("_map"))
    picked = chosen.select(F.col("run_id").alias("_run"))
    j = attach_row(attach_row(snapshot.join(mapping, "code", "left"), own), picked)
    good = F.col("_own") >= min_share
    return j.select(
        *[c for c in snapshot.columns if c != "industry"],
        F.when(good, F.col("industry")).otherwise(F.coalesce(F.col("_map"), F.col("industry"))).alias("industry"),
        F.when(good, "snapshot").when(F.col("_run").isNull(), "missing").otherwise(F.col("_run").cast("string")).alias("industry_origin"),
    )


def add_indicators(snapshot: DataFrame, indicators: DataFrame, fields: Sequence[str], suffix: str = "_ind") -> DataFrame:
    """Indicators by code; a name that already exists gets the suffix."""
    cols = [F.col(f).alias(f + suffix if f in snapshot.columns else f) for f in fields]
    return snapshot.join(indicators.select("code", *cols), "code", "left")


def three_way_snapshot(daily: DataFrame, basics: DataFrame, stocks: DataFrame) -> DataFrame:
    """Daily quotes with daily and stock basics by vendor code; symbol falls back to the code part; units to yuan."""
    j = daily.join(basics, "ts_code", "left").join(stocks, "ts_code", "left")
    j = j.withColumn("symbol", F.coalesce("symbol", F.split("ts_code", r"\.")[0]))
    return j.withColumns(
        {"amount": num("amount") * 1000, "total_mv": num("total_mv") * 10000, "circ_mv": num("circ_mv") * 10000}
    )


# -- bars and minutes -----------------------------------------------------------


PRICES = ("open", "high", "low", "close")


def _factors(bars: DataFrame, factors: DataFrame) -> DataFrame:
    """Bars with ``_f``, the factor of the date or the next known one, and ``_last``, the latest factor of the code.

    The next known one is the last one seen when going back in time, a running
    frame; a frame up to the end of the code would be computed anew for each row.
    """
    f = factors.select("code", "dt", dbl("factor").alias("_f"))
    latest = f.where(F.col("_f").isNotNull()).groupBy("code").agg(F.max_by("_f", "dt").alias("_last"))
    w = Window.partitionBy("code").orderBy(F.col("dt").desc()).rowsBetween(Window.unboundedPreceding, 0)
    j = bars.join(f, ["code", "dt"], "left").withColumn("_f", F.last("_f", ignorenulls=True).over(w))
    return j.join(latest, "code", "left")


def _adjusted(c: str, mode: str) -> Column:
    raw = dbl(c) * F.col("_f")
    return raw if mode == "hfq" else raw / null0(F.col("_last"))


def adjust_prices(bars: DataFrame, factors: DataFrame, mode: str = "qfq") -> DataFrame:
    """Adjusted prices; ``qfq`` relative to the latest factor, ``hfq`` by the factor alone."""
    return _factors(bars, factors).withColumns({c: _adjusted(c, mode) for c in PRICES}).drop("_f", "_last")


def adjust_prices_both(bars: DataFrame, factors: DataFrame) -> DataFrame:
    """Bars with ``qfq_`` and ``hfq_`` prices beside the raw ones, from one pass."""
    new = {f"{mode}_{c}": _adjusted(c, mode) for mode in ("qfq", "hfq") for c in PRICES}
    return _factors(bars, factors).withColumns(new).drop("_f", "_last")


def upsert_bars(existing: DataFrame, tail: DataFrame, keep: int) -> DataFrame:
    """Existing bars and a fetched tail: the tail wins per date, last ``keep`` bars remain."""
    both = existing.withColumn("_o", F.lit(0)).unionByName(tail.withColumn("_o", F.lit(1)))
    merged = keep_last(both, ["code", "dt"], "_o").drop("_o")
    return latest_per_key(merged, ["code"], [F.col("dt").desc()], keep).drop("_rn")


def upsert_minutes(existing: DataFrame, new: DataFrame, seq: str, keys: Sequence[str] = ("code", "ts")) -> DataFrame:
    """Minute rows appended; the last ingested row per (code, minute) wins."""
    both = existing.withColumn("_o", F.lit(0)).unionByName(new.withColumn("_o", F.lit(1)))
    return latest_per_key(both, list(keys), [F.col("_o").desc(), F.col(seq).desc()]).drop("_rn", "_o")


def pending_codes(codes: DataFrame, done: DataFrame, priority: DataFrame) -> DataFrame:
    """Codes still to do, priority ones first."""
    p = priority.select("code").distinct().withColumn("_p", F.lit(1))
    todo = codes.select("code").distinct().join(done.select("code"), "code", "left_anti").join(p, "code", "left")
    return todo.select("code", F.coalesce("_p", F.lit(0)).alias("priority")).orderBy(F.col("priority").desc(), "code")


def listing_days(df: DataFrame, master: DataFrame, as_of: str) -> DataFrame:
    """Days since listing at an explicit date; unknown when the master has no usable date."""
    m = master.select("code", F.left("listing_date", F.lit(10)).try_cast("date").alias("_ld"))
    j = df.join(m, "code", "left")
    return j.withColumn("listed_days", F.datediff(F.lit(as_of).cast("date"), "_ld")).drop("_ld")


def watchlist_members(df: DataFrame, watch: DataFrame) -> DataFrame:
    """Rows of watched codes only."""
    return df.join(watch.select("code").distinct(), "code", "left_semi")


def watchlist_missing(df: DataFrame, watch: DataFrame) -> DataFrame:
    """Watched codes without a row."""
    return watch.select("code").distinct().join(df.select("code"), "code", "left_anti")


# -- as-of ----------------------------------------------------------------------


def dense_calendar(calendar: DataFrame) -> DataFrame:
    """Every day between the first and a year after the last open day with its latest open day at or before.

    The spine is bounded by the calendar length (one row per day).
    """
    span = calendar.agg(F.min("dt").alias("a"), F.date_add(F.max("dt"), 366).alias("b"))
    spine = span.select(F.explode(F.sequence("a", "b")).alias("day"))
    open_days = calendar.select(F.col("dt").alias("day"), F.col("dt").alias("open_day"))
    w = Window.partitionBy(F.lit(1)).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return spine.join(open_days, "day", "left").select(
        "day",
        F.col("open_day").isNotNull().alias("is_open"),
        F.last("open_day", ignorenulls=True).over(w).alias("last_open"),
    )


def as_of_trading_day(df: DataFrame, ts: str, dense: DataFrame, close_hour: int = 15) -> DataFrame:
    """Latest open day at or before the row's date, and the date its daily bars should be from.

    After the close of an open day that is the day itself, before it the latest
    open day up to yesterday.
    """
    day = F.to_date(ts)
    today = dense.select(F.col("day").alias("_d"), F.col("is_open").alias("_open"), F.col("last_open").alias("_last"))
    before = dense.select(F.date_add("day", 1).alias("_d"), F.col("last_open").alias("_prev"))
    j = df.withColumn("_d", day).join(today, "_d", "left").join(before, "_d", "left")
    settled = F.coalesce("_open", is_weekday("_d")) & (F.hour(ts) >= close_hour)
    return j.select(
        *df.columns,
        F.coalesce("_last", "_d").alias("latest_trading_day"),
        F.when(settled, F.col("_d")).otherwise(F.coalesce("_prev", F.date_sub("_d", 1))).alias("effective_daily_date"),
    )


def last_good_snapshot(candidates: DataFrame, keys: Sequence[str], now: str, max_age_hours: float) -> DataFrame:
    """Per key the first usable live source, else the newest cached one that is young enough.

    ``candidates``: is_live, priority, created_at, rows, complete (required columns present), snapshot_id.
    """
    t = F.lit(now).cast("timestamp_ntz")
    age = F.greatest(
        (F.unix_timestamp(t.cast("timestamp")) - F.unix_timestamp(F.col("created_at").cast("timestamp"))) / 3600.0, F.lit(0.0)
    )
    usable = candidates.where((F.col("rows") > 0) & F.col("complete")).withColumn("_age", age)
    usable = usable.where(F.col("is_live") | (F.col("_age") <= max_age_hours))
    order = [
        F.col("is_live").desc(),
        F.when(F.col("is_live"), F.col("priority")).asc_nulls_last(),
        F.col("created_at").desc(),
        F.col("snapshot_id").desc(),
    ]
    best = latest_per_key(usable, list(keys), order)
    return best.select(
        *keys,
        "snapshot_id",
        (~F.col("is_live")).alias("fallback_used"),
        F.when(~F.col("is_live"), F.round("_age", 4)).alias("stale_age_hours"),
    )


def reusable_snapshot(snapshots: DataFrame, keys: Sequence[str], now: str, fresh_minutes: int) -> DataFrame:
    """Newest snapshot of the same day not older than ``fresh_minutes``."""
    t = F.lit(now).cast("timestamp_ntz")
    newest = snapshots.groupBy(*keys).agg(F.max("created_at").alias("created_at"))
    age = (F.unix_timestamp(t.cast("timestamp")) - F.unix_timestamp(F.col("created_at").cast("timestamp"))) / 60.0
    ok = (F.to_date("created_at") == F.to_date(t)) & age.between(0, fresh_minutes)
    return newest.select(*keys, "created_at", F.coalesce(ok, F.lit(False)).alias("reuse"))


#: Minutes of a bin of the interval join.
BIN_MINUTES = 30
MAX_LOOKBACK = 250
DAILY_FIELDS = {
    "ma": ("ma5", "ma10", "ma20", "ma60", "ma120", "ma250"),
    "rsi": ("rsi14",),
    "macd": ("macd_dif", "macd_dea", "macd_hist"),
    "atr": ("atr14", "atr14_pct"),
}


def _minute_of(hhmm: Column) -> Column:
    return F.left(hhmm, F.lit(2)).cast("int") * 60 + F.right(hhmm, F.lit(2)).cast("int")


def interval_facts(asks: DataFrame, minutes: DataFrame) -> DataFrame:
    """(ask, n, volume, amount) of every interval that holds minutes: their number and the last cumulative values.

    ``asks``: ask, code, date, low, high (minutes of the day, inclusive).
    ``minutes``: code, date, minute, price, volume, amount, unique per minute.
    Minutes are summed up in bins; an interval reads the sums of the bins that it
    covers and single minutes of the bins at its two ends only.
    """
    binned = minutes.withColumn("bin", F.floor(F.col("minute") / BIN_MINUTES))
    sums = binned.groupBy("code", "date", "bin").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("minute").alias("minute"),
        F.max_by("volume", "minute").alias("volume"),
        F.max_by("amount", "minute").alias("amount"),
    )
    bins = F.sequence(F.floor(F.col("low") / BIN_MINUTES), F.floor(F.col("high") / BIN_MINUTES))
    cut = asks.where("low <= high").select("*", F.explode(bins).alias("bin"))
    first = F.col("bin") * BIN_MINUTES
    covered = (first >= F.col("low")) & (first + BIN_MINUTES - 1 <= F.col("high"))
    keys = ["code", "date", "bin"]
    values = ["ask", "n", "minute", "volume", "amount"]
    inner = cut.where(covered).join(sums, keys).select(values)
    ends = cut.where(~covered).join(binned, keys).where(F.col("minute").between(F.col("low"), F.col("high")))
    parts = inner.unionByName(ends.withColumn("n", F.lit(1).cast("bigint")).select(values))
    return parts.groupBy("ask").agg(
        F.sum("n").alias("n"), F.max_by("volume", "minute").alias("volume"), F.max_by("amount", "minute").alias("amount")
    )


def interval_rows(asks: DataFrame, minutes: DataFrame) -> DataFrame:
    """(ask, raw): the minutes of every interval in order, at most a day's."""
    binned = minutes.withColumn("bin", F.floor(F.col("minute") / BIN_MINUTES))
    bins = F.sequence(F.floor(F.col("low") / BIN_MINUTES), F.floor(F.col("high") / BIN_MINUTES))
    hits = asks.where("low <= high").select("*", F.explode(bins).alias("bin")).join(binned, ["code", "date", "bin"])
    hits = hits.where(F.col("minute").between(F.col("low"), F.col("high")))
    item = F.struct("minute", "price", "volume", "amount")
    return hits.groupBy("ask").agg(F.array_sort(F.collect_list(item)).alias("minute_raw"))


def fulfil_requests(
    requests: DataFrame,
    indicators: DataFrame,
    bars: DataFrame,
    minutes: DataFrame,
    today: str | None = None,
    bar_as: Callable[[Column], Column] = lambda r: r,
    minute_as: Callable[[Column], Column] = lambda r: r,
) -> DataFrame:
    """One row per requested code and scope: what its fields ask for, or an error.

    ``requests``: request_id, codes, daily (lookback, fields), minute (date, start,
    end, fields).  ``indicators``: one record per code.  ``bars``: the bars of a code
    before the observation date, ``k`` = 1 the newest.  ``minutes``: code, date,
    minute, price and cumulative volume (in shares) and amount.  With ``today``
    minutes of any other date are refused.  A field that was not asked for is NULL.
    ``bar_as`` and ``minute_as`` say how a bar and a minute are shown; that is worked
    out once per code and per interval.
    """
    want = requests.select("*", F.explode("codes").alias("code")).drop("codes")

    def asked(scope: str, field: str) -> Column:
        return F.coalesce(F.array_contains(F.col(f"{scope}.fields"), field), F.lit(False))

    rec = indicators.select("code", F.lit(True).alias("_hit"), F.col("used_rows").alias("_rows"), *[c for f in DAILY_FIELDS.values() for c in f])
    ask_daily = want.where(F.col("daily").isNotNull())
    # only codes whose bars somebody asks for are gathered, each at most MAX_LOOKBACK of them
    tails = bars.where(F.col("k") <= MAX_LOOKBACK).join(ask_daily.where(asked("daily", "raw")).select("code").distinct(), "code", "left_semi")
    tails = tails.groupBy("code").agg(F.transform(F.array_sort(F.collect_list(F.struct("dt", "open", "high", "low", "close", "volume"))), bar_as).alias("_tail"))
    lookback = F.col("daily.lookback")
    raw = F.slice("_tail", F.greatest(F.size("_tail") - lookback, F.lit(0)) + 1, lookback)
    daily = (
        ask_daily.join(rec, "code", "left")
        .join(tails, "code", "left")
        .select(
            "request_id",
            "code",
            F.lit("daily").alias("scope"),
            F.coalesce("_hit", F.lit(False)).alias("ok"),
            F.coalesce("_rows", F.lit(0)).cast("bigint").alias("rows"),
            *[F.when(asked("daily", field), F.col(c)).alias(c) for field, cols in DAILY_FIELDS.items() for c in cols],
            F.when(asked("daily", "raw"), raw).alias("daily_raw"),
            F.when(F.col("_hit").isNull(), "daily data unavailable").alias("error"),
        )
    )
    ask_minute = want.where(F.col("minute").isNotNull()).select(
        "request_id",
        "code",
        F.col("minute.date").try_cast("date").alias("date"),
        _minute_of(F.col("minute.start")).alias("low"),
        _minute_of(F.col("minute.end")).alias("high"),
        asked("minute", "raw").alias("_raw"),
        asked("minute", "vwap").alias("_vwap"),
    )
    right_day = F.lit(True) if today is None else F.coalesce(F.col("date") == F.lit(today).cast("date"), F.lit(False))
    ask_minute = ask_minute.withColumn("_day", right_day)
    # many requests ask for the same interval: each is answered once
    keys = ["code", "date", "low", "high"]
    spans = ask_minute.where("_day AND date IS NOT NULL AND low <= high").groupBy(*keys).agg(F.max("_raw").alias("_raw"))
    spans = spans.withColumn("ask", F.concat_ws("|", *keys))
    facts = interval_facts(spans.select("ask", *keys), minutes)
    raws = interval_rows(spans.where("_raw").select("ask", *keys), minutes)
    raws = raws.select("ask", F.transform("minute_raw", minute_as).alias("minute_raw"))
    answers = spans.select("ask", *keys).join(facts, "ask").join(raws, "ask", "left").drop("ask")
    minute = (
        ask_minute.join(answers, keys, "left")
        .select(
            "request_id",
            "code",
            F.lit("minute").alias("scope"),
            F.col("n").isNotNull().alias("ok"),
            F.coalesce("n", F.lit(0)).alias("rows"),
            F.when(F.col("_vwap"), dbl("amount") / null0(dbl("volume"))).alias("vwap"),
            F.when(F.col("_raw"), F.col("minute_raw")).alias("minute_raw"),
            F.when(~F.col("_day"), "minute request date does not match current date")
            .when(F.col("n").isNull(), "no minute rows in requested interval")
            .alias("error"),
        )
    )
    return daily.unionByName(minute, allowMissingColumns=True)


def request_audit(fulfilled: DataFrame) -> DataFrame:
    """Requested / success / failed / rows per request and scope."""
    return fulfilled.groupBy("request_id", "scope").agg(
        F.count(F.lit(1)).alias("requested"),
        F.count(F.when(F.col("ok"), 1)).alias("success"),
        F.count(F.when(~F.col("ok"), 1)).alias("failed"),
        F.sum("rows").alias("rows"),
    )


