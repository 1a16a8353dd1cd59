"""Projection onto fixed layouts, unit conversion, request and record validation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake import schemas as S
from barlake.functions.numeric import blank_to_null, finite, num
from barlake.functions.ranking import latest_per_key
from barlake.functions.text import (
    CODE_PATTERN,
    SECOND_MARKET_PATTERN,
    list_text,
    market_of,
    market_order,
    pad_code,
    plain_text,
)

# The column names of each vendor, by the vendor's public name; the first existing alias wins.
PROVIDER_ALIASES: dict[str, dict[str, tuple[str, ...]]] = {
    "efinance": {
        "code": ("股票代码", "代码"),
        "name": ("股票名称", "名称"),
        "price": ("最新价",),
        "change_pct": ("涨跌幅",),
        "amount": ("成交额",),
        "total_mv": ("总市值",),
        "circ_mv": ("流通市值",),
        "pe_ratio": ("动态市盈率", "市盈率(动)"),
        "pb_ratio": ("市净率",),
        "volume_ratio": ("量比",),
        "turnover_rate": ("换手率",),
        "industry": ("行业", "所属行业", "行业板块"),
        "concepts": ("概念", "概念题材", "题材"),
    },
    "akshare_em": {
        "code": ("代码",),
        "name": ("名称",),
        "price": ("最新价",),
        "change_pct": ("涨跌幅",),
        "amount": ("成交额",),
        "total_mv": ("总市值",),
        "circ_mv": ("流通市值",),
        "pe_ratio": ("市盈率-动态", "市盈率(动)"),
        "pb_ratio": ("市净率",),
        "volume_ratio": ("量比",),
        "turnover_rate": ("换手率",),
        "industry": ("行业", "所属行业", "行业板块"),
        "concepts": ("概念", "概念题材", "题材"),
    },
    "sina": {
        "code": ("code",),
        "name": ("name",),
        "price": ("trade",),
        "pre_close": ("settlement",),
        "open": ("open",),
        "high": ("high",),
        "low": ("low",),
        "change_pct": ("changepercent",),
        "amount": ("amount",),
        "total_mv": ("mktcap",),
        "circ_mv": ("nmc",),
        "pe_ratio": ("per",),
        "pb_ratio": ("pb",),
        "turnover_rate": ("turnoverratio",),
    },
    "em_datacenter": {
        "code": ("SECURITY_CODE",),
        "name": ("SECURITY_NAME_ABBR",),
        "price": ("NEW_PRICE",),
        "pre_close": ("PRE_CLOSE_PRICE",),
        "open": ("OPEN_PRICE",),
        "high": ("HIGH_PRICE",),
        "low": ("LOW_PRICE",),
        "change_pct": ("CHANGE_RATE",),
        "amount": ("DEAL_AMOUNT",),
        "total_mv": ("TOTAL_MARKET_CAP",),
        "circ_mv": ("CIRCULATION_MARKET_CAP",),
        "pe_ratio": ("PE9",),
        "pb_ratio": ("PBNEWMRQ",),
        "volume_ratio": ("VOLUME_RATIO",),
        "turnover_rate": ("TURNOVERRATE",),
        "industry": ("INDUSTRY", "INDUSTRY_NAME", "BOARD_NAME"),
        "concepts": ("CONCEPT", "CONCEPT_NAME", "THEME_NAME"),
    },
    "tushare": {
        "code": ("symbol", "code"),
        "name": ("name",),
        "price": ("close",),
        "change_pct": ("pct_chg",),
        "amount": ("amount",),
        "total_mv": ("total_mv",),
        "circ_mv": ("circ_mv",),
        "pe_ratio": ("pe",),
        "pb_ratio": ("pb",),
        "volume_ratio": ("volume_ratio",),
        "turnover_rate": ("turnover_rate",),
        "industry": ("industry",),
        "concepts": ("concepts",),
    },
}
PROVIDER_NUMERIC = tuple(c for c in S.NUMERIC_FIELDS if c != "volume")
BAR_ALIASES: dict[str, tuple[str, ...]] = {
    "date": ("date", "日期", "交易日期", "trade_date", "day"),
    "open": ("open", "开盘"),
    "high": ("high", "最高"),
    "low": ("low", "最低"),
    "close": ("close", "收盘"),
    "volume": ("volume", "vol", "成交量"),
    "amount": ("amount", "成交额"),
}
# Request and record vocabulary.
DAILY_REQUEST_FIELDS = ("raw", "ma", "rsi", "macd", "atr")
MINUTE_REQUEST_FIELDS = ("raw", "vwap")
REQUEST_KEYS = ("schema_version", "request_id", "codes", "daily", "minute")
VERSION_FIELDS = (
    "strategy_profile_id", "strategy_version", "lifecycle_contract_version", "schema_version",
    "execution_rule_version", "skill_version",
)
RECORD_FIELDS = (
    "decision_id", *VERSION_FIELDS, "code", "timestamp", "action", "state_before", "state_after", "reason_code",
)


def provider_schema(df: DataFrame, provider: str, extra: Sequence[str] = ()) -> DataFrame:
    """Provider columns renamed to the standard ones and coerced; rows with missing or zero price stay."""
    picked: list[Column] = []
    for standard, names in PROVIDER_ALIASES[provider].items():
        hit = next((n for n in names if n in df.columns), None)
        if hit is None:
            continue
        value = F.col(f"`{hit}`")
        picked.append((num(value) if standard in PROVIDER_NUMERIC else value).alias(standard))
    return df.select(*picked, *extra)


def bar_schema(df: DataFrame, lookback: int, seq: str, key: str = "code") -> DataFrame:
    """Bar columns under any alias to the seven standard ones: typed, deduplicated, last ``lookback``.

    ``seq`` is the ingest order that decides which of two rows for a date wins.
    """
    picked = {t: next((n for n in names if n in df.columns), None) for t, names in BAR_ALIASES.items()}
    if picked["date"] is None or picked["close"] is None:
        raise ValueError("bar history lacks date or close")
    rows = df.select(
        key,
        F.col(seq).alias("_seq"),
        F.col(f"`{picked['date']}`").try_cast("date").alias("dt"),
        *[
            (num(F.col(f"`{picked[c]}`")) if picked[c] else F.lit(None).cast("double")).alias(c)
            for c in S.DAILY_COLUMNS[1:]
        ],
    ).where(F.col("dt").isNotNull() & F.col("close").isNotNull())
    best = latest_per_key(rows, [key, "dt"], [F.col("_seq").desc()]).drop("_rn", "_seq")
    return latest_per_key(best, [key], [F.col("dt").desc()], lookback).drop("_rn")


def snapshot_output(
    df: DataFrame,
    observed_at: str,
    primary: DataFrame,
    reference: DataFrame,
    primary_source: str,
    reference_source: str,
    seq: str,
) -> DataFrame:
    """Rows in the fixed snapshot layout, ordered by market then code.

    Six-digit mapped codes only, last row per code, numbers coerced, quote time
    from ``quote_time`` or ``ticktime``, source attributed from the row, the
    primary feed or the reference feed.
    """
    have = set(df.columns)

    def text(name: str) -> Column:
        if name not in have:
            return F.lit("")
        if dict(df.dtypes)[name].startswith("array"):
            return F.coalesce(list_text(name), F.lit(""))
        return F.coalesce(F.trim(F.col(name).cast("string")), F.lit(""))

    rows = df.withColumn("code", pad_code("code")).where(F.col("code").rlike(CODE_PATTERN))
    rows = rows.withColumn("market", market_of("code")).where(F.col("market").isNotNull())
    rows = latest_per_key(rows, ["code"], [F.col(seq).desc()]).drop("_rn")
    prim = primary.select(pad_code("code").alias("code")).distinct().withColumn("_p", F.lit(True))
    ref = latest_per_key(reference.withColumn("code", pad_code("code")), ["code"], [F.col(seq).desc()]).select(
        "code", blank_to_null("source").alias("_rs")
    )
    rows = rows.join(prim, "code", "left").join(ref, "code", "left")
    own = F.when(text("source") != "", text("source"))
    quote = text("quote_time") if "quote_time" in have else text("ticktime")
    special = {
        "code": F.col("code"),
        "market": F.col("market"),
        "quote_time": quote,
        "observed_at": F.lit(observed_at),
        "source": F.coalesce(
            own, F.when(F.col("_p"), F.lit(primary_source)), F.col("_rs"), F.lit(reference_source)
        ),
    }
    out = []
    for c in S.SNAPSHOT_FIELDS:
        if c in special:
            out.append(special[c].alias(c))
        elif c in S.NUMERIC_FIELDS:
            out.append((num(c) if c in have else F.lit(None).cast("double")).alias(c))
        elif c in ("name", "industry", "concepts"):
            out.append(text(c).alias(c))
        else:
            out.append((F.col(c) if c in have else F.lit(None).cast("string")).alias(c))
    return rows.select(*out).orderBy(market_order("market"), "code")


def segment_universe(df: DataFrame, pattern: str = SECOND_MARKET_PATTERN) -> DataFrame:
    """Sorted distinct codes of one market segment."""
    codes = df.select(pad_code("code").alias("code")).where(F.col("code").rlike(pattern))
    return codes.distinct().orderBy("code")


def universe_check(df: DataFrame) -> DataFrame:
    """One row: whether every code is six digits and unique."""
    bad = F.count(F.when(~F.coalesce(F.col("code").rlike(CODE_PATTERN), F.lit(False)), 1))
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("code").alias("distinct_codes"), bad.alias("invalid")
    ).select("*", ((F.col("rows") == F.col("distinct_codes")) & (F.col("invalid") == 0)).alias("valid"))


# Unit multipliers by source unit.
UNIT_FACTORS = {"shares": 1, "lots": 100, "yuan": 1, "thousand_yuan": 1_000, "ten_thousand_yuan": 10_000}


def convert_units(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Multiply each column by the factor of its unit; a unit may be a column name or a fixed unit."""

    def factor(unit: str) -> Column:
        if unit in UNIT_FACTORS:
            return F.lit(UNIT_FACTORS[unit])
        cases = F.lit(1)
        for name, f in UNIT_FACTORS.items():
            cases = F.when(F.col(unit) == name, f).otherwise(cases)
        return cases

    return df.withColumns({c: num(c) * factor(u) for c, u in columns.items()})


def strict_numbers(df: DataFrame) -> DataFrame:
    """NaN and infinities of every floating column to NULL."""
    floats = [c for c, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: finite(c) for c in floats})


# -- requests ------------------------------------------------------------------


def _unknown(keys: Column, allowed: Sequence[str]) -> Column:
    return F.size(F.array_except(keys, F.array(*[F.lit(a) for a in allowed]))) > 0


def validate_requests(raw: DataFrame, today: str) -> DataFrame:
    """Request documents (text) with the array of violated rules; empty array = accepted."""
    scopes = {k: F.get_json_object("text", f"$.{k}") for k in ("daily", "minute")}
    parsed = raw.select(
        "*",
        F.from_json("text", S.REQUEST).alias("req"),
        F.json_object_keys("text").alias("_keys"),
        *[F.json_object_keys(v).alias(f"_{k}_keys") for k, v in scopes.items()],
    )
    codes = F.col("req.codes")
    has_daily = F.array_contains("_keys", "daily")
    has_minute = F.array_contains("_keys", "minute")
    lookback = F.col("req.daily.lookback")
    start, end = F.col("req.minute.start"), F.col("req.minute.end")
    hhmm = r"^([01][0-9]|2[0-3]):[0-5][0-9]$"

    def bad_fields(c: str, allowed: Sequence[str]) -> Column:
        f = F.col(c)
        return f.isNull() | (F.size(f) == 0) | F.exists(f, lambda x: F.coalesce(~x.isin(*allowed), F.lit(True)))

    def false_if_null(c: Column) -> Column:
        return F.coalesce(c, F.lit(True))

    rules = [
        ("unreadable", F.col("_keys").isNull()),
        ("unknown_key", _unknown(F.col("_keys"), REQUEST_KEYS)),
        ("schema_version", false_if_null(F.col("req.schema_version") != 1)),
        ("request_id", false_if_null(F.trim("req.request_id") == "")),
        ("codes_empty", false_if_null(F.size(codes) <= 0) | codes.isNull()),
        ("code_format", F.exists(codes, lambda c: F.coalesce(~c.rlike(CODE_PATTERN), F.lit(True)))),
        ("code_duplicate", F.size(F.array_distinct(codes)) != F.size(codes)),
        ("no_scope", ~(has_daily | has_minute)),
        ("daily_unknown_key", has_daily & _unknown(F.col("_daily_keys"), ("lookback", "fields"))),
        ("daily_lookback", has_daily & false_if_null(~lookback.between(1, 250))),
        ("daily_fields", has_daily & bad_fields("req.daily.fields", DAILY_REQUEST_FIELDS)),
        ("minute_unknown_key", has_minute & _unknown(F.col("_minute_keys"), ("date", "start", "end", "fields"))),
        ("minute_date", has_minute & false_if_null(F.col("req.minute.date") != today)),
        ("minute_time", has_minute & false_if_null(~(start.rlike(hhmm) & end.rlike(hhmm)))),
        ("minute_order", has_minute & (start > end)),
        ("minute_fields", has_minute & bad_fields("req.minute.fields", MINUTE_REQUEST_FIELDS)),
    ]
    broken = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules]))
    return parsed.withColumn("errors", broken).drop("_keys", "_daily_keys", "_minute_keys")


# -- decision records ----------------------------------------------------------


def validate_records(df: DataFrame, legacy_words: Sequence[str] = ("legacy",)) -> DataFrame:
    """Missing record and version fields, the legacy test and the migration status per record."""
    have = set(df.columns)

    def empty(c: str) -> Column:
        if c not in have:
            return F.lit(True)
        return F.coalesce(F.col(c).cast("string") == "", F.lit(True))

    def names(fields: Sequence[str], test) -> Column:
        return F.array_compact(F.array(*[F.when(test(c), F.lit(c)) for c in fields]))

    def old(c: str) -> Column:
        return empty(c) | (F.col(c).isin(*legacy_words) if c in have else F.lit(True))

    missing_versions = names(VERSION_FIELDS, empty)
    errors = names(RECORD_FIELDS, empty)
    prefix = {c: ("missing_field:" if c not in have else "empty_field:") for c in RECORD_FIELDS}
    errors = F.array_compact(F.array(*[F.when(empty(c), F.lit(prefix[c] + c)) for c in RECORD_FIELDS]))
    return df.select(
        "*",
        errors.alias("schema_errors"),
        missing_versions.alias("missing_versions"),
        names(VERSION_FIELDS, old).alias("unversioned"),
        (old("schema_version") | old("strategy_version") | (F.size(missing_versions) >= 2)).alias("is_legacy"),
        F.when(F.size(missing_versions) > 0, "legacy_compatible").otherwise("fully_compatible").alias("migration_status"),
        F.transform(missing_versions, lambda x: F.concat(F.lit("missing_"), x)).alias("reason_codes"),
        names(("code", "decision_id"), empty).alias("legacy_warnings"),
    )


__all__ = [
    "bar_schema", "convert_units", "plain_text", "provider_schema", "segment_universe", "snapshot_output",
    "strict_numbers", "universe_check", "validate_records", "validate_requests",
]
