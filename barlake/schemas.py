"""Fixed table layouts and the field dictionary."""

from __future__ import annotations

from pyspark.sql import types as T

# Snapshot columns in output order with their descriptions.
SNAPSHOT_FIELDS = {
    "code": "six-digit security code",
    "name": "security name",
    "market": "sh, sz or bj",
    "price": "last price",
    "pre_close": "previous close",
    "open": "opening price",
    "high": "day high",
    "low": "day low",
    "change_pct": "change against previous close, percent",
    "volume": "traded shares",
    "amount": "traded value",
    "turnover_rate": "turnover, percent",
    "volume_ratio": "volume against the five-day mean",
    "total_mv": "total market value",
    "circ_mv": "free-float market value",
    "pe_ratio": "price / earnings",
    "pb_ratio": "price / book",
    "quote_time": "time stamp of the quote as delivered",
    "observed_at": "time of collection",
    "source": "origin of the row",
    "industry": "industry name",
    "concepts": "concept labels, comma separated",
    "board": "listing board",
    "is_st": "special-treatment flag",
    "is_suspended": "suspended flag",
    "delist_risk": "delisting-risk flag",
    "listed_days": "days since listing",
}
NUMERIC_FIELDS = (
    "price", "pre_close", "open", "high", "low", "change_pct", "volume", "amount", "turnover_rate",
    "volume_ratio", "total_mv", "circ_mv", "pe_ratio", "pb_ratio",
)
REFERENCE_FIELDS = (
    "pre_close", "open", "high", "low", "change_pct", "volume_ratio", "turnover_rate", "pe_ratio",
    "pb_ratio", "total_mv", "circ_mv", "industry", "concepts",
)

# Layout of a daily-bar document.
DAILY_COLUMNS = ("date", "open", "high", "low", "close", "volume", "amount")
DOCUMENT_KEYS = (
    "schema_version", "code", "fetched_at", "trading_date", "requested_lookback", "actual_rows",
    "latest_date", "source", "source_errors", "volume_unit", "rows",
)
MAX_DOCUMENT_ROWS = 260

BAR_ROW = T.StructType(
    [T.StructField("date", T.StringType())] + [T.StructField(c, T.DoubleType()) for c in DAILY_COLUMNS[1:]]
)
DAILY_DOCUMENT = T.StructType(
    [
        T.StructField("schema_version", T.IntegerType()),
        T.StructField("code", T.StringType()),
        T.StructField("fetched_at", T.StringType()),
        T.StructField("trading_date", T.StringType()),
        T.StructField("requested_lookback", T.IntegerType()),
        T.StructField("actual_rows", T.IntegerType()),
        T.StructField("latest_date", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("source_errors", T.ArrayType(T.StringType())),
        T.StructField("volume_unit", T.StringType()),
        T.StructField("rows", T.ArrayType(BAR_ROW)),
    ]
)

MASTER_FIELDS = ("code", "name", "market", "listing_date", "last_trade_date", "status", "source", "updated_at")
CLASSIFICATION_FIELDS = (
    "code", "name", "industry", "concepts", "supply_chain", "source", "updated_at", "coverage_status",
)
SUPPLY_CHAIN_FIELDS = ("theme", "code", "role", "relation_type", "evidence_source", "updated_at")
WATCHLIST = T.StructType(
    [
        T.StructField("strategy_profile_id", T.StringType()),
        T.StructField("strategy_version", T.StringType()),
        T.StructField("stocks", T.ArrayType(T.StructType([T.StructField("code", T.StringType()), T.StructField("name", T.StringType())]))),
    ]
)
REQUEST = T.StructType(
    [
        T.StructField("schema_version", T.IntegerType()),
        T.StructField("request_id", T.StringType()),
        T.StructField("codes", T.ArrayType(T.StringType())),
        T.StructField(
            "daily",
            T.StructType([T.StructField("lookback", T.IntegerType()), T.StructField("fields", T.ArrayType(T.StringType()))]),
        ),
        T.StructField(
            "minute",
            T.StructType(
                [
                    T.StructField("date", T.StringType()),
                    T.StructField("start", T.StringType()),
                    T.StructField("end", T.StringType()),
                    T.StructField("fields", T.ArrayType(T.StringType())),
                ]
            ),
        ),
    ]
)


def described_schema() -> T.StructType:
    """Snapshot schema whose columns carry their description as comment metadata."""
    fields = []
    for name, text in SNAPSHOT_FIELDS.items():
        if name in NUMERIC_FIELDS:
            kind: T.DataType = T.DoubleType()
        elif name in ("is_st", "is_suspended", "delist_risk"):
            kind = T.BooleanType()
        elif name == "listed_days":
            kind = T.IntegerType()
        else:
            kind = T.StringType()
        fields.append(T.StructField(name, kind, True, {"comment": text}))
    return T.StructType(fields)
