"""Raw provider payloads (already stored as text tables) to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.functions.numeric import finite, num
from barlake.functions.ranking import latest_per_key
from barlake.functions.text import market_of, pad_code

# Payload patterns and field positions of the two quote formats.
TILDE_QUOTE = r'v_bj(\d{6,})="([^"]*)";'
COMMA_QUOTE = r'var hq_str_bj(\d{6,})="([^"]*)"'
TILDE_FIELDS = {
    "price": 3, "pre_close": 4, "open": 5, "change_pct": 32, "high": 33, "low": 34, "turnover_rate": 38,
    "pe_ratio": 44, "total_mv": 45, "pb_ratio": 46, "circ_mv": 47,
}
LOT = 100
TEN_THOUSAND = 10_000.0
INDUSTRY_LABEL = r"所属行业[：:]\s*</td>\s*<td[^>]*>\s*(?:<a[^>]*>)?([^<]+)"


def _field(parts: Column, i: int) -> Column:
    return F.get(parts, F.lit(i))


def _number(parts: Column, i: int) -> Column:
    return F.coalesce(num(_field(parts, i)), F.lit(0.0))


def quote_time(parts: Column) -> Column:
    raw = F.trim(F.coalesce(_field(parts, 30), F.lit("")))
    iso = F.regexp_replace(raw, r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})$", "$1-$2-$3T$4:$5:$6")
    return iso


def quote_amount(parts: Column) -> Column:
    """Third part of the slash field when usable, else field 37 in ten-thousands."""
    slash = F.split(F.coalesce(_field(parts, 35), F.lit("")), "/")
    third = num(F.get(slash, F.lit(2)))
    return F.coalesce(third, _number(parts, 37) * TEN_THOUSAND)


def _entries(raw: DataFrame, pattern: str) -> DataFrame:
    codes = F.regexp_extract_all("text", F.lit(pattern), F.lit(1))
    bodies = F.regexp_extract_all("text", F.lit(pattern), F.lit(2))
    return raw.select(
        "seq", F.posexplode(F.arrays_zip(codes.alias("code"), bodies.alias("body"))).alias("pos", "e")
    ).select("seq", "pos", "e.code", "e.body")


def _last_per_code(rows: DataFrame) -> DataFrame:
    return latest_per_key(rows, ["code"], [F.col("seq").desc(), F.col("pos").desc()]).drop("_rn", "seq", "pos")


def parse_tilde_quotes(raw: DataFrame, source: str = "tilde_feed") -> DataFrame:
    """``v_bjNNNNNN="a~b~..."`` payloads (seq, text): price > 0 only, last quote per code; ``source`` labels the rows."""
    p = F.col("p")
    rows = _entries(raw, TILDE_QUOTE).withColumn("p", F.split("body", "~"))
    rows = rows.where(_number(p, 3) > 0)
    return _last_per_code(rows).select(
        "code",
        F.trim(F.coalesce(_field(p, 1), F.lit(""))).alias("name"),
        *[_number(p, i).alias(n) for n, i in TILDE_FIELDS.items()],
        (_number(p, 36) * LOT).alias("volume"),
        quote_amount(p).alias("amount"),
        quote_time(p).alias("quote_time"),
        F.lit(source).alias("source"),
        F.lit("bj").alias("market"),
    )


def parse_comma_quotes(raw: DataFrame, source: str = "comma_feed") -> DataFrame:
    """``var hq_str_bjNNNNNN="a,b,..."`` payloads (seq, text); ``source`` labels the rows."""
    p = F.col("p")
    rows = _entries(raw, COMMA_QUOTE).withColumn("p", F.split("body", ","))
    rows = rows.where((F.size("p") >= 3) & (_number(p, 3) > 0))
    return _last_per_code(rows).select(
        "code",
        F.trim(_field(p, 0)).alias("name"),
        _number(p, 3).alias("price"),
        _number(p, 4).alias("change_pct"),
        (_number(p, 8) * LOT).alias("volume"),
        _number(p, 9).alias("amount"),
        _number(p, 10).alias("turnover_rate"),
        F.lit(source).alias("source"),
        F.lit("bj").alias("market"),
    )


def parse_minute_lines(raw: DataFrame, keys: list[str]) -> DataFrame:
    """``HHMM price volume amount`` lines (keys, line_no, line) to typed rows.

    Wrong arity, impossible times, non-finite or negative values are dropped;
    the last line of a minute wins.
    """
    parts = F.split(F.trim("line"), r"\s+")
    hh = F.get(parts, F.lit(0))
    rows = raw.select(
        *keys,
        "line_no",
        F.size(parts).alias("_n"),
        hh.alias("_t"),
        *[num(F.get(parts, F.lit(i))).alias(c) for i, c in ((1, "price"), (2, "volume"), (3, "amount"))],
    )
    valid = (
        (F.col("_n") == 4)
        & F.col("_t").rlike(r"^([01]\d|2[0-3])[0-5]\d$")
        & F.col("price").isNotNull()
        & (F.col("volume") >= 0)
        & (F.col("amount") >= 0)
    )
    time = F.concat(F.substring("_t", 1, 2), F.lit(":"), F.substring("_t", 3, 2))
    return (
        rows.where(valid)
        .groupBy(*keys, time.alias("time"))
        .agg(*[F.max_by(c, "line_no").alias(c) for c in ("price", "volume", "amount")])
    )


def extract_label(pages: DataFrame, html: str = "html", pattern: str = INDUSTRY_LABEL, out: str = "label") -> DataFrame:
    """First capture group of ``pattern`` in each page; pages without a non-blank label are dropped."""
    text = F.trim(F.regexp_extract(html, pattern, 1))
    return pages.withColumn(out, text).where(F.col(out) != "")


def parse_master_rows(raw: DataFrame, today: str) -> DataFrame:
    """Provider master rows to the security master; the last row per code wins."""
    code = F.lpad(F.coalesce(F.col("security_code"), F.lit("")), 6, "0")
    code = F.when(F.length(F.col("security_code")) >= 6, F.col("security_code")).otherwise(code)
    full = F.col("secucode")
    market = (
        F.when(full.endswith(".SZ"), "sz")
        .when(full.endswith(".SH"), "sh")
        .when(full.endswith(".BJ"), "bj")
        .otherwise(F.coalesce(market_of(code), F.lit("")))
    )
    last = F.col("max_trade_date").try_cast("date")
    status = (
        F.when(last >= F.lit(today).cast("date"), "active").when(last.isNotNull(), "suspended").otherwise("unknown")
    )
    rows = raw.select(
        "seq",
        code.alias("code"),
        F.coalesce("name", F.lit("")).alias("name"),
        market.alias("market"),
        F.coalesce("listing_date", F.lit("")).alias("listing_date"),
        F.coalesce("max_trade_date", F.lit("")).alias("last_trade_date"),
        status.alias("status"),
    )
    return latest_per_key(rows, ["code"], [F.col("seq").desc()]).drop("_rn", "seq")


def parse_kline_arrays(raw: DataFrame, keep: int, min_keep: int = 30, lots: bool = True) -> DataFrame:
    """JSON arrays ``[[date, open, close, high, low, volume, amount?], ...]`` per code to bars.

    Rows with fewer than six items are dropped; volume in lots becomes shares;
    the last max(keep, 30) rows in document order remain.
    """
    n = max(keep, min_keep)
    rows = F.filter(F.from_json("text", "array<array<string>>"), lambda r: F.size(r) >= 6)
    tail = F.slice(rows, F.greatest(F.size(rows) - n + 1, F.lit(1)), F.lit(n))
    r = F.col("r")
    volume = F.coalesce(num(F.get(r, F.lit(5))), F.lit(0.0)) * (LOT if lots else 1)
    return raw.select("code", F.explode(tail).alias("r")).select(
        "code",
        F.get(r, F.lit(0)).try_cast("date").alias("dt"),
        num(F.get(r, F.lit(1))).alias("open"),
        num(F.get(r, F.lit(3))).alias("high"),
        num(F.get(r, F.lit(4))).alias("low"),
        num(F.get(r, F.lit(2))).alias("close"),
        volume.alias("volume"),
        num(F.get(r, F.lit(6))).alias("amount"),
    )


def parse_kline_objects(raw: DataFrame, keep: int, min_keep: int = 30) -> DataFrame:
    """JSON arrays of objects with ``day`` or ``date``: sorted by date, last max(keep, 30)."""
    n = max(keep, min_keep)
    row = "array<struct<day:string,date:string,open:string,high:string,low:string,close:string,volume:string,amount:string>>"
    rows = F.transform(
        F.from_json("text", row),
        lambda x: F.struct(
            F.coalesce(x["day"], x["date"]).alias("d"),
            *[x[c].alias(c) for c in ("open", "high", "low", "close", "volume", "amount")],
        ),
    )
    rows = F.array_sort(rows)
    tail = F.slice(rows, F.greatest(F.size(rows) - n + 1, F.lit(1)), F.lit(n))
    return raw.select("code", F.explode(tail).alias("r")).select(
        "code",
        F.col("r.d").try_cast("date").alias("dt"),
        *[num(F.col(f"r.{c}")).alias(c) for c in ("open", "high", "low", "close", "volume", "amount")],
    )


__all__ = [
    "extract_label", "finite", "pad_code", "parse_comma_quotes", "parse_kline_arrays", "parse_kline_objects",
    "parse_master_rows", "parse_minute_lines", "parse_tilde_quotes",
]
