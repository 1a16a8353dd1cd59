"""JSON documents: daily bars, snapshots, watchlists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake import schemas as S
from barlake.functions.numeric import dbl
from barlake.functions.ranking import latest_per_key
from barlake.functions.text import CODE_PATTERN, SECOND_MARKET_PATTERN


def render_daily_documents(
    bars: DataFrame, trading_date: str, fetched_at: str, source: str, lookback: int = S.MAX_DOCUMENT_ROWS
) -> DataFrame:
    """(code, text): one JSON document per code holding its last ``lookback`` bars."""
    tail = latest_per_key(bars, ["code"], [F.col("dt").desc()], lookback)
    row = F.struct(F.col("dt").cast("string").alias("date"), *[dbl(c).alias(c) for c in S.DAILY_COLUMNS[1:]])
    docs = tail.groupBy("code").agg(F.sort_array(F.collect_list(row)).alias("rows"))  # at most `lookback`
    return docs.select(
        "code",
        F.to_json(
            F.struct(
                F.lit(1).alias("schema_version"),
                F.col("code"),
                F.lit(fetched_at).alias("fetched_at"),
                F.lit(trading_date).alias("trading_date"),
                F.lit(lookback).alias("requested_lookback"),
                F.size("rows").alias("actual_rows"),
                F.element_at("rows", -1)["date"].alias("latest_date"),
                F.lit(source).alias("source"),
                F.array().cast("array<string>").alias("source_errors"),
                F.lit("shares").alias("volume_unit"),
                F.col("rows"),
            )
        ).alias("text"),
    )


def _ordered_unique(dates: Column) -> Column:
    """Dates parse and strictly increase."""
    parsed = F.transform(dates, lambda d: d.try_cast("date"))
    pairs = F.zip_with(
        F.slice(parsed, 1, F.greatest(F.size(parsed) - 1, F.lit(0))),
        F.slice(parsed, 2, F.greatest(F.size(parsed) - 1, F.lit(0))),
        lambda a, b: a < b,
    )
    return F.forall(parsed, lambda d: d.isNotNull()) & F.forall(pairs, lambda x: F.coalesce(x, F.lit(False)))


def parse_daily_documents(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Parse ``text`` and give ``doc`` plus the first broken rule in ``problem`` (NULL = valid).

    Strict mode also checks the metadata; the lenient mode is the one used when
    deciding whether an older document can be extended.
    """
    keys = F.json_object_keys("text")
    row_maps = F.from_json("text", "rows array<map<string,string>>")["rows"]
    parsed = raw.select(
        "*",
        F.from_json("text", S.DAILY_DOCUMENT, {"mode": "PERMISSIVE"}).alias("doc"),
        keys.alias("_keys"),
        row_maps.alias("_maps"),
    )
    rows = F.col("doc.rows")
    n = F.size(rows)
    wanted_row = F.array(*[F.lit(c) for c in sorted(S.DAILY_COLUMNS)])
    shape = F.forall("_maps", lambda m: F.sort_array(F.map_keys(m)) == wanted_row)
    dates = F.transform(rows, lambda r: r["date"])
    problem = F.when(F.col("_keys").isNull(), "unreadable")
    if strict:
        problem = problem.when(
            F.array_sort("_keys") != F.array(*[F.lit(k) for k in sorted(S.DOCUMENT_KEYS)]), "schema"
        )
    problem = (
        problem.when(~F.coalesce(F.col("doc.schema_version") == 1, F.lit(False)), "schema")
        .when(rows.isNull() | (n < 1) | (n > S.MAX_DOCUMENT_ROWS), "row_count")
        .when(~F.coalesce(shape, F.lit(False)), "row_shape")
        .when(~F.coalesce(_ordered_unique(dates), F.lit(False)), "dates")
    )
    if strict:
        meta = (
            F.col("doc.code").rlike(CODE_PATTERN)
            & F.col("doc.fetched_at").rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}.*([+-]\d{2}:\d{2}|Z)$")
            & F.col("doc.trading_date").isNotNull()
            & F.col("doc.requested_lookback").between(1, S.MAX_DOCUMENT_ROWS)
            & (F.col("doc.actual_rows") == n)
            & (F.col("doc.latest_date") == F.element_at(dates, -1))
            & (F.trim("doc.source") != "")
            & F.col("doc.source_errors").isNotNull()
        )
        problem = problem.when(F.exists(rows, lambda r: r["close"].isNull()), "rows").when(
            ~F.coalesce(meta, F.lit(False)), "metadata"
        )
    return parsed.withColumn("problem", problem).drop("_keys", "_maps")


def document_rows(parsed: DataFrame, *keep: str) -> DataFrame:
    """Columns of the documents with a row ``r`` for each bar of a valid one, and one without ``r`` for every other.

    No filter on ``problem``: Spark would move it below the parser and parse a text once for each rule.
    """
    return parsed.select(*keep, F.explode_outer(F.when(F.col("problem").isNull(), F.col("doc.rows"))).alias("r"))


def daily_rows(parsed: DataFrame) -> DataFrame:
    """Bars of the valid documents."""
    named = parsed.select("problem", "doc", F.col("doc.code").alias("code"), F.col("doc.source").alias("source"))
    return (
        document_rows(named, "code", "source")
        .where(F.col("r").isNotNull())
        .select("code", F.col("r.date").cast("date").alias("dt"), *[F.col(f"r.{c}") for c in S.DAILY_COLUMNS[1:]], "source")
    )


def read_daily_documents(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """A folder of one-document-per-file JSON; ``text`` is the raw document."""
    raw = spark.read.text(path, wholetext=True).select(F.col("value").alias("text"))
    return parse_daily_documents(raw, strict)


def snapshot_rows(raw: DataFrame, row_type: str, pattern: str | None = None) -> DataFrame:
    """Rows of snapshot documents (``{"rows": [...]}``); unreadable documents give no rows."""
    doc = F.from_json("text", f"rows array<{row_type}>")
    rows = raw.select(F.explode(doc["rows"]).alias("r")).select("r.*")
    return rows if pattern is None else rows.where(F.trim("code").rlike(pattern))


def second_market_rows(raw: DataFrame, row_type: str) -> DataFrame:
    return snapshot_rows(raw, row_type, SECOND_MARKET_PATTERN)


def watchlist_rows(raw: DataFrame) -> DataFrame:
    """(strategy_profile_id, strategy_version, code, name) from watchlist documents."""
    doc = F.from_json("text", S.WATCHLIST)
    return raw.select(doc.alias("d")).select(
        "d.strategy_profile_id", "d.strategy_version", F.inline("d.stocks")
    )
