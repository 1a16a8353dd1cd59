"""CSV, Parquet and run tables: readers, writers, manifests, latest pointers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.schemas import SNAPSHOT_FIELDS


def read_strings_csv(spark: SparkSession, path: str, columns: Sequence[str], required: Sequence[str] = ()) -> DataFrame:
    """CSV with every column as text, ``#`` comment lines and an optional BOM.

    ``columns`` is the file's header order; a missing required column fails
    before any data is read.
    """
    missing = sorted(set(required) - set(columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.csv(path, schema=schema, header=True, comment="#", encoding="UTF-8", enforceSchema=True)


def parse_csv_lines(lines: DataFrame, columns: Sequence[str], line: str = "line") -> DataFrame:
    """CSV text lines to string columns; comment, blank and header lines are skipped."""
    text = F.regexp_replace(F.col(line), "^﻿", "")
    schema = ", ".join(f"`{c}` string" for c in columns)
    body = lines.withColumn("_l", text).where((F.trim("_l") != "") & ~F.col("_l").startswith("#"))
    body = body.where(F.col("_l") != ",".join(columns))
    return body.select(F.from_csv("_l", schema).alias("r")).select("r.*")


def missing_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Required columns that are absent or entirely NULL, one pass over the table."""
    have = [c for c in required if c in df.columns]
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in have]) if have else df.agg(F.count(F.lit(1)).alias("_"))
    state = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                (F.when(F.col(c) == 0, "all_null") if c in have else F.lit("absent")).alias("problem"),
            )
            for c in required
        ]
    )
    return counts.select(F.explode(state).alias("s")).select("s.*").where(F.col("problem").isNotNull())


def load_minutes(minutes: DataFrame, trade_date: str, codes: DataFrame | None = None) -> DataFrame:
    """Minutes of one date (a partition filter on a date-partitioned table) and of the wanted codes."""
    day = minutes.where(F.col("trade_date") == F.lit(trade_date).cast("date"))
    return day if codes is None else day.join(codes.select("code").distinct(), "code", "left_semi")


def trading_calendar(lines: DataFrame, column: str = "trade_date") -> DataFrame:
    """Distinct ISO dates with the previous open day and a running number.

    The calendar has one row per trading day, so the single ordered window is
    bounded by a few tens of thousands of rows.
    """
    text = F.col(column)
    days = (
        lines.where(F.length(text) == 10)
        .select(text.try_cast("date").alias("dt"))
        .where(F.col("dt").isNotNull())
        .distinct()
    )
    w = Window.partitionBy(F.lit(1)).orderBy("dt")
    return days.select("dt", F.lag("dt").over(w).alias("prev_open"), F.row_number().over(w).alias("seq"))


def universe(master: DataFrame, include_suspended: bool = True) -> DataFrame:
    """Sorted distinct codes, optionally active ones only."""
    rows = master if include_suspended else master.where(F.col("status") == "active")
    return rows.where(F.col("code").isNotNull()).select("code").distinct().orderBy("code")


# -- sinks ---------------------------------------------------------------------


def write_run(df: DataFrame, path: str, partitions: Sequence[str] = ("trade_date", "run_id"), fmt: str = "parquet") -> None:
    """Idempotent write: only the partitions present in ``df`` are replaced."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def manifest(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """SHA-256 and size per file below ``path`` next to the row count of its artifact.

    ``rows`` has (artifact, rows); the artifact is the first folder below ``path``.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length", F.sha2("content", 256).alias("sha256"))
    )
    name = F.regexp_extract("path", r".*" + path.rstrip("/").split("/")[-1] + r"/([^/]+)/.*", 1)
    return files.withColumn("artifact", name).join(rows, "artifact", "left")


def latest_run(runs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Newest run per key; an older run never replaces a newer one, ties go to the larger run id."""
    return runs.groupBy(*keys).agg(
        F.max_by("run_id", F.struct("generated_at", "run_id")).alias("run_id"),
        F.max("generated_at").alias("generated_at"),
    )


def latest_pointers(runs: DataFrame) -> DataFrame:
    """Pointers per grade: ``any`` from every run, ``static`` from static or full runs, ``full`` from full runs."""
    grade = F.col("quality_status")
    targets = F.array_compact(
        F.array(
            F.lit("any"),
            F.when(grade.isin("data_ready", "data_ready_static_only"), "static"),
            F.when(grade == "data_ready", "full"),
        )
    )
    return latest_run(runs.withColumn("pointer", F.explode(targets)), ["pointer"])


def latest_run_with_snapshot(runs: DataFrame) -> DataFrame:
    """Newest (date, run_id) that has a snapshot."""
    return runs.where(F.col("has_snapshot")).agg(F.max(F.struct("run_date", "run_id")).alias("r")).select("r.*")


def field_dictionary(df: DataFrame) -> DataFrame:
    """Description and number of present values for every documented column of a snapshot."""
    from barlake.functions.numeric import present

    have = set(df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(F.when(present(c), 1)).alias(c) for c in SNAPSHOT_FIELDS if c in have]
    )

    def entry(c: str) -> Column:
        n = F.col(c) if c in have else F.lit(0).cast("bigint")
        return F.struct(F.lit(c).alias("field"), F.lit(SNAPSHOT_FIELDS[c]).alias("description"), n.alias("present"))

    return counts.select(F.explode(F.array(*[entry(c) for c in SNAPSHOT_FIELDS])).alias("e")).select("e.*")
