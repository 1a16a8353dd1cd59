"""Streaming jobs: source -> transformation -> append sink with a checkpoint.

``run_available`` drives a job over everything that is available and stops;
a production deployment starts the same query with a processing-time trigger.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions import session_time as st

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: The column that tells an end mark from a row.
MARK = "_end_mark"


def file_stream(spark: SparkSession, folder: str, pattern: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def run_available(stream: DataFrame, path: str, mode: str = "append") -> None:
    """Process all available input into ``path`` (parquet) and stop."""
    q = (
        stream.writeStream.format("parquet")
        .option("path", f"{path}/data")
        .option("checkpointLocation", f"{path}/checkpoint")
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def run_keyed(spark: SparkSession, stream: DataFrame, path: str) -> None:
    """As :func:`run_available`, with the RocksDB state store that arbitrary state needs."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        run_available(stream, path)
    finally:
        spark.conf.set(PROVIDER, before)


# -- minutes ---------------------------------------------------------------------


def watermarked(rows: DataFrame, ts: str, delay: str) -> DataFrame:
    """Rows behind a watermark; end marks (``ordered.with_end_marks``) move it and go no further."""
    marked = rows.withWatermark(ts, delay)
    # a mark has a time; a condition on the time itself is never moved below the watermark
    return marked.where(~F.col(MARK) | F.col(ts).isNull()).drop(MARK) if MARK in rows.columns else marked


def minute_bars(ticks: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Tumbling one-minute OHLCV per code; a minute is emitted once the watermark has passed it."""
    return (
        watermarked(ticks, "ts", delay)
        .groupBy(F.window("ts", "1 minute").alias("w"), "code")
        .agg(
            F.min_by("price", "seq").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "seq").alias("close"),
            F.sum("volume").alias("volume"),
            F.sum("amount").alias("amount"),
        )
        .select("code", F.col("w.start").alias("ts_min"), "open", "high", "low", "close", "volume", "amount")
    )


def distinct_ticks(ticks: DataFrame, keys: Sequence[str], delay: str = "10 minutes") -> DataFrame:
    """Each key once within the watermark; with the checkpoint a restart neither repeats nor skips rows."""
    return ticks.withWatermark("ts", delay).dropDuplicatesWithinWatermark(list(keys))


def activity_sessions(ticks: DataFrame, max_gap_minutes: int = 2, delay: str = "10 minutes") -> DataFrame:
    """Uninterrupted stretches per code on the trading-minute axis; every boundary is a continuity break.

    ``ticks``: code, ts on the compressed axis (lunch removed).  Spark closes a
    session at a gap of exactly the duration, the rule asks for more than the
    duration, hence the extra microsecond.
    """
    gap = f"{max_gap_minutes * 60} seconds 1 microsecond"
    return (
        watermarked(ticks, "ts", delay)
        .groupBy(F.session_window("ts", gap).alias("w"), "code")
        .agg(F.count(F.lit(1)).alias("ticks"), F.max("ts").alias("last_ts"))
        .select("code", F.col("w.start").alias("first_ts"), "last_ts", "ticks")
    )


def trading_axis(ts):
    """Timestamp on the compressed axis: date plus trading-minute index."""
    minute = st.minute_index(st.minute_of_day(ts))
    return F.to_date(ts).cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), minute)


# -- newest wins -----------------------------------------------------------------


def newest_wins(path: str, keys: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink: every batch leaves its newest run per key in its own folder.

    Writing a batch again replaces its folder, so retries change nothing; the
    pointer is the newest over all folders, so an older run that arrives late
    never replaces a newer one.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        best = batch.groupBy(*keys).agg(F.max(F.struct("generated_at", "run_id")).alias("b"))
        best.select(*keys, "b.generated_at", "b.run_id").write.mode("overwrite").parquet(f"{path}/data/batch={batch_id}")

    return write


def run_newest(stream: DataFrame, path: str, keys: Sequence[str]) -> None:
    q = (
        stream.writeStream.foreachBatch(newest_wins(path, keys))
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def newest_view(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    rows = spark.read.parquet(f"{path}/data")
    return rows.groupBy(*keys).agg(F.max(F.struct("generated_at", "run_id")).alias("b")).select(*keys, "b.generated_at", "b.run_id")
