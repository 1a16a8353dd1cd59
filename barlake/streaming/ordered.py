"""Keyed streams in event-time order: closed blocks, carried state, and a view that joins the two.

What a row means for the rows after it (the state of a machine, failures in a
row, the last value of a counter) must not depend on how input falls into
micro-batches.  So nothing is decided before its time is over:

1. ``closed_blocks``: rows are gathered by key and a tumbling block of event time
   in Spark's window state.  A block is emitted once, sorted, when the watermark
   has passed it; later rows for it are late and dropped.  A busy key is spread
   over as many tasks as it has open blocks.
2. ``carries``: every block is reduced to a summary that composes with its
   neighbours.  Blocks come in the order of their time, batch by batch, so one
   small value a key is enough to give every block what the blocks before it
   leave behind.
3. The view joins blocks with their carry and works out the rows, each block by
   itself, with built-in expressions.

Input that ends leaves blocks open.  ``close`` appends an end mark, a row that only
moves the watermark, and runs the job once more: every block that is still open is
emitted, under the same guarantee.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.streaming import carry
from barlake.streaming.jobs import MARK, file_stream, run_available, run_keyed, watermarked

cloudpickle.register_pickle_by_value(carry)


# -- end marks --------------------------------------------------------------------


def with_end_marks(stream: DataFrame, ts: str, path: str) -> DataFrame:
    """The stream and, below ``path``, a folder of end marks; marks have no other column than their time."""
    spark = stream.sparkSession
    kind = T.StructType([T.StructField(ts, stream.schema[ts].dataType)])
    folder = f"{path}/marks"
    spark.createDataFrame([], kind).write.mode("append").parquet(folder)
    marks = file_stream(spark, folder, "*.parquet", kind).withColumn(MARK, F.lit(True))
    return stream.withColumn(MARK, F.lit(False)).unionByName(marks, allowMissingColumns=True)


def close(spark: SparkSession, ts: str, kind: T.DataType, at: str, path: str) -> None:
    """Put an end mark for everything before ``at``."""
    row = spark.range(1).select(F.lit(at).cast("timestamp").cast(kind).alias(ts))
    row.write.mode("append").parquet(f"{path}/marks")


def run_to_end(job: Callable[[], DataFrame], ts: str, end: str, path: str) -> None:
    """Run a job with end marks over all input, then once more to close what is open at ``end``."""
    stream = job()
    run_available(stream, path)
    # the mark must lie beyond the delay
    close(stream.sparkSession, ts, T.TimestampType(), end, path)
    run_available(job(), path)


# -- blocks and what they carry --------------------------------------------------------


def closed_blocks(rows: DataFrame, key: str, ts: str, length: str, order: Sequence[str], columns: Sequence[str], delay: str) -> DataFrame:
    """(key, block, rows) with the rows of a block sorted by ``order``; ``rows`` is a stream with end marks."""
    item = F.struct(*order, *[c for c in columns if c not in order])
    return (
        watermarked(rows, ts, delay)
        .groupBy(F.window(ts, length).alias("w"), key)
        .agg(F.array_sort(F.collect_list(item)).alias("rows"))
        .select(key, F.col("w.start").alias("block"), "rows")
    )


def carries(blocks: DataFrame, key: str, summary: Column, kind: str, start: object) -> DataFrame:
    """(key, block, carry): what the blocks before leave behind, from a stream of closed blocks.

    ``summary`` is a struct that ``carry.COMPOSE[kind]`` applies to the value of the key.
    """
    rows = blocks.select(key, "block", summary.alias("s")).select(key, "block", "s.*")
    fields = [rows.schema[key], rows.schema["block"], T.StructField("carry", carry.TYPES[kind])]
    return rows.groupBy(key).transformWithStateInPandas(
        statefulProcessor=carry.CarryProcessor(key, kind, start),
        outputStructType=T.StructType(fields),
        outputMode="Append",
        timeMode="None",
    )


def run_ordered(
    job: Callable[[str], DataFrame], key: str, ts: str, summary: Column, kind: str, start: object, end: str, path: str, closing: bool = True
) -> DataFrame:
    """Run blocks and carries over all available input and return the view (key, block, rows, carry).

    ``job(path)`` builds the stream of closed blocks.  It may run again later on
    more input with the same ``path``; ``closing`` says that this is the end.
    """
    where = f"{path}/blocks"
    stream = job(where)
    spark, schema = stream.sparkSession, stream.schema
    run_available(stream, where)
    if closing:
        close(spark, ts, T.TimestampType(), end, where)
        run_available(job(where), where)
    done = spark.readStream.schema(schema).parquet(f"{where}/data")
    run_keyed(spark, carries(done, key, summary, kind, start), f"{path}/carries")
    return spark.read.parquet(f"{where}/data").join(spark.read.parquet(f"{path}/carries/data"), [key, "block"])


# -- failures in a row --------------------------------------------------------------


def failure_summary() -> Column:
    """(has_success, failures): all failures of a block without success, else those after the last one."""
    ok = F.exists("rows", lambda r: r["ok"])
    after = F.aggregate("rows", F.lit(0).cast("bigint"), lambda n, r: F.when(r["ok"], F.lit(0).cast("bigint")).otherwise(n + 1))
    return F.struct(ok.alias("has_success"), after.alias("failures"))


def health_view(view: DataFrame, threshold: int = 3, cooldown: int = 300) -> DataFrame:
    """Every failure that starts or restarts the cool-down of its source."""
    rows = view.select("source", "block", "carry", F.inline("rows"))
    by_time = Window.partitionBy("source", "block").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_run", F.count(F.when(F.col("ok"), 1)).over(by_time))
    in_run = Window.partitionBy("source", "block", "_run").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, 0)
    n = F.count(F.when(~F.col("ok"), 1)).over(in_run) + F.when(F.col("_run") == 0, F.col("carry")).otherwise(0)
    rows = rows.withColumn("failures", n).where(~F.col("ok") & (F.col("failures") >= threshold))
    until = F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(cooldown))
    return rows.select("source", "seq", "failures", until.alias("disabled_until"))


# -- state machines ------------------------------------------------------------------


def machine_summary(names: Sequence[str], table: Sequence[Sequence[int]]) -> Column:
    """(ends): the state in which a block leaves each state that it may meet."""
    maps = F.array(*[F.array(*[F.lit(int(x)) for x in row]) for row in table])
    same = F.array(*[F.lit(i) for i in range(len(names))])
    words = F.array(*[F.lit(s) for s in names])

    def step(acc: Column, r: Column) -> Column:
        op = F.nullif(F.array_position(words, r["to_state"]).cast("int"), F.lit(0)) - 1
        row = F.coalesce(F.get(maps, op), same)
        return F.transform(acc, lambda s: F.get(row, s))

    return F.struct(F.aggregate("rows", same, step).alias("ends"))


def machine_view(view: DataFrame, names: Sequence[str], table: Sequence[Sequence[int]], legal: Sequence[Sequence[bool]]) -> DataFrame:
    """Every event with the state it met, whether it was legal there, and the state after it."""
    maps = F.array(*[F.array(*[F.lit(int(x)) for x in row]) for row in table])
    allowed = F.array(*[F.array(*[F.lit(bool(x)) for x in row]) for row in legal])
    words = F.array(*[F.lit(s) for s in names])
    out = "array<struct<seq:bigint,to_state:string,op:int,met:int,left:int>>"
    kind = f"struct<s:int,out:{out}>"

    def step(acc: Column, r: Column) -> Column:
        op = F.nullif(F.array_position(words, r["to_state"]).cast("int"), F.lit(0)) - 1
        after = F.coalesce(F.get(F.get(maps, op), acc["s"]), acc["s"]).cast("int")
        item = F.struct(r["seq"].cast("bigint").alias("seq"), r["to_state"].alias("to_state"), op.alias("op"), acc["s"].alias("met"), after.alias("left"))
        return F.struct(after.alias("s"), F.concat(acc["out"], F.array(item)).alias("out")).cast(kind)

    init = F.struct(F.col("carry").cast("int").alias("s"), F.array().cast(out).alias("out")).cast(kind)
    rows = view.select("entity", F.inline(F.aggregate("rows", init, step, lambda acc: acc["out"])))
    return rows.select(
        "entity",
        "seq",
        "to_state",
        F.get(words, F.col("met")).alias("from_state"),
        F.coalesce(F.get(F.get(allowed, F.col("op")), F.col("met")), F.lit(False)).alias("legal"),
        F.get(words, F.col("left")).alias("state_after"),
    )


# -- counters that only grow -----------------------------------------------------------


def last_summary(columns: Sequence[str]) -> Column:
    """The columns of the last row of a block."""
    last = F.element_at("rows", -1)
    return F.struct(*[last[c].alias(c) for c in columns])


def increments_view(view: DataFrame, key: str, order: str, value: str, counters: Sequence[str]) -> DataFrame:
    """Rows with the value and the counters of the row before (``prev_...``) and the differences (``d_...``).

    The first row of a key only seeds; where a counter falls the row is skipped,
    though the next row is compared with it.
    """
    rows = view.select(key, "block", "carry", F.inline("rows"))
    w = Window.partitionBy(key, "block").orderBy(order)
    first = F.row_number().over(w) == 1
    prev = {c: F.when(first, F.col(f"carry.{c}")).otherwise(F.lag(c).over(w)) for c in (value, *counters)}
    rows = rows.select("*", *[p.alias(f"prev_{c}") for c, p in prev.items()])
    rows = rows.withColumns({f"d_{c}": F.col(c) - F.col(f"prev_{c}") for c in counters})
    return rows.where(reduce(Column.__and__, [F.col(f"d_{c}") >= 0 for c in counters]))
