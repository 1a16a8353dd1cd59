"""Exact ranks and medians without pulling one group into one task.

A percentile rank or a median over "all securities of a date" is usually
written as a window partitioned by the date, which sorts the whole date in one
task.  Here equal values are counted first (map-side combine), the distinct
values are spread over bins whose edges come from a mergeable sketch, and only
the short list of bin totals is accumulated per key.  Bin edges steer balance
only; the result is exact for any edges, if rows and totals use the same ones.

A sketch depends on the order in which parts arrive, so a plan that works it out
twice can get two sets of edges.  Edges and the totals of their bins therefore
travel together, in one struct per key that every row of the key reads.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS = 64


def attach_row(df: DataFrame, one: DataFrame) -> DataFrame:
    """The columns of a one-row table on every row, as scalar subqueries (more than one row is an error)."""
    return df.select("*", *[one.select(c).scalar().alias(c) for c in one.columns])


def value_positions(df: DataFrame, keys: list[str], value: str, bins: int = BINS) -> DataFrame:
    """One row per distinct value: ``cnt``, ``below`` (rows smaller), ``n`` (rows in the key).

    Keys must not be NULL; rows without a value are left out.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("cnt"))
    cuts = [i / bins for i in range(1, bins)]
    edges = counts.groupBy(*keys).agg(F.percentile_approx(F.col(value), cuts, 1000).alias("_edges"))

    def attached(rows: DataFrame, per_key: DataFrame) -> DataFrame:
        # without keys there is one row of at most `bins` numbers
        return rows.join(per_key, keys) if keys else attach_row(rows, per_key)

    def bin_of(e: Column) -> Column:
        return F.size(F.filter(e, lambda x: x < F.col(value)))

    # at most `bins` totals per key
    totals = attached(counts, edges).groupBy(*keys, bin_of(F.col("_edges")).alias("_bin")).agg(
        F.sum("cnt").alias("_rows"), F.first("_edges").alias("_edges")
    )
    per_bin = totals.groupBy(*keys).agg(F.collect_list(F.struct("_bin", "_rows")).alias("_bins"), F.first("_edges").alias("_edges"))

    def rows_of(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("bigint"), lambda n, t: n + t["_rows"])

    before = F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: rows_of(F.filter("_bins", lambda t: t["_bin"] < i)))
    guide = per_bin.select(*keys, F.struct("_edges", before.alias("_before"), rows_of(F.col("_bins")).alias("n")).alias("_guide"))
    in_bin = Window.partitionBy(*keys, "_bin").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    binned = attached(counts, guide).withColumn("_bin", bin_of(F.col("_guide._edges"))).select(
        *keys, value, "cnt", "_bin", F.get("_guide._before", F.col("_bin")).alias("_before"), F.col("_guide.n").alias("n")
    )
    inside = F.coalesce(F.sum("cnt").over(in_bin), F.lit(0))
    return binned.select(*keys, value, "cnt", (F.col("_before") + inside).alias("below"), "n")


def percent_rank_average(df: DataFrame, keys: list[str], value: str, out: str, scale: float = 100.0) -> DataFrame:
    """Rows with a value gain ``out`` = average rank of ties / rows * scale."""
    pos = value_positions(df, keys, value)
    rank2 = F.col("below") * 2 + F.col("cnt") + 1
    pos = pos.select(*keys, value, (rank2.cast("double") / 2 / F.col("n").cast("double") * scale).alias(out))
    return df.join(pos, [*keys, value], "left")


def exact_median(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Exact median per key: mean of the middle one or two values."""
    pos = value_positions(df, keys, value)
    lo = F.floor((F.col("n") + 1) / 2)
    hi = F.floor((F.col("n") + 2) / 2)
    low = (F.col("below") < lo) & (lo <= F.col("below") + F.col("cnt"))
    high = (F.col("below") < hi) & (hi <= F.col("below") + F.col("cnt"))
    both = F.max(F.when(low, F.col(value))).cast("double") + F.max(F.when(high, F.col(value))).cast("double")
    return pos.where(low | high).groupBy(*keys).agg((both / 2).alias(out))


def leading_bytes(text: Column, n: int = 6) -> Column:
    """The first bytes of a text as a number that never falls when the text rises in byte order."""
    digits = F.rpad(F.substring(F.hex(F.encode(text, "UTF-8")), 1, 2 * n), 2 * n, "0")
    return F.conv(digits, 16, 10).cast("double")


def binned_row_number(df: DataFrame, keys: list[str], lead: Column, second: Column, order: list[Column], out: str, bins: int = BINS) -> DataFrame:
    """``out`` = exact row number within ``keys`` by ``order``, without ordering a whole key in one task.

    ``lead`` and ``second`` are numbers that never fall along ``order`` (``second``
    only among rows with equal ``lead``).  Sketched edges cut a key into bins that
    follow each other; a value that is an edge itself has a bin of its own, cut
    again by ``second``, so that a very frequent value is spread too.  Edges steer
    balance only.
    """
    cuts = [i / bins for i in range(1, bins)]
    staged = df.withColumns({"_lead": lead, "_second": second})
    edges = staged.groupBy(*keys).agg(
        F.array_distinct(F.percentile_approx("_lead", cuts, 1000)).alias("_e1"), F.percentile_approx("_second", cuts, 1000).alias("_e2")
    )
    names = [f"_k{i}" for i in range(len(keys))]
    edges = edges.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], "_e1", "_e2")
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names, strict=True)])
    below = lambda e, v: F.size(F.filter(e, lambda x: x < F.col(v)))

    def place(e1: Column, e2: Column) -> Column:
        """The number of a row's bin."""
        alone = F.array_contains(e1, F.col("_lead"))
        first = 2 * below(e1, "_lead") + F.when(alone, 1).otherwise(0)
        return first * bins + F.when(alone, below(e2, "_second")).otherwise(0)

    # at most 2 * bins * bins bins per key are ordered here
    totals = staged.join(edges, same).groupBy(*names, place(F.col("_e1"), F.col("_e2")).alias("_place")).agg(
        F.count(F.lit(1)).alias("_n"), F.first("_e1").alias("_e1"), F.first("_e2").alias("_e2")
    )
    before = Window.partitionBy(*names).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    guide = totals.groupBy(*names).agg(
        F.array_sort(F.collect_list(F.struct("_place", "_before"))).alias("_bins"), F.first("_e1").alias("_e1"), F.first("_e2").alias("_e2")
    )
    guide = guide.select(*names, F.struct("_e1", "_e2", F.col("_bins._place").alias("places"), F.col("_bins._before").alias("before")).alias("_guide"))
    binned = staged.join(guide, same).withColumn("_place", place(F.col("_guide._e1"), F.col("_guide._e2")))
    before = F.get("_guide.before", F.array_position("_guide.places", F.col("_place")).cast("int") - 1)
    binned = binned.select(*df.columns, "_place", before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*keys, "_place").orderBy(*order))
    return binned.select(*df.columns, (F.col("_before") + inside).cast("int").alias(out))


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column], keep: int = 1, rn: str = "_rn") -> DataFrame:
    """At most ``keep`` rows per key, best first.

    Spark limits each map task to ``keep`` rows per key before the shuffle
    (window group limit), so a key that owns most rows costs no more than others.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) <= keep)
