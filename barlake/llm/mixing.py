"""Mixing sources to target weights by Pfair scheduling.

The documents of a source follow in an order given by a hash of their id and are
laid end to end; every ``BLOCK`` characters are a block.  Block i (from 0) of a
source with weight w is released at time i / w (rounded down) and due at time
(i + 1) / w (rounded up).  In every time slot one block is emitted: of those
released and not yet emitted, the one due first.  With weights that add up to 1
every block meets its window, so at any time each source is less than one block
away from its share.

Weights are fractions of a period of slots.  After a period every source has
exactly its share again, so the schedule of one period - a fold over a bounded
number of slots - serves all of them: the slot of a block follows from its
number.  Positions inside a source come from running sums over ``BINS`` ranges
of the hash, so no source, however large, is ordered in one task.

Where the first source runs out of blocks (the horizon) the shares stop being
the targets; ``mixture`` ends there.  ``whole_mixture`` keeps every document:
slots of sources that have run out stay empty, so the others go on by their
weights relative to each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.common import text_of, written

#: Characters of a block.
BLOCK = 20_000
#: Slots of a period, about; the smallest weight is one slot.
RESOLUTION = 1000
#: Default weights are the sizes of the sources to this power: large sources are held back a little.
SMOOTHING = 0.9
#: First hexadecimal digits of the hash that are a range.
DIGITS = 3


def sources(docs: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """(source, chars, share, slots): a row for each source, NULL as ''.  A source without a given weight gets one slot."""
    sizes = docs.groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(
        F.sum(F.greatest(F.lit(1), F.length(text_of()))).alias("chars")
    )
    if weights is None:
        weight = F.pow("chars", F.lit(SMOOTHING))
    else:
        pairs = [x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))]
        weight = F.coalesce(F.element_at(F.create_map(*pairs), F.col("source")), F.lit(0.0)) if pairs else F.lit(1.0)
    everything = Window.partitionBy(F.lit(1))
    share = F.coalesce(weight / F.sum(weight).over(everything), F.lit(0.0))
    sizes = sizes.select("source", "chars", share.alias("share"))
    return sizes.withColumn("slots", F.greatest(F.lit(1), F.round(F.col("share") * RESOLUTION)).cast("long"))


def _release(i: Column, slots: Column, period: Column) -> Column:
    return F.floor(i * period / slots)


def _due(i: Column, slots: Column, period: Column) -> Column:
    return F.ceil((i + 1) * period / slots)


def period_schedule(known: DataFrame) -> DataFrame:
    """(source, nth, slot, slots, period, horizon): earliest deadline first over one period.

    ``known`` is the output of ``sources``; its rows - a number of sources, not of
    documents - meet in one row, and the result has as many rows as the period.
    """
    one = known.agg(
        F.array_sort(F.collect_list(F.struct("source", "slots", "chars"))).alias("all"), F.sum("slots").alias("period")
    ).where("period > 0")

    def step(acc: Column, t: Column) -> Column:
        waiting = F.zip_with(
            F.col("all"),
            acc["done"],
            lambda s, k: F.when(
                _release(k, s["slots"], F.col("period")) <= t,
                F.struct(_due(k, s["slots"], F.col("period")).alias("due"), s["source"].alias("source"), k.alias("nth")),
            ),
        )
        pick = F.array_min(waiting)
        done = F.zip_with(F.col("all"), acc["done"], lambda s, k: F.when(s["source"] == pick["source"], k + 1).otherwise(k))
        item = F.struct(pick["source"].alias("source"), pick["nth"].alias("nth"), t.alias("slot"))
        return F.struct(done.alias("done"), F.concat(acc["out"], F.array(item)).alias("out"))

    start = F.struct(
        F.transform("all", lambda s: F.lit(0).cast("long")).alias("done"),
        F.array().cast("array<struct<source:string,nth:bigint,slot:bigint>>").alias("out"),
    )
    plan = one.select("all", "period", F.aggregate(F.sequence(F.lit(0).cast("long"), F.col("period") - 1), start, step)["out"].alias("out"))
    slots = plan.select("period", F.explode("out").alias("o")).select("o.source", "o.nth", "o.slot", "period")
    timed = slots.join(known.select("source", "slots", "chars"), "source")
    # a source runs out in the slot of the first block that it does not have
    blocks = F.ceil(F.col("chars") / BLOCK)
    ends = F.when(F.col("nth") == blocks % F.col("slots"), F.floor(blocks / F.col("slots")) * F.col("period") + F.col("slot"))
    return timed.withColumn("horizon", F.min(ends).over(Window.partitionBy(F.lit(1)))).drop("chars")


def mix(docs: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """(doc_id, source, chars, block, release, due, slot, place, in_mix), one row for each row of ``docs``.

    ``slot`` orders the blocks of the mixture, ``place`` (characters of the
    source before the row) the rows of a block.  A row counts at least one
    character; NULL texts count as empty, a NULL source as ''.  Rows with one id
    follow in order of a digest of their text; an empty table gives no rows.
    """
    return _mixed(docs, weights, {"doc_id": F.col("doc_id"), "source": F.col("source")}).drop("turn")


def _mixed(docs: DataFrame, weights: dict[str, float] | None, keep: dict[str, Column]) -> DataFrame:
    known = written(sources(docs, weights), "sources")
    plan = written(period_schedule(known), "schedule")
    names = [f"_k{i}" for i in range(len(keep))]
    rows = docs.select(
        *[c.alias(n) for c, n in zip(keep.values(), names, strict=True)],
        F.coalesce("source", F.lit("")).alias("_source"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"),
        F.greatest(F.lit(1), F.length(text_of())).cast("long").alias("_chars"),
        F.md5(text_of()).alias("_text"),
    ).withColumn("_hash", F.md5("_id"))
    rows = rows.withColumn("_bin", F.substring("_hash", 1, DIGITS))
    bins = docs.groupBy(
        F.coalesce("source", F.lit("")).alias("_source"),
        F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, DIGITS).alias("_bin"),
    ).agg(F.sum(F.greatest(F.lit(1), F.length(text_of()))).alias("_sum"))
    earlier = Window.partitionBy("_source").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select("_source", "_bin", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_source", "_bin").orderBy("_hash", "_id", "_text").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.join(bins, ["_source", "_bin"]).withColumn(
        "place", F.col("_before") + F.coalesce(F.sum("_chars").over(inside), F.lit(0))
    )
    placed = placed.withColumn("block", F.floor(F.col("place") / BLOCK))
    # whole slots of a period stretched to the exact weight; a source of less than one block, to the time it takes
    exact = F.when(F.col("share") > 0, F.col("slots") / (F.col("share") * RESOLUTION)).otherwise(1.0)
    stretch = exact * F.least(F.lit(1.0), F.col("chars") / BLOCK)
    slots = known.select(F.col("source").alias("_source"), F.col("slots").alias("_n"), stretch.alias("_stretch"))
    # one row for each source, and one for each slot of the period
    placed = placed.join(F.broadcast(slots), "_source").withColumn("_nth", F.col("block") % F.col("_n"))
    table = plan.select(
        F.col("source").alias("_source"), F.col("nth").alias("_nth"), F.col("slot").alias("_slot"), "period", "horizon"
    )
    timed = placed.join(F.broadcast(table), ["_source", "_nth"])
    slot = F.floor(F.col("block") / F.col("_n")) * F.col("period") + F.col("_slot")
    return timed.select(
        *[F.col(n).alias(c) for n, c in zip(names, keep, strict=True)],
        F.col("_chars").alias("chars"),
        "block",
        _release(F.col("block"), F.col("_n"), F.col("period")).alias("release"),
        _due(F.col("block"), F.col("_n"), F.col("period")).alias("due"),
        slot.alias("slot"),
        "place",
        (slot < F.col("horizon")).alias("in_mix"),
        (slot * F.col("_stretch")).alias("turn"),
    )


def mixture(docs: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """The rows of ``docs`` up to the horizon, with their columns, in mixing order from file to file."""
    row = F.struct(*[F.col(c) for c in docs.columns])
    found = _mixed(docs, weights, {"row": row}).where("in_mix").select("slot", "place", "row")
    return found.repartitionByRange("slot").sortWithinPartitions("slot", "place").select("row.*")


def whole_mixture(docs: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """All rows of ``docs``, with their columns, in mixing order from file to file.

    The order is that of the slots, stretched for each source from its whole
    number of slots a period to its exact weight, so a source below one slot is
    spread over the mixture like any other.
    """
    row = F.struct(*[F.col(c) for c in docs.columns])
    found = _mixed(docs, weights, {"row": row}).select("turn", F.coalesce("row.source", F.lit("")).alias("source"), "place", "row")
    order = ["turn", "source", "place"]
    return found.repartitionByRange(*order).sortWithinPartitions(*order).select("row.*")


ORACLE = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(source, '') AS s, greatest(1, length(coalesce(text, ''))) AS chars,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h, md5(coalesce(text, '')) AS x
  FROM documents),
z AS (SELECT s, sum(chars) AS chars FROM d GROUP BY s),
n AS (SELECT s, chars,
        CAST(greatest(1, round(pow(chars, {SMOOTHING}) / sum(pow(chars, {SMOOTHING})) OVER () * {RESOLUTION})) AS BIGINT) AS slots
      FROM z),
l AS (SELECT list({{'s': s, 'n': slots}} ORDER BY s) AS a, CAST(sum(slots) AS BIGINT) AS period FROM n),
e AS (
  SELECT CAST(-1 AS BIGINT) AS t, list_transform(a, lambda v: CAST(0 AS BIGINT)) AS c, CAST(NULL AS VARCHAR) AS s,
         CAST(NULL AS BIGINT) AS nth
  FROM l
  UNION ALL
  SELECT t + 1, list_transform(c, lambda v, i: v + CAST(a[i].s = p.s AS BIGINT)), p.s, p.nth
  FROM (
    SELECT t, c, a, list_sort(list_filter(list_transform(c, lambda v, i: {{
             'due': ((v + 1) * period + a[i].n - 1) // a[i].n, 's': a[i].s, 'nth': v, 'r': (v * period) // a[i].n}}),
             lambda w: w.r <= t + 1))[1] AS p
    FROM e, l WHERE t + 1 < period)),
k AS (SELECT e.s, e.nth, e.t, n.slots, n.chars, l.period FROM e JOIN n ON e.s = n.s, l WHERE e.t >= 0),
hz AS (SELECT min((CAST(ceil(chars / {BLOCK}.0) AS BIGINT) // slots) * period + t) AS horizon
       FROM k WHERE nth = CAST(ceil(chars / {BLOCK}.0) AS BIGINT) % slots),
p AS (SELECT doc_id, source, s, CAST(chars AS BIGINT) AS chars,
        CAST(coalesce(sum(chars) OVER (PARTITION BY s ORDER BY h, x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
             AS BIGINT) AS place
      FROM d),
b AS (SELECT p.*, place // {BLOCK} AS block FROM p)
SELECT b.doc_id, b.source, b.chars, b.block, (b.block * k.period) // k.slots AS release,
       ((b.block + 1) * k.period + k.slots - 1) // k.slots AS due, (b.block // k.slots) * k.period + k.t AS slot, b.place,
       (b.block // k.slots) * k.period + k.t < hz.horizon AS in_mix
FROM b JOIN k ON b.s = k.s AND k.nth = b.block % k.slots, hz
"""
