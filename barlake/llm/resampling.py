"""Importance resampling towards a target: hashed word runs, CRC-32 by position tables.

A feature is a run of one or two words; its bucket is the CRC-32 of its bytes
modulo a number of buckets.  The weight of a document is the mean log ratio of
the target's and the corpus' bucket shares, its score adds Gumbel noise that a
hash of its id fixes, and the documents with the highest scores are drawn
(Gumbel top-k: sampling without replacement by the weights).

Checksums of all features of a batch come from position tables (``spans``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.functions.ranking import attach_row, value_positions
from barlake.llm.common import bounded_batches, text_of, written
from barlake.llm.spans import LOWER, runs, span_crcs, spaced

BUCKETS = 10_000
LONGEST_RUN = 2
LEAST_WORDS = 20
PERCENT = 25
SEED = 7

#: Bytes of words: digits, small letters, and all of any character beyond ASCII.
_IN_WORD = np.array([0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text, text of each feature, CRC-32 of each feature)."""
    raw = [(t or "").encode("utf-8", "surrogatepass").translate(LOWER) for t in texts]
    data = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
    inside = _IN_WORD[data]
    starts, sizes = runs(inside)
    text = np.searchsorted(np.cumsum([len(r) + 1 for r in raw]), starts, side="right")
    joined, at = spaced(data, inside, sizes)
    owner, crcs = [], []
    for run in range(1, LONGEST_RUN + 1):
        first = np.arange(len(starts) - run + 1) if len(starts) >= run else np.empty(0, np.int64)
        first = first[text[first] == text[first + run - 1]]
        owner.append(text[first])
        crcs.append(span_crcs(joined, at[first], at[first + run - 1] + sizes[first + run - 1]))
    return np.bincount(text, minlength=len(texts)), np.concatenate(owner), np.concatenate(crcs)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features of all texts each bucket has, one row for each bucket that has any."""
    bounded_batches(texts.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(features(batch.column(0).to_pylist())[2] % buckets, minlength=buckets)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["bucket", "n"])

    each = texts.select(text_of().alias("t")).mapInArrow(count, "bucket long, n long")
    return each.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """1000 times the log ratio of the smoothed bucket shares, rounded down; two short lists reach the driver."""
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for counts, own in ((bucket_counts(corpus, buckets), s), (bucket_counts(target, buckets), t)):
        for row in counts.collect():
            own[row["bucket"]] = row["n"]
    in_s, in_t = float(s.sum() + buckets), float(t.sum() + buckets)
    ratio = (t + 1).astype(float) * in_s / ((s + 1).astype(float) * in_t)
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def _noise(seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of a digest of the id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(2.0**32))))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank), one row for each row of ``docs``; drawn rows have a rank.

    ``target`` is a table of texts.  NULL and empty texts have no features,
    weight 0, and are never drawn, like all texts under ``LEAST_WORDS`` words.
    A NULL id is hashed as an empty one and comes before others in ties;
    repeated rows score alike and take neighbouring ranks.  An empty target or
    table has no features (all shares are then the smoothing's); an empty table
    gives no rows.  Other columns are ignored.
    """
    spark = docs.sparkSession
    gain = gains(docs, target)
    bounded_batches(spark)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, owner, crcs = features(batch.column(1).to_pylist())
            n = np.bincount(owner, minlength=len(words))
            # whole numbers below 2**53: sums in doubles are exact
            total = np.bincount(owner, gain[crcs % BUCKETS], len(words)).astype(np.int64)
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            columns = [batch.column(0), pa.array(n), pa.array(weight), pa.array(words >= LEAST_WORDS)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_features", "weight", "long_enough"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    weighed = docs.select("doc_id", text_of().alias("t")).mapInArrow(
        weigh, f"doc_id {kind}, n_features long, weight long, long_enough boolean"
    )
    scored = written(weighed.withColumn("score", F.col("weight") + _noise(seed)), "scores")
    # scores are whole numbers in a range that gains and noise bound: far fewer than documents
    places = value_positions(scored.where("long_enough"), [], "score").select(
        F.col("score").alias("_score"), (F.col("n") - F.col("below") - F.col("cnt")).alias("better")
    )
    drawn = scored.where("long_enough").agg(F.floor(F.count(F.lit(1)) * percent / 100).alias("drawn"))
    ties = Window.partitionBy("long_enough", "score").orderBy("doc_id")
    ranked = scored.withColumn("nth", F.row_number().over(ties)).join(
        places, F.col("long_enough") & (F.col("score") == F.col("_score")), "left"
    )
    rank = F.col("better") + F.col("nth")
    return attach_row(ranked, drawn).select(
        "doc_id", "n_features", "weight", "score", F.when(rank <= F.col("drawn"), rank).alias("rank")
    )
