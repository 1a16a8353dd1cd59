"""Packing documents into training sequences: shortest-pack-first over the length histogram.

Every document (its token ids and an end id) is cut into full sequences and a
rest.  Only the histogram of rest lengths - at most one number for each length -
reaches the driver.  There lengths are placed longest first, each time into the
pack with the most room left; packs are not kept one by one but as patterns with
counts.  A pattern then stands for ``count`` sequences and its places are ranges
of ranks, so documents find their places by a join on (length, rank).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.llm.common import bounded_batches, text_of, written
from barlake.llm.tokens import encoder

SEQUENCE = 1024


def pack_histogram(counts: dict[int, int], capacity: int = SEQUENCE) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Patterns ((length, times), ...) with their counts; together they hold every piece exactly once.

    ``open_packs[room]`` holds the patterns with that much room.  Placing a
    length either uses up a group of equal packs or splits one; new packs take as
    many pieces of the length as fit and at most one takes the rest.  So there
    are never many more patterns than lengths.
    """
    open_packs: dict[int, dict[tuple[tuple[int, int], ...], int]] = {}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = max(open_packs, default=0)
            if room < length:
                # a new pack is the roomiest one until it is full: it takes the length as often as it fits
                times = min(left, capacity // length)
                packs = open_packs.setdefault(capacity - times * length, {})
                fresh = ((length, times),)
                packs[fresh] = packs.get(fresh, 0) + left // times
                left %= times
                continue
            group, n = next(iter(open_packs[room].items()))
            del open_packs[room][group]
            if not open_packs[room]:
                del open_packs[room]
            used = min(n, left)
            if n > used:
                open_packs.setdefault(room, {})[group] = n - used
            if group[-1][0] == length:
                grown = (*group[:-1], (length, group[-1][1] + 1))
            else:
                grown = (*group, (length, 1))
            packs = open_packs.setdefault(room - length, {})
            packs[grown] = packs.get(grown, 0) + used
            left -= used
    return sorted(((g, n) for packs in open_packs.values() for g, n in packs.items()), key=lambda x: (x[0], x[1]))


def _places(patterns: list[tuple[tuple[tuple[int, int], ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, rank after the last, first sequence, offset, times): rank ranges of each length."""
    ranks: dict[int, int] = {}
    out, sequence = [], 0
    for group, n in patterns:
        offset = 0
        for length, times in group:
            low = ranks.get(length, 0)
            ranks[length] = low + n * times
            out.append((length, low, low + n * times, sequence, offset, times))
            offset += length * times
        sequence += n
    return out


def pieces(docs: DataFrame, tokenizer: str, end_id: int, spaces: bool, capacity: int = SEQUENCE) -> DataFrame:
    """(part, rank, doc_id, start, length, ids_crc32, doc_tokens): full sequences and the rest of every document.

    ``rank`` counts the pieces of a length within the task ``part``.
    """
    bounded_batches(docs.sparkSession)
    end = struct.pack("<I", end_id)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, part, seen = encoder(tokenizer, spaces), TaskContext.get().partitionId(), {}
        for pdf in batches:
            out = []
            for doc, text in zip(pdf["doc_id"], pdf["t"], strict=True):
                ids = encode.ids(text) + end
                n = len(ids) // 4
                for a in range(0, n, capacity):
                    b = min(n, a + capacity)
                    rank = seen.get(b - a, 0)
                    seen[b - a] = rank + 1
                    out.append((part, rank, doc, a, b - a, zlib.crc32(ids[4 * a : 4 * b]), n))
            yield pd.DataFrame(out, columns=["part", "rank", "doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_of().alias("t")).mapInPandas(
        cut, f"part long, rank long, doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    )


def pack(docs: DataFrame, tokenizer: str, end_id: int, spaces: bool, capacity: int = SEQUENCE) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), a row for each piece.

    NULL and empty texts are their end id alone.  Repeated rows are packed one
    by one, an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    cut = written(pieces(docs, tokenizer, end_id, spaces, capacity), "pieces")
    # at most one row for each length
    counts = written(cut.groupBy("part", "length").count(), "piece-counts")
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("count")).collect()}
    places = _places(pack_histogram(histogram, capacity))
    fields = ("length", "low", "high", "sequence", "place", "times")
    table = spark.createDataFrame(places, T.StructType([T.StructField(f, T.LongType()) for f in fields]))

    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "length", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    ranked = cut.join(offsets, ["part", "length"]).withColumn("r", F.col("before") + F.col("rank"))
    # the table of places has a few rows for each length: its size is bounded by the capacity
    found = ranked.join(
        F.broadcast(table.withColumnRenamed("length", "_length")),
        (F.col("length") == F.col("_length")) & (F.col("r") >= F.col("low")) & (F.col("r") < F.col("high")),
    )
    nth = F.col("r") - F.col("low")
    return found.select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (F.col("sequence") + F.floor(nth / F.col("times"))).cast("long").alias("sequence_id"),
        (F.col("place") + F.col("length") * (nth % F.col("times"))).cast("long").alias("offset"),
    )
