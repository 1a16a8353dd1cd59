"""Phrase collocations, counted over a prefix-free parse.

A text is cut into pieces at punctuation and line ends, a piece into words.
Where a hash of two neighbouring words falls into one of ``EVERY`` classes, a
chunk ends with these two words and the next one begins with them.  Equal
passages are cut alike wherever they stand, so copies and shared passages come
down to entries of a dictionary with frequencies; everything after the parse
reads each distinct chunk once.  Neighbouring chunks overlap by ``LONGEST - 1``
words, so every run of up to ``LONGEST`` words lies in a chunk; one that begins
within an overlap counts for the later chunk only.

*Longest runs.*  A run of three words can be frequent only if both runs of two in
it are.  Those are marked in a bit table of fixed size by a hash, which spares
counting most rare runs; a run that passes by accident is counted and dropped by
its exact count.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.common import bounded_batches, text_of, written
from barlake.llm.spans import LOWER, copied, runs, span_crcs, spaced

LONGEST = 3
LEAST = 10
#: A longer run with this share of a candidate's occurrences, in percent, takes its place.
ABSORBED = 50
TOP = 2000
NO_LANG = "und"
#: One of so many word pairs ends a chunk.
EVERY = 16
#: Bits of the table of frequent pairs: 8 MiB for any corpus.
BIT_TABLE = 1 << 26
#: Parts of a language that choose their best phrases before these meet.
PARTS = 64
#: Rows of an Arrow batch of chunks or runs.
OUT_ROWS = 1 << 15

_SEPARATOR = np.array([b in b".,;:!?\n\x0b\x0c\r" for b in range(256)])
_BLANK = np.array([b in b" \t" for b in range(256)])


def chunks(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, text, whether it ends its piece) of the chunks of the texts; words are joined by one space."""
    raw = [t.encode("utf-8", "surrogatepass").translate(LOWER) for t in texts]
    data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
    cut = _SEPARATOR[data]
    inside = ~(cut | _BLANK[data])
    starts, sizes = runs(inside)
    if not len(starts):
        none = np.empty(0, np.int64)
        return data, none, none, none, none.astype(bool)
    text = np.searchsorted(np.cumsum([len(r) + 1 for r in raw]), starts, side="right")
    piece = np.cumsum(cut)[starts]
    words, at = spaced(data, inside, sizes)
    hashes = span_crcs(words, at, at + sizes)
    first = np.concatenate(([True], piece[1:] != piece[:-1]))
    last = np.concatenate((first[1:], [True]))
    # the pair (i - 1, i) ends a chunk, unless the piece ends there anyway
    trigger = np.zeros(len(at), bool)
    trigger[1:] = ((hashes[:-1] * np.uint32(31) + hashes[1:]) >> np.uint32(7)) % np.uint32(EVERY) == 0
    trigger &= ~(first | last)
    trigger[1:] &= ~first[:-1]
    begin = np.flatnonzero(first | np.concatenate((trigger[1:], [False])))
    end = np.flatnonzero(trigger | last)
    ends_piece = last[end]
    # a chunk of the overlap alone has no run of its own
    own = ends_piece | (end - begin + 1 >= LONGEST)
    begin, end = begin[own], end[own]
    return words, at[begin], at[end] + sizes[end], text[begin], ends_piece[own]


def _binary(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    values, offsets = copied(data, starts, ends)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(values)])


def parse(docs: DataFrame) -> DataFrame:
    """(lang, chunk, ends, times): the dictionary, a row for each distinct chunk of a language."""
    bounded_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts, stops, text, ends = chunks(batch.column(1).to_pylist())
            for k in range(0, len(starts), OUT_ROWS):
                part = slice(k, k + OUT_ROWS)
                arrays = [batch.column(0).take(pa.array(text[part])), _binary(data, starts[part], stops[part]), pa.array(ends[part])]
                yield pa.RecordBatch.from_arrays(arrays, names=["lang", "chunk", "ends"])

    rows = docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), text_of().alias("t"))
    cuts = rows.mapInArrow(cut, "lang string, chunk binary, ends boolean")
    return cuts.groupBy("lang", "chunk", "ends").agg(F.count(F.lit(1)).alias("times"))


def _marks(frequent: DataFrame) -> np.ndarray:
    """The bit table of the frequent pairs: at most BIT_TABLE / 64 rows reach the driver, however many pairs there are."""
    bit = F.crc32("phrase").bitwiseXOR(F.crc32(F.col("lang").cast("binary"))).bitwiseAND(F.lit(BIT_TABLE - 1))
    words = frequent.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("at"))
    words = words.agg(F.bit_or(F.expr("shiftleft(1L, int(bit & 63))")).alias("bits"))
    table = np.zeros(BIT_TABLE // 64, np.int64)
    for batch in words.toArrow().to_batches():
        table[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return table


def word_totals(dictionary: DataFrame) -> DataFrame:
    """(lang, n): all word occurrences of a language, those of an overlap once."""
    spaces = F.octet_length("chunk") - F.octet_length(F.replace(F.col("chunk"), F.lit(b" "), F.lit(b"")))
    words = spaces + 1 - F.when(F.col("ends"), 0).otherwise(LONGEST - 1)
    return dictionary.groupBy("lang").agg(F.sum(F.col("times") * words).alias("n"))


def run_counts(dictionary: DataFrame, sizes: tuple[int, ...], pairs: np.ndarray | None = None) -> DataFrame:
    """(lang, n_words, phrase, f): occurrences of the runs of these sizes, from the distinct chunks.

    ``pairs``: a bit table; longer runs count only if all their pairs are in it.
    """
    spark = dictionary.sparkSession
    bounded_batches(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(OUT_ROWS))
    table = spark.sparkContext.broadcast(pairs.tobytes()) if pairs is not None else None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(table.value, np.uint8) if table is not None else None
        for batch in batches:
            if not batch.num_rows:
                continue
            _, offsets, values = batch.column(1).buffers()
            low = batch.column(1).offset
            edges = np.frombuffer(offsets, np.int32)[low : low + batch.num_rows + 1].astype(np.int64)
            data = np.frombuffer(values, np.uint8)[edges[0] : edges[-1]]
            edges = edges - edges[0]
            # a chunk begins and ends with a word, words have one space between them
            space = np.flatnonzero(data == 32)
            starts, ends = np.sort(np.concatenate((edges[:-1], space + 1))), np.sort(np.concatenate((edges[1:], space)))
            chunk = np.searchsorted(edges, starts, side="right") - 1
            n_words = np.bincount(chunk, minlength=batch.num_rows)
            stop = np.cumsum(n_words) - np.where(batch.column(2).to_numpy(zero_copy_only=False), 0, LONGEST - 1)
            counted = np.arange(len(starts)) < stop[chunk]
            if bits is not None:
                same = np.flatnonzero(chunk[1:] == chunk[:-1])
                lang = np.array([zlib.crc32(x.encode()) for x in batch.column(0).to_pylist()], np.uint32)
                mark = (span_crcs(data, starts[same], ends[same + 1]) ^ lang[chunk[same]]) & np.uint32(BIT_TABLE - 1)
                good = np.zeros(len(starts), bool)
                good[same] = bits[mark >> np.uint32(3)] >> (mark & np.uint32(7)).astype(np.uint8) & 1
            for size in sizes:
                if len(starts) < size:
                    continue
                i = np.flatnonzero(counted[: len(starts) - size + 1] & (chunk[: len(chunk) - size + 1] == chunk[size - 1 :]))
                if bits is not None:
                    for k in range(size - 1):
                        i = i[good[i + k]]
                for k in range(0, len(i), OUT_ROWS):
                    part = i[k : k + OUT_ROWS]
                    rows = pa.array(chunk[part])
                    arrays = [batch.column(0).take(rows), _binary(data, starts[part], ends[part + size - 1]), batch.column(3).take(rows)]
                    yield pa.RecordBatch.from_arrays(arrays, names=["lang", "phrase", "f"])

    rows = dictionary.select("lang", "chunk", "ends", "times")
    each = rows.mapInArrow(count, "lang string, phrase binary, f long")
    # one key in place of three: nearly all that this operator writes to disk are these rows; no phrase has a line end
    each = each.select(F.concat(F.col("lang").cast("binary"), F.lit(b"\n"), "phrase").alias("key"), "f")
    counts = each.groupBy("key").agg(F.sum("f").alias("f"))
    key = F.col("key").cast("string")
    phrase = F.substring_index(key, "\n", -1)
    lang = F.substring(key, F.lit(1), F.char_length(key) - F.char_length(phrase) - 1)
    return counts.select(lang.alias("lang"), F.size(F.split(phrase, " ", -1)).alias("n_words"), phrase.cast("binary").alias("phrase"), "f")


def score() -> Column:
    """A million times a * a / (l * r), rounded down, from whole numbers below 10**15 and without rounding between."""
    a, left, right = (F.col(c).cast("decimal(15,0)") for c in ("a", "l", "r"))
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (a * a), left * right)


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    NULL and empty texts have no words, a NULL language is ``und``.  Repeated
    rows count again; ties in score and count go to the phrase that comes first
    in byte order, so ranks are unique.  An empty table, or one without any
    frequent phrase, gives no rows.  Other columns are ignored.  Counts are exact
    below 10**15.
    """
    dictionary = written(parse(docs), "chunks")
    # parts of candidates occur at least as often as these
    short = written(run_counts(dictionary, (1, 2)).where(F.col("f") >= least), "short-runs")
    long = run_counts(dictionary, tuple(range(3, LONGEST + 1)), _marks(short.where("n_words = 2")))
    long = written(long.where(F.col("f") >= least), "long-runs")
    text = F.col("phrase").cast("string")
    found = short.union(long).select("lang", "n_words", text.alias("phrase"), F.col("f").alias("a"))
    found = found.withColumn("w", F.split("phrase", " ", -1))

    # all runs inside a candidate stand in it at most LONGEST - 1 times
    inner = found.where("n_words > 2").select(
        "lang",
        F.col("a").alias("longer"),
        F.explode(
            F.array_distinct(
                F.flatten(
                    F.transform(
                        F.sequence(F.lit(2), F.col("n_words") - 1),
                        lambda k: F.transform(
                            F.sequence(F.lit(1), F.col("n_words") - k + 1), lambda i: F.array_join(F.slice("w", i, k), " ")
                        ),
                    )
                )
            )
        ).alias("phrase"),
    )
    covered = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    candidates = found.where("n_words > 1").join(covered, ["lang", "phrase"], "left")
    candidates = candidates.where(F.coalesce(100 * F.col("longer") < ABSORBED * F.col("a"), F.lit(True)))

    cut = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)))
    cut = cut.withColumn("first", F.array_join(F.slice("w", F.lit(1), F.col("k")), " "))
    cut = cut.withColumn("rest", F.array_join(F.slice("w", F.col("k") + 1, F.col("n_words")), " "))
    known = found.select("lang", F.col("phrase").alias("part"), "a")
    cut = cut.join(known.select("lang", F.col("part").alias("first"), F.col("a").alias("l")), ["lang", "first"])
    cut = cut.join(known.select("lang", F.col("part").alias("rest"), F.col("a").alias("r")), ["lang", "rest"])
    scored = cut.withColumn("score", score())
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    rows = lowest.select("lang", "phrase", "a", "c.l", "c.r", "c.score")

    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best))).where(F.col("place") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    # one row for each language
    return rows.join(word_totals(dictionary), "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = rf"""
WITH p AS (
  SELECT coalesce(lang, '{NO_LANG}') AS lang, unnest(regexp_split_to_array(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
s AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
g AS (SELECT lang, array_to_string(ws[i : i + k - 1], ' ') AS phrase, k FROM s, (SELECT unnest([1, 2, 3]) AS k) WHERE i + k - 1 <= len(ws)),
f AS (SELECT lang, phrase, k, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= {LEAST}),
i AS (SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase FROM c WHERE k = 3),
b AS (SELECT lang, phrase, max(a) AS longer FROM i GROUP BY ALL),
d AS (SELECT c.* FROM c LEFT JOIN b ON b.lang = c.lang AND b.phrase = c.phrase WHERE b.longer IS NULL OR 100 * b.longer < {ABSORBED} * c.a),
x AS (SELECT lang, phrase, a, m, array_to_string(ws[1:m], ' ') AS one, array_to_string(ws[m + 1:k], ' ') AS two
      FROM d, (SELECT unnest([1, 2]) AS m) WHERE m < k),
y AS (SELECT x.lang, x.phrase, x.a, x.m, p.f AS l, q.f AS r,
        ((1000000::HUGEINT * x.a * x.a) // (p.f::HUGEINT * q.f))::BIGINT AS score
      FROM x JOIN f p ON p.lang = x.lang AND p.phrase = x.one JOIN f q ON q.lang = x.lang AND q.phrase = x.two),
z AS (SELECT * FROM y QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, m) = 1),
t AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM z)
SELECT t.lang, t.rank, t.phrase, t.a, t.l, t.r, n.n, t.score FROM t JOIN n ON n.lang = t.lang WHERE t.rank <= {TOP}
"""
