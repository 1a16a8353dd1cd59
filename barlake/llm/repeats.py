"""Removal of long repeats with a logarithmic family of sampled suffix arrays.

Documents come in batches of ascending id.  A batch becomes a sorted run of
sampled suffixes (see ``suffixes``): entries ordered by seed, then by the bytes
they cover, then by place.  The run is merge-scanned with the runs of earlier
batches: one ordered pass over their union shows, for each entry of the batch,

* nothing with its seed elsewhere: none of its windows repeats,
* an equal cover earlier: all its windows are repeats,
* other covers with its seed: unsure, some windows may be repeats.

Afterwards runs that are no larger than the new one are merged with it, so
there are few runs at any time and an entry is rewritten seldom.

The windows of an unsure entry are dealt in two halves, each by the bytes that all
its windows have in common, and compared window by window with 128-bit hashes among those few that
share them.  A group too large for that gives its windows to a plain
aggregation, so every window is judged, whatever the size of its group.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.llm.common import bounded_batches, text_of, written
from barlake.llm.suffixes import FIRST, MATCH, SEED, SEEDS, entries, mix, windows
from barlake.session import scratch_dir

#: Entries of a task that are combined before they are sent.
COMBINE = 1_000_000
#: Halves of unsure entries compared in one go.
GROUP = 50_000
#: Ends of the batches, as shares of the documents by id.
BATCHES = (0.125, 1.0)
#: Unsure windows are dealt by the seed and this many bytes before it, or about as many after it.
SIDE = SEEDS // 2
#: A packed place is the first window, the anchor's distance from it and the number of windows; the last two take so many bits.
_BITS = 7
_LOW = (1 << _BITS) - 1


def _keyed(docs: DataFrame) -> DataFrame:
    """(k, doc_id, text) with a unique order key: the id itself, or, if ids repeat or are NULL, places in their order."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    odd = rows.groupBy("doc_id").count().where("doc_id IS NULL OR count > 1")
    if not odd.take(1):
        return rows.select(F.col("doc_id").alias("k"), "doc_id", "text")
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return written(ordered.withColumn("k", F.monotonically_increasing_id()).select("k", "doc_id", "text"), "ordered-documents")


def _sampled(docs: DataFrame, first_of_task: bool) -> DataFrame:
    """(h, cover, k, p) of the entries that are the first of their kind in a task, or (k, p) of the others.

    A task's copies of one entry are repeats whatever other tasks hold, so only
    the earliest of them takes part in the scan; ``p`` packs place and windows.
    """

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        n = 0

        def flush() -> pa.RecordBatch:
            h, cover, k, p = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.lexsort((p, k, cover, h))
            h, cover, k, p = h[order], cover[order], k[order], p[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (cover[1:] != cover[:-1])
            if first_of_task:
                cols = [h[new].view(np.int64), cover[new].view(np.int64), k[new], p[new]]
                return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["h", "cover", "k", "p"])
            return pa.RecordBatch.from_arrays([pa.array(k[~new]), pa.array(p[~new])], names=["k", "p"])

        for batch in batches:
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
                h, cover, first, place, count = entries(data)
                if len(h):
                    held.append((h, cover, np.full(len(h), k, np.int64), (((first << _BITS) | place) << _BITS) | count))
                    n += len(h)
            if n >= COMBINE:
                n = 0
                yield flush()
        if held:
            yield flush()

    schema = "h long, cover long, k long, p long" if first_of_task else "k long, p long"
    return docs.select("k", "text").mapInArrow(sample, schema)


def merge_scan(new: DataFrame, runs: list[DataFrame]) -> DataFrame:
    """(h, cover, k, p, old, first, unsure) over a batch and the runs before it, by one pass in sorted order."""
    rows = new.withColumn("old", F.lit(False))
    for run in runs:
        rows = rows.unionByName(run.select("h", "cover", "k", "p", F.lit(True).alias("old")))
    seed = Window.partitionBy("h")
    same = Window.partitionBy("h", "cover").orderBy("k", "p")
    return rows.select(
        "*",
        (F.row_number().over(same) == 1).alias("first"),
        (F.min("cover").over(seed) != F.max("cover").over(seed)).alias("unsure"),
    )


class IndexFamily:
    """Runs of sampled suffixes, at most a few at a time; batches must come in order of their keys."""

    def __init__(self) -> None:
        self.runs: list[tuple[int, DataFrame]] = []

    def add(self, batch: DataFrame, last: bool = False) -> list[DataFrame]:
        """Scan a batch against the runs and keep it; returns marks (k, p, unsure).  The last batch is not kept."""
        copies = _sampled(batch, False).withColumn("unsure", F.lit(False))
        scanned = merge_scan(_sampled(batch, True), [run for _, run in self.runs])
        marked = (~F.col("old") & ~F.col("first")) | (F.col("first") & F.col("unsure"))
        mark = (F.col("first") & F.col("unsure")).alias("unsure")
        if last:
            return [copies, scanned.where(marked).select("k", "p", mark)]
        scanned = written(scanned, "suffix-run")
        size = scanned.where("NOT old").count()
        stay = [(n, run) for n, run in self.runs if n > size]
        if len(stay) == len(self.runs):
            merged = scanned.where("first AND NOT old")
        else:
            # runs no larger than the batch merge with it; the scan has them in order already
            merged = scanned.where("first")
            stay, size = [], size + sum(n for n, _ in self.runs)
        self.runs = [*stay, (size, merged.select("h", "cover", "k", "p"))]
        return [copies, scanned.where(marked).select("k", "p", mark)]


def _bucketed(spark: SparkSession, df: DataFrame, key: str, name: str) -> DataFrame:
    """A table in the shared scratch folder that later joins on ``key`` need not shuffle."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    writer = df.repartition(parts, key).write.format("parquet").option("compression", "zstd")
    writer.bucketBy(parts, key).option("path", scratch_dir(spark, name)).saveAsTable(table)
    found = spark.table(table)
    # the plan above holds the files; only the name goes
    spark.sql(f"DROP TABLE {table}")
    return found


def _halves(texts: DataFrame) -> DataFrame:
    """(core, k, first, data): the two halves of every unsure entry, with the bytes that its windows cover."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cores, ks, firsts, datas = [], [], [], []
            for k, text, unsure in zip(*(batch.column(c).to_pylist() for c in ("k", "text", "unsure")), strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                for p in unsure:
                    first, count = p >> 2 * _BITS, p & _LOW
                    anchor, end = first + (p >> _BITS & _LOW), first + count
                    middle = min(max(anchor - SIDE + 1, first), end)
                    # windows that start SIDE bytes or more before the anchor hold all bytes from there to the seed's end
                    for a, b, core in (
                        (first, middle, raw[anchor - SIDE : anchor + SEED] if first < middle else b""),
                        (middle, end, raw[anchor : anchor - SIDE + 1 + MATCH]),
                    ):
                        if a < b:
                            ks.append(k)
                            firsts.append(a)
                            datas.append(raw[a : b - 1 + MATCH])
                            cores.append(core)
            yield pa.RecordBatch.from_arrays(
                [pa.array(_stretch_hashes(cores)), pa.array(ks, pa.int64()), pa.array(firsts, pa.int64()), pa.array(datas, pa.binary())],
                names=["core", "k", "first", "data"],
            )

    return texts.select("k", "text", "unsure").mapInArrow(cut, "core long, k long, first long, data binary")


def _stretch_hashes(parts: list[bytes]) -> np.ndarray:
    """One hash for each byte string; strings are hashed a batch at a time."""
    if not parts:
        return np.empty(0, np.int64)
    out = np.empty(len(parts), np.uint64)
    ends = np.cumsum([0, *map(len, parts)])
    step = 4096
    for i in range(0, len(parts), step):
        j = min(len(parts), i + step)
        prefix = FIRST.prefix(np.frombuffer(b"".join(parts[i:j]), np.uint8))
        edge = ends[i : j + 1] - ends[i]
        out[i:j] = mix(FIRST.stretch(prefix, edge[:-1], edge[1:]) + mix(np.diff(edge).astype(np.uint64)))
    return out.view(np.int64)


def _compared(halves: DataFrame) -> DataFrame:
    """(k, first, count, w1, w2): repeated windows of each group, or all windows of a group that is too large."""

    def judge(group: list[tuple[int, int, bytes]], whole: bool) -> pa.RecordBatch | None:
        if len(group) < 2 and whole:
            return None
        counts = np.array([len(d) - MATCH + 1 for _, _, d in group])
        pairs = [windows(np.frombuffer(d, np.uint8), 0, int(n)) for (_, _, d), n in zip(group, counts, strict=True)]
        w1, w2 = (np.concatenate(x) for x in zip(*pairs, strict=True))
        k = np.repeat([g[0] for g in group], counts)
        at = np.repeat([g[1] for g in group], counts) + np.arange(len(w1)) - np.repeat(np.cumsum(counts) - counts, counts)
        if not whole:
            return _windows_batch(k, at, np.ones(len(k), np.int64), w1.view(np.int64), w2.view(np.int64))
        order = np.lexsort((at, k, w2, w1))
        again = np.zeros(len(order), bool)
        a, b = order[1:], order[:-1]
        again[a] = (w1[a] == w1[b]) & (w2[a] == w2[b])
        if not again.any():
            return None
        k, at = k[again], at[again]
        start = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (at[1:] != at[:-1] + 1)))
        return _windows_batch(k[start], at[start], np.diff(np.append(start, len(k))), None, None)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        core, group, open_group = None, [], False
        for batch in batches:
            for c, k, first, data in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if c != core:
                    found = judge(group, not open_group) if group else None
                    if found is not None:
                        yield found
                    core, group, open_group = c, [], False
                group.append((k, first, data))
                if len(group) >= GROUP:
                    open_group = True
                    yield judge(group, False)
                    group = []
        found = judge(group, not open_group) if group else None
        if found is not None:
            yield found

    dealt = halves.repartition("core").sortWithinPartitions("core", "k", "first")
    return written(dealt.mapInArrow(compare, "k long, first long, count long, w1 long, w2 long"), "repeated-windows")


def _windows_batch(k, first, count, w1, w2) -> pa.RecordBatch:
    none = pa.nulls(len(k), pa.int64())
    cols = [pa.array(x, pa.int64()) for x in (k, first, count)]
    cols += [none if w is None else pa.array(w) for w in (w1, w2)]
    return pa.RecordBatch.from_arrays(cols, names=["k", "first", "count", "w1", "w2"])


def cut_repeats(text: str, first: np.ndarray, count: np.ndarray) -> tuple[bytes, int]:
    """The bytes outside the given windows, and the number of runs removed."""
    raw = text.encode("utf-8", "surrogatepass")
    edge = np.zeros(len(raw) + 1, np.int32)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + count - 1 + MATCH, -1)
    gone = np.cumsum(edge[:-1]) > 0
    runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(raw, np.uint8)[~gone].tobytes(), runs


def remove_repeats(docs: DataFrame, batches: tuple[float, ...] = BATCHES, with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row for each row of ``docs``.

    A byte goes if a string of 100 bytes over it also starts earlier: at a
    smaller id, or earlier in the same text.  NULL texts count as empty; rows
    with one id are ordered by their text; an empty table gives no rows.
    ``docs`` must be a table, because it is read several times.
    ``with_text`` adds the kept bytes.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    keyed = _keyed(docs)
    ends = keyed.agg(F.percentile_approx("k", [float(b) for b in batches[:-1]], 1000)).first()[0] if len(batches) > 1 else []
    family, marks, low = IndexFamily(), [], None
    for n, high in enumerate([*(ends or []), None]):
        batch = keyed
        if low is not None:
            batch = batch.where(F.col("k") > low)
        if high is not None:
            batch = batch.where(F.col("k") <= high)
        marks += family.add(batch, last=high is None)
        low = high
    found = marks[0]
    for more in marks[1:]:
        found = found.unionByName(more)
    by_doc = found.groupBy("k").agg(
        F.collect_list(F.when(~F.col("unsure"), F.col("p"))).alias("sure"),
        F.array_distinct(F.collect_list(F.when(F.col("unsure"), F.col("p")))).alias("unsure"),
    )
    marked = F.col("sure").isNotNull()
    table = keyed.join(by_doc, "k", "left").select(
        "k",
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.when(~marked, F.sha2(F.col("text").cast("binary"), 256)).alias("whole_sha256"),
        F.when(marked | F.lit(with_text), F.col("text")).alias("text"),
        "sure",
        "unsure",
    )
    table = _bucketed(spark, table, "k", "marked_documents")
    compared = _compared(_halves(table.where(F.size("unsure") > 0)))
    done = compared.where("w1 IS NULL").select("k", "first", "count")
    rest = compared.where("w1 IS NOT NULL")
    earliest = rest.groupBy("w1", "w2").agg(F.min(F.struct("k", "first")).alias("e"))
    later = rest.join(earliest, ["w1", "w2"]).where("k <> e.k OR first <> e.first").select("k", "first", "count")
    places = done.unionByName(later).groupBy("k").agg(
        F.collect_list("first").alias("firsts"), F.collect_list("count").alias("counts")
    )
    rows = table.join(places, "k", "left")
    fields = ("doc_id", "n_bytes", "whole_sha256", "text", "sure", "firsts", "counts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            cols = (batch.column(c).to_pylist() for c in fields)
            for doc, n, sha, text, sure, firsts, counts in zip(*cols, strict=True):
                if sure or firsts:
                    packed = np.array(sure or [], np.int64)
                    first = np.concatenate((packed >> 2 * _BITS, np.array(firsts or [], np.int64)))
                    count = np.concatenate((packed & _LOW, np.array(counts or [], np.int64)))
                    kept, runs = cut_repeats(text, first, count)
                    out.append((doc, n, n - len(kept), runs, hashlib.sha256(kept).hexdigest(), kept))
                else:
                    raw = text.encode("utf-8", "surrogatepass") if text is not None else None
                    out.append((doc, n, 0, 0, sha or hashlib.sha256(raw).hexdigest(), raw))
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 6 if with_text else 5]
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            cols = list(zip(*out, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols[: len(names)], kinds)], names=names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else "")
    return rows.select(*fields).mapInArrow(cut, schema)


ORACLE = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, s, substr(h, 2 * s + 1, {2 * MATCH}) AS x
      FROM (SELECT doc_id, h, unnest(range(0, n - {MATCH} + 1)) AS s FROM d)),
f AS (SELECT doc_id, s, row_number() OVER (PARTITION BY x ORDER BY doc_id, s) AS r FROM w),
g AS (SELECT doc_id, s, coalesce(s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) > {MATCH}, true) AS opens FROM f WHERE r > 1),
i AS (SELECT *, sum(CAST(opens AS INT)) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM g),
p AS (SELECT doc_id, min(s) AS a, max(s) + {MATCH} AS b FROM i GROUP BY doc_id, run),
q AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS z FROM p),
k AS (SELECT q.doc_id, count(*) AS n_spans, sum(b - a) AS gone, max(b) AS last,
        string_agg(substr(h, CAST(2 * z + 1 AS BIGINT), CAST(2 * (a - z) AS BIGINT)), '' ORDER BY a) AS head
      FROM q JOIN d ON d.doc_id = q.doc_id GROUP BY q.doc_id)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN k.doc_id IS NULL THEN h ELSE head || substr(h, CAST(2 * last + 1 AS BIGINT)) END)) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""
