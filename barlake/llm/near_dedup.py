"""Near-duplicate groups by BagMinHash.

A text is the multiset of its runs of five words; two texts are linked if the
weighted Jaccard similarity of their multisets is 0.8 or more, and a group is
what links connect.

*Signature.*  The weight axis of every run is cut into dyadic intervals [0, 1),
[1, 2), [2, 4), ...  Each interval has a Poisson process whose rate is its
length; a point has a time, a slot of the signature and a unit level inside the
interval, all from a hash of (run, interval, number of the point), and belongs
to a text if its level is below the weight there.  A slot holds the earliest
point; two texts agree in a slot with probability equal to their similarity.
Points are drawn only while they can still be earlier than the latest slot.

*Candidates.*  Slots are banded.  Copies of a text are one node.  In every
bucket the text that shares most buckets with others - in a group of copies with
changes of their own that is the one they come from - is compared with the
others; then one from outside its class; at the end every pair of a bucket whose
texts still are in different classes, unless what each has in common with the
bucket's leader, and what it has beyond it, leaves no room for the similarity.  So a bucket of n texts of one class costs
about n comparisons, and comparisons are spared only where a class already joins
two texts or where their signatures rule the similarity out: of four bits for each
slot, more than ``MOST_APART`` slots differ in one of 30,000 pairs with similarity
0.8, and in fewer above.

*Verification* counts the overlap of the two multisets.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.common import bounded_batches, text_of, written
from barlake.llm.tokens import Cache

WORDS = 5
SIMILARITY = 0.8
BANDS = 42
ROWS = 6
SLOTS = BANDS * ROWS
#: Slots whose bits may differ: 252 * 0.2 * 15 / 16 are expected at similarity 0.8, the standard deviation is 6.2.
MOST_APART = 72
PLANES = 4
#: Points drawn in one step for all runs of a batch, and the most of one run.
POINTS = 1 << 14
MOST_POINTS = 16
#: Rounds of comparing with one leader a bucket before the pairs that are left.
LEADER_ROUNDS = 3
#: Buckets of at least so many texts are measured against their leader before their pairs are formed.
CROWD = 8
#: Bits for the runs that a text has beyond its leader, in integers of 64.
BEYOND = 8

_WORD = re.compile(r"\w+")
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_STEP = np.uint64(0x9E3779B97F4A7C15)
_HASHES = Cache(lambda w: xxhash.xxh64_intdigest(w), 200_000)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of the runs of five words (lower case) and how often each occurs; fewer words are one run."""
    words = _WORD.findall((text or "").lower())
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    k = min(WORDS, len(h))
    n = len(h) - k + 1
    runs = np.full(n, k, np.uint64)
    for i in range(k):
        runs = _mix(runs * _STEP + h[i : i + n])
    return np.unique(runs, return_counts=True)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of the smaller over sum of the larger counts; two texts without words: 0."""
    _, at_a, at_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][at_a], b[1][at_b]).sum())
    either = int(a[1].sum() + b[1].sum()) - both
    return both / either if either else 0.0


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], slots: int = SLOTS) -> np.ndarray:
    """(bags, slots) times of the earliest points; an empty bag has infinite times."""
    owner, run, low, size, weight = [], [], [], [], []
    for k, (hashes, counts) in enumerate(bags):
        lo, length = 0, 1
        inside = counts > 0
        while inside.any():
            n = int(inside.sum())
            owner.append(np.full(n, k))
            run.append(hashes[inside])
            low.append(np.full(n, lo, np.int64))
            size.append(np.full(n, length, np.int64))
            weight.append(counts[inside])
            lo, length = lo + length, max(1, lo + length)
            inside = counts > lo
    first = np.full((len(bags), slots), np.inf)
    if not owner:
        return first
    owner, run, low, size, weight = map(np.concatenate, (owner, run, low, size, weight))
    state = _mix(run + low.astype(np.uint64) * _MIX[0])
    time = np.zeros(len(run))
    flat = first.reshape(-1)
    point = 0
    while len(run):
        # several points of each run at once where few runs are left; one too many changes no minimum
        many = min(max(POINTS // len(run), 1), MOST_POINTS)
        numbers = np.arange(point + 1, point + many + 1, dtype=np.uint64) * _STEP
        point += many
        a = _mix(state[:, None] + numbers)
        b = _mix(a + _STEP)
        gaps = np.log(((a >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / size[:, None]
        gaps[:, 0] = time + -gaps[:, 0]
        np.negative(gaps[:, 1:], out=gaps[:, 1:])
        times = np.cumsum(gaps, axis=1)
        slot = (b >> np.uint64(32)).astype(np.int64) * slots >> 32
        level = low[:, None] + ((b & np.uint64(0xFFFFFFFF)).astype(np.int64) * size[:, None] >> 32)
        real = level < weight[:, None]
        np.minimum.at(flat, (owner[:, None] * slots + slot)[real], times[real])
        time = times[:, -1]
        left = np.unique(owner)
        latest = np.empty(len(bags))
        latest[left] = first[left].max(axis=1)
        active = time < latest[owner]
        if not active.all():
            owner, state, time = owner[active], state[active], time[active]
            low, size, weight, run = low[active], size[active], weight[active], run[active]
    return first


def bands(signature: np.ndarray) -> np.ndarray:
    """(texts, BANDS) signed 64-bit bucket ids."""
    parts = signature.view(np.uint64).reshape(len(signature), BANDS, ROWS)
    out = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) + np.uint64(1), parts.shape[:2]).copy()
    for r in range(ROWS):
        out = _mix(out * _STEP + parts[:, :, r])
    return out.view(np.int64)


def bits(signature: np.ndarray) -> np.ndarray:
    """(texts, 16) integers: the first to fourth bits of all slots, four integers each."""
    mixed = _mix(signature.view(np.uint64)).reshape(len(signature), 4, SLOTS // 4)
    place = np.arange(SLOTS // 4, dtype=np.uint64)
    planes = [(((mixed >> np.uint64(k)) & np.uint64(1)) << place).sum(axis=2, dtype=np.uint64) for k in range(PLANES)]
    return np.concatenate(planes, axis=1).view(np.int64)


BITS = [f"b{i}" for i in range(4 * PLANES)]


def _signed(docs: DataFrame) -> DataFrame:
    """(uid, doc_id, key, bands, b0 ... b15): ``key`` is a digest of the text; texts without words have no bands."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            bags = [shingles(t) for t in pdf["t"]]
            first = signatures(bags)
            ids, one = bands(first), bits(first)
            yield pd.DataFrame(
                {
                    "uid": pdf["uid"],
                    "doc_id": pdf["doc_id"],
                    "key": pdf["key"],
                    "bands": [list(x) if len(bag[0]) else [] for x, bag in zip(ids, bags, strict=True)],
                }
                | {n: one[:, i] for i, n in enumerate(BITS)}
            )

    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"), "doc_id", F.md5(text_of()).alias("key"), text_of().alias("t")
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = f"uid long, doc_id {kind}, key string, bands array<long>, " + ", ".join(f"{n} long" for n in BITS)
    return written(rows.mapInPandas(sign, fields), "signatures")


def _maybe(a: str, b: str) -> Column:
    """Whether the signature bits in columns ``a``0 ... and ``b``0 ... allow for the similarity."""
    differ = [F.col(f"{a}{i}").bitwiseXOR(F.col(f"{b}{i}")) for i in range(4 * PLANES)]
    apart = [F.bit_count(reduce(Column.bitwiseOR, differ[i::4])) for i in range(4)]
    return apart[0] + apart[1] + apart[2] + apart[3] <= MOST_APART


def beyond(bag: tuple[np.ndarray, np.ndarray], lead: tuple[np.ndarray, np.ndarray]) -> tuple[int, ...]:
    """(size, inside, spare, bits ...): all runs of a text, those it shares with the leader and, of the others, how many have no bit of their own.

    Two texts share at most the smaller of their ``inside``, a run for each common bit and the smaller of their ``spare``.
    """
    _, here, there = np.intersect1d(bag[0], lead[0], assume_unique=True, return_indices=True)
    more, size = bag[1].copy(), int(bag[1].sum())
    more[here] -= np.minimum(bag[1][here], lead[1][there])
    extra = int(more.sum())
    places = np.unique(bag[0][more > 0] & np.uint64(64 * BEYOND - 1)).astype(np.int64)
    marks = np.zeros(64 * BEYOND, np.uint8)
    marks[places] = 1
    return (size, size - extra, extra - len(places), *np.packbits(marks, bitorder="little").view("<i8").tolist())


MEASURES = ["size", "inside", "spare", *[f"o{i}" for i in range(BEYOND)]]


def _measured(led: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, lead, size, inside, spare, o0 ...) for every (node, lead)."""

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, lead = None, None
        for pdf in batches:
            out = []
            for node, at, text, lead_text in zip(pdf["node"], pdf["lead"], pdf["text"], pdf["lead_text"], strict=True):
                if at != last:
                    last, lead = at, shingles(lead_text)
                out.append((node, at, *beyond(shingles(text), lead)))
            yield pd.DataFrame(out, columns=["node", "lead", *MEASURES])

    both = led.join(texts, "node").join(texts.select(F.col("node").alias("lead"), F.col("text").alias("lead_text")), "lead")
    return both.select("node", "lead", "text", "lead_text").mapInPandas(measure, "node long, lead long, " + ", ".join(f"{c} long" for c in MEASURES))


def _room() -> Column:
    """Whether the measures of two texts by one leader, the second ones in columns with ``2`` after their names, allow for the similarity."""
    common = sum((F.bit_count(F.col(f"o{i}").bitwiseAND(F.col(f"o{i}2"))) for i in range(BEYOND)), F.lit(0))
    most = F.least("inside", "inside2") + common + F.least("spare", "spare2")
    return F.coalesce((1 + SIMILARITY) * most >= SIMILARITY * (F.col("size") + F.col("size2")) - 1e-6, F.lit(True))


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes that are similar enough."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, bag = None, None
        for pdf in batches:
            good = []
            for a, ta, tb in zip(pdf["a"], pdf["ta"], pdf["tb"], strict=True):
                if a != last:
                    last, bag = a, shingles(ta)
                good.append(similarity(bag, shingles(tb)) >= SIMILARITY)
            yield pdf.loc[good, ["a", "b"]]

    both = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b").join(
        texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a"
    )
    return both.select("a", "b", "ta", "tb").mapInPandas(check, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of (a, b): the smallest node that it is connected with.

    Every node hooks to its smallest neighbour, the forest is flattened by
    pointer jumping and the edges move to the roots, until none is left.
    """
    left = written(edges.where("a <> b").distinct(), "edges")
    labels = left.select(F.col("a").alias("node")).union(left.select("b")).distinct().withColumn("comp", F.col("node"))
    labels = written(labels, "labels")
    while left.take(1):
        ways = left.union(left.select("b", "a"))
        parent = ways.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("p"))
        parent = written(parent.select(F.col("a").alias("c"), "p"), "parents")
        while True:
            up = parent.select(F.col("c").alias("p"), F.col("p").alias("pp"))
            jumped = written(parent.join(up, "p").select("c", F.col("pp").alias("p"), (F.col("pp") != F.col("p")).alias("moved")), "parents")
            parent = jumped.select("c", "p")
            if not jumped.where("moved").take(1):
                break
        labels = written(
            labels.join(parent.withColumnRenamed("c", "comp"), "comp", "left").select("node", F.coalesce("p", "comp").alias("comp")),
            "labels",
        )
        by = lambda x: parent.select(F.col("c").alias(x), F.col("p").alias(f"p{x}"))
        left = written(
            left.join(by("a"), "a").join(by("b"), "b").where("pa <> pb").select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct(),
            "edges",
        )
    return labels


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, class_size, kept, text_md5), one row for each row of ``docs``.

    ``class_id`` is the smallest ``doc_id`` of the class; the row with it is
    kept, of repeated rows one.  NULL texts count as empty; texts without any
    word are near to none but their own copies, texts of less than five words
    are one run.  A NULL id comes before others; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    signed = _signed(docs)
    # copies of a text are one node, named by its first row
    heads = signed.groupBy("key").agg(F.min(F.struct("uid", "doc_id")).alias("h"))
    heads = written(heads.select("key", F.col("h.uid").alias("node"), F.col("h.doc_id").alias("head_id")), "nodes")
    postings = (
        signed.join(heads.select(F.col("node").alias("uid")), "uid", "left_semi")
        .select(F.col("uid").alias("node"), F.explode("bands").alias("bucket"))
    )
    # a bucket with one text has no candidates
    crowded = postings.groupBy("bucket").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")
    postings = written(postings.join(crowded, "bucket"), "buckets")
    degrees = postings.groupBy("node").agg(F.sum("texts").alias("degree"))
    facts = signed.select(F.col("uid").alias("node"), "bands", *BITS).join(degrees, "node")
    postings = written(postings.select("node", "bucket").join(facts, "node"), "buckets")

    involved = postings.select("node").distinct().join(heads, "node")
    texts = docs.select(F.col("doc_id").alias("_id"), F.md5(text_of()).alias("_key"), text_of().alias("text"))
    texts = written(
        texts.join(involved, (F.col("_key") == F.col("key")) & F.col("_id").eqNullSafe(F.col("head_id")))
        .dropDuplicates(["node"])
        .select("node", "text"),
        "texts",
    )

    names = BITS

    def classes(edges: DataFrame) -> DataFrame:
        return postings.join(components(edges), "node", "left").withColumn("comp", F.coalesce("comp", "node"))

    tested = edges = None
    state = postings.withColumn("comp", F.col("node"))
    for turn in range(LEADER_ROUNDS + 1):
        if turn < LEADER_ROUNDS:
            # the most connected text leads; later one of the class that holds fewest of the bucket's texts
            if turn:
                sizes = state.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("own"))
                spread = state.join(sizes, ["bucket", "comp"]).withColumn("first", -F.col("own"))
            else:
                spread = state.withColumn("first", F.lit(0).cast("long"))
            lead = spread.groupBy("bucket").agg(F.max(F.struct("first", "degree", "node", "comp", *names)).alias("l"))
            lead = lead.select(
                "bucket", F.col("l.node").alias("lead"), F.col("l.comp").alias("lead_comp"), *[F.col(f"l.{n}").alias(f"l{n}") for n in names]
            )
            pairs = state.join(lead, "bucket").where((F.col("comp") != F.col("lead_comp")) & _maybe("b", "lb"))
            pairs = pairs.select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b"))
        else:
            # the most connected text of a bucket leads it, as in the first round
            open_buckets = state.groupBy("bucket").agg(
                F.min("comp").alias("x"), F.max("comp").alias("y"), F.count(F.lit(1)).alias("texts"), F.max(F.struct("degree", "node")).alias("l")
            )
            open_buckets = open_buckets.where("x <> y").select("bucket", F.when(F.col("texts") >= CROWD, F.col("l.node")).alias("lead"))
            near = written(state.join(open_buckets, "bucket"), "open")
            measures = written(_measured(near.where("lead is not null").select("node", "lead").distinct(), texts), "measures")
            near = written(near.join(measures, ["node", "lead"], "left"), "open")
            other = near.select(
                "bucket",
                F.col("node").alias("n2"),
                F.col("comp").alias("c2"),
                F.col("bands").alias("o_bands"),
                *[F.col(n).alias(f"o{n}") for n in names],
                *[F.col(n).alias(f"{n}2") for n in MEASURES],
            )
            near = near.alias("s")
            # two texts often share several buckets; only the first of these gives the pair
            shared = F.filter(F.zip_with("bands", "o_bands", lambda x, y: F.when(x == y, x)), lambda x: x.isNotNull())
            pairs = near.join(
                other.alias("o"),
                (F.col("s.bucket") == F.col("o.bucket"))
                & (F.col("comp") < F.col("c2"))
                & F.when(_maybe("b", "ob"), F.get(shared, F.lit(0)) == F.col("s.bucket")).otherwise(False)
                & _room(),
            )
            pairs = pairs.select(F.least("node", "n2").alias("a"), F.greatest("node", "n2").alias("b"))
        pairs = pairs.distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        tested = pairs if tested is None else tested.union(pairs)
        if not pairs.take(1):
            continue
        found = written(_verified(pairs, texts), "links")
        edges = found if edges is None else edges.union(found)
        if turn < LEADER_ROUNDS and found.take(1):
            state = written(classes(edges), "classes")
    if edges is None:
        edges = tested
    comps = components(edges)
    placed = signed.select("uid", "doc_id", "key").join(heads.select("key", "node"), "key")
    placed = placed.join(comps, "node", "left").select("uid", "doc_id", "key", F.coalesce("comp", "node").alias("comp"))
    placed = written(placed, "placed")
    whole = written(
        placed.groupBy("comp").agg(F.min(F.struct("doc_id", "uid")).alias("first"), F.count(F.lit(1)).alias("class_size")), "sizes"
    )
    return placed.join(whole, "comp").select(
        "doc_id",
        F.col("first.doc_id").alias("class_id"),
        "class_size",
        (F.col("uid") == F.col("first.uid")).alias("kept"),
        F.col("key").alias("text_md5"),
    )


def keep_one_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    kept = near_duplicates(docs).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_md5").alias("_kept"))
    rows = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("_row"), F.col("doc_id").alias("_doc"), F.md5(text_of()).alias("_md5")
    )
    again = Window.partitionBy("_doc", "_md5").orderBy("_row")
    return (
        rows.join(kept, (F.col("_kept") == F.col("_md5")) & F.col("_id").eqNullSafe(F.col("_doc")), "left_semi")
        .withColumn("_nth", F.row_number().over(again))
        .where("_nth = 1")
        .select("_row.*")
    )


ORACLE = f"""
WITH RECURSIVE t AS (
  SELECT doc_id, coalesce(text, '') AS x, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS node FROM documents),
w AS (SELECT doc_id AS node, regexp_extract_all(lower(x), '[\\p{{L}}\\p{{N}}_]+') AS ws FROM t WHERE doc_id = node),
s AS (SELECT node, unnest(list_transform(range(1, greatest(len(ws) - {WORDS - 1}, 1) + 1),
        lambda i: array_to_string(ws[i : i + {WORDS - 1}], ' '))) AS run FROM w WHERE len(ws) > 0),
c AS (SELECT node, run, count(*) AS n FROM s GROUP BY node, run),
m AS (SELECT node, sum(n) AS n FROM c GROUP BY node),
o AS (SELECT a.node AS a, b.node AS b, sum(least(a.n, b.n)) AS common FROM c a JOIN c b ON a.run = b.run AND a.node < b.node GROUP BY 1, 2),
e AS (SELECT o.a, o.b FROM o JOIN m x ON x.node = o.a JOIN m y ON y.node = o.b
      WHERE CAST(common AS DOUBLE) / CAST(x.n + y.n - common AS DOUBLE) >= {SIMILARITY}),
l AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT a AS node, a AS other FROM l UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.other),
k AS (SELECT node, min(other) AS comp FROM r GROUP BY node),
g AS (SELECT t.doc_id, t.x, coalesce(k.comp, t.node) AS comp FROM t LEFT JOIN k ON k.node = t.node),
z AS (SELECT comp, min(doc_id) AS class_id, count(*) AS class_size FROM g GROUP BY comp)
SELECT g.doc_id, z.class_id, z.class_size, g.doc_id = z.class_id AS kept, md5(g.x) AS text_md5
FROM g JOIN z ON z.comp = g.comp
"""
