"""Exact deduplication by deterministic block naming.

A normalised text is cut into blocks of a fixed number of bytes.  Blocks are
sorted and every distinct block gets an integer name; then adjacent names are
paired and the pairs named in the same way, until one name stands for the whole
text.  Names are ranks of sorted values, not hashes: two texts with the same
number of blocks have the same name exactly when they are equal.

To rank without sorting everything in one task, values are dealt by a hash to a
fixed number of buckets and ranked inside their bucket; ``rank * buckets +
bucket`` is unique over all of them.  The text moves through one shuffle only.
A block that occurs very often is counted beforehand and dealt to several
buckets; its few names are unified afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.common import ascii_lower, text_of, written

#: Bytes of a block.
BLOCK = 8192
#: Ranges of ranks; a bucket of 100 TB in 8 KiB blocks holds about 12,000 blocks.
BUCKETS = 1 << 20
#: A block is dealt to several buckets if it occurs more often than this and than 1 / HOT_SHARE of all blocks.
HOT_LEAST = 1000
HOT_SHARE = 2000


def _ranked(value: list[str], bucket: str) -> Column:
    rank = F.dense_rank().over(Window.partitionBy(bucket).orderBy(*value))
    return (rank.cast("long") - 1) * BUCKETS + F.col(bucket)


def _blocks(docs: DataFrame, block: int) -> DataFrame:
    """(uid, doc_id, sha, n, idx, block); the digest travels with the first block."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col("doc_id"),
        ascii_lower(text_of()).cast("binary").alias("bin"),
    ).withColumn("n", F.greatest(F.lit(1), F.ceil(F.octet_length("bin") / block)).cast("int"))
    at = F.transform(
        F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.substring(F.col("bin"), i * block + F.lit(1), F.lit(block))
    )
    return rows.select("uid", "doc_id", "n", F.sha2("bin", 256).alias("sha"), F.posexplode(at).alias("idx", "block")).select(
        "uid", "n", "idx", "block", F.when(F.col("idx") == 0, F.col("doc_id")).alias("doc_id"), F.when(F.col("idx") == 0, F.col("sha")).alias("sha")
    )


def _hot_blocks(docs: DataFrame, block: int) -> DataFrame:
    """(h, salts) of very frequent blocks: at most HOT_SHARE rows, because their counts add up to all blocks."""
    text = docs.select(ascii_lower(text_of()).cast("binary").alias("bin")).withColumn(
        "n", F.greatest(F.lit(1), F.ceil(F.octet_length("bin") / block)).cast("int")
    )
    hashes = text.select(
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.col("n") - 1),
                lambda i: F.xxhash64(F.substring(F.col("bin"), i * block + F.lit(1), F.lit(block))),
            )
        ).alias("h")
    )
    counts = written(hashes.groupBy("h").count(), "block-counts")
    total = counts.agg(F.sum("count")).first()[0] or 0
    limit = max(HOT_LEAST, total // HOT_SHARE)
    return counts.where(F.col("count") > limit).select("h", F.ceil(F.col("count") / limit).cast("int").alias("salts"))


def identities(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(uid, doc_id, sha, n, name), one row per row of ``docs``: (n, name) is equal exactly for equal normalised texts."""
    hot = _hot_blocks(docs, block)
    rows = (
        _blocks(docs, block)
        .withColumn("h", F.xxhash64("block"))
        .join(F.broadcast(hot), "h", "left")
        .withColumn("salt", F.when(F.col("salts").isNotNull(), F.pmod(F.xxhash64("uid"), F.col("salts"))).otherwise(0))
        .withColumn("bucket", F.pmod(F.xxhash64("h", "salt"), F.lit(BUCKETS)))
    )
    order = Window.partitionBy("bucket").orderBy("block")
    first = F.lag("block").over(order).eqNullSafe(F.col("block"))
    named = rows.select(
        "uid",
        "n",
        "idx",
        "doc_id",
        "sha",
        _ranked(["block"], "bucket").alias("name"),
        F.when(F.col("salts").isNotNull() & ~first, F.col("block")).alias("hot_block"),
    )
    level = written(named, "block-names")
    # the names of a frequent block become one; at most a few for each of HOT_SHARE blocks
    several = level.where(F.col("hot_block").isNotNull()).select("hot_block", "name")
    one = several.groupBy("hot_block").agg(F.min("name").alias("one"))
    unify = several.join(one, "hot_block").select("name", "one").distinct()
    base = level.drop("hot_block").join(F.broadcast(unify), "name", "left")
    base = base.withColumn("name", F.coalesce("one", "name")).drop("one")

    whole = base.where(F.col("n") == 1).select("uid", "doc_id", "sha", "n", "name")
    longest = level.agg(F.max("n")).first()[0] or 1
    current, tops = base.where(F.col("n") > 1).select("uid", "n", "idx", "name", F.col("n").alias("left_n")), []
    while longest > 1:
        pairs = (
            current.groupBy("uid", "n", "left_n", F.shiftright("idx", 1).alias("half"))
            .agg(
                F.max(F.when(F.col("idx") % 2 == 0, F.col("name"))).alias("a"),
                F.max(F.when(F.col("idx") % 2 == 1, F.col("name"))).alias("b"),
            )
            .withColumn("b", F.coalesce("b", F.lit(-1)))
        )
        names = (
            pairs.select("a", "b")
            .distinct()
            .withColumn("bucket", F.pmod(F.xxhash64("a", "b"), F.lit(BUCKETS)))
            .select("a", "b", _ranked(["a", "b"], "bucket").alias("name"))
        )
        step = written(
            pairs.join(names, ["a", "b"]).select(
                "uid", "n", F.col("half").alias("idx"), "name", F.ceil(F.col("left_n") / 2).cast("int").alias("left_n")
            ),
            "pair-names",
        )
        tops.append(step.where(F.col("left_n") == 1).select("uid", "name"))
        current = step.where(F.col("left_n") > 1)
        longest = (longest + 1) // 2
    if tops:
        top = tops[0]
        for more in tops[1:]:
            top = top.unionByName(more)
        heads = base.where((F.col("n") > 1) & (F.col("idx") == 0)).select("uid", "doc_id", "sha", "n")
        whole = whole.unionByName(heads.join(top, "uid").select("uid", "doc_id", "sha", "n", "name"))
    return whole


def exact_dedup(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of ``docs``.

    NULL texts count as empty; texts are equal if identical after lower-casing
    A-Z.  The row with the largest ``doc_id`` stays, of repeated rows with that
    id one, NULL ids before no other.  An empty table gives no rows; columns
    other than ``doc_id`` and ``text`` are ignored.
    """
    ids = written(identities(docs, block), "identities")
    groups = ids.groupBy("n", "name").agg(
        F.max(F.struct("doc_id", "uid")).alias("top"), F.count(F.lit(1)).alias("group_size")
    )
    return ids.join(groups, ["n", "name"]).select(
        "doc_id",
        F.col("top.doc_id").alias("keep_id"),
        "group_size",
        (F.col("uid") == F.col("top.uid")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def keep_one_each(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    kept = exact_dedup(docs, block).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_kept"))
    rows = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("_row"),
        F.col("doc_id").alias("_doc"),
        F.sha2(ascii_lower(text_of()).cast("binary"), 256).alias("_sha"),
    )
    again = Window.partitionBy("_doc", "_sha").orderBy("_row")
    return (
        rows.join(kept, (F.col("_kept") == F.col("_sha")) & F.col("_id").eqNullSafe(F.col("_doc")), "left_semi")
        .withColumn("_nth", F.row_number().over(again))
        .where("_nth = 1")
        .select("_row.*")
    )


ORACLE = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g ON t.norm = g.norm
"""
