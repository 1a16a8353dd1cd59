"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree: nodes with equal labels (tag, class,
id) below the same branch are one.  A node gathers its presentation styles (the
sequences of child labels) and its contents (texts, links, images) with the number
of times that pages show them.

*Importance.*  With m pages showing a node, the presentation importance is the
entropy of its styles to base m, the content importance one minus the mean over
its contents of the entropy of a content's places to base m: what every page
shows alike weighs 0, what each page has for itself 1.  A node has the larger of
the two, a branch the largest of its nodes, since a branch is only noise if all of
it is.  Few pages prove little: a branch counts as ``EVIDENCE`` more pages of
importance 1.

*Extraction.*  Every page loses its branches of low importance.  What the page's own
markup rules out (menus, forms, adverts by name and so on) goes as well, since a
tree of one page knows no noise; inside a declared article only branches with a
class or an id are judged, and a page of which the tree would leave nothing at
all keeps what its markup does not rule out.

Pages are parsed once.  Only hashes are aggregated, by node, so no host meets in
one task; a host's list of low branches is joined to its pages.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import bounded_batches, written
from barlake.llm.page_tree import branches, features, judged_blocks, parse
from barlake.session import scratch_dir

#: Branches below are noise.
IMPORTANCE = 0.7
#: As many pages of importance 1 are added to every branch.
EVIDENCE = 8

_PARSED = (
    "page_id {kind}, url string, host string, "
    "blocks array<struct<text:string,noise:boolean,nodes:array<long>>>, "
    "nodes array<struct<node:long,above:array<long>>>, "
    "features array<struct<node:long,kind:int,feature:long,n:long>>"
)


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def parsed(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, blocks, nodes, features) of every page."""
    bounded_batches(pages.sparkSession)
    block = pa.struct([("text", pa.string()), ("noise", pa.bool_()), ("nodes", pa.list_(pa.int64()))])
    node = pa.struct([("node", pa.int64()), ("above", pa.list_(pa.int64()))])
    feature = pa.struct([("node", pa.int64()), ("kind", pa.int32()), ("feature", pa.int64()), ("n", pa.int64())])

    def column(rows: list[list[tuple]], kind: pa.StructType) -> pa.Array:
        return pa.array([[dict(zip(kind.names, r, strict=True)) for r in row] for row in rows], pa.list_(kind))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts = [host_of(url) for url in batch.column(1).to_pylist()]
            trees = [parse(source, host) for source, host in zip(batch.column(2).to_pylist(), hosts, strict=True)]
            columns = [
                batch.column(0),
                batch.column(1),
                pa.array(hosts, pa.string()),
                column([judged_blocks(t) for t in trees], block),
                column([branches(t) for t in trees], node),
                column([features(t) for t in trees], feature),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "host", "blocks", "nodes", "features"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(read, _PARSED.format(kind=kind))


def importance(pages: DataFrame) -> DataFrame:
    """(host, node, up, m, importance): every branch of the trees of all hosts, from ``parsed`` pages."""
    each = pages.select(F.explode("features").alias("f")).select("f.*")
    seen = each.groupBy("node", "kind", "feature").agg(
        F.sum("n").alias("c"), F.sum(F.col("n") * F.log(F.col("n").cast("double"))).alias("s")
    )
    c = F.col("c").cast("double")
    style, content = F.col("kind") == 0, F.col("kind") == 1
    sums = seen.groupBy("node").agg(
        F.sum(F.when(style, c)).alias("styles"),
        F.sum(F.when(style, c * F.log(c))).alias("style_logs"),
        F.sum(F.when(content, F.log(c) - F.col("s") / c)).alias("spread"),
        F.count(F.when(content, 1)).alias("contents"),
    )
    places = pages.select("host", F.explode("nodes").alias("f")).select("host", "f.*")
    places = places.groupBy("node").agg(F.min("host").alias("host"), F.max("above").alias("above"), F.count(F.lit(1)).alias("pages"))
    nodes = places.join(sums, "node")
    m = F.col("pages").cast("double")
    base = F.log(F.greatest(m, F.lit(2.0)))
    presentation = (F.log("styles") - F.col("style_logs") / F.col("styles")) / base
    contents = F.when(F.col("contents") > 0, 1 - F.col("spread") / F.col("contents") / base).otherwise(0.0)
    own = F.when(m < 2, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(presentation, contents, F.lit(0.0))))
    nodes = nodes.select("host", "node", "above", m.alias("m"), ((EVIDENCE + m * own) / (EVIDENCE + m)).alias("own"))
    branch = nodes.select(F.explode(F.concat(F.array("node"), "above")).alias("node"), "own")
    branch = branch.groupBy("node").agg(F.max("own").alias("importance"))
    return nodes.join(branch, "node").select("host", "node", F.get("above", F.lit(0)).alias("up"), "m", "importance")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks, n_low, n_ruled_out), one row for each row of ``pages``.

    ``n_blocks`` are blocks of text, ``n_low`` those in branches of low
    importance, ``n_ruled_out`` those that only the page's markup rules out.
    NULL and empty pages have an empty text; pages with a NULL or broken url share
    a tree.  Repeated rows count as pages of their own, an empty table gives no
    rows, other columns are ignored.
    """
    path = scratch_dir(pages.sparkSession, "parsed-pages")
    parsed(pages).write.option("compression", "zstd").parquet(path)
    read = pages.sparkSession.read.parquet(path)
    low = importance(read).where(F.col("importance") < IMPORTANCE)
    # as a table its size is known: pages move only if the lists of all hosts are too large to send around
    low = written(low.groupBy("host").agg(F.collect_list("node").alias("low")), "low-branches").withColumnRenamed("host", "_host")
    judged = read.select("page_id", "url", "host", "blocks").join(low, F.col("host") == F.col("_host"), "left")
    judged = judged.withColumn("low", F.coalesce("low", F.array().cast("array<long>")))
    judged = judged.withColumn(
        "b",
        F.transform(
            "blocks",
            lambda b: F.struct(b["text"].alias("text"), b["noise"].alias("noise"), F.arrays_overlap(b["nodes"], F.col("low")).alias("low")),
        ),
    )
    judged = judged.withColumn("kept", F.filter("b", lambda b: ~b["noise"] & ~b["low"]))
    judged = judged.withColumn("kept", F.when(F.size("kept") > 0, F.col("kept")).otherwise(F.filter("b", lambda b: ~b["noise"])))
    judged = judged.withColumn("text", F.array_join(F.transform("kept", lambda b: b["text"]), "\n"))
    return judged.select(
        "page_id",
        "url",
        "text",
        F.char_length("text").cast("long").alias("n_chars"),
        F.size("b").cast("long").alias("n_blocks"),
        F.size(F.filter("b", lambda b: b["low"])).cast("long").alias("n_low"),
        F.size(F.filter("b", lambda b: b["noise"] & ~b["low"])).cast("long").alias("n_ruled_out"),
    )
