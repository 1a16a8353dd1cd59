"""Token files: blocks of ids as compressed byte planes, with a chunk index.

The ids of all documents, in ascending order of ``doc_id``, form one stream for
each shard (a range of ids).  A stream is cut into blocks of a fixed number of
ids; a block is transposed into its four byte planes, each compressed with
zstandard by itself (the high planes of token ids are almost constant).  A block
and its index entry - place in the stream, number of ids, checksum, and which
part of which document lies where - are one row of a Parquet table, so files
live in any store and any block can be read alone.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.llm.common import bounded_batches, text_of
from barlake.llm.tokens import encoder

#: Ids of a block.
BLOCK = 1 << 16
LEVEL = 3

FORMAT = (
    "shard int, block int, first long, n_ids int, crc32 long, planes array<binary>, "
    "parts array<struct<ord:long,doc_id:long,start:long,n_tokens:long,offset:long,length:long>>"
)
_ARROW = pa.schema(
    [
        ("shard", pa.int32()),
        ("block", pa.int32()),
        ("first", pa.int64()),
        ("n_ids", pa.int32()),
        ("crc32", pa.int64()),
        ("planes", pa.list_(pa.binary())),
        (
            "parts",
            pa.list_(pa.struct([(x, pa.int64()) for x in ("ord", "doc_id", "start", "n_tokens", "offset", "length")])),
        ),
    ]
)


def to_planes(ids: bytes, compressor: zstandard.ZstdCompressor) -> list[bytes]:
    """Four compressed planes, lowest byte first, of little-endian 32-bit ids."""
    planes = np.frombuffer(ids, np.uint8).reshape(-1, 4).T
    return [compressor.compress(np.ascontiguousarray(p).tobytes()) for p in planes]


def from_planes(planes: list[bytes], n: int) -> bytes:
    out = np.empty((n, 4), np.uint8)
    for k, p in enumerate(planes):
        out[:, k] = np.frombuffer(zstandard.ZstdDecompressor().decompress(p, max_output_size=max(n, 1)), np.uint8)
    return out.tobytes()


def _times(matrix: list[int], vector: int) -> int:
    total, k = 0, 0
    while vector:
        if vector & 1:
            total ^= matrix[k]
        vector >>= 1
        k += 1
    return total


def _zero_bytes(powers: int = 40) -> list[list[int]]:
    """Operators that append 2**k zero bytes to a message, on its CRC-32 (reflected polynomial EDB88320)."""
    step = [0xEDB88320] + [1 << k for k in range(31)]
    out = []
    for k in range(powers + 3):
        if k >= 3:
            out.append(step)
        step = [_times(step, x) for x in step]
    return out


_ZEROS = _zero_bytes()


def crc_before(crc: int, n_bytes: int) -> int:
    """What a part with this checksum adds, by exclusive or, to the CRC-32 of a message with ``n_bytes`` more bytes."""
    k = 0
    while n_bytes:
        if n_bytes & 1:
            crc = _times(_ZEROS[k], crc)
        n_bytes >>= 1
        k += 1
    return crc


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, spaces: bool, block: int = BLOCK) -> None:
    """Encode every whole text (NULL: empty) and write the files; rows of one ``doc_id`` follow in order of their text.

    NULL ids come first.  An empty table writes an empty one.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    end = struct.pack("<I", end_id)
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, compressor = encoder(tokenizer, spaces), zstandard.ZstdCompressor(level=LEVEL)
        shard, number, done, ords = TaskContext.get().partitionId(), 0, 0, 0
        held, held_bytes, parts = [], 0, []

        def flush(n_bytes: int) -> pa.RecordBatch:
            nonlocal held, held_bytes, parts, number, done
            joined = b"".join(held)
            own, rest = joined[:n_bytes], joined[n_bytes:]
            row = {
                "shard": shard,
                "block": number,
                "first": done,
                "n_ids": len(own) // 4,
                "crc32": zlib.crc32(own),
                "planes": to_planes(own, compressor),
                "parts": parts,
            }
            number, done, held, held_bytes, parts = number + 1, done + len(own) // 4, [rest], len(rest), []
            return pa.RecordBatch.from_pylist([row], schema=_ARROW)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode.ids(text) + end
                n, start, offset = len(ids) // 4, done + held_bytes // 4, 0
                held.append(ids)
                held_bytes += len(ids)
                while offset < n:
                    take = min(n - offset, block - (start + offset - done))
                    parts.append({"ord": ords, "doc_id": doc, "start": start, "n_tokens": n, "offset": offset, "length": take})
                    offset += take
                    if start + offset - done == block:
                        yield flush(4 * block)
                ords += 1
        if held_bytes:
            yield flush(held_bytes)

    rows.mapInArrow(blocks, FORMAT).write.option("compression", "none").parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) by document, from the files; a damaged block fails."""
    bounded_batches(spark)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                ids = from_planes(row["planes"], row["n_ids"])
                if zlib.crc32(ids) != row["crc32"]:
                    raise ValueError(f"block {row['block']} of shard {row['shard']} is damaged")
                for p in row["parts"]:
                    a = 4 * (p["start"] + p["offset"] - row["first"])
                    crc = zlib.crc32(ids[a : a + 4 * p["length"]])
                    after = p["n_tokens"] - p["offset"] - p["length"]
                    out.append((row["shard"], p["ord"], p["doc_id"], p["start"], p["n_tokens"], crc_before(crc, 4 * after)))
            cols = list(zip(*out, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in cols], names=["shard", "ord", "doc_id", "start", "n_tokens", "crc"]
            )

    files = spark.read.schema(FORMAT).parquet(path)
    each = files.mapInArrow(parts, "shard long, ord long, doc_id long, start long, n_tokens long, crc long")
    docs = each.groupBy("shard", "ord", "doc_id", "start", "n_tokens").agg(F.bit_xor("crc").alias("ids_crc32"))
    # one row for each shard, that is for each task that wrote
    shards = files.groupBy("shard").agg(F.max(F.col("first") + F.col("n_ids")).alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shards.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))
    return docs.join(F.broadcast(offsets), "shard").select(
        "doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids_crc32"
    )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, offset, ids): the ids themselves, a row for each part of a document."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, offsets, ids = [], [], []
            for row in batch.to_pylist():
                flat = np.frombuffer(from_planes(row["planes"], row["n_ids"]), "<u4").astype(np.int64)
                for p in row["parts"]:
                    a = p["start"] + p["offset"] - row["first"]
                    docs.append(p["doc_id"])
                    offsets.append(p["offset"])
                    ids.append(flat[a : a + p["length"]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(offsets, pa.int64()), pa.array(ids, pa.list_(pa.int64()))],
                names=["doc_id", "offset", "ids"],
            )

    return spark.read.schema(FORMAT).parquet(path).mapInArrow(parts, "doc_id long, offset long, ids array<long>")
