from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

#: Columns of ``documents`` and some that operators use as names of their own.
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("kept", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("n_words", T.StringType()),
        T.StructField("spans", T.StringType()),
        T.StructField("slot", T.LongType()),
        T.StructField("k", T.LongType()),
    ]
)


def texts() -> list[tuple[int | None, str | None, str | None]]:
    """(doc_id, text, source): NULLs, empty, very short and very long texts, copies, near copies, odd white space."""
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 9))) for _ in range(800)]
    prose = lambda n: " ".join(rnd.choice(words) for _ in range(n)).capitalize() + "."
    base = [prose(rnd.randint(30, 220)) for _ in range(30)]
    out = [(k, t, f"s{k % 3}") for k, t in enumerate(base)]
    out += [(40 + k, base[0] if k % 2 else base[0].upper(), "s0") for k in range(9)]
    near = base[1].split()
    for k in range(6):
        changed = list(near)
        changed[rnd.randrange(len(near))] = "zzz"
        out.append((60 + k, " ".join(changed), "s1"))
    passage = prose(40)
    out += [(70 + k, prose(20) + "\n" + passage + "\n" + prose(20), None) for k in range(5)]
    odd = [None, "", " ", "\n\n", "a", "one two three", "ÄÖÜ straße é̀ 中文 😀\n\nx y\ttab  two", "aaaa " * 200, "x" * 5000, "<|endoftext|> it's 12 34"]
    out += [(80 + k, t, "s2") for k, t in enumerate(odd)]
    out += [(95, "Mail a.b@c.example.org or +1 (017) 555-7713, card 4111 1111 1111 1111, ip 10.0.0.255 and 1.2.3.256.", "s2")]
    out += [(96, "IBAN GB82 WEST 1234 5698 7654 32 and GB82 WEST 1234 5698 7654 33; ssn: 123-45-6789, no 123-45-6789.", "s2")]
    out += [(97, prose(6000), "s0"), (97, base[2], "s0"), (97, base[2], "s0"), (None, base[3], None), (None, "", None)]
    return out


def as_rows(cases: list[tuple]) -> list[tuple]:
    return [(i, t, None, s, None, "x", None, 7, "y", None, None, 1) for i, t, s in cases]


@pytest.fixture(scope="session")
def cases() -> list[tuple]:
    return texts()


@pytest.fixture(scope="session")
def docs(spark, cases, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(as_rows(cases), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "documents.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)
