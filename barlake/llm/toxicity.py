"""Toxicity: non-negative positive-unlabelled learning.

The classifier is linear over the character runs of several lengths inside words
that a text has (hashed; how often does not matter).  It is trained with numpy from
confirmed toxic texts (P) and texts of unknown kind (U), by the class-prior
corrected risk

    prior * R_P(+) + max(0, R_U(-) - prior * R_P(-))

where the part in max() estimates the risk on clean texts and, when it turns
negative, is walked back instead of forwards.  Labels are used as confirmations
and for the class prior only; a label 0 is never an example of a clean text.

P and U are bounded samples (``POSITIVES``, ``UNLABELLED`` rows, taken by a hash
of the id); every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import bounded_batches, text_of

#: Size of the samples that are trained on.
POSITIVES = 2000
UNLABELLED = 6000
#: Hashed character runs, and how many of them the model uses.
DIMS = 1 << 18
FEATURES = 2048
#: Lengths of the runs; a word's start and end count as a character.
RUNS = (4, 6, 8)
#: A run is used if it is this much more frequent in P than in U, and in this many texts of P.
LIFT = 2.0
LEAST = 3
STEPS = 400
RATE = 0.05
DECAY = 1e-4
THRESHOLD = 0.7

_LETTER = np.array([chr(c).isalpha() for c in range(0x250)])


def runs(text: str) -> np.ndarray:
    """Sorted hashes of the character runs of a text; other characters than letters count as a word end."""
    code = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    code = np.where(_LETTER[np.minimum(code, 0x24F).astype(np.int64)] | (code > 0x24F), code, 0)
    found = np.zeros(DIMS, bool)
    space = np.concatenate(([0], np.cumsum(code == 0)))
    h = np.zeros(len(code), np.uint64)
    for k in range(max(RUNS)):
        n = len(code) - k
        if n <= 0:
            break
        h = h[:n] * np.uint64(0x9E3779B97F4A7C15) + code[k:] + np.uint64(1)
        if k + 1 in RUNS:
            inside = space[k : k + n] == space[1 : n + 1]
            mixed = (h[inside] ^ (h[inside] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            found[(mixed >> np.uint64(64 - DIMS.bit_length() + 1)).astype(np.int64)] = True
    return np.flatnonzero(found)


@dataclass
class Model:
    """``table`` has the weight of every hashed run, 0 where the model does not use it."""

    table: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.table[runs(text)].sum() + self.bias, -30, 30))))


def _matrix(texts: list[np.ndarray], features: np.ndarray) -> np.ndarray:
    out = np.zeros((len(texts), len(features)), np.float32)
    column = np.full(DIMS, -1)
    column[features] = np.arange(len(features))
    for k, found in enumerate(texts):
        at = column[found]
        out[k, at[at >= 0]] = 1
    return out


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Model:
    """Minimise the non-negative risk with the logistic loss (Adam, full batches)."""
    if not positive or not unlabelled:
        return Model(np.zeros(DIMS), -30.0)
    prior = min(max(prior, 1e-3), 0.9)
    in_p = np.bincount(np.concatenate(positive), minlength=DIMS)
    in_u = np.bincount(np.concatenate(unlabelled), minlength=DIMS)
    lift = (in_p / len(positive)) / ((in_u + 1) / (len(unlabelled) + 1))
    usable = np.flatnonzero((in_p >= min(LEAST, len(positive))) & (lift >= LIFT))
    worth = in_p[usable] * np.log(lift[usable])
    features = np.sort(usable[np.argsort(-worth, kind="stable")[:FEATURES]])
    p, u = _matrix(positive, features), _matrix(unlabelled, features)
    w, b = np.zeros(len(features), np.float32), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(features) + 1), np.zeros(len(features) + 1)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for t in range(1, STEPS + 1):
        zp, zu = p @ w + b, u @ w + b
        sp, su = sigmoid(zp), sigmoid(zu)
        clean = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        gp_plus = prior * (sp - 1) / len(p)
        gu, gp_minus = su / len(u), -prior * sp / len(p)
        if clean >= 0:
            at_p, at_u = gp_plus + gp_minus, gu
        else:
            at_p, at_u = -gp_minus, -gu
        g = np.append(p.T @ at_p + u.T @ at_u + DECAY * w, at_p.sum() + at_u.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = (w - step[:-1]).astype(np.float32), b - float(step[-1])
    table = np.zeros(DIMS)
    table[features] = w
    return Model(table, b)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; rows with 1 are held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the rows that are not held out; no positives: everything scores next to 0."""
    spark = docs.sparkSession
    bounded_batches(spark)
    known = (
        labels.where((fold(F.col("doc_id")) != 1) & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    prior = known.agg(F.avg("toxic")).first()[0] or 0.0
    by_hash = F.xxhash64("doc_id")
    # two samples of a fixed number of ids
    confirmed = known.where("toxic = 1").orderBy(by_hash, "doc_id").limit(POSITIVES).select("doc_id", F.lit(True).alias("_p"))
    anyone = (
        docs.where(fold(F.col("doc_id")) != 1).select("doc_id").orderBy(by_hash, "doc_id").limit(UNLABELLED).distinct()
    ).withColumn("_u", F.lit(True))
    wanted = confirmed.join(anyone, "doc_id", "full")
    chosen = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(wanted), "doc_id")

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame(
                {
                    "doc_id": pdf["doc_id"],
                    "p": pdf["_p"].notna(),
                    "u": pdf["_u"].notna(),
                    "found": [runs(t).astype("<i4").tobytes() for t in pdf["text"]],
                }
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = chosen.mapInPandas(features, f"doc_id {kind}, p boolean, u boolean, found binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["found"])))
    as_array = lambda r: np.frombuffer(r["found"], "<i4").astype(np.int64)
    return fit([as_array(r) for r in rows if r["p"]], [as_array(r) for r in rows if r["u"]], float(prior))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row for each row of ``docs``.

    NULL texts count as empty; an empty text gets the score of a text without
    any marked run.  A NULL id is not held out and never trained on.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(train(docs, labels))

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = model.value
        for texts in batches:
            yield texts.map(own.score).astype("float64")

    scored = docs.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"),
        F.pandas_udf(score, "double")(text_of()).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
