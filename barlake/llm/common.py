"""What the corpus operators share: inputs, bounded Arrow batches, scratch tables."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import barlake
from barlake.session import materialize

#: Rows and bytes of one Arrow batch handed to a Python worker.
BATCH_ROWS = 128
BATCH_BYTES = 8 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


_SHIPPED: set[str] = set()


def _ship_package(spark: SparkSession) -> None:
    """Python workers import this package by name: hand it to them once for each application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(barlake.__file__).parent.parent
    archive = Path(tempfile.mkdtemp(prefix="spark-")) / "barlake.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(root.glob("barlake/**/*.py")):
            z.write(source, source.relative_to(root))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def bounded_batches(spark: SparkSession) -> None:
    """Before Python work: small Arrow batches, so that a batch of very long texts still fits a worker."""
    _ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: computed once, safe when executors are lost."""
    return materialize(df.sparkSession, df, name)


def text_of(column: str = "text") -> Column:
    """The text; NULL counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character as it is; ASCII-only texts take the faster built-in."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower())
    )
