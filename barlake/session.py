"""Session defaults and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings every barlake job expects.  They are runtime (SQL) settings, so they
#: can also be applied to a session that a cluster has already created.
SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "barlake") -> SparkSession:
    """A single-JVM session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BARLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # call-site tracking costs two JVM round trips per column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in SQL_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table once to the shared scratch location and read it back.

    Used where several branches of one job need the same expensive input: it is
    computed once, its size is known to the planner afterwards, and losing an
    executor costs nothing because the files are shared.
    """
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_LOCAL_BASE: list[str] = []


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint location.

    The cluster names the location in ``spark.checkpoint.dir``.  Where it is
    unset, a temporary folder takes its place if driver and executors are one
    process; on a cluster that is an error, because executors would not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if not _LOCAL_BASE:
            _LOCAL_BASE.append(tempfile.mkdtemp(prefix="spark-"))
        base = _LOCAL_BASE[0]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Before Python work: workers import this package by name, so hand it to them once for each application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="spark-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)
