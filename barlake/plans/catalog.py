"""All registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.ranking import percent_rank_average
from barlake.operators import indicators as ind
from barlake.plans import (  # noqa: F401
    catalog_crosssection,
    catalog_indicators,
    catalog_lifecycle,
    catalog_merges,
    catalog_minutes,
    catalog_outcomes,
    catalog_quality,
    catalog_screening,
    catalog_sources,
    catalog_streaming,
)
from barlake.plans.bindings import AS_OF_DATES, bars
from barlake.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flagship"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indicators and relative strength of every security as of each date."""
    rec = ind.indicators_as_of(bars(spark, sf_dir), AS_OF_DATES)
    ranked = percent_rank_average(rec, ["as_of"], "return_20d", "rps20")
    return ranked.select(
        "code", F.col("as_of").cast("string").alias("as_of"), "last_close", "ma5", "ma20", "ma60", "rsi14",
        "macd_hist", "atr14", "boll_position", "return_20d", "rps20",
    )
