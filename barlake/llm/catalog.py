"""Registered queries of the corpus operators and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from barlake.llm import (
    collocations,
    exact_dedup,
    html_extraction,
    mixing,
    near_dedup,
    packing,
    pii,
    quality,
    repeats,
    resampling,
    token_counts,
    token_files,
    toxicity,
)
from barlake.llm.common import documents
from barlake.session import scratch_dir


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(documents(spark, sf_dir)))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(documents(spark, sf_dir))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "token-files")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    token_files.write_tokens(documents(spark, sf_dir), path, tokenizer, end_id=1, spaces=False)
    return token_files.read_documents(spark, path)


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(documents(spark, sf_dir), tokenizer, end_id=0, spaces=True)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_pii": op2_pii,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_token_counts": op4_token_counts,
    "op5_mixing": op5_mixing,
    "op6_repeats": op6_repeats,
    "op7_token_files": op7_token_files,
    "op8_near_dedup": op8_near_dedup,
    "op9_packing": op9_packing,
    "op10_toxicity": op10_toxicity,
    "op11_html_extraction": op11_html_extraction,
    "op12_resampling": op12_resampling,
    "op13_collocations": op13_collocations,
}

ORACLES: dict[str, str] = {
    "op3_exact_dedup": exact_dedup.ORACLE,
    "op5_mixing": mixing.ORACLE,
    "op6_repeats": repeats.ORACLE,
    "op8_near_dedup": near_dedup.ORACLE,
    "op13_collocations": collocations.ORACLE,
}
