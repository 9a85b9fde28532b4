"""The queries of this subpackage and, where SQL can express them, their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparvane.llm import bpe, collocations, decontaminate, fim, html_text, oracles, packing, quality, sharding, suffix_dedup, toxicity, warc, winnowing
from sparvane.llm.common import documents, pages
from sparvane.llm.simhash import simhash_components


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(documents(spark, sf_dir))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(documents(spark, sf_dir))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(pages(spark, sf_dir))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(documents(spark, sf_dir))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(documents(spark, sf_dir))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.fingerprints(documents(spark, sf_dir))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digests(pages(spark, sf_dir))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_simhash, op2_packing, op3_decontaminate, op4_sharding, op5_html_text, op6_quality, op7_toxicity, op8_suffix_dedup, op9_fingerprints, op10_warc, op11_byte_bpe, op12_collocations, op13_fill_in_middle)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op4_sharding": oracles.sharding(), "op8_suffix_dedup": oracles.suffix_dedup(), "op12_collocations": oracles.collocations(), "op13_fill_in_middle": oracles.fill_in_middle()}
