"""Queries over the synthetic text tables, one for each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm import (
    clustering, decontaminate, html_extract, licenses, mixing, oracle, packing, prefix_trie, quality, secrets_crf, sharding, simhash, toxicity, urls,
)

from colloquy.session import settled


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of each document."""
    return settled(spark, "secrets", lambda: secrets_crf.report(_table(spark, sf_dir, "documents")))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contaminated documents with the benchmark items they contain."""
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from each document."""
    return mixing.report(_table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of each document."""
    return simhash.report(_table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of each document."""
    return quality.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of each page."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages).select("page_id", "host", "path", "rule", "verdict")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each document."""
    return settled(spark, "toxicity", lambda: toxicity.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each page."""
    return html_extract.extract(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence labels of each document."""
    return settled(spark, "licenses", lambda: licenses.report(_table(spark, sf_dir, "documents")))


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of each document."""
    return settled(spark, "shards", lambda: sharding.report(_table(spark, sf_dir, "documents")))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of the rebuilt conversations."""
    return prefix_trie.report(_table(spark, sf_dir, "conversations"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of each piece of a document in the packed sequences."""
    return packing.pack(_table(spark, sf_dir, "documents"))


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of each vector."""
    return clustering.report(_table(spark, sf_dir, "embeddings")).drop("scans")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents filtered, deduplicated, decontaminated, mixed and sharded."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_secrets, op2_decontaminate, op3_mix, op4_simhash, op5_quality, op6_urls, op7_toxicity, op8_html, op9_licenses, op10_shards,
        op11_prefix_trie, op12_packing, op13_clusters, pipeline,
    )}


def oracle_sql() -> dict[str, str]:
    return oracle.all_sql()
