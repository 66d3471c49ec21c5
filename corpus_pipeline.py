"""From raw documents to a mixed, sharded training corpus.

Each stage works on all rows its predecessor kept; the result of each is written as Parquet and read again. Nulls, empty
texts, repeated rows and empty tables are handled as the operators' modules say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from colloquy.llm import decontaminate, mixing, quality, sharding, simhash
from colloquy.session import Workspace, settled, stage, work_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.passing(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints are linked, by the operator's own shingle length and bit distance."""
    return simhash.one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard and slot."""
    return sharding.assign(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("shards", shards),
]

#: Fingerprints, components and binomial bounds have no SQL counterpart; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder. Only the last one's result stays in the shared folder."""
    docs, result = spark.read.parquet(f"{sf_dir}/documents.parquet"), work_path(spark, "pipeline")
    with Workspace(spark, "pipeline-stages"):
        for name, step in STAGES[:-1]:
            docs = settled(spark, name, lambda: step(spark, docs, sf_dir))  # noqa: B023 - called at once
        return stage(STAGES[-1][1](spark, docs, sf_dir), result)
