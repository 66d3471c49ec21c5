"""Distinct speakers by mergeable sketches, stored batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Registers are 2^12: the relative standard error of an estimate is 1.04 / sqrt(4096).
LG_K = 12
STANDARD_ERROR = 1.04 / (1 << LG_K) ** 0.5


def speaker_sketches(utterances: DataFrame, *keys: str) -> DataFrame:
    """One sketch of the speakers for each key; a null speaker counts as one speaker. Of a few kB each, combined before anything moves."""
    speaker = F.coalesce(F.concat(F.lit("s"), F.col("speaker_id").cast("string")), F.lit("null"))
    return utterances.groupBy(*keys).agg(F.hll_sketch_agg(speaker, LG_K).alias("speakers"), F.count(F.lit(1)).alias("n_utterances"))


def store_sketches(utterances: DataFrame, path: str, batch_no: int) -> None:
    """Add the sketch of a batch; a batch that is stored again replaces its own."""
    speaker_sketches(utterances).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch_no={batch_no}")


def merged(sketches: DataFrame, *keys: str) -> DataFrame:
    """Estimated speakers and utterances of all sketches of a key together."""
    whole = sketches.groupBy(*keys).agg(F.hll_union_agg("speakers").alias("speakers"), F.sum("n_utterances").alias("n_utterances"))
    return whole.select(*keys, F.hll_sketch_estimate("speakers").alias("n_speakers"), "n_utterances")


def stored_estimate(spark: SparkSession, path: str) -> DataFrame:
    """Speakers over all stored batches, without reading an utterance."""
    return merged(spark.read.parquet(path))
