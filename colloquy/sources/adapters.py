"""Views that give general tables the shape of the tables this library works on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .utterances import read_utterances


def document_utterances(spark: SparkSession, sf_dir: str, language: str | None = None) -> DataFrame:
    """One utterance per document: few speakers, long tail of lengths."""
    return read_utterances(
        spark, f"{sf_dir}/documents.parquet", utt_id="doc_id", speaker_id="source",
        n_samples=F.lit(1600) + F.col("n_chars") * 16, language=language,
    )


def gappy_utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document utterances with missing speakers, missing texts and empty audio."""
    raw = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return raw.select(
        F.col("doc_id").cast("bigint").alias("utt_id"),
        F.nullif(F.col("source"), F.lit("src0")).alias("speaker_id"),
        F.when(F.col("doc_id") % 7 != 0, F.col("text")).alias("text"),
        F.when(F.col("doc_id") % 11 == 0, F.lit(0)).otherwise(1600 + F.col("n_chars") * 16)
        .cast("bigint").alias("n_samples"),
    )


def event_utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One short utterance per event: many speakers."""
    return read_utterances(
        spark, f"{sf_dir}/events.parquet", utt_id="event_id", speaker_id="user_id", text="event_type",
        n_samples=F.lit(1600) + (F.col("value") * 160).cast("bigint"),
    )


def embedding_waves(spark: SparkSession, sf_dir: str, repeat: int = 1) -> DataFrame:
    """Short waveforms, optionally looped to a realistic length."""
    raw = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    wave = F.col("embedding").cast("array<float>")
    if repeat > 1:
        wave = F.flatten(F.array_repeat(wave, repeat))
    return raw.select(
        F.col("vec_id").cast("bigint").alias("utt_id"),
        F.col("label").cast("string").alias("speaker_id"),
        F.lit(None).cast("string").alias("text"),
        F.size("embedding").cast("bigint").__mul__(repeat).alias("n_samples"),
        wave.alias("audio"),
    )


def track_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One track is requested per customer."""
    raw = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return raw.select(F.col("c_custkey").cast("bigint").alias("track_id"))


def conversation_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as annotated tracks: one segment per turn, laid end to end."""
    order = Window.partitionBy("track_id").orderBy("seg_idx")
    raw = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return raw.select(
        F.col("conv_id").cast("bigint").alias("track_id"),
        F.col("turn").cast("bigint").alias("seg_idx"),
        F.when(F.col("role") == "user", 1).when(F.col("role") == "assistant", 2).otherwise(3)
        .cast("bigint").alias("speaker_id"),
        (F.length("text") * 800).cast("bigint").alias("n_samples"),
        "text",
    ).withColumn(
        "cum_after", F.sum("n_samples").over(order.rowsBetween(Window.unboundedPreceding, 0))
    ).withColumn("cum_before", F.col("cum_after") - F.col("n_samples"))


def conversation_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as planned turns, so that everything downstream of planning can run on them."""
    segs = conversation_segments(spark, sf_dir)
    overlapped = (F.col("track_id") % 3 == 0) & (F.col("seg_idx") == 1)
    return segs.select(
        "track_id", F.col("seg_idx").alias("turn"), (F.col("speaker_id") - 1).alias("spk"),
        F.lit(3).cast("bigint").alias("n_spk"), "n_samples",
        F.when(overlapped, "overlap").otherwise("plain").alias("kind"),
        F.lit(0).cast("bigint").alias("pause"),
        F.lit(None).cast("bigint").alias("sim_spk"), F.lit(None).cast("bigint").alias("sim_samples"),
        "cum_before", "cum_after", "text",
    )
