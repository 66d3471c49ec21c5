"""Reading and shaping the utterance table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_utterances(
    spark: SparkSession,
    path: str,
    *,
    utt_id: str = "utt_id",
    speaker_id: str = "speaker_id",
    text: str = "text",
    n_samples: str | Column = "n_samples",
    language: str | None = None,
    language_column: str = "lang",
    split: str | None = None,
    split_column: str = "split",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Utterance metadata under logical names; language and split filters reach the Parquet scan.

    Audio is never read here: planning needs only the stored sample count.
    """
    raw = spark.read.parquet(path)
    if language is not None:
        raw = raw.where(F.col(language_column) == language)
    if split is not None:
        raw = raw.where(F.col(split_column) == split)
    length = F.col(n_samples) if isinstance(n_samples, str) else n_samples
    return raw.select(
        F.col(utt_id).cast("bigint").alias("utt_id"),
        F.col(speaker_id).cast("string").alias("speaker_id"),
        F.col(text).cast("string").alias("text"),
        length.cast("bigint").alias("n_samples"),
        *keep,
    )


def audio_array(df: DataFrame, column: str = "audio") -> Column:
    """The samples of an audio column that is either a bare array or a struct with an ``array`` field."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StructType):
        if "array" not in kind.fieldNames():
            raise ValueError(f"{column} has no field 'array'")
        samples = F.col(f"{column}.array")
    elif isinstance(kind, T.ArrayType):
        samples = F.col(column)
    else:
        raise ValueError(f"{column} is neither an array nor a struct with an 'array' field")
    return samples.cast("array<float>")


def at_rate(df: DataFrame, sampling_rate: int, column: str = "audio") -> DataFrame:
    """Rows whose stored rate is the wanted one; a bare array carries no rate and passes."""
    if isinstance(df.schema[column].dataType, T.StructType):
        return df.where(F.col(f"{column}.sampling_rate") == sampling_rate)
    return df


def usable(utterances: DataFrame, null_speaker: str = "any") -> DataFrame:
    """Utterances with audio; ``null_speaker='drop'`` also leaves out rows without a speaker."""
    kept = utterances.where(F.col("n_samples") > 0)
    return kept.where(F.col("speaker_id").isNotNull()) if null_speaker == "drop" else kept
