"""Difficulty classes, quality validation and dataset statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timing import centis, seconds
from ..params import MAX_SPEAKER_SHARE, MIN_SPEAKER_SECONDS, TrackParams
from .labels import has_segment
from .specs import with_spec


# Wording of the three warnings.
SHORT_SPEAKER = "Speaker %d has duration %ss < {minimum}s"
IMBALANCE = "Speaker imbalance: max ratio %s > {maximum}"
MISSING_SPEAKERS = "Only %d speakers found, expected %d"


def difficulty(
    n_speakers: Column, has_overlaps: Column, has_simultaneous: Column, has_noise: Column, mean_seconds: Column
) -> Column:
    """Score: speakers plus one for each complication; up to 2 easy, up to 4 medium, else hard."""
    extras = (has_overlaps, has_simultaneous, has_noise, mean_seconds < 2.0)
    score = n_speakers
    for flag in extras:
        score = score + flag.cast("int")
    return F.when(score <= 2, "easy").when(score <= 4, "medium").otherwise("hard")


def mean_seconds(length: Column) -> Column:
    """Mean segment duration in seconds as an aggregate; 0 without segments."""
    return F.coalesce(F.sum(length) / (F.count(length) * F.lit(100.0)), F.lit(0.0))


def two_decimals(hundredths: Column) -> Column:
    """Format an integer number of hundredths."""
    return F.format_string("%d.%02d", F.floor(hundredths / 100).cast("bigint"), hundredths % 100)


def speaker_time(segments: DataFrame) -> DataFrame:
    """Spoken time per track and speaker in hundredths of a second (combined before the shuffle)."""
    return segments.groupBy("track_id", "speaker_id").agg(
        F.sum("centis").cast("bigint").alias("centis"), F.count("*").alias("n_segments")
    )


def short_speaker_warnings(total_centis: Column, speaker_id: Column, minimum: float = MIN_SPEAKER_SECONDS) -> Column:
    """Warning text for a speaker below the minimum, else null."""
    return F.when(
        total_centis < F.lit(minimum * 100),
        F.format_string(SHORT_SPEAKER.format(minimum=minimum), speaker_id, two_decimals(total_centis)),
    )


def validate(
    segments: DataFrame,
    expected: DataFrame | None = None,
    minimum: float = MIN_SPEAKER_SECONDS,
    max_share: float = MAX_SPEAKER_SHARE,
) -> DataFrame:
    """Per track: speakers found, total and longest time, share, warnings, validity.

    ``expected`` is ``(track_id, expected_speakers)``; without it the speakers found are expected.
    """
    warn = short_speaker_warnings(F.col("centis"), F.col("speaker_id"), minimum)
    per_track = speaker_time(segments).groupBy("track_id").agg(
        F.count("*").alias("n_found"),
        F.sum("centis").cast("bigint").alias("total_centis"),
        F.max("centis").alias("max_centis"),
        F.array_sort(F.collect_list(F.when(warn.isNotNull(), F.struct("speaker_id", warn.alias("w"))))).alias("_short"),
    )
    if expected is not None:
        per_track = per_track.join(expected, "track_id", "left")
    else:
        per_track = per_track.withColumn("expected_speakers", F.col("n_found"))
    share = F.when(F.col("total_centis") > 0, F.col("max_centis") / F.col("total_centis"))
    hundredths = F.floor(
        (F.col("max_centis") * 200 + F.col("total_centis")) / (F.col("total_centis") * 2)
    ).cast("bigint")
    per_track = per_track.withColumn("max_share", share)
    uneven = F.when(
        F.col("max_share") > F.lit(max_share),
        F.format_string(IMBALANCE.format(maximum=max_share), two_decimals(hundredths)),
    )
    missing = F.when(
        F.col("n_found") < F.col("expected_speakers"),
        F.format_string(MISSING_SPEAKERS, F.col("n_found"), F.col("expected_speakers")),
    )
    warnings = F.concat(F.col("_short.w"), F.array_compact(F.array(uneven, missing)))
    return per_track.withColumn("warnings", warnings).withColumn(
        "is_valid", F.size("warnings") == 0
    ).drop("_short")


def summarise(turns: DataFrame, p: TrackParams) -> DataFrame:
    """Class and verdict of every track in two aggregates over the planner's own partitioning."""
    spoken = has_segment()
    length = F.when(spoken, centis("n_samples", p.sampling_rate))
    per_speaker = turns.groupBy("track_id", "spk").agg(
        F.coalesce(F.sum(length), F.lit(0)).alias("centis"), F.count(length).alias("n_segments"),
        F.max("cum_after").alias("total_samples"),
        F.bool_or(F.col("kind") == "overlap").alias("has_overlaps"),
        F.bool_or(F.col("kind") == "simultaneous").alias("has_simultaneous"),
    )
    heard = F.col("n_segments") > 0
    per_track = per_speaker.groupBy("track_id").agg(
        F.count_if(heard).alias("num_speakers"),
        F.sum("n_segments").alias("n_segments"), F.sum("centis").alias("_sum"), F.max("centis").alias("_max"),
        F.min(F.when(heard, F.col("centis"))).alias("_min"),
        F.max("total_samples").alias("total_samples"),
        F.bool_or("has_overlaps").alias("has_overlaps"), F.bool_or("has_simultaneous").alias("has_simultaneous"),
    )
    mean = F.when(F.col("n_segments") > 0, F.col("_sum") / (F.col("n_segments") * 100.0)).otherwise(0.0)
    share = F.when(F.col("_sum") > 0, F.col("_max") / F.col("_sum"))
    fair = (F.col("_min") >= MIN_SPEAKER_SECONDS * 100) & (share <= MAX_SPEAKER_SHARE)
    return with_spec(per_track, p).select(
        "track_id", F.col("pattern").alias("conversation_type"), "num_speakers",
        seconds("total_samples", p.sampling_rate).alias("duration"),
        difficulty(
            F.col("num_speakers"), F.col("has_overlaps"), F.col("has_simultaneous"), F.col("want_noise"), mean
        ).alias("difficulty"),
        "n_segments", F.round(share, 9).alias("max_share"), F.coalesce(fair, F.lit(True)).alias("is_valid"),
    )


def dataset_stats(tracks: DataFrame) -> DataFrame:
    """Counts and duration range per conversation type and difficulty."""
    return tracks.groupBy("conversation_type", "difficulty").agg(
        F.count("*").alias("n_tracks"),
        F.min("duration").alias("min_duration"),
        F.max("duration").alias("max_duration"),
        F.count_if("has_overlaps").alias("n_overlaps"),
        F.count_if("has_simultaneous").alias("n_simultaneous"),
        F.count_if("has_noise").alias("n_noise"),
    )


def run_totals(requests: DataFrame, produced: DataFrame) -> DataFrame:
    """How many requested tracks were produced and how many failed."""
    done = produced.select("track_id", F.lit(True).alias("_done"))
    return requests.select("track_id").join(done, "track_id", "left").agg(
        F.count("*").alias("requested"),
        F.count_if(F.col("_done")).alias("produced"),
        F.count_if(F.col("_done").isNull()).alias("failed"),
    )
