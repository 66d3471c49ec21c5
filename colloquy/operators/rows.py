"""One nested row per track: the shape consumers read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timing import centis, seconds
from ..params import TrackParams
from ..session import by_track
from .labels import has_segment, with_text_by_task
from .pools import slot_volume
from .quality import difficulty, mean_seconds
from .specs import with_spec

SPEAKERS = "array<struct<speaker_id:bigint,start:double,end:double,duration:double,text:string>>"
VOLUMES = "array<struct<speaker_id:bigint,volume:double>>"
SIMULTANEOUS = "array<struct<start:double,end:double,speaker1_id:bigint,speaker2_id:bigint,duration:double>>"

# Columns and types of the stored track table, in order.
TRACK_COLUMNS = (
    ("audio", "struct<array:array<float>,sampling_rate:bigint>"),
    ("duration", "double"),
    ("num_speakers", "bigint"),
    ("sampling_rate", "bigint"),
    ("conversation_type", "string"),
    ("difficulty", "string"),
    ("has_overlaps", "boolean"),
    ("has_simultaneous", "boolean"),
    ("has_noise", "boolean"),
    ("speakers", SPEAKERS),
    ("noise_type", "string"),
    ("snr", "double"),
    ("speaker_volumes", VOLUMES),
    ("simultaneous_segments", SIMULTANEOUS),
)


def _nested(keep: Column, **fields: Column) -> Column:
    row = F.struct(F.col("turn").alias("_turn"), *[c.alias(n) for n, c in fields.items()])
    ordered = F.array_sort(F.collect_list(F.when(keep, row)))
    return F.transform(ordered, lambda r: F.struct(*[r[n].alias(n) for n in fields]))


#: Turns with their texts that a task nests, about: tens of MB, sorted in memory.
_TASK_TURNS = 20_000


def track_rows_with_texts(turns: DataFrame, utterances: DataFrame, p: TrackParams, n_turns: int) -> DataFrame:
    """As :func:`track_rows` of the turns with their texts. The turns are read twice and should be stored.

    A text travels once to a task, however many of its turns say it, and turns are sorted without texts: neither the shuffle nor
    the sort grows with turns times texts.
    """
    return track_rows(with_text_by_task(turns, utterances, n_turns), p)


def track_rows(turns: DataFrame, p: TrackParams, n_turns: int = 0) -> DataFrame:
    """Metadata of every track from its turns (with ``text``) in one aggregate over ``track_id``.

    Lists are bounded by the target duration of a track. With the number of turns given, about, those with texts are dealt out
    by track before they are nested: nesting them where they were found would sort and spill the texts once more.
    """
    if n_turns and "text" in turns.columns:
        turns = by_track(turns, rows=n_turns, task_rows=_TASK_TURNS)
    sr = p.sampling_rate
    spoken = has_segment()
    simultaneous = F.col("kind") == "simultaneous"
    text = F.coalesce(F.col("text"), F.lit("")) if "text" in turns.columns else F.lit("")
    placed = [c for c in ("_task",) if c in turns.columns]  # turns of a task are sorted by track already
    rows = turns.groupBy(*placed, "track_id").agg(
        F.first("n_spk").alias("n_planned"),
        F.max("cum_after").alias("total_samples"),
        # a set of at most the track's speakers; a distinct count would add two aggregation rounds
        F.size(F.collect_set(F.when(spoken, F.col("spk")))).cast("bigint").alias("num_speakers"),
        F.bool_or(F.col("kind") == "overlap").alias("has_overlaps"),
        F.bool_or(simultaneous).alias("has_simultaneous"),
        mean_seconds(F.when(spoken, centis("n_samples", sr))).alias("mean_segment"),
        _nested(
            spoken, speaker_id=F.col("spk") + 1, start=seconds("cum_before", sr), end=seconds("cum_after", sr),
            duration=seconds("n_samples", sr), text=text,
        ).alias("speakers"),
        _nested(
            simultaneous, start=seconds("cum_before", sr),
            end=seconds(F.col("cum_before") + F.col("sim_samples"), sr),
            speaker1_id=F.col("spk") + 1, speaker2_id=F.col("sim_spk") + 1, duration=seconds("sim_samples", sr),
        ).alias("simultaneous_segments"),
    )
    volumes = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("n_planned") - 1),
        lambda s: F.struct((s + 1).alias("speaker_id"), F.round(slot_volume(p, F.col("track_id"), s), 2).alias("volume")),
    )
    return with_spec(rows, p).select(
        "track_id",
        seconds("total_samples", sr).alias("duration"),
        "num_speakers",
        F.lit(sr).cast("bigint").alias("sampling_rate"),
        F.col("pattern").alias("conversation_type"),
        difficulty(
            F.col("num_speakers"), F.col("has_overlaps"), F.col("has_simultaneous"), F.col("want_noise"),
            F.col("mean_segment"),
        ).alias("difficulty"),
        "has_overlaps", "has_simultaneous",
        F.col("want_noise").alias("has_noise"),
        "speakers", "noise_type",
        F.round("snr_db", 2).alias("snr"),
        volumes.alias("speaker_volumes"),
        "simultaneous_segments",
        (F.col("num_speakers") != F.col("n_planned")).alias("speakers_differ"),
    )
