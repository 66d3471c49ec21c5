"""Events and ground-truth labels of planned turns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timing import centis, seconds
from ..params import TrackParams
from ..session import by_task, tasks_for
from .pools import slot_volume

EVENT_FIELDS = (
    ("kind", "string"), ("spk", "bigint"), ("utt_id", "bigint"), ("volume", "double"),
    ("start_samples", "bigint"), ("n_samples", "bigint"), ("trim_start", "bigint"),
    ("duration_samples", "bigint"), ("overlap_percent", "double"), ("sim_spk", "bigint"), ("sim_utt_id", "bigint"),
)


def _trim() -> Column:
    return F.coalesce(F.col("sim_samples"), F.lit(0))


def has_segment() -> Column:
    """A turn leaves a segment unless simultaneous speech swallowed its whole utterance."""
    return F.col("n_samples") > _trim()


def _event(**values: Column) -> Column:
    return F.struct(*[
        values.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in EVENT_FIELDS
    ])


def events(turns: DataFrame, p: TrackParams) -> DataFrame:
    """One sparse row per event in playing order: what precedes the segment, then the segment."""
    lead_in = (
        F.when(F.col("pause") > 0, _event(kind=F.lit("pause"), duration_samples=F.col("pause")))
        .when(F.col("kind") == "overlap", _event(kind=F.lit("overlap"), overlap_percent=F.col("ov_pct")))
        .when(F.col("kind") == "simultaneous", _event(
            kind=F.lit("simultaneous"), spk=F.col("spk"), utt_id=F.col("utt_id"),
            start_samples=F.col("cum_before"), duration_samples=F.col("sim_samples"),
            sim_spk=F.col("sim_spk"), sim_utt_id=F.col("sim_utt_id"),
        ))
    )
    segment = F.when(has_segment(), _event(
        kind=F.lit("segment"), spk=F.col("spk"), utt_id=F.col("utt_id"),
        volume=slot_volume(p, "track_id", "spk"), start_samples=F.col("cum_before"),
        n_samples=F.col("n_samples"), trim_start=F.when(_trim() > 0, _trim()),
    ))
    # a turn's events are counted before they are laid out: the sum over turns goes along with the planner's order
    has_lead_in = (F.col("pause") > 0) | F.col("kind").isin("overlap", "simultaneous")
    count = F.coalesce(has_lead_in, F.lit(False)).cast("bigint") + F.coalesce(has_segment(), F.lit(False)).cast("bigint")
    earlier = Window.partitionBy("track_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    return turns.withColumn("_before", F.coalesce(F.sum(count).over(earlier), F.lit(0))).select(
        "track_id", "turn", "_before", F.posexplode(F.array_compact(F.array(lead_in, segment))).alias("_pos", "_e")
    ).select(
        "track_id", (F.col("_before") + F.col("_pos")).cast("bigint").alias("event_idx"), "turn",
        *[F.col(f"_e.{name}").alias(name) for name, _ in EVENT_FIELDS],
    )


def previous_segment(event_rows: DataFrame) -> DataFrame:
    """Each overlap with the latest segment before it (backward as-of match on event order)."""
    earlier = (
        Window.partitionBy("track_id").orderBy("event_idx").rowsBetween(Window.unboundedPreceding, -1)
    )
    seen = F.last(
        F.when(F.col("kind") == "segment", F.struct("event_idx", "utt_id", "n_samples", "trim_start")),
        ignorenulls=True,
    ).over(earlier)
    return event_rows.withColumn("_prev", seen).where(F.col("kind") == "overlap").select(
        "track_id", "event_idx", "overlap_percent",
        F.col("_prev.event_idx").alias("prev_event_idx"), F.col("_prev.utt_id").alias("prev_utt_id"),
        (F.col("_prev.n_samples") - F.coalesce(F.col("_prev.trim_start"), F.lit(0))).alias("prev_samples"),
    )


def with_text(turns: DataFrame, utterances: DataFrame) -> DataFrame:
    """Dataset speaker and text of each turn's utterance (kept out of planning until here)."""
    meta = utterances.select("utt_id", F.col("speaker_id").alias("source_speaker_id"), "text")
    return turns.join(meta, "utt_id", "left")


#: Bytes of different texts that a task holds, about, and turns that it takes at most.
_TASK_TEXT_BYTES = 256 << 20
_TASK_TURNS = 500_000


def with_text_by_task(turns: DataFrame, utterances: DataFrame, n_turns: int) -> DataFrame:
    """As :func:`with_text`, with the turns dealt to tasks by track (``_task``) and sorted by track and turn.

    The turns travel without texts, and each text once to every task that needs it, where turns look it up in a hash table. Tasks are as
    large as their texts allow, so that few texts go to many tasks.
    """
    n, size = utterances.agg(F.count("text"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    most = _TASK_TURNS if size <= _TASK_TEXT_BYTES else max(1, min(_TASK_TURNS, _TASK_TEXT_BYTES * n // size))
    n_tasks = tasks_for(turns.sparkSession, n_turns, most)
    dealt = turns.withColumn("_task", F.pmod(F.hash("track_id"), F.lit(n_tasks)))
    # in as many partitions as that, given outright: the rows are narrow, but each of them becomes a text
    needed = dealt.select("_task", "utt_id").repartition(n_tasks, "utt_id").distinct()
    meta = utterances.select("utt_id", F.col("speaker_id").alias("source_speaker_id"), "text")
    sent = by_task(needed.join(meta.hint("merge"), "utt_id"), n_tasks)
    # sorted by a window that stays in the plan: a bare sort below a join would be taken out, and texts be sorted above it
    nth = F.row_number().over(Window.partitionBy("_task", "track_id").orderBy("turn"))
    in_order = by_task(dealt, n_tasks).withColumn("_nth", nth).where("_nth > 0").drop("_nth")
    return in_order.join(sent.hint("shuffle_hash"), ["_task", "utt_id"], "left")


def segments(turns: DataFrame, p: TrackParams) -> DataFrame:
    """Speaker labels: 1-based speaker, start before the pause, full utterance duration."""
    sr = p.sampling_rate
    extra = ["text"] if "text" in turns.columns else []
    return turns.where(has_segment()).select(
        "track_id", F.col("turn").alias("seg_idx"), (F.col("spk") + 1).alias("speaker_id"),
        seconds("cum_before", sr).alias("start"),
        seconds("cum_after", sr).alias("end"),
        seconds("n_samples", sr).alias("duration"),
        seconds(F.col("cum_before") + F.col("pause"), sr).alias("speech_start"),
        centis("n_samples", sr).alias("centis"),
        *extra,
    )


def simultaneous_segments(turns: DataFrame, p: TrackParams) -> DataFrame:
    """Labels of simultaneous speech."""
    sr = p.sampling_rate
    return turns.where(F.col("kind") == "simultaneous").select(
        "track_id", F.col("turn").alias("seg_idx"),
        seconds("cum_before", sr).alias("start"),
        seconds(F.col("cum_before") + F.col("sim_samples"), sr).alias("end"),
        (F.col("spk") + 1).alias("speaker1_id"),
        (F.col("sim_spk") + 1).alias("speaker2_id"),
        seconds("sim_samples", sr).alias("duration"),
    )


def all_activity(segs: DataFrame, sims: DataFrame) -> DataFrame:
    """Who is audible when: segments and both sides of simultaneous speech."""
    pair = F.array(
        F.struct(F.col("speaker1_id").alias("speaker_id"), F.lit("simultaneous").alias("source")),
        F.struct(F.col("speaker2_id").alias("speaker_id"), F.lit("simultaneous").alias("source")),
    )
    both = sims.select("track_id", "start", "end", F.inline(pair))
    return segs.select("track_id", "start", "end", "speaker_id", F.lit("segment").alias("source")).unionByName(both)


def unused_members(pools: DataFrame, turns: DataFrame) -> DataFrame:
    """Pool utterances no turn used."""
    return pools.join(turns, ["track_id", "spk", "utt_id"], "left_anti")
