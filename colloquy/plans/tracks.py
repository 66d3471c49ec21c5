"""End-to-end plans: from utterances and requests to turns, labels and track rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import labels, quality, rows, waveforms
from ..operators.pools import build_pools, speaker_slots, utterance_index
from ..operators.turns import plan_turns
from ..params import TrackParams
from ..session import discard, stage, tune, work_path
from ..sinks import tables

#: Pool rows to a turn, about.
_ROWS_PER_TURN = 3
#: Planned bytes of the shards that are on their way at a time, about, and shards for each core at least.
_PART_BYTES = 2 << 30
_PART_SHARDS_PER_CORE = 4


@dataclass(frozen=True)
class Plan:
    """Frames of a planned run; ``index`` and ``pools`` are stored tables, the rest is lazy."""

    params: TrackParams
    requests: DataFrame
    utterances: DataFrame
    index: DataFrame
    slots: DataFrame
    pools: DataFrame
    stored: tuple[str, ...] = ()
    n_pool_rows: int = 0

    @property
    def turns(self) -> DataFrame:
        return plan_turns(self.pools, self.params, self.n_pool_rows)

    def segments(self, text: bool = False) -> DataFrame:
        turns = labels.with_text(self.turns, self.utterances) if text else self.turns
        return labels.segments(turns, self.params)

    def track_rows(self, text: bool = True) -> DataFrame:
        n_turns = self.n_pool_rows // _ROWS_PER_TURN
        if not text:
            return rows.track_rows(self.turns, self.params, n_turns)
        turns = stage(self.turns, work_path(self.utterances.sparkSession, "turns"))  # read twice
        return rows.track_rows_with_texts(turns, self.utterances, self.params, n_turns)

    def summary(self) -> DataFrame:
        """Flagship result: one flat row per track with its class and quality verdict."""
        return quality.summarise(self.turns, self.params)


def plan(utterances: DataFrame, requests: DataFrame, params: TrackParams | None = None) -> Plan:
    """Index the utterances, draw the pools, and return the plan.

    The index and the pools are read several times downstream, so both are written once to shared storage;
    this also cuts lineage, so a lost executor costs a re-read and not a recomputation.
    """
    params = params or TrackParams()
    spark = tune(utterances.sparkSession)
    index_at, pools_at = work_path(spark, "index"), work_path(spark, "pools")
    index = stage(utterance_index(utterances, params), index_at)
    slots = speaker_slots(requests, index, params)
    pools = stage(build_pools(slots, index, params), pools_at)
    return Plan(params, requests, utterances, index, slots, pools, (index_at, pools_at), pools.count())


@dataclass(frozen=True)
class Report:
    """What a run made: the manifest of the files, the tracks that failed with the reason, and the totals."""

    manifest: DataFrame
    failed: DataFrame
    totals: DataFrame


def generate(
    utterances: DataFrame,
    audio: DataFrame,
    requests: DataFrame,
    out: str,
    params: TrackParams | None = None,
    max_megabytes: int = tables.SHARD_MEGABYTES,
) -> DataFrame:
    """Build the whole dataset; returns the manifest."""
    return run(utterances, audio, requests, out, params, max_megabytes).manifest


def run(
    utterances: DataFrame,
    audio: DataFrame,
    requests: DataFrame,
    out: str,
    params: TrackParams | None = None,
    max_megabytes: int = tables.SHARD_MEGABYTES,
) -> Report:
    """Build the whole dataset: labelled tracks with audio, in shards below ``out``.

    ``audio`` is ``(utt_id, audio)``. Shards follow from planned lengths, before any audio is read; of the audio only
    what the pieces need is packed, and slices travel once, straight to the partition of their shard, together with the
    metadata. A track that lacks audio, or for which there are too few utterances, does not stop the run: it is
    reported with its reason and has no row in the data. Working tables are deleted at the end, but for the list of failures.
    Shards are made in parts of about :data:`_PART_BYTES`, one after the other, so that the disk holds what is written and one part's slices; ``_SUCCESS``
    is written with the last one.
    """
    spark = utterances.sparkSession
    made = plan(utterances, requests, params)
    p = made.params
    turns = stage(made.turns, turns_at := work_path(spark, "turns"))
    discard(spark, *made.stored)
    everything = waveforms.pieces(turns, p)
    wanted = waveforms.wanted_audio(everything, audio, p)
    gaps = waveforms.find_gaps(everything, wanted)
    unplanned = requests.select("track_id").distinct().join(turns.select("track_id").distinct(), "track_id", "left_anti")
    failed = stage(gaps.unionByName(unplanned.withColumn("reason", F.lit("too few utterances"))), work_path(spark, "failed"))

    good = turns.join(failed.select("track_id"), "track_id", "left_anti")
    lengths = good.groupBy("track_id").agg(F.max("cum_after").alias("n"))
    sizes = lengths.select("track_id", tables.row_bytes(tables.wav_bytes(F.col("n"))).alias("bytes"))
    max_bytes = max_megabytes * 1024 * 1024
    shards = stage(tables.assign_shards(sizes, max_bytes).select("track_id", "shard"), shards_at := work_path(spark, "shards"))
    n_shards = tables.count_shards(shards)
    n_part = max(1, int(_PART_BYTES // max_bytes), _PART_SHARDS_PER_CORE * spark.sparkContext.defaultParallelism)
    for first in range(0, n_shards, n_part):
        end = min(first + n_part, n_shards)
        own = shards.where(F.col("shard").between(first, end - 1))
        part = good.join(own.select("track_id"), "track_id", "left_semi")
        meta = rows.track_rows(labels.with_text(part, utterances), p).drop("snr").join(own, "track_id")
        pieces = waveforms.pieces(good.join(own, "track_id"), p)
        slices = waveforms.cut_slices(pieces, waveforms.pack_audio(wanted))
        mixed = waveforms.mix_down(slices, p, rows=meta, n_shards=end - first, first_shard=first)
        tracks = mixed.select(
            "shard", "track_id", "row.*", F.round("snr", 2).alias("snr"),
            F.struct(F.col("audio").alias("array"), F.lit(p.sampling_rate).cast("bigint").alias("sampling_rate")).alias("audio"),
        )
        tables.write_part(tracks, out, append=first > 0, last=end == n_shards)
    manifest = tables.manifest(spark, out)
    totals = manifest.agg(F.coalesce(F.sum("tracks"), F.lit(0)).alias("tracks"), F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
    totals = totals.crossJoin(failed.agg(F.count("*").alias("failed")))  # one row each
    discard(spark, turns_at, shards_at)
    return Report(manifest, failed, totals)
