"""Named queries over the given tables, one per operator."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import audio, kernels, rng
from ..functions.timing import centis, seconds
from ..operators import labels, patterns, pools, quality, rows, sketches, specs, waveforms
from ..operators.turns import plan_turns
from ..params import NOISE_TYPES, TrackParams
from ..session import by_track, stage, tune, work_path
from ..sinks import layout, tables, wav
from ..sinks.ledger import Ledger, audio_paths
from ..sinks.versions import Versions
from ..sources import adapters
from ..sources.tolerant import read_tolerantly
from ..sources.utterances import at_rate, audio_array, usable
from ..streaming import incremental
from .tracks import Plan, generate, plan, run

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

DEFAULT = TrackParams()
# 64-sample waves as two-second utterances
SLOW = dict(sampling_rate=32, end_reserve=10)
PLAIN_WAVES = TrackParams(**SLOW, overlap_probability=0.0, simultaneous_probability=0.0, noise_probability=0.0)
OVERLAP_WAVES = TrackParams(**SLOW, overlap_probability=1.0, simultaneous_probability=0.0, noise_probability=0.0)
LOUD_WAVES = TrackParams(
    **SLOW, simultaneous_probability=1.0, noise_probability=0.0, volume_min=3.0, volume_max=5.0
)
NOISY_WAVES = TrackParams(**SLOW)


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tune(spark), sf_dir)

    _QUERIES[fn.__name__] = run
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def document_plan(spark: SparkSession, sf_dir: str) -> Plan:
    return plan(adapters.document_utterances(spark, sf_dir), adapters.track_requests(spark, sf_dir), DEFAULT)


def event_plan(spark: SparkSession, sf_dir: str) -> Plan:
    return plan(adapters.event_utterances(spark, sf_dir), adapters.track_requests(spark, sf_dir), DEFAULT)


def wave_plan(spark: SparkSession, sf_dir: str, params: TrackParams) -> Plan:
    return plan(adapters.embedding_waves(spark, sf_dir), adapters.track_requests(spark, sf_dir), params)


# --- sources and filters ---------------------------------------------------------------------------


@query
def src_utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.document_utterances(spark, sf_dir, language="en")


@query
def src_audio_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    bare = adapters.embedding_waves(spark, sf_dir)
    rate = F.when(F.col("utt_id") % 5 == 0, 8000).otherwise(16000).cast("bigint")
    wrapped = bare.withColumn("audio", F.struct(F.col("audio").alias("array"), rate.alias("sampling_rate")))

    def shape(df: DataFrame, form: str) -> DataFrame:
        return at_rate(df, 16_000).select(
            "utt_id", F.lit(form).alias("form"), audio.micro(audio_array(df)).alias("samples")
        )

    return shape(bare, "bare").unionByName(shape(wrapped, "wrapped"))


@query
def src_count_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "count-back")
    tables.write_tracks(_conversation_rows(spark, sf_dir), path, _conversation_sizes(spark, sf_dir))
    return tables.count_back(spark, path)


@query
def src_json_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = _conversation_rows(spark, sf_dir)
    volumes = F.map_from_entries(F.transform(
        F.array_distinct(F.transform("speakers", lambda s: s["speaker_id"])),
        lambda i: F.struct(i.cast("string"), F.lit(0.75) + i / F.lit(8.0)),
    ))
    old = nested.select(
        "track_id", F.to_json("speakers").alias("speakers"), F.to_json(volumes).alias("speaker_volumes")
    )
    read = tables.from_json_records(old)
    volume = F.filter("speaker_volumes", lambda v: v["speaker_id"] == F.col("s.speaker_id"))
    return read.select("track_id", "speaker_volumes", F.posexplode("speakers").alias("pos", "s")).select(
        "track_id", F.col("pos").cast("bigint").alias("pos"), "s.speaker_id", "s.start", "s.end", "s.duration",
        "s.text", F.element_at(volume, 1)["volume"].alias("volume"),
    )


@query
def flt_usable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usable(adapters.gappy_utterances(spark, sf_dir)).select("utt_id", "speaker_id", "n_samples")


@query
def flt_short_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    utterances = adapters.document_utterances(spark, sf_dir).select("utt_id", "speaker_id", "n_samples")
    return pools.short_or_all(utterances, 2_400)


def _damage(spark: SparkSession, folder: str) -> None:
    """Put a truncated copy of a file, and one that is no table at all, beside the others."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(conf)
    first = min((f.getPath().toString(), f.getLen()) for f in fs.listStatus(at) if f.getPath().getName().startswith("part-"))
    source = fs.open(jvm.org.apache.hadoop.fs.Path(first[0]))
    head = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(source, int(first[1]) // 2))
    source.close()
    for name, content in (("truncated", head), ("other", b"no table")):
        out = fs.create(jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet"), True)
        out.write(content)
        out.close()


@query
def src_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Utterances of a table with damaged files among sound ones, and those files with the reason."""
    path = work_path(spark, "damaged")
    waves = adapters.embedding_waves(spark, sf_dir)
    waves.repartition(6, "utt_id").write.parquet(path)
    _damage(spark, path)
    good, bad = read_tolerantly(spark, path, waves.schema)
    name = F.regexp_extract("file", "([a-z]+)[.]parquet$", 1)
    return good.select("utt_id", "speaker_id", F.lit(None).cast("string").alias("damaged")).unionByName(
        bad.select(F.lit(None).cast("bigint").alias("utt_id"), F.lit(None).cast("string").alias("speaker_id"), F.concat(name, F.lit(": "), "reason").alias("damaged")))


# --- draws and specifications ----------------------------------------------------------------------


@query
def rnd_uniform(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = rng.uniform01(DEFAULT.seed, "volume", "utt_id", F.lit(0))
    return adapters.document_utterances(spark, sf_dir).select(
        "utt_id", F.round(u, 9).alias("u"), F.round(rng.between(u, 0.7, 1.3), 9).alias("volume"),
        rng.whole(rng.between(u, 0.5, 3.0) * F.lit(16000.0)).alias("samples"),
    )


@query
def rnd_weighted_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = rng.uniform01(DEFAULT.seed, "spec", "utt_id")
    return adapters.document_utterances(spark, sf_dir).select(
        "utt_id", rng.weighted(u, DEFAULT.pattern_weights, "dialogue").alias("pattern")
    )


@query
def rnd_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = rng.digest(DEFAULT.seed, "choice", "utt_id")
    return adapters.document_utterances(spark, sf_dir).select(
        "utt_id", rng.one_of(rng.lane(d, 0), NOISE_TYPES).alias("noise_type"),
        rng.integer(rng.lane(d, 1), 2, 4).alias("n_spk"),
    )


@query
def rnd_sample_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = pools.utterance_index(adapters.document_utterances(spark, sf_dir), DEFAULT)
    wanted = specs.with_spec(adapters.track_requests(spark, sf_dir), DEFAULT).select("track_id", "n_spk")
    drawn = pools.sample_utterances(wanted, index, F.col("n_spk"), DEFAULT)
    return drawn.join(index, "utt_no").select("track_id", "spk", "utt_id")


@query
def spec_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return specs.with_spec(adapters.track_requests(spark, sf_dir), DEFAULT).withColumn("snr_db", F.round("snr_db", 9))


@query
def spec_prob_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    n_docs = docs.agg(F.count("*")).scalar()
    by_language = docs.groupBy("lang").agg(F.count("*").alias("n"))
    by_quality = spark.read.parquet(f"{sf_dir}/labels.parquet").groupBy("quality").agg(F.count("*").alias("n"))

    def check(table: DataFrame, name: str) -> DataFrame:
        shares = table.select((F.col("n") / n_docs).alias("p"))
        return specs.probability_check(shares).select(
            F.lit(name).alias("name"), "n", F.round("total", 9).alias("total"), "ok"
        )

    return check(by_language, "language").unionByName(check(by_quality, "quality"))


# --- pools and order of speech -----------------------------------------------------------------------


@query
def pool_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_plan(spark, sf_dir).pools


@query
def pool_null_speaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan(adapters.gappy_utterances(spark, sf_dir), adapters.track_requests(spark, sf_dir), DEFAULT).pools


@query
def pool_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_plan(spark, sf_dir).turns.select("track_id", "turn", "spk", "utt_id", "n_samples")


def _speech_order(spark: SparkSession, sf_dir: str, pattern: str | None) -> DataFrame:
    """Speakers of 12 to 31 turns per requested track."""
    return patterns.assign_speakers(_drawn_turns(spark, sf_dir, pattern)).select("track_id", "turn", "pattern", "n_spk", "spk")


def _drawn_turns(spark: SparkSession, sf_dir: str, pattern: str | None) -> DataFrame:
    wanted = adapters.track_requests(spark, sf_dir)
    spec = specs.with_spec(by_track(wanted, rows=20 * wanted.count()), DEFAULT)
    if pattern is not None:
        u = rng.lane(rng.digest(DEFAULT.seed, "spec", "track_id"), 1)
        spec = spec.withColumn("pattern", F.lit(pattern)).withColumn("n_spk", specs.speaker_count(F.col("pattern"), u))
    turns = spec.select(
        "track_id", "pattern", "n_spk",
        F.explode(F.sequence(F.lit(0).cast("bigint"), 11 + F.col("track_id") % 20)).alias("turn"),
    ).withColumn("_d", rng.digest(DEFAULT.seed, "turn", "track_id", "turn"))
    return turns.withColumns({"u": rng.lane("_d", 0), "v": rng.lane("_d", 1)}).drop("_d")


@query
def pat_monologue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _speech_order(spark, sf_dir, "monologue")


@query
def pat_dialogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _speech_order(spark, sf_dir, "dialogue")


@query
def pat_interview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _speech_order(spark, sf_dir, "interview")


@query
def pat_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _speech_order(spark, sf_dir, "group_discussion")


@query
def pat_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _speech_order(spark, sf_dir, None)


def _after_next(turn: int, n_spk: int, u: float, v: float, spoken: list[int]) -> int:
    """One speaker is passed over where the last two turns were those of neighbours."""
    if not spoken:
        return 0
    near = len(spoken) > 1 and (spoken[-1] - spoken[-2]) % n_spk == 1
    return (spoken[-1] + (2 if near else 1)) % n_spk


@query
def pat_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own patterns: one in window form, registered for the query, and one speaker by speaker."""
    patterns.register("round_robin", patterns.Pattern((3, 3), lambda t: t.turn % t.n))
    drawn = _drawn_turns(spark, sf_dir, None)
    try:
        window = patterns.assign_speakers(drawn.withColumns({"pattern": F.lit("round_robin"), "n_spk": F.lit(3).cast("bigint")}))
    finally:
        patterns.unregister("round_robin")
    stepwise = patterns.assign_speakers_sequential(drawn.withColumn("pattern", F.lit("stepwise")), _after_next)
    columns = ["track_id", "turn", "pattern", "n_spk", "spk"]
    return window.select(*columns).unionByName(stepwise.select(*columns))


# --- planner and labels ------------------------------------------------------------------------------


@query
def plan_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_plan(spark, sf_dir).turns.select(
        "track_id", "turn", "kind", "n_samples", "pause", "cum_before", "cum_after"
    )


@query
def plan_pause(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = event_plan(spark, sf_dir).turns
    return turns.where(F.col("kind") == "pause").select("track_id", "turn", "pause")


@query
def plan_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = event_plan(spark, sf_dir).turns
    return turns.where(F.col("kind") == "overlap").select("track_id", "turn", F.round("ov_pct", 9).alias("ov_pct"))


@query
def plan_sim_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_plan(spark, sf_dir).turns.select("track_id", "turn", "want_sim", "kind", "sim_eligible")


@query
def sim_partner(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = document_plan(spark, sf_dir).turns
    return turns.where(F.col("kind") == "simultaneous").select(
        "track_id", "turn", "spk", "utt_id", "sim_spk", "sim_utt_id", "sim_samples"
    )


@query
def turn_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = document_plan(spark, sf_dir)
    return labels.with_text(p.turns, p.utterances).select("track_id", "turn", "utt_id", "source_speaker_id", "text")


@query
def plan_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.events(event_plan(spark, sf_dir).turns, DEFAULT).drop("turn").withColumns({
        "volume": F.round("volume", 9), "overlap_percent": F.round("overlap_percent", 9),
    })


@query
def ov_asof_prev(spark: SparkSession, sf_dir: str) -> DataFrame:
    event_rows = labels.events(event_plan(spark, sf_dir).turns, DEFAULT)
    return labels.previous_segment(event_rows).withColumn("overlap_percent", F.round("overlap_percent", 9))


@query
def plan_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_plan(spark, sf_dir).segments(text=True).drop("centis")


@query
def plan_sim_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.simultaneous_segments(event_plan(spark, sf_dir).turns, DEFAULT)


@query
def all_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = stage(event_plan(spark, sf_dir).turns, work_path(spark, "turns"))  # read twice
    return labels.all_activity(labels.segments(turns, DEFAULT), labels.simultaneous_segments(turns, DEFAULT))


@query
def set_unused(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = document_plan(spark, sf_dir)
    return labels.unused_members(p.pools, p.turns).select("track_id", "spk", "utt_id")


@query
def vol_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    segs = adapters.conversation_segments(spark, sf_dir)
    known = segs.select("track_id", "speaker_id").distinct().where(F.col("speaker_id") < 3).withColumn(
        "volume", pools.slot_volume(DEFAULT, "track_id", F.col("speaker_id") - 1)
    )
    return segs.join(known, ["track_id", "speaker_id"], "left").select(
        "track_id", "seg_idx", F.round(F.coalesce("volume", F.lit(1.0)), 9).alias("volume")
    )


# --- aggregation and quality --------------------------------------------------------------------------


@query
def agg_speaker_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = pools.speaker_index(adapters.gappy_utterances(spark, sf_dir), chunk=256)
    return index.select(
        "speaker_id", "chunk", F.size("utt_ids").cast("bigint").alias("n"),
        F.array_join(F.col("utt_ids").cast("array<string>"), ",").alias("utt_ids"),
    )


@query
def agg_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.gappy_utterances(spark, sf_dir).select("utt_id", "speaker_id", "text")


@query
def agg_unique_speakers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pools.unique_speakers(adapters.gappy_utterances(spark, sf_dir))


@query
def agg_speaker_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speakers by sketches that eight batches stored, one of them twice, beside the exact number."""
    utterances, path = adapters.event_utterances(spark, sf_dir), work_path(spark, "sketches")
    for batch_no in (*range(8), 3):
        sketches.store_sketches(utterances.where(F.pmod("utt_id", F.lit(8)) == batch_no), path, batch_no)
    exact = utterances.agg(F.count_distinct("speaker_id").alias("n_exact"))
    near = F.abs(F.col("n_speakers") - F.col("n_exact")) <= F.ceil(4 * sketches.STANDARD_ERROR * F.col("n_exact"))
    return sketches.stored_estimate(spark, path).join(exact, F.lit(True)).select("n_exact", "n_utterances", near.alias("within_bound"))  # one row each


def _centis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.conversation_segments(spark, sf_dir).withColumn("centis", centis("n_samples", 16_000))


@query
def agg_actual_speakers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.track_rows(adapters.conversation_turns(spark, sf_dir), DEFAULT).select(
        "track_id", "num_speakers", "speakers_differ"
    )


@query
def agg_avg_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _centis(spark, sf_dir).groupBy("track_id").agg(
        F.round(quality.mean_seconds(F.col("centis")), 6).alias("mean_seconds")
    )


@query
def agg_difficulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_track = _centis(spark, sf_dir).groupBy("track_id").agg(
        F.count_distinct("speaker_id").alias("n_speakers"), quality.mean_seconds(F.col("centis")).alias("mean")
    )
    return per_track.select("track_id", quality.difficulty(
        F.col("n_speakers"), F.col("track_id") % 3 == 0, F.col("track_id") % 5 == 0, F.col("track_id") % 2 == 0,
        F.col("mean"),
    ).alias("difficulty"))


@query
def val_speaker_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.speaker_time(_centis(spark, sf_dir))


@query
def val_min_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    warning = quality.short_speaker_warnings(F.col("centis"), F.col("speaker_id"), 20.0)
    return quality.speaker_time(_centis(spark, sf_dir)).select(
        "track_id", "speaker_id", warning.alias("warning")
    ).where(F.col("warning").isNotNull())


@query
def val_imbalance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.validate(_centis(spark, sf_dir)).select(
        "track_id", "max_centis", "total_centis", F.round("max_share", 9).alias("max_share"),
        (F.col("max_share") > 0.4).alias("imbalanced"),
    )


@query
def val_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    segs = _centis(spark, sf_dir)
    expected = segs.select("track_id").distinct().withColumn("expected_speakers", F.lit(3).cast("bigint"))
    return quality.validate(segs, expected, minimum=20.0, max_share=0.6).select(
        "track_id", "n_found", "expected_speakers", F.array_join("warnings", "; ").alias("warnings"), "is_valid"
    )


@query
def agg_dataset_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dataset_stats(document_plan(spark, sf_dir).track_rows(text=False))


@query
def agg_run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    produced = adapters.conversation_segments(spark, sf_dir).select("track_id").distinct()
    return quality.run_totals(adapters.track_requests(spark, sf_dir), produced)


def _segment_list(speakers: Column) -> Column:
    def show(s):
        return F.concat_ws(
            ":", s["speaker_id"].cast("string"),
            *[F.round(s[name] * 100).cast("bigint").cast("string") for name in ("start", "end", "duration")],
        )
    return F.array_join(F.transform(speakers, show), ",")


def _flat_row(tracks: DataFrame) -> DataFrame:
    """Track rows with their nested columns as text, for comparison."""
    volumes = F.transform(
        "speaker_volumes", lambda v: F.concat_ws(
            ":", v["speaker_id"].cast("string"), F.round(v["volume"] * 100).cast("bigint").cast("string")
        )
    )
    simultaneous = F.transform("simultaneous_segments", lambda s: F.concat_ws(
        ":", s["speaker1_id"].cast("string"), s["speaker2_id"].cast("string"),
        *[F.round(s[name] * 100).cast("bigint").cast("string") for name in ("start", "end", "duration")],
    ))
    return tracks.select(
        "track_id", "duration", "num_speakers", "sampling_rate", "conversation_type", "difficulty", "has_overlaps",
        "has_simultaneous", "has_noise", "noise_type", "snr",
        _segment_list(F.col("speakers")).alias("speakers"),
        F.array_join(volumes, ",").alias("speaker_volumes"),
        F.array_join(simultaneous, ",").alias("simultaneous_segments"),
    )


@query
def track_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_row(document_plan(spark, sf_dir).track_rows())


@query
def track_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_plan(spark, sf_dir).summary()


@query
def seg_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conversation_rows(spark, sf_dir).select("track_id", F.inline_outer("speakers"))


# --- waveforms -----------------------------------------------------------------------------------------


def _waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.embedding_waves(spark, sf_dir).withColumn("audio", F.col("audio").cast("array<double>"))


@query
def dsp_gain(spark: SparkSession, sf_dir: str) -> DataFrame:
    volume = pools.slot_volume(DEFAULT, "utt_id", F.lit(0))
    return _waves(spark, sf_dir).select("utt_id", audio.micro(audio.gain(F.col("audio"), volume)).alias("samples"))


@query
def dsp_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    trimmed = audio.trim_start(F.col("audio"), F.col("utt_id") % 70)
    return _waves(spark, sf_dir).select("utt_id", audio.micro(trimmed).alias("samples"))


@query
def dsp_silence(spark: SparkSession, sf_dir: str) -> DataFrame:
    quiet = audio.silence(F.col("utt_id") % 50)
    return _waves(spark, sf_dir).select("utt_id", audio.micro(F.concat(quiet, F.col("audio"))).alias("samples"))


@query
def dsp_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _waves(spark, sf_dir).select("utt_id", F.round(audio.power(F.col("audio")), 9).alias("power"))


@query
def dsp_peak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _waves(spark, sf_dir).select("utt_id", F.round(audio.peak(F.col("audio")), 9).alias("peak"))


@query
def dsp_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    loud = audio.gain(F.col("audio"), 3.0)
    return _waves(spark, sf_dir).withColumn("audio", loud).select(
        "utt_id", audio.micro(audio.limit_peak(F.col("audio"))).alias("samples")
    )


@query
def dsp_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    looped = F.flatten(F.array_repeat("audio", (F.col("utt_id") % 25 + 1).cast("int")))
    return _waves(spark, sf_dir).select("utt_id", audio.duration(looped, 16_000).alias("duration"))


@query
def dsp_pcm16(spark: SparkSession, sf_dir: str) -> DataFrame:
    loud = audio.gain(F.col("audio"), 3.0)
    return _waves(spark, sf_dir).select("utt_id", audio.micro(audio.pcm16(loud)).alias("samples"))


@query
def dsp_snr_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    waves = _waves(spark, sf_dir)
    noise = waves.select((F.col("utt_id") - 1).alias("utt_id"), F.col("audio").alias("noise"))
    wanted = rng.between(rng.uniform01(DEFAULT.seed, "snr", "utt_id"), DEFAULT.snr_min, DEFAULT.snr_max)
    pair = waves.join(noise, "utt_id").withColumn("wanted", wanted)
    pair = pair.withColumn("scale", audio.snr_scale(F.col("audio"), F.col("noise"), F.col("wanted")))
    reached = audio.snr_reached(F.col("audio"), F.col("noise"), F.col("scale"))
    return pair.select(
        "utt_id", F.round("wanted", 6).alias("wanted"), F.round(reached, 6).alias("reached"),
        audio.micro(audio.snr_mix(F.col("audio"), F.col("noise"), F.col("scale"))).alias("samples"),
    )


def _built(spark: SparkSession, sf_dir: str, params: TrackParams) -> DataFrame:
    source = adapters.embedding_waves(spark, sf_dir)
    turns = wave_plan(spark, sf_dir, params).turns
    return waveforms.build_waveforms(turns, source, params)


@query
def dsp_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _built(spark, sf_dir, PLAIN_WAVES).select("track_id", audio.micro(F.col("audio")).alias("samples"))


@query
def dsp_concat_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``dsp_concat``, from audio stored in buckets by utterance."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = waveforms.store_bucketed(adapters.embedding_waves(spark, sf_dir), f"audio_{uuid.uuid4().hex}", buckets, work_path(spark, "audio"))
    turns = wave_plan(spark, sf_dir, PLAIN_WAVES).turns
    return waveforms.build_waveforms(turns, stored, PLAIN_WAVES).select("track_id", audio.micro(F.col("audio")).alias("samples"))


@query
def dsp_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _built(spark, sf_dir, OVERLAP_WAVES).select("track_id", audio.micro(F.col("audio")).alias("samples"))


@query
def dsp_simultaneous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _built(spark, sf_dir, LOUD_WAVES).select("track_id", audio.micro(F.col("audio")).alias("samples"))


@query
def track_waveforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _built(spark, sf_dir, NOISY_WAVES).select(
        "track_id", F.size("audio").cast("bigint").alias("n_samples"), F.round("snr", 6).alias("snr"),
        (audio.peak(F.col("audio").cast("array<double>")) <= 1.0).alias("within_range"),
    )


@query
def dataset_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job: plan, mix, store in shards, read back."""
    path = work_path(spark, "dataset")
    source = adapters.embedding_waves(spark, sf_dir)
    generate(source, source, adapters.track_requests(spark, sf_dir), path, NOISY_WAVES, 1)
    stored = spark.read.parquet(path)
    return stored.select(
        "track_id", "conversation_type", "num_speakers", "difficulty", "noise_type", F.round("snr", 1).alias("snr"),
        F.size("audio.array").cast("bigint").alias("n_samples"), F.size("speakers").cast("bigint").alias("n_segments"),
    )


@query
def generate_with_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job with some audio null, cut short or absent: lengths of good tracks, reasons of the others."""
    path = work_path(spark, "dataset")
    source = adapters.embedding_waves(spark, sf_dir)
    kept = F.when(F.col("utt_id") % 97 == 0, F.lit(None)).when(F.col("utt_id") % 89 == 0, F.slice("audio", 1, 32)).otherwise(F.col("audio"))
    damaged = source.where(F.col("utt_id") % 101 != 0).select("utt_id", kept.alias("audio"))
    made = run(source, damaged, adapters.track_requests(spark, sf_dir), path, NOISY_WAVES, 1)
    stored = spark.read.parquet(path).select(
        "track_id", F.lit("good").alias("status"), F.size("audio.array").cast("bigint").alias("n_samples"),
    )
    return stored.unionByName(made.failed.select("track_id", F.col("reason").alias("status"), F.lit(None).cast("bigint").alias("n_samples")))


def _noise(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """One noise clip per conversation turn, as long as its text."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        "conv_id", "turn", F.length("text").cast("bigint").alias("n")
    )
    key = F.conv(F.substring(rng.digest(DEFAULT.seed, "clip", "conv_id", "turn"), 1, 15), 16, 10).cast("bigint")
    clips = waveforms.noise_clips(turns, F.lit(kind), key, F.col("n"), 16_000)
    return clips.select("conv_id", "turn", "n", audio.micro(F.col("noise")).alias("samples"))


@query
def noise_white(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _noise(spark, sf_dir, "white")


@query
def noise_pink(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _noise(spark, sf_dir, "pink")


@query
def noise_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _noise(spark, sf_dir, "brown")


@query
def noise_crowd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _noise(spark, sf_dir, "crowd")


@query
def noise_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _noise(spark, sf_dir, "static")


@query
def noise_hum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _noise(spark, sf_dir, "hum")


def _square(key: int, n: int, sampling_rate: int) -> np.ndarray:
    """A square wave of 16 samples; low first where the key is odd."""
    high = (np.arange(n) // 8 + key) % 2 == 0
    return np.where(high, 0.5, -0.5)


@query
def noise_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An own kind of noise, registered for the query."""
    kernels.register_noise("square", _square)
    try:
        return _noise(spark, sf_dir, "square")
    finally:
        kernels.unregister_noise("square")


# --- sinks and streaming ----------------------------------------------------------------------------------


def _conversation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.track_rows(adapters.conversation_turns(spark, sf_dir), DEFAULT)


def _conversation_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    segs = adapters.conversation_segments(spark, sf_dir)
    return segs.groupBy("track_id").agg(tables.row_bytes(tables.wav_bytes(F.sum("n_samples"))).alias("bytes"))


@query
def snk_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "tracks")
    tables.write_tracks(_conversation_rows(spark, sf_dir), path, _conversation_sizes(spark, sf_dir), 16)
    return _flat_row(spark.read.parquet(path))


@query
def snk_shard_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.assign_shards(_conversation_sizes(spark, sf_dir), 16 * 1024 * 1024)


@query
def snk_schema_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    shaped = tables.to_track_schema(_conversation_rows(spark, sf_dir).drop("snr", "noise_type"))
    return _flat_row(shaped)


@query
def snk_jsonl_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "json")
    numbered = tables.numbered_paths(_conversation_rows(spark, sf_dir))
    tables.write_json_lines(numbered, path)
    line = F.col("value")
    return spark.read.text(path).select(
        F.get_json_object(line, "$.track_id").cast("bigint").alias("track_id"),
        F.get_json_object(line, "$.duration").cast("double").alias("duration"),
        F.get_json_object(line, "$.audio_path").alias("audio_path"),
        F.get_json_object(line, "$.speakers[0].text").alias("first_text"),
        F.contains(line, F.lit('"noise_type"')).alias("names_noise"),
    )


@query
def snk_audio_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    solvent = spark.read.parquet(f"{sf_dir}/customer.parquet").where(F.col("c_acctbal") > 0)
    tracks = solvent.select(F.col("c_custkey").cast("bigint").alias("track_id"))
    return tables.numbered_paths(tracks, width=4_096)


@query
def snk_wav_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    waves = adapters.embedding_waves(spark, sf_dir).select(F.col("utt_id").alias("track_id"), "audio")
    return wav.write_wav_files(tables.numbered_paths(waves), work_path(spark, "wav"), 16_000)


@query
def snk_batch_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.col("c_custkey").cast("bigint").alias("track_id"), (F.col("c_acctbal") * 100).cast("bigint").alias("cents")
    )
    batched = tables.with_batch_no(customers, width=4_096)
    commits = batched.groupBy("batch_no").agg(F.sum("cents").alias("cents")).where(F.col("cents") > 20_000_000)
    return tables.committed_only(batched, commits).select("track_id", "batch_no")


@query
def snk_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracks published in five batches, one of them empty and each replayed: shard, number, and file name without gaps."""
    ledger = Ledger(spark, work_path(spark, "ledger"), 4 << 20)
    tracks, sizes = _conversation_rows(spark, sf_dir), _conversation_sizes(spark, sf_dir)
    solvent = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(F.col("conv_id").alias("track_id")).distinct()
    n = solvent.count()
    for batch_no, (low, high) in enumerate([(0, n // 3), (n // 3, n // 3), (n // 3, n // 2), (n // 2, n // 2 + 1), (n // 2 + 1, 1 << 62)]):
        own = (F.col("track_id") >= low) & (F.col("track_id") < high)
        for _ in range(2):
            ledger.append(batch_no, tables.to_track_schema(tracks.where(own)), sizes.where(own), width=4_096)
    ledger.finish()
    return audio_paths(ledger.read()).select("track_id", "batch_no", "shard", "track_no", "audio_path", "duration")


@query
def snk_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers see after a job that died while it replaced a table, and after one that did not."""
    table = Versions(spark, work_path(spark, "versions"))
    tracks = _conversation_rows(spark, sf_dir).select("track_id", "duration")
    table.replace(tracks.where(F.col("track_id") % 2 == 0).write.parquet)

    def dies(path: str) -> None:
        tracks.write.parquet(path)
        raise InterruptedError

    with contextlib.suppress(InterruptedError):
        table.replace(dies)
    former = table.read()
    table.replace(tracks.write.parquet)
    return former.withColumn("version", F.lit("former")).unionByName(table.read().withColumn("version", F.lit("new")))


@query
def snk_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codec, dictionaries and row groups of stored tracks, from the files' footers."""
    path = work_path(spark, "layout")
    rows_ = _conversation_rows(spark, sf_dir)
    tables.write_tracks(rows_, path, _conversation_sizes(spark, sf_dir), row_group_bytes=1 << 14)
    # a writer looks at its size every hundred rows; groups end within that of the limit
    widest = F.max(F.when(F.col("rows") > 200, F.col("bytes")).otherwise(0))
    return layout.row_groups(spark, path).agg(
        F.array_join(F.array_sort(F.collect_set("codecs")), ",").alias("codecs"), F.sum("rows").alias("tracks"),
        (F.min("dictionary_columns") > 0).alias("dictionaries"), (widest <= 1 << 17).alias("groups_bounded"),
    )


@query
def snk_text_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = adapters.conversation_turns(spark, sf_dir).withColumn(
        "text", F.when(F.col("turn") % 2 == 0, F.col("text"))
    )
    nested = turns.groupBy("track_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("speakers"))
    filled = nested.withColumn("speakers", tables.fill_texts(F.col("speakers")))
    return filled.select("track_id", F.inline("speakers"))


@query
def scalar_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_samples")
    x = n / F.lit(16000.0)
    return adapters.document_utterances(spark, sf_dir).select(
        "utt_id",
        seconds("n_samples", 16_000).alias("seconds"),
        rng.whole(x * 1.5).alias("truncated"),
        F.round(F.pow(F.lit(10.0), x / 100.0), 6).alias("power_of_ten"),
        F.round(F.log10(x), 6).alias("log10"),
        F.round(F.sqrt(x), 6).alias("root"),
        F.round(F.sin(x * 2.0 * F.pi()), 6).alias("sine"),
        F.abs(n - 16_000).alias("distance"),
        F.least(n, F.lit(16_000)).cast("bigint").alias("at_most"),
        F.greatest(n, F.lit(16_000)).cast("bigint").alias("at_least"),
        F.format_string("track-%05d.wav", "utt_id").alias("file_name"),
        quality.two_decimals(centis("n_samples", 16_000)).alias("two_decimals"),
        F.startswith("speaker_id", F.lit("src1")).alias("starts"),
        F.endswith("speaker_id", F.lit("1")).alias("ends"),
        F.get_json_object(F.to_json(F.struct("speaker_id")), "$.speaker_id").alias("via_json"),
        F.coalesce(F.nullif("speaker_id", F.lit("src0")), F.lit("")).alias("with_default"),
    )


@query
def str_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests that arrive in four files, planned batch by batch and published through a ledger."""
    folder = work_path(spark, "requests")
    customers = adapters.track_requests(spark, sf_dir).select("track_id")
    most = customers.agg(F.max("track_id")).scalar()
    for k in range(4):
        part = customers.where((F.col("track_id") * 4 >= most * k) & (F.col("track_id") * 4 < (most * (k + 1) if k < 3 else most * 5)))
        part.coalesce(1).write.mode("append").parquet(folder)
    requests = incremental.stream_requests(spark, folder, "part-*", "track_id bigint", "track_id", files_per_batch=1)
    ledger = Ledger(spark, work_path(spark, "published"), 32 << 20)
    incremental.publish_incrementally(requests, adapters.document_utterances(spark, sf_dir), ledger, work_path(spark, "published-state"), DEFAULT)
    return audio_paths(ledger.read()).select("track_id", "shard", "track_no", "audio_path", "duration", "num_speakers")


@query
def str_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/customer.parquet").schema
    requests = incremental.stream_requests(spark, sf_dir, "customer.parquet", schema, "c_custkey")
    out = work_path(spark, "stream")
    incremental.generate_incrementally(
        requests, adapters.document_utterances(spark, sf_dir), out, work_path(spark, "stream-state"), DEFAULT
    )
    return _flat_row(incremental.incremental_rows(spark, out))
