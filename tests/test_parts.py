"""Draws, numbering, waveforms, sinks, parameters, plan shapes."""

import collections
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquy.functions import kernels, rng
from colloquy.operators import waveforms
from colloquy.operators.numbering import running_totals
from colloquy.params import TrackParams, probabilities_ok
from colloquy.plans.tracks import generate, plan
from colloquy.session import work_path
from colloquy.sinks import tables, wav
from colloquy.sources import adapters
from colloquy.sources.utterances import at_rate, audio_array

P = TrackParams()


def test_distinct_draws_are_uniform(spark):
    n, k, rows = 6, 3, 6000
    drawn = spark.range(rows).select(
        rng.distinct_below(F.lit(n).cast("bigint"), F.lit(k).cast("bigint"), lambda i: rng.uniform01(1, "t", "id", i)).alias("s")
    ).collect()
    counts = collections.Counter(frozenset(r.s) for r in drawn)
    assert all(len(s) == k for s in counts)
    assert len(counts) == 20
    expected = rows / 20
    assert sum((c - expected) ** 2 / expected for c in counts.values()) < 50


@pytest.mark.parametrize("n,k", [(0, 0), (1, 1), (5, 5), (40, 30)])
def test_distinct_draws_at_the_edges(spark, n, k):
    row = spark.range(1).select(
        rng.distinct_below(F.lit(n).cast("bigint"), F.lit(k).cast("bigint"), lambda i: rng.uniform01(1, "t", "id", i)).alias("s")
    ).first()
    assert len(set(row.s)) == k and all(0 <= x < n for x in row.s)


@pytest.mark.parametrize("width", [1, 3, 64, 10_000])
def test_running_totals_over_blocks(spark, width):
    data = spark.range(0, 600, 3).select(
        F.col("id"), F.when(F.col("id") % 4 > 0, "hot").alias("g"), (F.col("id") % 7).alias("v")
    )
    got = running_totals(data, "id", width, {"no": ((), F.lit(1)), "rank": (("g",), F.lit(1)), "run": (("g",), F.col("v"))})
    ranks, runs, sums = collections.Counter(), collections.Counter(), collections.Counter()
    for r in data.collect():
        sums[r.g] += r.v
    for i, r in enumerate(sorted(got.collect(), key=lambda r: r.id)):
        assert (r.no, r.no_total) == (i, 200)
        assert (r["rank"], r.run, r.run_total) == (ranks[r.g], runs[r.g], sums[r.g])
        ranks[r.g] += 1
        runs[r.g] += r.v


def test_waveform_invariants(spark, small):
    params = TrackParams(sampling_rate=32, end_reserve=10)
    source = adapters.embedding_waves(spark, small)
    made = plan(source, adapters.track_requests(spark, small), params)
    meta = {r.track_id: r for r in made.track_rows(text=False).collect()}
    built = waveforms.build_waveforms(made.turns, source, params).collect()
    assert {r.track_id for r in built} == set(meta)
    for r in built:
        m = meta[r.track_id]
        assert abs(len(r.audio) / 32 - m.duration) < 0.01
        assert max(map(abs, r.audio)) <= 1.0 + 1e-6
        assert (r.snr is None) == (not m.has_noise)
        if r.snr is not None:
            assert abs(r.snr - m.snr) < 0.006


def test_noise_kernels():
    for kind in ("white", "pink", "brown", "crowd", "cafe", "static", "hum", "no such kind"):
        x = kernels.noise(kind, 99, 5000, 16_000)
        assert len(x) == 5000 and np.isclose(np.abs(x).max(), 1.0)
        assert np.array_equal(x, kernels.noise(kind, 99, 5000, 16_000))
    assert np.array_equal(kernels.noise("crowd", 5, 900, 16_000), kernels.noise("cafe", 5, 900, 16_000))
    assert np.array_equal(kernels.noise("no such kind", 5, 900, 16_000), kernels.noise("white", 5, 900, 16_000))
    assert not kernels.noise("pink", 5, 6, 16_000).any()
    assert len(kernels.noise("static", 5, 0, 16_000)) == 0


def test_pink_feedback_is_exact():
    n, key = 4000, 1234
    w = kernels.normals(key, n, 6, 7)
    x = np.zeros(n)
    for i in range(6, n):
        x[i] = sum(c * w[i - j] for j, c in enumerate(kernels.PINK_TAPS))
        x[i] -= sum(a * x[i - 1 - j] for j, a in enumerate(kernels.PINK_FEEDBACK))
    assert np.allclose(x, kernels.pink(key, n), rtol=0, atol=1e-12)


def test_snr_and_peaks():
    signal = np.sin(np.arange(8000) / 20)
    mixed, reached = kernels.mix_at_snr(signal, kernels.noise("white", 3, 8000, 16_000), 12.5)
    assert abs(reached - 12.5) < 1e-9 and np.abs(mixed).max() <= 1.0
    same, silent = kernels.mix_at_snr(signal, np.zeros(8000), 12.5)
    assert same is signal and silent == float("inf")
    assert np.array_equal(kernels.limit_peak(np.array([1.0, -1.0])), np.array([1.0, -1.0]))
    assert np.allclose(kernels.limit_peak(np.array([0.5, -2.0])), [0.25, -1.0])


def test_audio_columns(spark):
    frame = spark.sql("select 1L as utt_id, array(0.5f, -1f) as bare, named_struct('array', array(1d), 'sampling_rate', 8000L) as wrapped, 3 as bad")
    assert frame.select(audio_array(frame, "bare").alias("a")).first().a == [0.5, -1.0]
    assert frame.select(audio_array(frame, "wrapped").alias("a")).first().a == [1.0]
    assert at_rate(frame, 16_000, "wrapped").count() == 0 and at_rate(frame, 16_000, "bare").count() == 1
    with pytest.raises(ValueError):
        audio_array(frame, "bad")


def test_shards_keep_the_limit(spark):
    sizes = spark.range(3000).select(
        F.col("id").alias("track_id"), F.when(F.col("id") % 500 == 0, 1500).otherwise(F.col("id") % 97 + 1).cast("bigint").alias("bytes")
    )
    shards = collections.defaultdict(list)
    for r in tables.assign_shards(sizes, 1000, width=64).collect():
        shards[r.shard].append(r.bytes)
    assert all(sum(s) <= 1000 or len(s) == 1 for s in shards.values())
    assert sum(map(len, shards.values())) == 3000
    small = sum(b for s in shards.values() for b in s if b <= 500)
    assert len(shards) <= small / 800 + 8


def test_wav_files(spark, tmp_path):
    frame = spark.createDataFrame(
        [(0, "audio/track-00000.wav", [0.0, 0.5, -1.0, 2.0])], "track_id bigint, audio_path string, audio array<float>"
    )
    written = wav.write_wav_files(frame, str(tmp_path), 16_000).collect()
    assert written[0].bytes == 44 + 8
    with wave.open(str(tmp_path / "audio/track-00000.wav")) as f:
        assert (f.getnchannels(), f.getsampwidth(), f.getframerate()) == (1, 2, 16_000)
        assert list(np.frombuffer(f.readframes(9), "<i2")) == [0, 16384, -32767, 32767]


def test_generate_writes_one_file_per_shard(spark, small):
    params = TrackParams(sampling_rate=32, end_reserve=10)
    source = adapters.embedding_waves(spark, small)
    path = work_path(spark, "test-dataset")
    files = generate(source, source, adapters.track_requests(spark, small), path, params, max_megabytes=1).collect()
    assert len({f.file for f in files}) == len({f.shard for f in files}) == len(files)
    assert sum(f.tracks for f in files) == 150 == tables.count_back(spark, path).first().n_rows
    stored = spark.read.parquet(path)
    assert stored.where("size(speakers) = 0 or audio.sampling_rate <> 32 or (has_noise and snr is null)").count() == 0


def test_parameters_are_checked():
    for bad in (
        {"min_duration": 0}, {"max_duration": 10}, {"overlap_probability": 1.5}, {"pattern_weights": (("dialogue", 0.5),)},
        {"noise_types": ()}, {"null_speaker": "keep"}, {"snr_max": 5}, {"simultaneous_min": 0.00001},
    ):
        with pytest.raises(ValueError):
            TrackParams(**bad)
    assert probabilities_ok([0.33, 0.33, 0.34]) and not probabilities_ok([0.5, 0.4])


def _physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, small):
    text = _physical(adapters.document_utterances(spark, small, language="en").select("utt_id", "n_samples"))
    assert "EqualTo(lang,en)" in text
    assert "ReadSchema: struct<doc_id:bigint,lang:string,n_chars:bigint>" in text


def test_planner_moves_each_pool_row_once_per_use(spark, small):
    """Whatever the sizes: partition by track, and nothing else is exchanged or crossed."""
    made = plan(adapters.document_utterances(spark, small), adapters.track_requests(spark, small), P)
    text = _physical(made.turns)
    exchanges = [line for line in text.splitlines() if "Exchange" in line]
    assert exchanges and all("hashpartitioning(track_id" in line for line in exchanges)
    assert "Cartesian" not in text and "NestedLoop" not in text and "Broadcast" not in text


def test_no_cross_join_in_pools(spark, small):
    made = plan(adapters.gappy_utterances(spark, small), adapters.track_requests(spark, small), P)
    from colloquy.operators.pools import build_pools
    text = _physical(build_pools(made.slots, made.index, P))
    assert "Cartesian" not in text and "NestedLoop" not in text
