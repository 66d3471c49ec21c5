"""Runs as a whole: failures, pruned audio, working tables, independent draws."""

import os
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquy import session
from colloquy.functions import kernels, rng
from colloquy.operators import waveforms
from colloquy.plans.catalog import NOISY_WAVES
from colloquy.plans.tracks import plan, run
from colloquy.sources import adapters


def _fake(master, folder=None):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: folder), sparkContext=SimpleNamespace(master=master))


def test_no_local_working_folder_on_a_cluster():
    assert session.shared_folder(_fake("spark://host:7077", "hdfs://x/y/")) == "hdfs://x/y"
    assert session.shared_folder(_fake("local[4]"))
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError, match="checkpoint"):
            session.shared_folder(_fake(master))


def _report(spark, small, tmp_path, audio):
    source = adapters.embedding_waves(spark, small)
    requests = adapters.track_requests(spark, small).where("track_id between 1 and 12")
    return run(source, audio(source), requests, f"{tmp_path}/tracks", NOISY_WAVES, 1)


def test_run_without_any_audio_reports_all_tracks(spark, small, tmp_path):
    made = _report(spark, small, tmp_path, lambda source: source.select("utt_id", F.lit(None).cast("array<float>").alias("audio")))
    failed = made.failed.collect()
    assert len(failed) == 12 and {r["reason"] for r in failed} == {"audio missing"}


def test_struct_audio_and_totals(spark, small, tmp_path):
    os.makedirs(folder := session.work_path(spark, "x").rpartition("/")[0], exist_ok=True)
    before = set(os.listdir(folder))
    wrapped = lambda s: s.select("utt_id", F.struct(F.col("audio").alias("array"), F.lit(NOISY_WAVES.sampling_rate).cast("bigint").alias("sampling_rate")).alias("audio"))
    made = _report(spark, small, tmp_path, wrapped)
    totals = made.totals.first()
    assert (totals["tracks"], totals["failed"]) == (12, 0) and totals["files"] >= 1
    left = set(os.listdir(folder)) - before
    assert all(name.startswith("failed-") for name in left)  # the list of failures is a result


def test_audio_is_pruned_before_it_is_packed(spark, small):
    source = adapters.embedding_waves(spark, small)
    turns = plan(source, adapters.track_requests(spark, small).where("track_id <= 5"), NOISY_WAVES).turns
    piece_rows = waveforms.pieces(turns, NOISY_WAVES)
    packed = waveforms.pack_audio(waveforms.wanted_audio(piece_rows, source.select("utt_id", "audio"), NOISY_WAVES))
    text = packed._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("MapInArrow") < text.index("LeftSemi")


def test_no_clip_is_a_shifted_part_of_another():
    n, lag = 4_000, 1_000
    for key in (5, 1 << 40, 123_456_789_012):
        base = kernels.hash_counter(key, 0, n)
        others = [key + lag, key - lag, key ^ 1, key + (lag << 32), (key + lag * 0x9E3779B9) & ((1 << 60) - 1)]
        for other in others:
            moved = kernels.hash_counter(other % (1 << 60), 0, n)
            assert np.intersect1d(base, moved).size < 10
            assert not (base[lag:] == moved[: n - lag]).any()


def test_draws_reach_large_tables_evenly(spark):
    n = (1 << 33) + 1
    drawn = spark.range(40_000).select(rng.below(rng.wide01(1, "t", "id"), F.lit(n)).alias("x"))
    row = drawn.agg(F.count_distinct("x"), F.sum((F.col("x") % 2).cast("int")), F.count_if(F.col("x") < n // 2), F.max("x")).first()
    assert row[0] > 39_990 and abs(row[1] - 20_000) < 600 and abs(row[2] - 20_000) < 600 and row[3] < n
