"""Audio travels once to a task, in however many pieces it is heard, and shards are written in parts."""

import os

from pyspark.sql import functions as F

from colloquy.operators import specs, waveforms
from colloquy.plans import catalog, tracks
from colloquy.plans.tracks import plan, run
from colloquy.session import stage, work_path
from colloquy.sources import adapters


def wave_turns(spark, small, params):
    source = adapters.embedding_waves(spark, small)
    return source, stage(plan(source, adapters.track_requests(spark, small).where("track_id < 60"), params).turns, work_path(spark, "turns"))


def test_same_waveforms_as_from_slices(spark, small):
    source, turns = wave_turns(spark, small, catalog.NOISY_WAVES)
    # some audio absent, some cut short, some twice
    audio = source.where("utt_id % 101 <> 0").withColumn("audio", F.when(F.col("utt_id") % 89 == 0, F.slice("audio", 1, 32)).otherwise(F.col("audio"))).drop("n_samples")
    audio = audio.unionByName(audio.where("utt_id % 97 = 0"))
    piece_rows = stage(waveforms.pieces(turns, catalog.NOISY_WAVES), work_path(spark, "pieces"))
    wanted = waveforms.wanted_audio(piece_rows, audio, catalog.NOISY_WAVES)
    whole = piece_rows.join(waveforms.find_gaps(piece_rows, wanted), "track_id", "left_anti")
    want = waveforms.mix_down(waveforms.cut_slices(whole, waveforms.pack_audio(wanted)), catalog.NOISY_WAVES).collect()
    found = waveforms.build_waveforms(turns, audio, catalog.NOISY_WAVES).collect()
    assert 0 < len(want) < 60 and sorted(map(str, found)) == sorted(map(str, want))


def test_audio_travels_once_to_a_task(spark, small):
    source, turns = wave_turns(spark, small, catalog.OVERLAP_WAVES)
    made = waveforms.build_waveforms(turns, source, catalog.OVERLAP_WAVES)
    text = made._jdf.queryExecution().executedPlan().toString()
    above = text[: text.index("ShuffledHashJoin")]
    assert "Exchange" not in above and "Sort [" not in above  # no slice is moved or sorted
    pieces_read = [line for line in text.splitlines() if "FileScan" in line and "half_tail" in line]
    assert len(pieces_read) == 1 and "audio" not in pieces_read[0]


def test_tasks_hold_bounded_audio(spark, small, monkeypatch):
    source, turns = wave_turns(spark, small, catalog.PLAIN_WAVES)
    piece_rows = stage(waveforms.pieces(turns, catalog.PLAIN_WAVES), work_path(spark, "pieces"))
    monkeypatch.setattr(waveforms, "_TASK_SAMPLES", 1_000)
    dealt = waveforms.cut_slices_by_task(piece_rows, waveforms.pack_audio(source), 100, 64_000)
    assert dealt.rdd.getNumPartitions() == 64


def test_shards_are_written_in_parts(spark, small, tmp_path, monkeypatch):
    source, requests = adapters.embedding_waves(spark, small), specs.requests(spark, 700)

    def stored(path):
        made = run(source, source, requests, path, catalog.NOISY_WAVES, 1)
        assert os.path.exists(f"{path}/_SUCCESS")
        files = made.manifest.collect()
        assert len(files) == len({r["shard"] for r in files}) > 2  # one file a shard
        assert made.totals.first()["tracks"] == 700 and made.failed.count() == 0
        return sorted(map(str, spark.read.parquet(path).collect()))

    want = stored(f"{tmp_path}/a")
    monkeypatch.setattr(tracks, "_PART_BYTES", 2 << 20)
    monkeypatch.setattr(tracks, "_PART_SHARDS_PER_CORE", 0)
    parts = []
    monkeypatch.setattr(tracks.tables, "write_part", lambda *a, _write=tracks.tables.write_part, **k: (parts.append(k), _write(*a, **k)))
    assert stored(f"{tmp_path}/b") == want
    assert len(parts) > 1 and [k["append"] for k in parts] == [k > 0 for k in range(len(parts))] and [k["last"] for k in parts] == [False] * (len(parts) - 1) + [True]
