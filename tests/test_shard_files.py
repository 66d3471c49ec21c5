"""One file a shard, in one folder."""

import os

from pyspark.sql import functions as F

from colloquy.plans.catalog import NOISY_WAVES
from colloquy.plans.tracks import run
from colloquy.sinks import tables
from colloquy.sources import adapters


def check(spark, path, manifest, limit, sizes, least=4):
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    assert not [f for f in os.listdir(path) if os.path.isdir(f"{path}/{f}")]
    rows = manifest.collect()
    assert len(files) == len(rows) == len({r["shard"] for r in rows}) >= least
    held = spark.read.parquet(path).select("track_id", "shard").join(sizes, "track_id").groupBy("shard").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
    assert all(r["bytes"] <= limit or r["n"] == 1 for r in held.collect())


def test_written_tracks(spark, tmp_path):
    tracks = spark.range(500).select(F.col("id").alias("track_id"), F.array().cast(tables.TRACK_COLUMNS[9][1]).alias("speakers"))
    sizes = tracks.select("track_id", (20_000 + F.col("track_id") % 7 * 9_000).alias("bytes"))
    made = tables.write_tracks(tracks, f"{tmp_path}/t", sizes, 1)
    check(spark, f"{tmp_path}/t", made, 1 << 20, sizes)
    assert made.agg(F.sum("tracks")).first()[0] == 500


def test_whole_run(spark, small, tmp_path):
    source = adapters.embedding_waves(spark, small, repeat=40)
    requests = adapters.track_requests(spark, small).where("track_id <= 60")
    made = run(source, source, requests, f"{tmp_path}/tracks", NOISY_WAVES, 0.125)
    stored = spark.read.parquet(f"{tmp_path}/tracks")
    sizes = stored.select("track_id", tables.row_bytes(tables.wav_bytes(F.size("audio.array"))).alias("bytes"))
    check(spark, f"{tmp_path}/tracks", made.manifest, 1 << 17, sizes, 2)
    assert made.totals.first()["tracks"] == stored.count() == requests.count()
