"""A task writes several shards, a file for each; tasks and their results don't grow with small shards."""

import os

from pyspark.sql import functions as F

from colloquy.session import qualified
from colloquy.sinks import tables
from colloquy.sinks.ledger import Ledger


def parts(path):
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    return len(files), len({f.split("-")[1] for f in files})


def test_written_tracks(spark, tmp_path):
    tracks = spark.range(900).select(F.col("id").alias("track_id"), F.array().cast(tables.TRACK_COLUMNS[9][1]).alias("speakers"))
    sizes = tracks.select("track_id", F.when(F.col("track_id") % 3 == 0, 2 << 20).otherwise(500_000 + F.col("track_id") % 7).cast("bigint").alias("bytes"))
    shards = {r.track_id: r.shard for r in tables.assign_shards(sizes, 1 << 20).collect()}
    path = f"{tmp_path}/it's"  # quoted in SQL
    made = tables.write_tracks(tracks, path, sizes, 1)
    n_files, n_tasks = parts(path)
    assert n_files == made.count() == made.select("shard").distinct().count() == len(set(shards.values())) > 800 and n_tasks <= 60
    stored = spark.read.parquet(path)
    assert stored.columns == ["track_id", *[c for c, _ in tables.TRACK_COLUMNS], "shard"]
    assert sorted((r.track_id, r.shard) for r in stored.collect()) == sorted(shards.items())
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("shards_")]
    tables.write_tracks(tracks.where("track_id < 90"), path, sizes.where("track_id < 90"), 1)  # replaces
    assert tables.count_back(spark, path).first().n_rows == 90 and parts(path)[0] < 90


def test_relative_paths(spark):
    assert qualified(spark, "tracks/a") == f"file:{os.getcwd()}/tracks/a"


def test_no_tracks(spark, tmp_path):
    tracks = spark.range(0).select(F.col("id").alias("track_id"), F.array().cast(tables.TRACK_COLUMNS[9][1]).alias("speakers"))
    made = tables.write_tracks(tracks, f"{tmp_path}/t", tracks.select("track_id", F.lit(1).cast("bigint").alias("bytes")), 1)
    assert made.count() == 0 and spark.read.parquet(f"{tmp_path}/t").count() == 0


def test_ledger(spark, tmp_path):
    rows = spark.range(1_000).select(F.col("id").alias("track_id"), F.concat(F.lit("row "), "id").alias("text"))
    sizes = rows.select("track_id", F.when(F.col("track_id") % 4 == 0, 5_000).otherwise(120).cast("bigint").alias("bytes"))
    ledger = Ledger(spark, f"{tmp_path}/t", 1_000, 125)
    for n, own in enumerate(("track_id < 700", "track_id >= 700")):
        ledger.append(n, rows.where(own), sizes.where(own))
        files = [parts(f"{tmp_path}/t/data/{f}") for f in os.listdir(f"{tmp_path}/t/data")]
        assert all(n_tasks * 3 < n_files for n_files, n_tasks in files)
    ledger.finish()
    files = ledger.manifest()
    assert files.count() == files.select("shard").distinct().count() == 250 + 750 * 120 // 875 + 1
    want, before, large = {}, 0, 0
    for r in sizes.orderBy("track_id").collect():
        large += r.bytes > 125
        want[r.track_id] = -large if r.bytes > 125 else before // 875
        before += r.bytes if r.bytes <= 125 else 0
    assert {r.track_id: r.shard for r in ledger.read().collect()} == want
