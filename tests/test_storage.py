"""Replaced tables, damaged files, footers, sketches, bucketed audio, published streams."""

import os
import re
import uuid

import pytest
from pyspark.sql import functions as F

from colloquy.operators import sketches, waveforms
from colloquy.plans.catalog import DEFAULT, PLAIN_WAVES, wave_plan
from colloquy.sinks import layout, tables
from colloquy.sinks.commits import CommitLog
from colloquy.sinks.ledger import Ledger, audio_paths
from colloquy.sinks.versions import Versions
from colloquy.sources import adapters
from colloquy.sources.tolerant import read_tolerantly
from colloquy.streaming import incremental


def test_versions(spark, tmp_path):
    table = Versions(spark, f"{tmp_path}/t")
    with pytest.raises(FileNotFoundError):
        table.read()

    def half(path):
        spark.range(5).write.parquet(path)
        raise OSError("died")

    with pytest.raises(OSError, match="died"):
        table.replace(half)
    assert table.current() is None
    table.replace(spark.range(3).write.parquet)
    with pytest.raises(OSError, match="died"):
        table.replace(half)
    assert table.read().count() == 3
    former = table.read()
    table.replace(spark.range(7).write.parquet)
    assert table.read().count() == 7 and former.count() == 3  # who reads the old one goes on
    assert table.vacuum() == 3 and table.vacuum() == 0 and table.read().count() == 7


def _folder(spark, tmp_path, n=4):
    """Files of some row groups each; their names."""
    path = f"{tmp_path}/damaged"
    frame = spark.range(40_000).select("id", F.md5(F.col("id").cast("string").cast("binary")).alias("text"))
    frame.repartitionByRange(n, "id").write.option("parquet.block.size", 1 << 16).option("parquet.page.size", 1 << 12).option("compression", "none").parquet(path)
    return path, frame, sorted(f for f in os.listdir(path) if f.endswith(".parquet"))


def test_tolerant_reading(spark, tmp_path):
    path, frame, names = _folder(spark, tmp_path)
    good, bad = read_tolerantly(spark, path, frame.schema)
    assert good.count() == 40_000 and bad.count() == 0
    whole = open(f"{path}/{names[0]}", "rb").read()
    open(f"{path}/{names[0]}", "wb").write(whole[: len(whole) // 2])  # truncated
    middle = bytearray(open(f"{path}/{names[2]}", "rb").read())
    at = len(middle) * 3 // 5
    middle[at : at + 40_000] = b"\xff" * 40_000  # sound footer, damaged pages
    open(f"{path}/{names[2]}", "wb").write(bytes(middle))
    for name in names:
        crc = f"{path}/.{name}.crc"
        if os.path.exists(crc):
            os.replace(crc, f"{tmp_path}/{uuid.uuid4().hex}")  # as on stores without side files
    open(f"{path}/junk.parquet", "wb").write(b"junk")
    spark.createDataFrame([], frame.schema).coalesce(1).write.parquet(f"{tmp_path}/empty")
    empty = next(f for f in os.listdir(f"{tmp_path}/empty") if f.endswith(".parquet"))
    os.replace(f"{tmp_path}/empty/{empty}", f"{path}/{empty}")

    good, bad = read_tolerantly(spark, path, frame.schema)
    found = {os.path.basename(r["file"]): r["reason"] for r in bad.collect()}
    assert set(found) == {names[0], names[2], "junk.parquet"}
    assert found[names[0]] == found["junk.parquet"] == "no readable footer"
    assert re.fullmatch(r"\d+ of \d+ rows readable", found[names[2]])
    want = {r["id"] for n in (names[1], names[3]) for r in spark.read.parquet(f"{path}/{n}").collect()}
    assert {r["id"] for r in good.collect()} == want and good.columns == ["id", "text"]
    only_footers = read_tolerantly(spark, path, frame.schema, pages=False)[1]
    assert {os.path.basename(r["file"]) for r in only_footers.collect()} == {names[0], "junk.parquet"}


def test_row_groups(spark, tmp_path):
    path, frame, names = _folder(spark, tmp_path, 2)
    groups = layout.row_groups(spark, path).collect()
    assert sum(r["rows"] for r in groups) == 40_000 and len({r["file"] for r in groups}) == len(names)
    assert len(groups) > 8 and all(r["codecs"] == "UNCOMPRESSED" and r["columns"] == 2 for r in groups)


def test_sketches(spark, tmp_path):
    people = spark.range(60_000).select(F.when(F.col("id") % 1_000 != 0, F.col("id") % 20_011).cast("string").alias("speaker_id"), "id")
    exact = people.agg(F.count_distinct("speaker_id")).first()[0] + 1
    for batch_no in (0, 1, 2, 1):
        sketches.store_sketches(people.where(F.col("id") % 3 == batch_no), f"{tmp_path}/s", batch_no)
    merged = sketches.stored_estimate(spark, f"{tmp_path}/s").first()
    whole = sketches.merged(sketches.speaker_sketches(people.withColumn("k", F.lit(1)), "k")).first()
    assert merged["n_utterances"] == 60_000 and merged["n_speakers"] == whole["n_speakers"]
    assert abs(merged["n_speakers"] - exact) <= 4 * sketches.STANDARD_ERROR * exact


def test_bucketed_audio_is_not_shuffled(spark, small, tmp_path):
    source = adapters.embedding_waves(spark, small)
    stored = waveforms.store_bucketed(source, f"audio_{uuid.uuid4().hex}", 8, f"{tmp_path}/audio")
    pieces = waveforms.pieces(wave_plan(spark, small, PLAIN_WAVES).turns, PLAIN_WAVES)
    plan = waveforms.cut_slices(pieces, stored)._jdf.queryExecution().executedPlan().toString()
    join = plan[plan.index("SortMergeJoin"):]
    audio_side = join[join.rindex("Scan parquet") if "Bucketed: true" in join else 0:]
    assert "Bucketed: true" in join and "SelectedBucketsCount: 8 out of 8" in audio_side
    lines = join.splitlines()
    scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    above = [line for line in lines[1:scan] if depth(line) < depth(lines[scan])]
    branch, level = [], depth(lines[scan])
    for line in reversed(above):  # the chain of nodes between the scan and the join
        if depth(line) < level:
            branch.append(line)
            level = depth(line)
    assert not any("Exchange" in line for line in branch), plan


def test_published_stream_survives_a_death(spark, small, tmp_path, monkeypatch):
    """A stream that dies between data and commit, started again: the same tracks, shards and numbers as in one batch."""
    for k in range(3):
        spark.range(1 + 4 * k, 5 + 4 * k).select(F.col("id").alias("track_id")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/requests")
    utterances = adapters.document_utterances(spark, small)

    def start(path, per_batch):
        ledger = Ledger(spark, f"{tmp_path}/{path}", 16 << 20)
        requests = incremental.stream_requests(spark, f"{tmp_path}/requests", "part-*", "track_id bigint", "track_id", per_batch)
        incremental.publish_incrementally(requests, utterances, ledger, f"{tmp_path}/{path}-state", DEFAULT)
        return ledger

    def rows(ledger):
        return sorted(tuple(r) for r in audio_paths(ledger.read()).select("track_id", "shard", "audio_path", "duration").collect())

    whole = rows(start("whole", 16))
    assert [r[0] for r in whole] == list(range(1, 13)) and len({r[1] for r in whole}) > 1
    put, calls = CommitLog.put, []

    def dying(self, number, record):
        calls.append(number)
        if calls == [0, 1]:
            raise OSError("killed")
        put(self, number, record)

    monkeypatch.setattr(CommitLog, "put", dying)
    with pytest.raises(Exception, match="killed"):
        start("parts", 1)
    assert len(rows(Ledger(spark, f"{tmp_path}/parts", 16 << 20))) <= 4
    ledger = start("parts", 1)
    assert rows(ledger) == whole and len(ledger.vacuum()) == 1
    assert calls[:3] == [0, 1, 1]


def test_row_group_option(spark, small, tmp_path):
    rows = spark.range(3_000).select(F.col("id").alias("track_id"), F.lit("dialogue").alias("conversation_type"), F.array().cast(tables.TRACK_COLUMNS[9][1]).alias("speakers"))
    sizes = rows.select("track_id", F.lit(10).alias("bytes"))
    tables.write_tracks(rows, f"{tmp_path}/t", sizes, row_group_bytes=1 << 13)
    groups = layout.row_groups(spark, f"{tmp_path}/t").collect()
    assert len(groups) > 3 and {r["codecs"] for r in groups} == {"ZSTD"} and sum(r["rows"] for r in groups) == 3_000
