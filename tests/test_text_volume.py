"""Texts travel once to a task, in whatever number of turns they are said, and shuffle files go with their job."""

import time

from pyspark.sql import functions as F
from test_growth import settings

from colloquy.operators import labels, rows
from colloquy.params import TrackParams
from colloquy.plans.tracks import plan
from colloquy.session import stage
from colloquy.sources import adapters

P = TrackParams()


def shuffle_files(spark):
    found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {name for name in found.splitlines() if "/shuffle_" in name}


def test_texts_travel_once_to_a_task(spark, small):
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        plan_ = plan(adapters.document_utterances(spark, small), adapters.track_requests(spark, small), P)
        text = plan_.track_rows()._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" in text and "ObjectHashAggregate" not in text  # nested in the order of the turns
    above = text[: text.index("ShuffledHashJoin")]
    assert "Exchange" not in above and "Sort [" not in above  # nothing is moved or sorted once it has its text


def test_same_rows_with_nulls_and_repeated_utterances(spark, tmp_path):
    utterances = spark.sql("select if(id = 11, null, id % 9) as utt_id, 's' as speaker_id, if(id % 4 = 0, null, concat('text ', id)) as text from range(12)")
    turns = stage(spark.sql(
        "select if(t = 3, null, t) as track_id, n as turn, n % 2 as spk, 2L as n_spk, if(n = 2, null, (t * 5 + n) % 12) as utt_id, 16000L as n_samples, "
        "if(n = 1, 'simultaneous', 'pause') as kind, if(n = 1, 1L, null) as sim_spk, if(n = 1, 800L, null) as sim_samples, n * 16000 as cum_before, n * 16000 + 16000 as cum_after "
        "from (select id as t from range(300)), (select id as n from range(6))"), f"{tmp_path}/turns")
    want = rows.track_rows(labels.with_text(turns, utterances), P)
    found = rows.track_rows_with_texts(turns, utterances, P, 1_800)
    assert found.columns == want.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))


def test_tasks_hold_a_bounded_amount_of_text(spark, monkeypatch):
    monkeypatch.setattr(labels, "_TASK_TEXT_BYTES", 1_000)
    utterances = spark.range(100).select(F.col("id").alias("utt_id"), F.lit("s").alias("speaker_id"), F.repeat(F.lit("x"), 100).alias("text"))
    turns = spark.range(400).select((F.col("id") / 10).cast("bigint").alias("track_id"), F.col("id").alias("turn"), (F.col("id") % 100).alias("utt_id"))
    assert labels.with_text_by_task(turns, utterances, 400).rdd.getNumPartitions() == 40  # ten texts a task
    monkeypatch.setattr(labels, "_TASK_TEXT_BYTES", 10_000)
    assert labels.with_text_by_task(turns, utterances, 400).rdd.getNumPartitions() == 8  # all of them fit


def test_shuffle_files_go_with_their_job(spark, tmp_path):
    before = shuffle_files(spark)
    stage(spark.range(10_000).repartition(7, "id").groupBy("id").count(), f"{tmp_path}/t")
    for _ in range(50):  # they go in the background
        if shuffle_files(spark) <= before:
            return
        time.sleep(0.1)
    raise AssertionError("left behind")
