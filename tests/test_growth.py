"""Work is spread by what it costs, not by how narrow its rows are."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from colloquy.operators import pools, turns
from colloquy.params import TrackParams
from colloquy.plans.tracks import plan
from colloquy.session import by_track
from colloquy.sources import adapters

P = TrackParams()


@contextmanager
def settings(spark, **values):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_partitions_grow_with_rows(spark):
    df = spark.range(10).withColumnRenamed("id", "track_id")
    assert by_track(df).rdd.getNumPartitions() == 8
    assert by_track(df, rows=20_000_000).rdd.getNumPartitions() == 40


def test_slots_are_spread_after_a_merge_join(spark, small):
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        index = pools.utterance_index(adapters.document_utterances(spark, small), P)
        slots = pools.speaker_slots(adapters.track_requests(spark, small), index, P)
        tasks = slots.groupBy(F.spark_partition_id()).count().count()
        assert tasks == 8


def test_turns_are_sorted_once_in_tasks_of_bounded_size(spark, small):
    made = plan(adapters.document_utterances(spark, small), adapters.track_requests(spark, small), P)
    text = made.turns._jdf.queryExecution().executedPlan().toString()
    assert len([line for line in text.splitlines() if "Sort [" in line]) == 2  # the order of each pool, and the turns
    assert "SortMergeJoin" not in text
    assert turns.plan_turns(made.pools, P, 2_000_000).rdd.getNumPartitions() == 20


def test_turns_laid_fit_into_the_track_with_all_its_pools(spark):
    """Of two pools, what both together can say before the target is laid, not what each could alone."""
    pools_ = spark.sql("select track_id, spk, pool_rank, track_id * 1000 + spk * 100 + pool_rank as utt_id, 40000L as n_samples "
                       "from (select id as track_id from range(40)), (select id as spk from range(2)), (select id as pool_rank from range(31))")
    laid = turns.lay_turns(turns.sized_pools(pools_, P), P).groupBy("track_id").agg(F.count("*").alias("n"), F.max("target_samples").alias("target"))
    assert all(r.n == (r.target - 1) // 40_000 + 1 for r in laid.collect())
    # one pool of two short utterances is begun as often as it takes
    short = pools_.where("spk = 0 and pool_rank < 2").withColumn("n_samples", F.lit(1000).cast("bigint"))
    planned = turns.plan_turns(short, P).groupBy("track_id").agg(F.sum("n_samples").alias("said"), F.max("cum_after").alias("after"), F.max("target_samples").alias("target"))
    assert all(r.said <= r.after and r.target <= r.after for r in planned.collect())
