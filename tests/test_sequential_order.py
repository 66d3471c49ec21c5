"""An order of speech without window form, over batches that cut tracks."""

from pyspark.sql import functions as F

from colloquy.operators.patterns import assign_speakers, assign_speakers_sequential

from test_growth import settings


def test_sequential_order_runs_on_over_batches(spark):
    turns = spark.range(40).select(
        (F.col("id") % 3).alias("track_id"), F.floor(F.col("id") / 3).cast("bigint").alias("turn"), F.lit("dialogue").alias("pattern"),
        F.lit(2).cast("bigint").alias("n_spk"), F.lit(0.5).alias("u"), F.lit(0.5).alias("v"),
    )
    turns = turns.unionByName(turns.where("track_id = 1").withColumn("track_id", F.lit(None).cast("bigint")))
    stepwise = assign_speakers_sequential(turns, lambda turn, n, u, v, spoken: len(spoken) % n)
    assert "FlatMapGroups" not in stepwise._jdf.queryExecution().executedPlan().toString()
    with settings(spark, **{"spark.sql.execution.arrow.maxRecordsPerBatch": "5"}):
        found = sorted((r["track_id"] is None, r["track_id"] or 0, r["turn"], r["spk"]) for r in stepwise.collect())
    assert found == sorted((r["track_id"] is None, r["track_id"] or 0, r["turn"], r["spk"]) for r in assign_speakers(turns).collect())
