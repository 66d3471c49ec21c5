"""Track specifications: what each requested track should look like."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rng
from ..params import TrackParams
from .patterns import speaker_range


def requests(spark, track_count: int) -> DataFrame:
    """Tracks 0 .. track_count - 1 as work items."""
    return spark.range(track_count).withColumnRenamed("id", "track_id")


def speaker_count(pattern: Column, u: Column) -> Column:
    """Speakers of a pattern: fixed or drawn from the pattern's range."""
    chain = None
    for name, (low, high) in speaker_range.known().items():
        chain = (F if chain is None else chain).when(pattern == name, rng.integer(u, low, high))
    return chain.otherwise(rng.integer(u, *speaker_range.other))


def target_length(shape: Column, p: TrackParams) -> Column:
    """Samples a track should reach, from its shape digest."""
    wanted = rng.between(rng.lane(shape, 2), p.min_duration, p.max_duration)
    return rng.whole(wanted * F.lit(float(p.sampling_rate)))


def with_spec(df: DataFrame, p: TrackParams) -> DataFrame:
    """Add the specification of ``track_id``.

    It is a function of the track id and the parameters alone, so any frame that holds a track id can
    have it back without a join.
    """
    shape = rng.digest(p.seed, "spec", "track_id")
    mood = rng.digest(p.seed, "mood", "track_id")
    out = df.withColumns({"_shape": shape, "_mood": mood})
    out = out.withColumns({
        "pattern": rng.weighted(rng.lane("_shape", 0), p.pattern_weights, "dialogue"),
        "target_samples": target_length(F.col("_shape"), p),
        "use_short": rng.lane("_shape", 3) < F.lit(p.short_probability),
        "want_sim": rng.lane("_mood", 0) < F.lit(p.simultaneous_probability),
        "want_noise": rng.lane("_mood", 1) < F.lit(p.noise_probability),
    })
    return out.withColumns({
        "n_spk": speaker_count(F.col("pattern"), rng.lane("_shape", 1)),
        "snr_db": F.when(F.col("want_noise"), rng.between(rng.lane("_mood", 2), p.snr_min, p.snr_max)),
        "noise_type": F.when(F.col("want_noise"), rng.one_of(rng.lane("_mood", 3), p.noise_types)),
    }).drop("_shape", "_mood")


def probability_check(table: DataFrame) -> DataFrame:
    """Sum of a ``(name, p)`` table and whether it is close enough to one."""
    total = table.agg(F.count("*").alias("n"), F.sum("p").alias("total"))
    return total.withColumn("ok", F.col("total").between(0.99, 1.01))
