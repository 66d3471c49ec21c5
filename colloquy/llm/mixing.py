"""Mixing sources to target weights.

Each document gets a hash-random key. Within a source the key orders the documents; the words before each key range are
prefix sums of the range totals. A source whose budget is ``epochs`` whole passes plus a rest takes every document
``epochs`` times and, in the last pass, the documents before the point where the prefix sum reaches the rest: a cutoff
key per source. The range that holds the cutoff is refined key by key. So the mix of any document follows from its
key and one small row of its source; documents are neither sorted nor shuffled as a whole.

The document at the cutoff is cut at the exact word in the figures (``taken``). Where rows are delivered
(:func:`mix`) it comes whole if at least half of it is due.

Nulls: a null text has no words; a null source is a source of its own, last in order; a null id is a key like any
other. Rows with one key at the cutoff share what is left by their size, rounded down. A source without words has
target 0. An empty table gives an empty result. Nothing depends on the order of rows, so reruns agree. Columns other
than ``doc_id``, ``text`` and ``source`` are only handed on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.llm.text import n_words, packed, require, unpacked
from colloquy.session import stage, work_path

WEIGHTS = (3, 1, 2)
RATIO = 1.5
MOST = 2
SEED = 20_252
KEY_BITS, RANGE_BITS = 60, 12


def key_of(doc_id: Column, seed: int = SEED) -> Column:
    """60 bits of the MD5 of seed and id."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("bigint")


def measured(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, key), stored for the passes that follow."""
    require(docs, "doc_id", "text", "source")
    rows = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), key_of(F.col("doc_id"), seed).alias("key"))
    return stage(rows, work_path(docs.sparkSession, "mix-sizes"))


def budgets(totals: DataFrame, weights: Sequence[int], ratio: float, most: int) -> DataFrame:
    """Targets of (source, source_size); one row per source, so that its windows hold the list of sources only.

    In order of cap / weight, some first sources are capped and the rest share what is left by weight, at one level.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    listed = totals.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(place, F.lit(len(weights))) + 1))
    listed = listed.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    listed = listed.withColumn("full_at", F.col("cap") / F.col("weight"))
    order = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything) * F.lit(ratio)
    listed = listed.withColumn("level", (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward))
    # any guess which sources are capped gives a level that is at most the right one
    listed = listed.withColumn("at", F.max("level").over(everything))
    target = F.least("cap", F.col("at") * F.col("weight"))
    listed = listed.withColumn("target", target).withColumn("budget", F.floor(F.col("target") + 0.5).cast("bigint"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(0).cast("bigint")
    return listed.withColumn("epochs", epochs).select(
        "source", "source_size", "target", "budget", "epochs",
        (F.col("budget") - F.col("epochs") * F.col("source_size")).alias("rest"),
    )


def cutoffs(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, ratio: float = RATIO, most: int = MOST) -> DataFrame:
    """One row per source: sizes, target, epochs, and the key at which the last pass ends.

    ``left`` of the ``at_cutoff`` words with that key are due.
    """
    spark = sizes.sparkSession
    ranged = sizes.withColumn("range", F.shiftright("key", KEY_BITS - RANGE_BITS))
    ranges = stage(ranged.groupBy("source", "range").agg(F.sum("size").alias("words")), work_path(spark, "mix-ranges"))
    totals = ranges.groupBy("source").agg(F.sum("words").alias("source_size"))
    sources = stage(budgets(totals, weights, ratio, most), work_path(spark, "mix-budgets"))

    def holding(frame: DataFrame, key: str, value: str, rest: Column) -> DataFrame:
        earlier = Window.partitionBy("source").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
        summed = frame.withColumn("_start", F.coalesce(F.sum(value).over(earlier), F.lit(0)))
        return summed.where((F.col("_start") <= rest) & (rest < F.col("_start") + F.col(value)))

    renamed = sources.select(F.col("source").alias("_s"), "rest")
    same = F.col("source").eqNullSafe(F.col("_s"))
    edge = holding(ranges.join(renamed, same).drop("_s"), "range", "words", F.col("rest"))
    edge = edge.select(
        F.col("source").alias("_s"), F.col("range").alias("_r"), (F.col("rest") - F.col("_start")).alias("_rest"),
    )
    edge = stage(edge, work_path(spark, "mix-edges"))
    inside = ranged.join(edge, same & (F.col("range") == F.col("_r"))).groupBy("source", "key", "_rest")
    inside = holding(inside.agg(F.sum("size").alias("words")), "key", "words", F.col("_rest"))
    cut = inside.select(
        F.col("source").alias("_s"), F.col("key").alias("cutoff"), (F.col("_rest") - F.col("_start")).alias("left"),
        F.col("words").alias("at_cutoff"),
    )
    return stage(sources.join(cut, same, "left").drop("_s"), work_path(spark, "mix-cutoffs"))


def last_pass(size: Column) -> Column:
    """Words of a document that the last, partial pass takes."""
    share = F.when(F.col("key") < F.col("cutoff"), size)
    share = share.when(F.col("key") == F.col("cutoff"), F.floor(F.col("left") * size / F.col("at_cutoff")).cast("bigint"))
    return share.otherwise(F.lit(0))


def report(docs: DataFrame, weights: Sequence[int] = WEIGHTS, ratio: float = RATIO, most: int = MOST, seed: int = SEED) -> DataFrame:
    """One row per document with the words that the mix takes from it."""
    sizes = measured(docs, seed)
    plan = cutoffs(sizes, weights, ratio, most).withColumnRenamed("source", "_s")
    return sizes.join(plan, F.col("source").eqNullSafe(F.col("_s"))).select(
        "doc_id", "size", "source_size", "target",
        (F.col("epochs") * F.col("size") + last_pass(F.col("size"))).cast("bigint").alias("taken"),
    )


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, ratio: float = RATIO, most: int = MOST, seed: int = SEED) -> DataFrame:
    """The rows of the mix with the columns of the input: a document comes as often as the mix takes it.

    A document without words comes as often as whole passes are made.
    """
    plan = cutoffs(measured(docs, seed), weights, ratio, most).select(
        F.col("source").alias("_s"), F.col("epochs").alias("_epochs"), F.col("cutoff").alias("_cutoff"),
        (2 * F.col("left") >= F.col("at_cutoff")).alias("_half"),
    )
    keyed = docs.select(packed(docs), "source", key_of(F.col("doc_id"), seed).alias("_key"))
    joined = keyed.join(plan, F.col("source").eqNullSafe(F.col("_s")))
    again = F.when(F.col("_key") < F.col("_cutoff"), 1).when((F.col("_key") == F.col("_cutoff")) & F.col("_half"), 1).otherwise(0)
    copies = (F.col("_epochs") + again).cast("int")
    rows = joined.select("row", F.explode(F.array_repeat(F.lit(1), copies)))
    return rows.select(*unpacked(rows))
