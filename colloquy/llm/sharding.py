"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered from 0 in the order of a hash of their id and text. A keyed Feistel network permutes the numbers
0 … N-1 (cycle walking: a number that leaves the range is permuted again until it is back). The permuted number
``p`` gives ``shard = p mod n_shards`` and ``slot = p div n_shards``, so that shard sizes differ by one row at most,
slots have no gaps, and the place of a row number is computed without a table.

Numbering needs no total order in one task and no group: rows are dealt by ranges of their hash, sorted within each range and written with
their place in it; the ranges' totals, one for each shuffle partition, are summed up. Equal rows have one hash and are told apart by their place in the
input, so that a row repeated for a third of the table is spread over tasks, too. A number does not depend on the ranges.

Nulls: a null id or text is hashed like any other value; a null text counts no bytes. Repeated rows get places of
their own; which copy gets which does not matter, as they are equal. Rows of one hash that are not equal go by id, then by a second hash. Texts of any length are hashed as a whole. An
empty table gives an empty result. Other columns are handed on, packed, so that no name clashes; input columns called ``shard`` or ``slot`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.llm.text import hash63, packed, require, unpacked
from colloquy.session import stage, work_path

SHARDS = 40
SEED = 20_251
ROUNDS = 6
#: Each walk leaves the range with probability under 1/2; a row that has not returned after so many stops the job.
WALKS = 160


def permuted(number: Column, bits: int, seed: int = SEED, rounds: int = ROUNDS) -> Column:
    """A keyed permutation of 0 … 2^bits - 1: rounds that alter the upper and the lower part in turn."""
    low = bits - bits // 2
    low_mask, high_mask = (1 << low) - 1, (1 << (bits - low)) - 1
    high_part, low_part = F.shiftright(number, low), number.bitwiseAND(F.lit(low_mask))
    for i in range(rounds):
        if i % 2 == 0:
            high_part = high_part.bitwiseXOR(F.xxhash64(F.lit(seed), F.lit(i), low_part).bitwiseAND(F.lit(high_mask)))
        else:
            low_part = low_part.bitwiseXOR(F.xxhash64(F.lit(seed), F.lit(i), high_part).bitwiseAND(F.lit(low_mask)))
    return F.shiftleft(high_part, low).bitwiseOR(low_part)


def permuted_within(number: Column, n: int, seed: int = SEED, rounds: int = ROUNDS) -> Column:
    """The same for 0 … n - 1, by cycle walking."""
    bits = max(2, (n - 1).bit_length())
    once = permuted(number, bits, seed, rounds)
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALKS)), once,
        lambda at, _: F.when(at < n, at).otherwise(permuted(at, bits, seed, rounds)),
    )
    inside = F.when(walked < n, walked).otherwise(F.raise_error(F.lit("cycle walking did not return")).cast("bigint"))
    return F.when(once < n, once).otherwise(inside)


def numbered(docs: DataFrame, carried: Column, seed: int = SEED) -> tuple[DataFrame, int]:
    """What is carried of each row, with ``number``, its place in hash order, and the number of rows."""
    require(docs, "doc_id", "text")
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hashed = docs.select(
        carried.alias("row"), "doc_id", hash63(F.lit(seed), F.col("doc_id"), F.col("text")).alias("key"), hash63(F.lit(seed + 1), F.col("text")).alias("key2"),
        F.monotonically_increasing_id().alias("copy"),
    )
    order = ["key", "doc_id", "key2", "copy"]
    dealt = hashed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # the place of a row is its range and its row in it
    rows = stage(dealt.select("row", F.monotonically_increasing_id().alias("place")), work_path(spark, "shard-rows"))
    part = F.shiftright("place", 33)
    totals = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows")).orderBy("part").collect()  # one a shuffle partition at most
    starts, n = [], 0
    for total in totals:
        starts.append((total["part"], n))
        n += total["rows"]
    begun = spark.createDataFrame(starts, "part bigint, start bigint")
    numbered_rows = rows.withColumn("p", part).join(F.broadcast(begun), F.col("p") == F.col("part"))
    return numbered_rows.select("row", (F.col("start") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))).alias("number")), n


def _placed(docs: DataFrame, carried: Column, n_shards: int, seed: int) -> DataFrame:
    rows, n = numbered(docs, carried, seed)
    place = rows.withColumn("place", permuted_within(F.col("number"), max(n, 1), seed))
    return place.select(
        *unpacked(place, ("shard", "slot")),
        F.pmod("place", F.lit(n_shards)).cast("int").alias("shard"),
        F.floor(F.col("place") / F.lit(n_shards)).cast("bigint").alias("slot"),
    )


def assign(docs: DataFrame, n_shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """All rows and columns with ``shard`` (int) and ``slot`` (bigint)."""
    return _placed(docs, packed(docs), n_shards, seed)


def report(docs: DataFrame, n_shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row per document: id, size, checksum and place. Texts are hashed where they are read and not moved."""
    whole = F.coalesce(F.col("text"), F.lit(""))
    carried = F.struct(
        "doc_id", (F.octet_length(whole).cast("bigint") + 16).alias("size"),
        F.crc32(whole.cast("binary")).cast("bigint").alias("text_crc32"),
    )
    return _placed(docs, carried, n_shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
