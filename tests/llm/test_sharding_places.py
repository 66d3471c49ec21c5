"""Places against a plain Feistel network, and rows that repeat."""

from collections import Counter

import xxhash
from pyspark.sql import functions as F

from colloquy.llm import sharding


def _hash(*values):
    """Spark's xxhash64 of ints and longs: each is hashed with the hash before as seed."""
    h = 42
    for value, size in values:
        h = xxhash.xxh64_intdigest((value % (1 << 8 * size)).to_bytes(size, "little"), h)
    return h


def permuted(number, bits, seed=sharding.SEED):
    low = bits - bits // 2
    high_mask, low_mask = (1 << (bits - low)) - 1, (1 << low) - 1
    high, rest = number >> low, number & low_mask
    for i in range(sharding.ROUNDS):
        if i % 2 == 0:
            high ^= _hash((seed, 4), (i, 4), (rest, 8)) & high_mask
        else:
            rest ^= _hash((seed, 4), (i, 4), (high, 8)) & low_mask
    return high << low | rest


def places(n):
    bits = max(2, (n - 1).bit_length())
    out = []
    for number in range(n):
        at = permuted(number, bits)
        while at >= n:
            at = permuted(at, bits)
        out.append(at)
    assert sorted(out) == list(range(n))
    return out


def expected(rows, n_shards):
    """(id, text) → places of its copies; rows in the order of their hashes, which Spark gives."""
    where = places(len(rows))
    found = Counter()
    for number, (doc_id, text) in enumerate(rows):
        found[doc_id, text, where[number] % n_shards, where[number] // n_shards] += 1
    return found


def check(spark, rows, n_shards=7):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    ordered = docs.select("doc_id", "text", sharding.hash63(F.lit(sharding.SEED), F.col("doc_id"), F.col("text")).alias("h")).orderBy("h").collect()
    got = Counter((r["doc_id"], r["text"], r["shard"], r["slot"]) for r in sharding.assign(docs, n_shards).collect())
    assert got == expected([(r["doc_id"], r["text"]) for r in ordered], n_shards)


def test_place_by_place(spark):
    check(spark, [(i, f"text {i % 90}") for i in range(500)] + [(None, None), (None, "a"), (3, None), (3, None)])
    check(spark, [(1, "one")])


def test_a_third_of_equal_rows(spark):
    rows = [(7, "the same row")] * 4_000 + [(i, "another") for i in range(8_000)]
    check(spark, rows, 40)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    numbered, n = sharding.numbered(docs, F.struct("doc_id"))
    assert n == len(rows)
    tasks = numbered.where("row.doc_id = 7").select(F.input_file_name().alias("file")).groupBy("file").count().collect()
    assert len(tasks) > 2 and max(r["count"] for r in tasks) < 3_000
