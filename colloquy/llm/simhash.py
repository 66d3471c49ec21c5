"""SimHash near-duplicates by a binary trie self-join.

Fingerprint: bit i is set if over half of the XXH64 hashes (seed 42) of a text's four-word shingles have it; A-Z count as
lower case. Equal fingerprints are one entry of the join, however many documents have them.

The trie of the fingerprints is traversed by pairs of nodes: a pair starts with no differing bits; going down, the bits in
which two children differ are added, and the pair is dropped when they exceed the error budget. Here all pairs with one
first node are a group: its own fingerprints (``spent`` 0, ``home``) and visitors from other nodes with the bits they have
spent so far. One step down by a few bits copies each member to all child nodes its remaining budget reaches. Each
unordered pair of nodes is met once, at the larger. A group that is small enough is compared in its task; a larger
one goes down further, so that no task holds an unbounded group. As fingerprints are distinct, the last level has one
home fingerprint per node.

Of two fingerprints within four bits, one half differs by two or less. So there are two tries: one over the bits as they
are, with at most two differing bits in the first 32, and one over the swapped halves, with at most one (the
other half then differs by three or more). This bounds the visitors.

A task reports a spanning forest of the links of its group, not all pairs; the components of all forests are the
components of all links. They come from alternating large-star and small-star steps, each stored in the shared folder.

Nulls: a null text is empty; without words the fingerprint is zero, and linked like any other. A null id
belongs to its fingerprint's group but cannot name it; a group of null ids only has a null component. Repeated rows get one
result each. Texts of any length are hashed as a whole, in chunks of bounded size; a bit that half of the hashes have is 0. An empty table gives an empty result.
:func:`one_per_group` keeps all columns, packed, so that no name clashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.llm.text import packed, require, unpacked
from colloquy.session import ship, stage, work_path

SHINGLE, SEED, BUDGET = 4, 42, 4
#: Largest group that one task compares, about; bits of the first step at most, and of a later step.
GROUP, FIRST_BITS, STEP_BITS = 4_096, 20, 4
#: Hashes handled at once.
CHUNK = 1 << 18


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> list[int]:
    words = (text or "").encode().lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) < shingle:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[start : end - 1], SEED) for start, end in zip(starts, ends[shingle - 1 :])]


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def fingerprint(text: str | None) -> int:
    """As a signed 64-bit integer."""
    hashes = shingle_hashes(text)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        counts += _bit_counts(np.array(hashes[at : at + CHUNK], np.uint64))
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def _fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([fingerprint(t) for t in texts], dtype="int64")


def _fingerprint(text: Column) -> Column:
    return F.pandas_udf(_fingerprints, "bigint")(F.coalesce(text, F.lit("")))


def fingerprinted(docs: DataFrame) -> DataFrame:
    """(doc_id, fp), stored."""
    require(docs, "doc_id", "text")
    ship(docs.sparkSession)
    rows = docs.select("doc_id", _fingerprint(F.col("text")).alias("fp"))
    return stage(rows, work_path(docs.sparkSession, "simhash-fingerprints"))


def _members(fps: DataFrame) -> DataFrame:
    """The roots of both tries: (trie, node, bits, spent, home)."""
    bits = F.explode(F.array(
        F.struct(F.lit(0).alias("trie"), F.col("fp").alias("bits")),
        F.struct(F.lit(1).alias("trie"), F.shiftleft("fp", 32).bitwiseOR(F.shiftrightunsigned("fp", 32)).alias("bits")),
    ))
    return fps.select(bits.alias("m")).select(
        "m.trie", F.lit(0).cast("bigint").alias("node"), "m.bits", F.lit(0).alias("spent"), F.lit(True).alias("home"),
    )


def _masks(width: int, weight: int) -> list[tuple[int, int]]:
    """(mask, its number of bits), for all masks of the width with at most so many bits."""
    found = [(0, 0)]
    for bit in range(width):
        found += [(mask | 1 << bit, n + 1) for mask, n in found if n < weight]
    return sorted(found, key=lambda x: (x[1], x[0]))


def descend(members: DataFrame, depth: int, width: int) -> DataFrame:
    """The members one step further down, ``width`` bits below ``depth``."""
    half = depth < 32
    allowed = F.when(F.col("trie") == 0, 2).otherwise(1) if half else F.lit(BUDGET)
    weight = 2 if half else BUDGET
    masks = F.array(*[F.struct(F.lit(m).cast("bigint").alias("mask"), F.lit(n).alias("n")) for m, n in _masks(width, weight)])
    own = F.shiftrightunsigned("bits", 64 - depth - width).bitwiseAND(F.lit((1 << width) - 1))
    reached = F.filter(masks, lambda m: m["n"] + F.col("spent") <= allowed)
    moved = members.select("trie", "node", "bits", "spent", "home", own.alias("own"), F.explode(reached).alias("m"))
    child = F.col("own").bitwiseXOR(F.col("m.mask"))
    # of two home children the pair is met at the larger; a visitor from another node goes to all
    moved = moved.where(~F.col("home") | (child >= F.col("own")))
    return moved.select(
        "trie", F.shiftleft("node", width).bitwiseOR(child).alias("node"), "bits",
        (F.col("spent") + F.col("m.n")).alias("spent"), (F.col("home") & (F.col("m.n") == 0)).alias("home"),
    )


def _forest(home: np.ndarray, visitors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (fingerprint, root) that span the links of home fingerprints with each other and with visitors."""
    everyone = np.concatenate([home, visitors])
    label = np.arange(len(everyone))
    rows, columns = [], []
    for at in range(0, len(home), 256):
        near = np.bitwise_count(home[at : at + 256, None] ^ everyone[None, at:]) <= BUDGET
        i, j = np.nonzero(near)
        i, j = i + at, j + at
        later = j > i
        rows.append(i[later])
        columns.append(j[later])
        if sum(map(len, rows)) > 1_000_000:
            label = _merge(label, np.concatenate(rows), np.concatenate(columns))
            rows, columns = [], []
    if rows:
        label = _merge(label, np.concatenate(rows), np.concatenate(columns))
    linked = label != np.arange(len(everyone))
    return everyone[linked], everyone[label[linked]]


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest member as label, after joining the classes of i and j."""
    while len(i):
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            break
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        low, high = np.minimum(a, b), np.maximum(a, b)
        np.minimum.at(label, high, low)
        while True:
            shorter = label[label]
            if (shorter == label).all():
                break
            label = shorter
    return label


def _compare(pdf: pd.DataFrame) -> pd.DataFrame:
    bits = pdf["bits"].to_numpy(np.int64).view(np.uint64)
    if pdf["trie"].iloc[0] == 1:
        bits = (bits << np.uint64(32)) | (bits >> np.uint64(32))
    home = pdf["home"].to_numpy(bool)
    a, b = _forest(bits[home], bits[~home])
    return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})


def links(fps: DataFrame, group: int = GROUP) -> DataFrame:
    """(a, b): a forest of the links of distinct fingerprints; ``fps``: distinct ``fp``."""
    spark = fps.sparkSession
    n = fps.count()
    found, depth, members = [], 0, _members(fps)
    # a node has about 2^-bits of the fingerprints, and some tens of nodes visit it
    width = min(max((n * 16 // group).bit_length(), 1), FIRST_BITS)
    while True:
        members = stage(descend(members, depth, width), work_path(spark, "simhash-nodes")) if depth else descend(members, depth, width)
        depth += width
        if depth == 64:
            found.append(members)
            break
        sizes = members.groupBy("trie", "node").agg(F.count(F.lit(1)).alias("size"), F.bool_or("home").alias("own"))
        sizes = sizes.where("own and size > 1").select("trie", "node", (F.col("size") > 4 * group).alias("large"))
        sizes = stage(sizes, work_path(spark, "simhash-sizes"))
        if sizes.where("large").isEmpty():
            found.append(members)
            break
        # nodes without a fingerprint of their own end here
        marked = stage(members.join(sizes, ["trie", "node"]), work_path(spark, "simhash-marked"))
        found.append(marked.where("not large").drop("large"))
        members = marked.where("large").drop("large")
        width = min(STEP_BITS, (32 if depth < 32 else 64) - depth)
    edges = None
    for part in found:
        some = part.groupBy("trie", "node").applyInPandas(_compare, "a bigint, b bigint")
        edges = some if edges is None else edges.unionByName(some)
    return stage(edges.distinct(), work_path(spark, "simhash-links"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes with an edge; the root is the smallest node.

    Large-star links each node's larger neighbours to its smallest neighbour, small-star its smaller ones; the rounds
    end when the edges no longer change. Only minima are gathered per node, never lists of neighbours.
    """
    spark = edges.sparkSession
    edges = edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("u < v").distinct()
    edges, state = stage(edges, work_path(spark, "components")), None

    def digest(frame: DataFrame) -> tuple:
        return tuple(frame.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())

    while True:
        both = edges.select("v", "u").unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy(F.col("v").alias("n")).agg(F.min("u").alias("m")).select("n", F.least("n", "m").alias("m"))
        large = both.join(least, F.col("v") == F.col("n")).where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = stage(large.where("u < v").distinct(), work_path(spark, "components"))
        least = large.groupBy(F.col("v").alias("n")).agg(F.min("u").alias("m"))
        small = large.join(least, F.col("v") == F.col("n")).select(F.col("u").alias("v"), F.col("m").alias("u"))
        small = small.unionByName(least.select(F.col("n").alias("v"), F.col("m").alias("u")))
        edges = stage(small.where("u < v").distinct(), work_path(spark, "components"))
        now = digest(edges)
        if now == state:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("root"))
        state = now


def grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp), one row per document; (f, root, component_id), one per fingerprint."""
    prints = fingerprinted(docs)
    spark = docs.sparkSession
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), work_path(spark, "simhash-distinct"))
    found = components(links(nodes.select("fp")))
    rooted = nodes.join(found, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    names = rooted.groupBy(F.col("root").alias("r")).agg(F.min("first").alias("component_id"))
    named = rooted.join(names, F.col("root") == F.col("r")).select(F.col("fp").alias("f"), "root", "component_id")
    return prints, stage(named, work_path(spark, "simhash-components"))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: fingerprint as 16 hex digits, component."""
    prints, named = grouped(docs)
    return prints.join(named, F.col("fp") == F.col("f")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
    )


def one_per_group(docs: DataFrame) -> DataFrame:
    """Of each group the document that names it, and of repeated rows one; all columns.

    Where all ids of a group are null, one of its rows stays.
    """
    prints, named = grouped(docs)
    chosen = named.select(F.col("component_id").alias("kept_id")).distinct()
    rows = docs.select(packed(docs), "doc_id", F.xxhash64("text").alias("order"))
    kept = rows.where("doc_id is not null").join(chosen, F.col("doc_id") == F.col("kept_id"))
    kept = kept.groupBy("doc_id").agg(F.min_by("row", "order").alias("row")).select("row")
    nameless = rows.where("doc_id is null").withColumn("fp", _fingerprint(F.col("row.text")))
    nameless = nameless.join(named.where("component_id is null"), F.col("fp") == F.col("f"))
    kept = kept.unionByName(nameless.groupBy("root").agg(F.min_by("row", "order").alias("row")).select("row"))
    return kept.select(*unpacked(kept))
