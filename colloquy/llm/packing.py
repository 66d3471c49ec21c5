"""Packing documents into sequences of bounded length by hierarchical residual packing.

A document is its token ids and an end mark. Only documents longer than a sequence are cut, into pieces of a whole sequence;
the last piece may be shorter. The tasks that read and tokenise the documents also pack them: each packs its pieces by best fit, in order of falling
length, in blocks of ``BLOCK`` pieces. Bins that are nearly full, or that no remaining bin fits into, are done. The others go up a
tree: ``FAN`` neighbouring tasks share a parent, and each parent packs the underfull bins of its children as items, by best fit again;
what is left there goes on to its own parent, up to the root. A parent with more than ``MOST`` bins packs them in several
parts, so that no task holds an unbounded list; they meet again one step up. Only bins travel, never texts or ids.

A bin packed into another is moved as a whole: its pieces keep their order, and offsets add up.

Words are tokenised once: a text is split at white space, which never belong to a token of the vocabulary; its words that are
not known yet are tokenised together, and the ids of each are kept in two bounded tables, the older of which goes when the newer is full. That gives the ids of the whole text: normalisation and special tokens
don't reach over white space. :func:`token_bytes` is tested against the tokeniser on whole texts.

Nulls: a null text is empty, and an empty text is its end mark alone; a null id is handed on. Repeated rows are packed one by
one. Very long texts are tokenised as a whole and cut. Ties of length go by order of reading. An empty table gives an empty result. Other columns are
not used; :func:`pack` names its own columns and so cannot clash with them.
"""

from __future__ import annotations

import functools
import re
import string
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from colloquy.llm.text import require
from colloquy.session import Workspace, ship, stage, work_path

ALPHANUMERIC = frozenset(string.ascii_letters + string.digits)
CAPACITY, END, VOCABULARY = 4_096, 1, "word_bpe_49k.json"
#: Pieces packed at once by a reading task; children of a parent; bins that a parent packs at once; room that may stay empty.
BLOCK, FAN, MOST, SLACK = 16_384, 8, 65_536, 8
#: Words whose ids are kept in either table (some 80 MB at most), and the longest of them.
KEPT_WORDS, KEPT_LENGTH = 400_000, 64
BLANKS = re.compile(r"[ \t\n\r]+")
#: Characters at which Python splits words and the vocabulary's tokeniser does not.
SEPARATORS = "\x1c\x1d\x1e\x1f"

PLACED = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, bin bigint, offset bigint, fill bigint, task bigint"


def _parts(word: str) -> tuple[str, ...]:
    """The word, or words with the same ids: marks after an ASCII letter or digit are a token of their own, and ASCII capitals count as lower case."""
    if "<|" in word:  # may be a special token
        return (word,)
    stem = word.rstrip(string.punctuation)
    lower = stem.lower() if stem.isascii() else stem
    if not stem or stem[-1] not in ALPHANUMERIC:
        return (word.lower() if word.isascii() else word,)
    return (lower,) if stem == word else (lower, word[len(stem) :])


@functools.lru_cache(maxsize=4)
def token_bytes(path: str) -> Callable[[str], bytes]:
    """A function from a text to its ids, as little-endian unsigned 32-bit numbers."""
    tokenizer = Tokenizer.from_file(path)
    known: dict[str, bytes] = {}
    earlier: dict[str, bytes] = {}

    def encoded(words: list[str]) -> Iterator[bytes]:
        """Ids of each word, from one call over all of them; a token's place in the text tells its word."""
        found = tokenizer.encode(" ".join(words), add_special_tokens=False)
        ids = np.array(found.ids, "<u4").tobytes()
        starts = np.cumsum([0, *[len(w) + 1 for w in words]])
        ends = np.searchsorted([at for at, _ in found.offsets], starts).tolist()
        return (ids[4 * a : 4 * b] for a, b in zip(ends, ends[1:]))

    def ids(text: str) -> bytes:
        nonlocal known, earlier
        words = text.split() if not any(c in text for c in SEPARATORS) else BLANKS.split(text)
        found = list(map(known.get, words))
        if None not in found:
            return b"".join(found)
        new = list({w for w, f in zip(words, found) if f is None})
        if len(known) + len(new) > KEPT_WORDS:  # words in use come back from the table before
            earlier, known = known, {}
            new = list(set(words))
        parts = [_parts(w) for w in new]
        unknown = []
        for part in {part for found in parts for part in found}:
            if part in earlier:
                known[part] = earlier[part]
            elif part not in known:
                unknown.append(part)
        if unknown:
            known.update(zip(unknown, encoded(unknown)))
        for w, found in zip(new, parts):
            known[w] = known[found[0]] if len(found) == 1 else known[found[0]] + known[found[1]]
        out = b"".join(map(known.__getitem__, words))
        for w in [*new, *unknown]:
            if len(w) > KEPT_LENGTH:
                known.pop(w, None)
        return out

    return ids


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and how full each bin is; the largest items first, each into the fullest bin that has room."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    fill: list[int] = []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: a bin has room for exactly r more
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            at = open_bins[room].pop()
            if not open_bins[room]:
                rooms &= ~(1 << room)
        else:
            room, at = capacity, len(fill)
            fill.append(0)
        bins[i], offsets[i] = at, fill[at]
        fill[at] += size
        if room > size:
            open_bins[room - size].append(at)
            rooms |= 1 << (room - size)
    return bins, offsets, np.array(fill, np.int64)


def _pieces(doc_id: int | None, ids: bytes, capacity: int) -> Iterator[tuple]:
    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
        part = ids[at : at + 4 * capacity]
        yield doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)


def placed_locally(docs: DataFrame, path: str | None, capacity: int, end: int, block: int) -> DataFrame:
    """Pieces with the bin that their reading task put them into; bins are numbered by task."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = token_bytes(path or public_tokenizers.path(VOCABULARY))
        mark = np.array([end], "<u4").tobytes()
        task, rows, made = TaskContext.get().partitionId(), [], 0

        def flush() -> pd.DataFrame:
            nonlocal rows, made
            frame = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            bins, offsets, fill = best_fit(frame["length"].to_numpy(np.int64), capacity)
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            frame["bin"], frame["offset"], frame["fill"], frame["task"] = (task << 40) + made + bins, offsets, fill[bins], task
            rows, made = [], made + len(fill)
            return frame

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].astype("Int64"), batch["text"]):
                rows += _pieces(None if doc_id is pd.NA else doc_id, encode(text) + mark, capacity)
                if len(rows) >= block:
                    yield flush()
        if rows:
            yield flush()

    return docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text")).mapInPandas(run, PLACED)


def _moved(capacity: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(bins: pd.DataFrame) -> pd.DataFrame:
        bins = bins.sort_values("item")
        at, offsets, fill = best_fit(bins["size"].to_numpy(np.int64), capacity)
        first = np.full(len(fill), np.iinfo(np.int64).max)
        np.minimum.at(first, at, bins["item"].to_numpy(np.int64))  # a merged bin is named after one of its items
        return pd.DataFrame({"node": bins["node"], "item": bins["item"], "bin": first[at], "offset": offsets, "fill": fill[at]})

    return run


def merged(open_bins: DataFrame, work: Workspace, capacity: int, slack: int, fan: int, most: int) -> DataFrame | None:
    """(item, sequence, shift) of bins that were packed into others, from (item, size, node); the node is a leaf of the tree."""
    moves, n = None, 0
    while True:
        n, smallest, top = open_bins.agg(F.count(F.lit(1)), F.min("size"), F.max("node")).first()
        if n < 2:
            return moves
        # a bin stays open only while the smallest of the others might fit
        room = F.lit(capacity) - F.col("size")
        open_bins = open_bins.where((room >= smallest) & (room > slack)).withColumn("node", F.floor(F.col("node") / fan).cast("bigint"))
        counts = open_bins.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / most).alias("parts"))
        dealt = open_bins.join(counts, "node").withColumn("part", F.pmod(F.xxhash64("item"), F.col("parts")))
        packed = dealt.groupBy("node", "part").applyInPandas(_moved(capacity), "node bigint, item bigint, bin bigint, offset bigint, fill bigint")
        packed = work.stage(packed, "packed")
        step = packed.where("item != bin or offset > 0").select(F.col("item").alias("i"), F.col("bin").alias("b"), "offset")
        if moves is None:
            moves = step.select(F.col("i").alias("item"), F.col("b").alias("sequence"), F.col("offset").alias("shift"))
        else:
            followed = moves.join(step, F.col("sequence") == F.col("i"), "left").select(
                "item", F.coalesce("b", "sequence").alias("sequence"), (F.col("shift") + F.coalesce("offset", F.lit(0))).alias("shift"))
            fresh = step.join(moves, F.col("i") == F.col("item"), "left_anti")
            moves = followed.unionByName(fresh.select(F.col("i").alias("item"), F.col("b").alias("sequence"), F.col("offset").alias("shift")))
        moves = work.stage(moves, "moves")
        if top < fan:  # that was the root
            return moves
        open_bins = packed.groupBy("node", "bin").agg(F.max("fill").alias("size")).select(F.col("bin").alias("item"), "size", "node")


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END, block: int = BLOCK, slack: int = SLACK,
         fan: int = FAN, most: int = MOST) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id and the offset in that sequence.

    ``path``: a tokeniser's file, readable by all tasks; by default the public word vocabulary of the installed package.
    """
    require(docs, "doc_id", "text")
    spark = docs.sparkSession
    out = work_path(spark, "packed")
    with Workspace(spark, "packing") as work:
        placed = work.stage(placed_locally(docs, path, capacity, end, block), "placed")
        underfull = placed.where((F.col("offset") == 0) & (F.col("fill") < capacity - slack))
        moves = merged(underfull.select(F.col("bin").alias("item"), F.col("fill").alias("size"), F.col("task").alias("node")), work, capacity, slack, fan, most)
        columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
        if moves is None:
            done = placed.select(*columns, F.col("bin").alias("sequence_id"), "offset")
        else:
            done = placed.join(moves, F.col("bin") == F.col("item"), "left").select(
                *columns, F.coalesce("sequence", "bin").alias("sequence_id"), (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"))
        return stage(done, out)


def sequences(docs: DataFrame, packed: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(sequence_id, ids, starts): the token ids of each sequence, and where its pieces start; ``docs`` with unique, non-null ids.

    Here the ids travel; a sequence is bounded by its capacity, and so is each group.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, mark = token_bytes(path or public_tokenizers.path(VOCABULARY)), np.array([end], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["d"], batch["text"]):
                ids = np.frombuffer(encode(text) + mark, "<u4").astype(np.int32)
                rows += [(doc_id, k, ids[at : at + capacity]) for k, at in enumerate(range(0, len(ids), capacity))]
            yield pd.DataFrame(rows, columns=["d", "p", "ids"])

    cut = docs.select(F.col("doc_id").cast("bigint").alias("d"), F.coalesce("text", F.lit("")).alias("text"))
    cut = cut.mapInPandas(run, "d bigint, p int, ids array<int>")
    joined = cut.join(packed, (F.col("d") == F.col("doc_id")) & (F.col("p") == F.col("piece")))
    gathered = joined.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return gathered.select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.offset").alias("starts"))
