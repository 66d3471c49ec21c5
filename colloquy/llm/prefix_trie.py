"""Prefix trie of conversations by van Emde Boas recursion.

A conversation is a sequence of symbols (a digest of a turn's role and text). The trie over depths 1 … 2^K - 1 is cut at half its depth:
the prefixes that end at the cut are named, the sequences before the cut form the upper trie, and those after it one lower trie for
each name. Both are cut again, in parallel, until a trie has one level, which is its nodes. A round of this recursion is one
step over all tries of a size:

* A row is a distinct sequence in the range of its trie: the name of the prefix before it, its smallest member and the number of
  members. The digest of the row's left half names its prefix up to the cut. Rows of one name become one row of the upper trie
  (its smallest member, the sum of members); each row that goes on becomes a row of the lower trie of that name.
* A row too short for a cut skips the rounds to the first that cuts it. Digests of all halves are made bottom up beforehand, each from two of the
  size below. So all rounds together handle rows in proportion to the turns, and there are about log2 of the longest conversation rounds.

Totals of subtrees are grafted upward: bottom up, the total of a trie is that of its upper trie and of the lower tries at its cut. What
hangs below a cut then belongs to every node above it: it is handed to the upper row, which hands it to the rows it was cut into, and so down to the nodes.

Names are 128 bits of SHA-256 over the name and digest before; prefixes of equal content have equal names, whichever conversation they are read from.
No step gathers a conversation, a node's members or its children: rows are summed before they move, joins are by keys that are unique on
both sides, and parents with more than a thousandth of all nodes as children, so a thousand parents at most, are broadcast instead of joined. Turns
are numbered within ranges of (conversation, turn), so that a conversation may span many tasks. The digest of a node's members is one SHA-256
over their list, which only goes in order; members are sorted and written out in pieces by all tasks, and the task that digests a node reads pieces.

Nulls: a null role or text is empty; a null turn comes first; turns without a conversation are left out. Turns with equal numbers go by their digest, repeated rows
are turns of their own. Empty texts are turns like any other, and a text of any length is a digest from the first step on. An empty table has no node,
not even a root. Other columns are not used, so their names don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.llm.text import require
from colloquy.session import Workspace, ship, stage, work_path

ROOT = bytes(16)
#: Conversations of which a rebuilt one may take its first turns, and the most turns it takes.
GROUP, HEAD = 5, 8
#: Member ids in a piece of a node's list; most parents that are broadcast.
PIECE, HOT = 1_000, 1_000

NODES = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"


def _name(*parts: Column) -> Column:
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def numbered(conversations: DataFrame, work: Workspace) -> DataFrame:
    """(conv_id, pos, symbol, bytes): turns numbered from 1 within their conversation; stored.

    Ranges of (conversation, turn, symbol) hold about the same number of rows each, also where one conversation has most of them or one turn is
    repeated over and over; a turn's number is its place in its range and what the ranges before have of its conversation.
    """
    require(conversations, "conv_id", "turn", "role", "text")
    parts = int(work.spark.conf.get("spark.sql.shuffle.partitions"))
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    symbol = _name(F.octet_length(role).cast("string").cast("binary"), F.lit(b":"), role.cast("binary"), text.cast("binary"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", symbol.alias("symbol"), F.octet_length(text).cast("bigint").alias("bytes"))
    dealt = turns.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(parts, "conv_id", F.col("turn").asc_nulls_first(), "symbol", "salt")
    dealt = work.stage(dealt.withColumn("part", F.spark_partition_id()).drop("salt"), "turns")
    earlier = Window.partitionBy("c").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    begun = dealt.groupBy(F.col("conv_id").alias("c"), F.col("part").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    begun = begun.select("c", "p", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("part", "conv_id").orderBy(F.col("turn").asc_nulls_first(), "symbol"))
    placed = dealt.withColumn("within", within).join(begun, (F.col("part") == F.col("p")) & (F.col("conv_id") == F.col("c")))
    return work.stage(placed.select("conv_id", (F.col("start") + F.col("within")).alias("pos"), "symbol", "bytes"), "numbered")


def lengths(turns: DataFrame) -> DataFrame:
    return turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("len"))


def rebuilt(turns: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """Each conversation with the first turns of the first of its group, some by its id's checksum, instead of its own: (turns, lengths)."""
    all_lengths = work.stage(lengths(turns), "lengths")
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD + 1)
    convs = all_lengths.select("conv_id", "len", taken.alias("h"), (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"))
    bases = all_lengths.select(F.col("conv_id").alias("b"), F.col("len").alias("base_len"))
    convs = convs.join(bases, F.col("base") == F.col("b"), "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("base_len", F.lit(0))).alias("head"), F.greatest(F.col("len") - F.col("h"), F.lit(0)).alias("rest"))
    convs = work.stage(convs, "convs")
    # head is known from h and the base's length alone, but for turns past HEAD it is joined only where a conversation is long: by (conversation, block)
    blocks = convs.select(F.col("conv_id").alias("c"), "h", "head", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("h") + F.col("rest")) / BLOCK))).alias("k"))
    own = turns.withColumn("block", F.floor(F.col("pos") / BLOCK)).join(blocks, (F.col("conv_id") == F.col("c")) & (F.col("block") == F.col("k")))
    own = own.where("pos > h").select("conv_id", (F.col("head") + F.col("pos") - F.col("h")).alias("pos"), "symbol", "bytes")
    first = turns.where((F.col("pos") <= HEAD) & (F.col("conv_id") % GROUP == 0)).withColumnRenamed("conv_id", "b")
    heads = first.join(convs.select("conv_id", "base", "head"), F.col("b") == F.col("base")).where("pos <= head").select("conv_id", "pos", "symbol", "bytes")
    made = work.stage(own.unionByName(heads), "rebuilt")
    return made, convs.select("conv_id", (F.col("head") + F.col("rest")).alias("len"))


#: Turns of a conversation that are joined with one row about it.
BLOCK = 4_096


def _ends(members: DataFrame, digests: DataFrame, levels: int, work: Workspace) -> DataFrame:
    """(conv_id, len, name): the name of each whole conversation, from the digests of the blocks it is made of; stored."""
    sizes = F.expr(f"filter(sequence(0, {levels - 1}), t -> shiftrightunsigned(len, t) & 1 = 1)")
    blocks = members.where("len > 0").select("conv_id", "len", F.explode(sizes).alias("t"))
    blocks = blocks.select(F.col("conv_id").alias("c"), "len", "t", F.expr("shiftleft(shiftrightunsigned(len, t + 1), 1)").alias("at"))
    joined = blocks.join(digests, (F.col("c") == F.col("conv_id")) & (F.col("t") == F.col("level")) & (F.col("at") == F.col("q")))
    listed = joined.groupBy("c", "len").agg(F.sort_array(F.collect_list(F.struct("t", "digest")), asc=False).alias("blocks"))  # at most one a level
    whole = F.aggregate("blocks", F.lit(ROOT), lambda name, b: _name(name, b["digest"]))
    named = listed.select(F.col("c").alias("conv_id"), "len", whole.alias("name"))
    empty = members.where("len = 0").select("conv_id", "len", F.lit(ROOT).alias("name"))
    return work.stage(named.unionByName(empty), "ends")


def _listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Ids of equal names, sorted, as pieces of text."""
    name, first, ids = None, 0, []
    for batch in batches:
        rows = []
        for n, c in zip(batch["name"], batch["conv_id"].tolist()):
            if n != name or len(ids) == PIECE:
                if ids:
                    rows.append((name, first, ",".join(ids)))
                name, first, ids = n, c, []
            ids.append(str(c))
        yield pd.DataFrame(rows, columns=["name", "first", "ids"])
    if ids:
        yield pd.DataFrame([(name, first, ",".join(ids))], columns=["name", "first", "ids"])


def _digested(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One digest for each name, from its pieces in order."""
    name, digest = None, None
    for batch in batches:
        rows = []
        for n, ids in zip(batch["name"], batch["ids"]):
            if n == name:
                digest.update(b",")
            else:
                if digest:
                    rows.append((name, digest.hexdigest()))
                name, digest = n, hashlib.sha256()
            digest.update(ids.encode())
        yield pd.DataFrame(rows, columns=["name", "ends_sha256"])
    if digest:
        yield pd.DataFrame([(name, digest.hexdigest())], columns=["name", "ends_sha256"])


def member_digests(ends: DataFrame, work: Workspace) -> DataFrame:
    """(name, ends_sha256) of the nodes at which conversations end; stored."""
    parts = int(work.spark.conf.get("spark.sql.shuffle.partitions"))
    listed = ends.select("name", "conv_id").repartitionByRange(parts, "name", "conv_id").sortWithinPartitions("name", "conv_id")
    pieces = work.stage(listed.mapInPandas(_listed, "name binary, first bigint, ids string"), "pieces")
    dealt = pieces.repartition(parts, "name").sortWithinPartitions("name", "first")
    return work.stage(dealt.mapInPandas(_digested, "name binary, ends_sha256 string"), "digests")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def trie(turns: DataFrame, members: DataFrame, work: Workspace) -> DataFrame:
    """All nodes, as in ``NODES``, from (conv_id, pos, symbol, bytes) with positions from 1 and (conv_id, len); both stored."""
    spark = work.spark
    root = members.agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"), F.max("len").alias("longest")).first()
    if not root["n"]:
        return spark.createDataFrame([], NODES)
    levels = int(root["longest"]).bit_length()

    # bottom up: digests of blocks of 1, 2, 4 … symbols
    digests = [turns.select("conv_id", (F.col("pos") - 1).alias("q"), F.col("symbol").alias("digest"))]
    for level in range(1, levels):
        half = F.col("q") % 2
        pair = digests[-1].groupBy("conv_id", F.shiftright("q", 1).alias("q")).agg(
            F.max(F.when(half == 0, F.col("digest"))).alias("left"), F.max(F.when(half == 1, F.col("digest"))).alias("right"))
        digests.append(work.stage(pair.where("right is not null").select("conv_id", "q", _name(F.col("left"), F.col("right")).alias("digest")), f"digests{level}"))
    every = _union([d.withColumn("level", F.lit(k)) for k, d in enumerate(digests)]) if digests else None
    ends = _ends(members, every, levels, work) if levels else work.stage(members.withColumn("name", F.lit(ROOT)), "ends")
    member_lists = member_digests(ends, work)

    # the first rows: distinct conversations; ``to``: the round that cuts a row, -1 for a node
    def round_of(rest: Column, most: int) -> Column:
        return F.least(F.floor(F.log2(rest.cast("double") + 0.5)), F.lit(most)).cast("int")

    distinct = ends.where("len > 0").groupBy(F.col("name").alias("whole")).agg(F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("w"), F.max("len").alias("len"))
    distinct = distinct.select(F.lit(ROOT).alias("name"), F.lit(0).cast("bigint").alias("lo"), "rep", "w", "len", round_of(F.col("len"), levels - 1).alias("to"))
    sources = [work.stage(distinct, "distinct")] if levels else []
    cut, upper = {}, {}
    for j in reversed(range(levels)):
        rows = _union([s.where(F.col("to") == j) for s in sources])
        block = digests[j].select("conv_id", "q", "digest")
        joined = rows.join(block, (F.col("rep") == F.col("conv_id")) & (F.shiftright("lo", j) == F.col("q")))
        cut[j] = work.stage(joined.select("name", "lo", "rep", "w", "len", _name(F.col("name"), F.col("digest")).alias("g")), f"cut{j}")
        made = cut[j].groupBy("lo", "name", "g").agg(F.min("rep").alias("rep"), F.sum("w").alias("w"), F.max("len").alias("len"))
        upper[j] = work.stage(made.withColumn("to", F.lit(j - 1)), f"upper{j}")
        middle = F.col("lo") + (1 << j)
        lower = cut[j].where(F.col("len") > middle).select(
            F.col("g").alias("name"), middle.alias("lo"), "rep", "w", "len", round_of(F.col("len") - middle, j - 1).alias("to"))
        sources += [upper[j].select("name", "lo", "rep", "w", "len", "to"), lower]

    if levels:
        found = _union([s.where("to = -1") for s in sources])
        last = turns.select(F.col("conv_id").alias("c"), (F.col("pos") - 1).alias("q"), "bytes")
        found = found.join(last, (F.col("rep") == F.col("c")) & (F.col("lo") == F.col("q"))).select(
            "name", "lo", "rep", "w", (F.col("len") == F.col("lo") + 1).cast("bigint").alias("leaves"), ((F.col("w") - 1) * F.col("bytes")).alias("saved"))
        found = work.stage(found, "nodes")
        root_totals, added = _grafted(found, cut, upper, levels, work)
        nodes = _assembled(found, added, upper, member_lists, root["least"], work)
    else:
        root_totals, nodes = (1, 0), None
    n_first = found.where(F.col("lo") == 0).count() if levels else 0
    top = spark.createDataFrame([(root["least"], 0, None, root["n"], n_first, *root_totals)], "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint")
    ended = member_lists.where(F.col("name") == F.lit(ROOT)).select("ends_sha256")
    top = top.join(ended, F.lit(True), "left").withColumn("ends_sha256", F.coalesce("ends_sha256", _nobody()))  # one row each
    return top if nodes is None else nodes.unionByName(top)


def _nobody() -> Column:
    return F.lit(hashlib.sha256(b"").hexdigest())


def _grafted(found: DataFrame, cut: dict, upper: dict, levels: int, work: Workspace) -> tuple[tuple[int, int], DataFrame]:
    """Totals of the whole trie, and for nodes (lo, rep) what hangs below their own trie: (lo, rep, leaves, saved)."""
    sums = [F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]
    totals = work.stage(found.groupBy("lo", "name").agg(*sums), "totals")
    hanging = {}
    for j in range(levels):
        below = totals.select(F.col("lo").alias("l"), F.col("name").alias("n"), "leaves", "saved")
        cuts = upper[j].select("lo", "name", "g", "rep")
        hanging[j] = work.stage(cuts.join(below, (F.col("g") == F.col("n")) & (F.col("lo") + (1 << j) == F.col("l"))).select("lo", "name", "g", "rep", "leaves", "saved"), f"hanging{j}")
        stays = totals.where(F.col("lo") % (2 << j) == 0)
        totals = work.stage(stays.unionByName(hanging[j].select("lo", "name", "leaves", "saved")).groupBy("lo", "name").agg(*sums), "totals")
    whole = totals.agg(F.sum("leaves"), F.sum("saved")).first()

    handed: list[DataFrame] = []
    for j in reversed(range(levels)):
        own = hanging[j].select("lo", "name", "g", "leaves", "saved")
        if handed:
            due = _union([h.where(F.col("to") == j) for h in handed]).select(F.col("lo").alias("l"), F.col("rep").alias("r"), "leaves", "saved")
            passed = work.stage(cut[j].join(due, (F.col("lo") == F.col("l")) & (F.col("rep") == F.col("r"))).drop("l", "r"), f"passed{j}")
            own = own.unionByName(passed.select("lo", "name", "g", "leaves", "saved"))
            middle = F.col("lo") + (1 << j)
            rest = F.least(F.floor(F.log2((F.col("len") - middle).cast("double") + 0.5)), F.lit(j - 1)).cast("int")
            handed.append(passed.where(F.col("len") > middle).select(middle.alias("lo"), "rep", "leaves", "saved", rest.alias("to")))
        own = own.groupBy("lo", "name", "g").agg(*sums)
        named = upper[j].select(F.col("lo").alias("l"), F.col("g").alias("k"), "rep")
        onto = own.join(named, (F.col("lo") == F.col("l")) & (F.col("g") == F.col("k"))).select("lo", "rep", "leaves", "saved", F.lit(j - 1).alias("to"))
        handed.append(work.stage(onto, f"handed{j}"))
    return (whole[0], whole[1]), _union([h.where("to = -1") for h in handed]).drop("to")


def _assembled(found: DataFrame, added: DataFrame, upper: dict, member_lists: DataFrame, least: int, work: Workspace) -> DataFrame:
    """Nodes with their names, children, parents and totals."""
    names = _union([u.select("g", F.col("rep").alias("r"), (F.col("lo") + (1 << j)).alias("d")) for j, u in upper.items()])
    kids = work.stage(found.groupBy(F.col("name").alias("p")).agg(F.count(F.lit(1)).alias("n_children")), "kids")
    more = added.select(F.col("lo").alias("l"), F.col("rep").alias("r2"), F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))
    listed = member_lists.select(F.col("name").alias("e"), "ends_sha256")
    nodes = found.join(names, (F.col("rep") == F.col("r")) & (F.col("lo") + 1 == F.col("d")))
    nodes = nodes.join(more, (F.col("rep") == F.col("r2")) & (F.col("lo") == F.col("l")), "left")
    nodes = nodes.join(kids, F.col("g") == F.col("p"), "left").join(listed, F.col("g") == F.col("e"), "left")
    nodes = work.stage(nodes.select(
        "name", "g", F.col("rep").alias("conv_id"), F.col("d").alias("depth"), F.col("w").alias("n_convs"), F.coalesce("n_children", F.lit(0)).alias("n_children"),
        (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"), (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
        F.coalesce("ends_sha256", _nobody()).alias("ends_sha256"),
    ), "described")

    # parents: the root by itself, those with many children (HOT of them at most, as children are disjoint) by broadcast, the rest by a join
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    many = nodes.count() // HOT
    parents = nodes.where("n_children > 0").select(F.col("g").alias("p"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    hot = parents.where(F.col("n_children") > many).select(F.col("p").alias("hot_p"), F.col("parent_conv_id").alias("hot_id"))
    below = nodes.where(F.col("name") != F.lit(ROOT)).join(F.broadcast(hot), F.col("name") == F.col("hot_p"), "left")
    rest = below.where("hot_p is null").join(parents.where(F.col("n_children") <= many).drop("n_children"), F.col("name") == F.col("p"))
    first = nodes.where(F.col("name") == F.lit(ROOT)).withColumn("parent_conv_id", F.lit(least).cast("bigint"))
    some = below.where("hot_p is not null").withColumn("parent_conv_id", F.col("hot_id"))
    return _union([part.select(*columns) for part in (first, some, rest)])


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of the conversations as they are; stored."""
    spark = conversations.sparkSession
    ship(spark)
    out = work_path(spark, "trie-nodes")
    with Workspace(spark, "trie") as work:
        turns = numbered(conversations, work)
        return stage(trie(turns, work.stage(lengths(turns), "lengths"), work), out)


def report(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations; stored."""
    spark = conversations.sparkSession
    ship(spark)
    out = work_path(spark, "trie-nodes")
    with Workspace(spark, "trie") as work:
        turns, members = rebuilt(numbered(conversations, work), work)
        return stage(trie(turns, members, work), out)
