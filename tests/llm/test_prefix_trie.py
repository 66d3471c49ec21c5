"""The trie against a plain one that walks every prefix of every conversation."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from colloquy.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, name string, rep string, len string, lo string, g string, pos string"


def _symbol(role, text):
    role = role or ""
    return hashlib.sha256(f"{len(role.encode())}:{role}{text or ''}".encode()).digest()[:16]


def turns_of(rows):
    """conv_id -> its turns in order."""
    out = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            out[conv_id].append((turn is not None, turn or 0, _symbol(role, text), role or "", text or ""))
    return {c: [t[3:] for t in sorted(found)] for c, found in out.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = int(c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5)))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def plainly(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(set)
    for prefix in members:
        if prefix:
            children[prefix[:-1]].add(prefix)
    leaves, saved = defaultdict(int), defaultdict(int)
    for prefix, who in members.items():
        own = (len(who) - 1) * len(prefix[-1][1].encode()) if prefix else 0
        for d in range(len(prefix) + 1):
            leaves[prefix[:d]] += not children[prefix]
            saved[prefix[:d]] += own
    rows = set()
    for prefix, who in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in who if len(convs[c]) == len(prefix)))
        parent = min(members[prefix[:-1]]) if prefix else None
        rows.add((min(who), len(prefix), parent, len(who), len(children[prefix]), leaves[prefix], saved[prefix], hashlib.sha256(ends.encode()).hexdigest()))
    return rows


def check(spark, rows, builds=("prefix_trie", "report")):
    frame = spark.createDataFrame([(*r, *[f"own {i}" for i in range(6)]) for r in rows], SCHEMA).repartition(3)
    convs = turns_of(rows)
    for build in builds:
        made, want = getattr(prefix_trie, build)(frame), rebuilt(convs) if build == "report" else convs
        got = made.collect()
        assert made.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
        assert len(got) == len({(r["conv_id"], r["depth"]) for r in got})
        assert {tuple(r) for r in got} == (plainly(want) if want else set())


def test_edges(spark):
    rows = [(0, 1, "user", "a"), (0, 0, "system", "be ünkind"), (0, None, None, None), (1, 3, "user", ""), (1, 3, "user", ""), (1, 3, "assistant", "zz"),
            (None, 1, "user", "nobody's"), (7, 1, "user", "x" * 100_000), (7, 2, None, "x"), (12, 0, "user", "a"), (-3, 0, "user", "a"), (-3, 1, "user", "b")]
    rows += [(20 + i, 0, "user", "hello") for i in range(12)]
    check(spark, rows)


def test_long_and_short_conversations(spark):
    draw = random.Random(3)
    rows = [(0, t, "user", "ab"[t % 2]) for t in range(70)] + [(1, t, "user", "ab"[t % 2]) for t in range(70)]
    rows += [(2, t, "user", "ab"[t % 2] if t < 63 else "c") for t in range(64)] + [(3, t, "user", "ab"[t % 2]) for t in range(32)]
    for c in range(5, 150):
        text = draw.choice(["ab", "abab", "aab", "abcab"]) * draw.randint(1, 5)
        rows += [(c, t, "user", x) for t, x in enumerate(text[: draw.randint(1, 20)])]
    check(spark, rows)


def test_hot_conversation_and_repeated_turn(spark):
    """One conversation with most of the turns, most of them the same row; and one text that many share."""
    rows = [(0, 5, "user", "again")] * 600 + [(0, t, "user", str(t)) for t in range(300)] + [(c, 0, "user", "hello") for c in range(5, 400)]
    check(spark, rows, ["prefix_trie"])


def test_pieces_of_member_lists(spark, monkeypatch):
    """Lists of members longer than a piece, over several tasks."""
    check(spark, [(c, 0, "user", "hello") for c in range(2_500)], ["prefix_trie"])


@pytest.mark.parametrize("rows", [[], [(None, 0, "user", "a")], [(4, 0, "user", "a")], [(1, 0, "user", "only turn, replaced by none")]])
def test_few_rows(spark, rows):
    check(spark, rows, ["report"])


def test_given_table(spark, small):
    frame = spark.read.parquet(f"{small}/conversations.parquet")
    got = {tuple(r) for r in prefix_trie.report(frame).collect()}
    assert got == plainly(rebuilt(turns_of([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in frame.collect()])))
