"""Sharding, mixing, quality rules, URLs: SQL counterparts, plain versions, edges."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from checks.compare import compare, connect
from colloquy.llm import catalog, mixing, quality, sharding, urls

from .conftest import CLASHING

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_sql_counterpart(spark, small, name):
    same, note = compare(spark, connect(small), name, catalog.queries()[name], catalog.oracle_sql()[name], small)
    assert same, note


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 65, 1000])
def test_permutation_is_one_to_one(spark, n):
    rows = spark.range(n).select(sharding.permuted_within(F.col("id"), n).alias("p")).collect()
    assert sorted(r.p for r in rows) == list(range(n))


def check_places(placed, shards):
    counts = Counter(r["shard"] for r in placed)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for shard in counts:
        assert sorted(r["slot"] for r in placed if r["shard"] == shard) == list(range(counts[shard]))


def test_shards(spark, documents):
    first = sharding.report(documents).collect()
    check_places(first, 40)
    again = sharding.report(documents.repartition(7)).collect()
    assert plain(first) == plain(again)
    other = sharding.report(documents, seed=1).collect()
    assert plain(first) != plain(other)


def test_shards_edges(edge, nothing):
    placed = sharding.assign(edge, 5)
    assert placed.columns == [*edge.columns, "shard", "slot"]
    rows = placed.collect()
    check_places(rows, 5)
    assert len(rows) == edge.count() and all(r["bucket"] == "own bucket" for r in rows)
    assert sharding.report(nothing).count() == 0
    assert {r["size"] for r in sharding.report(edge).where("size = 16 and text_crc32 = 0").collect()} == {16}


def mixed_plainly(rows):
    """Taken words by (source, key order), targets by resharing until none is above."""
    sized = [(r["doc_id"], r["source"], len(WORD.findall(r["text"] or ""))) for r in rows]
    total = defaultdict(int)
    for _, source, n in sized:
        total[source] += n
    order = sorted((s for s in total if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in total)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    want, capped = 1.5 * sum(total.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        level = (want - sum(2 * total[s] for s in capped)) / max(1, sum(weight[s] for s in free))
        above = {s for s in free if level * weight[s] > 2 * total[s] + 1e-9}
        if not above:
            break
        capped |= above
    target = {s: 2.0 * total[s] if s in capped else level * weight[s] for s in order}
    key = lambda i: int(hashlib.md5(f"{mixing.SEED}|{'null' if i is None else i}".encode()).hexdigest()[:15], 16)
    taken = {}
    for s in order:
        budget = math.floor(target[s] + 0.5)
        epochs = budget // total[s] if total[s] else 0
        rest, start = budget - epochs * total[s], 0
        for k, i, n in sorted((key(i), -1 if i is None else i, n) for i, source, n in sized if source == s):
            taken.setdefault(i, []).append(epochs * n + max(0, min(n, rest - start)))
            start += n
    return target, total, taken


def test_mix_against_plain_version(documents):
    target, total, taken = mixed_plainly(documents.collect())
    source = {r["doc_id"]: r["source"] for r in documents.collect()}
    got = mixing.report(documents).collect()
    assert len(got) == documents.count()
    sums = Counter()
    for r in got:
        s = source[r["doc_id"]]
        assert math.isclose(r["target"], target[s]) and r["source_size"] == total[s]
        assert [r["taken"]] == taken[r["doc_id"]] and r["taken"] <= 2 * r["size"]
        sums[s] += r["taken"]
    assert all(abs(sums[s] - target[s]) <= 0.5 for s in target)


def test_mixed_rows(documents):
    rows = mixing.mix(documents)
    assert rows.columns == documents.columns
    copies = Counter(r["doc_id"] for r in rows.collect())
    for r in mixing.report(documents).collect():
        if r["size"]:
            assert abs(copies[r["doc_id"]] - r["taken"] / r["size"]) <= 0.5


def test_mix_edges(edge, nothing):
    report = mixing.report(edge).collect()
    assert len(report) == edge.count()
    assert all(r["taken"] <= 2 * r["size"] for r in report)
    rows = mixing.mix(edge)
    assert rows.columns == edge.columns
    assert all(r["_key"] == "own _key" for r in rows.collect())
    assert mixing.report(nothing).count() == 0 and mixing.mix(nothing).count() == 0


def repeated(words):
    grams = defaultdict(list)
    for i in range(len(words) - 4):
        grams[tuple(words[i : i + 5])].append(i)
    return len({at + k for starts in grams.values() if len(starts) > 1 for at in starts for k in range(5)})


def counted(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), repeated(words))


def test_quality_counts(edge, documents, labels):
    for table in (edge, documents):
        got = quality.report(table, labels).collect()
        want = [(r["doc_id"], *counted(r["text"])) for r in table.collect()]
        assert plain(tuple(r)[:6] for r in got) == plain(want)
        for r in got:
            assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
            assert not (r["kept"] and r["base_failed"])


def test_binomial_tail(spark):
    cases = [(0, 10, 0.01), (3, 50, 0.1), (9, 900, 0.02), (0, 5000, 0.002), (20, 20, 0.5), (0, 0, 0.1)]
    for k, n, p in cases:
        got = spark.range(1).select(quality.binomial_tail(F.lit(k).cast("bigint"), F.lit(n).cast("bigint"), p)).first()[0]
        exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert got == 1.0 if n == 0 or k >= n * p else math.isclose(got, exact, rel_tol=1e-9)


def test_thresholds_hold_back_junk_and_keep_good(spark):
    good, junk = "plain words that say something about a thing today", "wo### rd*** ju$$$ nk%%% an&&& oth### er*** li$$$ ne%%% of&&&"
    texts = [(i, f"{good} number {i} {i + 1} {i + 2} end", "en", 1) for i in range(4000)] + [(10_000 + i, f"{junk} {i}", "en", 0) for i in range(50)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string, quality int")
    kept = {r["doc_id"]: r["kept"] for r in quality.report(docs, docs.select("doc_id", "quality")).collect()}
    assert all(kept[i] for i in range(4000)) and not any(kept[10_000 + i] for i in range(50))
    few = docs.where("doc_id < 100 or doc_id >= 10000")
    assert all(r["kept"] for r in quality.report(few, few.select("doc_id", "quality")).collect())  # too few labels to reject anything


def test_quality_rows(edge, nothing, labels):
    kept = quality.passing(edge, labels)
    assert kept.columns == edge.columns
    verdicts = Counter(r["doc_id"] for r in quality.report(edge, labels).where("kept").collect())
    assert Counter(r["doc_id"] for r in kept.collect()) == verdicts
    assert quality.report(nothing, labels).count() == 0 and quality.passing(nothing, labels).count() == 0
    assert quality.report(edge, labels.limit(0)).count() == edge.count()


URLS = [
    None, "", "no scheme", "http://", "http:///x", "HTTP://WWW.Example.ORG/es/1", "https://example.org/es", "https://a.example.org/en/12?q=1",
    "https://badexample.org/en/1", "http://x.com/fr/", "http://x.com/de/9#a", "http://com/fr/z", "http://y.net/en/1", "http://org?x=/es/", "ftp://ünï.org/é/",
    "http://org/", "http://x.com.evil.net/fr/", "a://b://c.org/",
]


def test_urls_by_trie_and_by_join(spark):
    pages = spark.createDataFrame([(i, u, *[f"own {c}" for c in CLASHING]) for i, u in enumerate([*URLS, *URLS[5:7]])],
                                  "page_id long, url string, " + ", ".join(f"`{c}` string" for c in CLASHING))
    by_trie = urls.judge(pages).collect()
    by_join = urls.judge(pages, max_broadcast=0).collect()
    assert plain(map(tuple, by_trie)) == plain(map(tuple, by_join))
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in by_trie}
    for i, url in enumerate(URLS):
        rest = (url or "").partition("://")
        host = re.match(r"[^/?#]*", rest[2])[0] if rest[1] else ""
        path = re.match(r"[^?#]*", rest[2][len(host):])[0] if rest[1] else ""
        host = host.translate({c: c + 32 for c in range(65, 91)})
        fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        want = max(fits)[1:] if fits else (None, "block" if not host else "allow")
        assert got[i] == want, url
    assert all(r["key"] == "own key" and r["host"] != "own host" for r in by_trie)
    assert urls.judge(pages.limit(0)).count() == 0


def test_longest_entry_and_block_before_allow(spark):
    rules = [("allow", "a.b.c", "/x/"), ("block", "b.c", "/x/y/z/"), ("block", "q.c", "/"), ("allow", "q.c", "/"), ("block", "c", "")]
    pages = spark.createDataFrame([(0, "h://a.b.c/x/y/z/"), (1, "h://b.c/x/y/z/1"), (2, "h://q.c/k"), (3, "h://w.c")], "page_id long, url string")
    for limit in (100, 0):
        got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.judge(pages, rules, limit).collect()}
        assert got == {0: ("a.b.c/x/", "allow"), 1: ("b.c/x/y/z/", "block"), 2: ("q.c/", "block"), 3: ("c", "block")}
