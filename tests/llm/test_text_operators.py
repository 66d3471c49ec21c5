"""SimHash, decontamination, licences, secrets, toxicity, HTML: plain versions, planted cases, edges."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from colloquy.llm import catalog, decontaminate, html_extract, licenses, secrets_crf, simhash, toxicity

from .conftest import TEXTS, edge_rows


def plain(rows):
    return sorted(rows, key=repr)


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(items, linked):
    label = {x: x for x in items}

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    items = list(items)
    for i, a in enumerate(items):
        for b in items[i + 1 :]:
            if linked(a, b):
                label[top(a)] = top(b)
    return {x: top(x) for x in items}


def grouped_plainly(rows):
    prints = [(i, fingerprint(t)) for i, t in rows]
    root = classes({f for _, f in prints}, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for i, f in prints:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    return plain((i, f"{f:016x}", least.get(root[f])) for i, f in prints)


def test_simhash_against_plain_version(documents):
    got = simhash.report(documents).collect()
    assert plain(map(tuple, got)) == grouped_plainly([(r["doc_id"], r["text"]) for r in documents.collect()])


def test_simhash_edges(edge, nothing):
    got = simhash.report(edge).collect()
    assert plain(map(tuple, got)) == grouped_plainly([(r[0], r[1]) for r in edge_rows()])
    kept = simhash.one_per_group(edge)
    assert kept.columns == edge.columns
    rows = kept.collect()
    groups = {r["component_id"] for r in got}
    assert {r["doc_id"] for r in rows if r["doc_id"] is not None} == groups - {None}
    assert sum(r["doc_id"] is None for r in rows) == 1  # the only group without an id
    assert all(r["key"] == "own key" for r in rows)
    assert simhash.report(nothing).count() == 0 and simhash.one_per_group(nothing).count() == 0


@pytest.mark.parametrize("group", [8, 4096])
def test_trie_join_finds_all_links(spark, group):
    """Random prints, some dense balls, neighbours in either half; small groups force deep descents."""
    draw = random.Random(5)
    prints = {draw.getrandbits(64) for _ in range(40)}
    for base in sorted(prints)[:8]:
        for _ in range(12):
            prints.add(base ^ sum(1 << b for b in draw.sample(range(64), draw.randint(1, 5))))
        prints.add(base ^ 0b1111)
        prints.add(base ^ (0b1111 << 40))
    prints |= {0, 1, (1 << 64) - 1, 1 << 63}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    fps = spark.createDataFrame([(p,) for p in signed], "fp long")
    edges = simhash.links(fps, group)
    found = simhash.components(edges).collect()
    want = classes(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    by_root = defaultdict(set)
    for p, r in want.items():
        by_root[r].add(p)
    got = defaultdict(set)
    for r in found:
        got[r["root"]].update({r["node"] % (1 << 64), r["root"] % (1 << 64)})
    assert sorted(map(sorted, got.values())) == sorted(sorted(c) for c in by_root.values() if len(c) > 1)
    assert edges.count() < len(prints) * 40


ITEM = "Anna Smith buys 12 apples and 7 pears at the market near Berlin, then Anna Smith gives 3 kg of apples to Peter Jones who lives nearby."


def planted(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(7, ITEM), (9, ITEM), (8, "Short but telling question here"), (3, None), (4, "")], "item_id long, text string")
    return docs, bench


def test_contaminated_passages(spark):
    other = ITEM.replace("Anna Smith", "Maria Lopez").replace("Peter Jones", "Karl Weber").replace("12", "45").replace("7", "99").replace("kg", "pounds")
    mixed = ITEM.replace("Anna Smith buys", "Maria Lopez buys").replace("12", "45")  # Anna is Maria here and Anna there
    wrong = "Anna Smith buys 12 apples and 7 pears"  # a part only
    docs, bench = planted(spark, [
        "Some text before. " + ITEM + " And after it more.", "We read that " + other, wrong, mixed, "nothing of the kind at all", None, "",
        "it says: short but telling question here.", ITEM + " " + ITEM,
    ])
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.report(docs, bench).collect()}
    assert {(0, 7), (1, 7), (7, 8), (8, 7)} <= set(got) and not {d for d, _ in got} & {2, 4, 5, 6}
    assert got[0, 7]["slots"] == got[0, 7]["agreeing"]
    assert got[1, 7]["covered"] >= 0.9 * got[1, 7]["item_tokens"] and got[1, 7]["agreeing"] == got[1, 7]["slots"]
    left = {r["doc_id"] for r in decontaminate.clean(docs, bench).collect()}
    assert left == set(range(9)) - {d for d, _ in got}


def test_inconsistent_slots_are_no_copy(spark):
    names = ["Ann", "Bob", "Cid", "Dan", "Eve", "Fay", "Gil", "Hal"]
    item = "then " + " went to see and talk with ".join(f"{n} or {n}" for n in names) + " today"
    scrambled = "then " + " went to see and talk with ".join(f"{a} or {b}" for a, b in zip(names[::-1], names[3:] + names[:3])) + " today"
    docs = spark.createDataFrame([(0, item), (1, scrambled)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert [r["doc_id"] for r in decontaminate.report(docs, bench).collect()] == [0]


def test_leaks_of_the_tables(documents, benchmark):
    """Against all word windows: each document with a whole item, and no document without a common window."""
    items = {r["item_id"]: re.findall(r"\w+", r["text"].lower()) for r in benchmark.collect()}
    whole, some = set(), set()
    for r in documents.collect():
        words = re.findall(r"\w+", (r["text"] or "").lower())
        joined, windows = " " + " ".join(words) + " ", {tuple(words[i : i + 8]) for i in range(len(words) - 7)}
        for k, item in items.items():
            if f" {' '.join(item)} " in joined:
                whole.add((r["doc_id"], k))
            if any(tuple(item[i : i + 8]) in windows for i in range(len(item) - 7)):
                some.add((r["doc_id"], k))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.report(documents, benchmark).collect()}
    assert whole and whole <= got <= some


def test_decontamination_edges(edge, nothing, benchmark):
    left = decontaminate.clean(edge, benchmark)
    assert left.columns == edge.columns and left.count() == edge.count()
    assert decontaminate.report(nothing, benchmark).count() == 0
    assert decontaminate.report(edge, benchmark.limit(0)).count() == 0
    assert decontaminate.clean(edge, benchmark.limit(0)).count() == edge.count()


def test_contaminated_row_without_id_goes(spark):
    docs = spark.createDataFrame([(None, ITEM), (None, "clean words"), (1, ITEM), (1, ITEM)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    assert [r["text"] for r in decontaminate.clean(docs, bench).collect()] == ["clean words"]
    assert plain(r["doc_id"] for r in decontaminate.report(docs, bench).collect()) == plain([None, 1])


def license_words(text):
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def test_license_base(edge, documents):
    for table in (edge, documents):
        want = []
        for r in table.collect():
            words, starts, labels = license_words(r["text"]), [], set()
            for phrase, label in licenses.BASE:
                p = phrase.split()
                at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
                starts += at
                labels |= {label} if at else set()
            want.append((r["doc_id"], len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))))
        got = licenses.report(table).collect()
        assert plain(tuple(r)[:6] for r in got) == plain(want)
        for r in got:
            assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_license_notices(spark, nothing):
    filler = "some other words of the text that follow and lead "
    texts = [filler + notice + " " + filler for _, notice, _ in licenses.NOTICES]
    texts += ["a licence to use the software", "cc by nc", "creative commons " * 3, "Permission is granted, free of charge"]
    got = {r["doc_id"]: r for r in licenses.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, (label, _, _) in enumerate(licenses.NOTICES):
        assert label in got[i]["labels"].split(","), (label, got[i])
    for i in range(len(licenses.NOTICES), len(texts)):
        assert got[i]["labels"] in ("", "cc-by-nc"), got[i]
    assert licenses.report(nothing).count() == 0


def secrets_plainly(text):
    spans = [("assign", *m.span()) for m in secrets_crf.ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def test_secret_base(documents, edge):
    for table in (documents, edge):
        want = []
        for r in table.collect():
            spans = secrets_plainly(r["text"] or "")
            digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
            n = Counter(k for k, _, _ in spans)
            want.append((r["doc_id"], n["assign"], n["access"], n["hex"], digest))
        got = secrets_crf.report(table).collect()
        assert plain(tuple(r)[:5] for r in got) == plain(want)
        for r in got:
            listed = [s for s in r["spans"].split(",") if s and not s.startswith("crf")]
            assert hashlib.sha256(",".join(listed).encode()).hexdigest() == r["base_sha256"]


def corpus_of_secrets(spark, n=160):
    draw = random.Random(3)
    filler = "the quick brown fox jumps over a lazy dog while many people look on".split()
    rows = []
    for i in range(n):
        words = [draw.choice(filler) for _ in range(60)]
        value = "".join(draw.choice("0123456789abcdef") for _ in range(32))
        insert = (f'token = "{value}"', f"password={value[:18]}", "on 12.05.2021 at 10:30", "call +49-555-1234567 now", "mail a.b1234@example.com")[i % 5]
        words.insert(30, insert)
        rows.append((i, " ".join(words)))
    return rows


def test_field_adds_unlisted_secrets(spark):
    rows = corpus_of_secrets(spark)
    unlisted = "the fox jumps over api credential: 9f8e7d6c5b4a39281706f5e while many people look"
    rows += [(1000, unlisted)]
    got = {r["doc_id"]: r for r in secrets_crf.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    at = unlisted.index("9f8e")
    assert got[1000]["n_crf"] == 1 and got[1000]["spans"] == f"crf:{at}:{at + 23}"
    assert not any(got[i]["n_crf"] for i in range(160) if i % 5 >= 2)  # dates, numbers, addresses


def test_viterbi_is_the_best_path():
    draw = np.random.default_rng(1)
    field = secrets_crf.Field({}, np.zeros((1, 3)), draw.normal(size=(3, 3)), draw.normal(size=3))
    batch = [draw.normal(size=(n, 3)) for n in (1, 4, 2, 6, 6, 3)]
    for emit, tags in zip(batch, field.decode(batch)):
        best = max(np.ndindex(*(3,) * len(emit)), key=lambda p: field.first[p[0]] + sum(emit[i, t] for i, t in enumerate(p)) + sum(field.pairs[a, b] for a, b in zip(p, p[1:])))
        assert tuple(tags) == best


def test_secrets_nothing(nothing):
    assert secrets_crf.report(nothing).count() == 0


def test_all_maximal_segments():
    """Against the definition by recursion: the best run, then left and right of it."""
    def split(scores, lo, hi):
        best = max(((sum(scores[a:b]), -(b - a), a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=None)
        if best is None or best[0] <= 1e-9:
            return []
        _, _, a, b = best
        return split(scores, lo, a) + [(a, b - 1, sum(scores[a:b]))] + split(scores, b, hi)

    draw = random.Random(2)
    for _ in range(60):
        gap = 0.37
        scores = [draw.uniform(0.5, 3) if draw.random() < 0.2 else -gap for _ in range(40)]
        hits = [(i, s) for i, s in enumerate(scores) if s > 0]
        got = toxicity.segments(hits, gap)
        assert [(a, b, round(s, 6)) for a, b, s in got] == [(a, b, round(s, 6)) for a, b, s in split(scores, 0, 40)]


def test_toxicity_on_held_out_documents(spark):
    where = "/root/testdata/sf0.01"
    marks = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{where}/labels.parquet").collect()}
    rows = catalog.op7_toxicity(spark, where).collect()
    assert len(rows) == spark.read.parquet(f"{where}/documents.parquet").count()
    held = [(marks[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in marks]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_toxicity_edges(edge, nothing, labels):
    for marks in (labels, labels.limit(0)):
        model = toxicity.fit(edge, marks)
        scored = toxicity.score(edge, model)
        assert scored.columns == [*edge.columns, "score", "passages"] and scored.count() == edge.count()
        assert toxicity.report(nothing, marks).count() == 0


def test_toxic_passage_is_found(spark):
    draw = random.Random(4)
    plain_words, bad = "the house stands on a hill by the sea with many trees".split(), ["vile", "nasty", "awful"]
    rows = []
    for i in range(400):
        words = [draw.choice(plain_words) for _ in range(80)]
        if i % 4 == 0:
            for k in range(30, 60, 5):
                words[k] = draw.choice(bad)
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    scored = toxicity.score(docs, toxicity.fit(docs, docs.select("doc_id", "toxic"))).collect()
    for r in scored:
        assert (r["score"] >= 0.5) == bool(r["toxic"])
        if r["toxic"]:
            (p,) = r["passages"]
            inside = r["text"][p["start"] : p["end"]].split()
            assert inside[0] in bad and inside[-1] in bad and sum(w in bad for w in inside) == 6


PAGE = """<!DOCTYPE html><html><head><title>x</title><style>p{a:b}</style></head><body class="no-comments">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies, many of them, truly.</div>
<main><article><h1>Title &amp; more</h1><p>First,&nbsp;of   all,
 a <b>bold<br>word</b>.<p>Second <a href="#">link</a> here, with commas, too.<script>if (a < b) "</p>"</script>
<aside>Aside</aside><div class="ad">Buy now</div><ul><li>one<li>two</ul><form><input><p>Mail</form><table><tr><td>c1<td>c2</table>
<!-- hidden > --></article><section id="comments"><p>I, for one, think, that, this, is, long, and, has, commas.</p></section></main>
<div class="sidebar">Side</div><footer>&copy; us</footer>"""


def test_main_text():
    assert html_extract.main_text(PAGE).split("\n\n") == [
        "Title & more", "First, of all, a bold word.", "Second link here, with commas, too.", "one", "two", "c1", "c2",
    ]
    assert html_extract.main_text("<div id=a><p>Some text, with, commas and length.</p></div><div class=menu><p>x</p></div>") == "Some text, with, commas and length."
    for page in (None, "", "<p", "<nav><a>x</a></nav>", "<!-- open"):
        assert html_extract.main_text(page) == ""
    assert html_extract.main_text("<p>1 < 2 &lt;b&gt; &#65; &unknown;") == "1 < 2 <b> A &unknown;"


def test_pages_of_the_tables(spark, small):
    rows = catalog.op8_html(spark, small).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        blocks = [" ".join(html_extract.html.unescape(re.sub(r"</?b>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?p>|</?h1>", inner)]
        assert r["text"] == "\n\n".join(x for x in blocks if x) and r["n_chars"] == len(r["text"])


def test_html_edges(spark):
    pages = spark.createDataFrame([(1, None, "own"), (2, "", "own"), (3, "<p>" + "x, " * 200_000, "own"), (3, "<p>y</p>", "own")], "page_id long, html string, row string")
    rows = html_extract.extract(pages)
    assert rows.columns == ["page_id", "html", "row", "text", "n_chars"]
    assert plain((r["page_id"], r["n_chars"]) for r in rows.collect()) == [(1, 0), (2, 0), (3, 1), (3, 599_999)]
    assert html_extract.extract(pages.limit(0)).count() == 0
    assert len(TEXTS) == 14


def test_deep_nesting():
    assert html_extract.main_text("<div>" * 5000 + "deep, text") == "deep, text"


def test_passages_where_lower_case_is_longer():
    """Dotted capital I becomes two characters: places are those of the given text."""
    model = toxicity.Model(lexicon={"vile": 6.0, "awful": 6.0}, gap=0.2, rate=1.0, k=0.1, intercept=-5.0, slope=1.0)
    text = "İstanbul İ İİ is a plain place " + "but VİLE no " + "you VILE awful " * 3 + "end İ"
    _, found = toxicity.passages(text, model)
    assert [text[a:b] for a, b, *_ in found] == ["VILE awful you VILE awful you VILE awful"]
    weak, strong = (toxicity.passages("you vile awful " * n, model)[0] for n in (20, 40))
    assert 0.99 < weak < strong <= 1 or weak == strong == 1.0
    scores = [model.normalised(best, 100) for best in (40.0, 80.0, 4_000.0)]
    assert scores == sorted(set(scores)) and model.probability(1e6) == 1 and model.probability(-1e6) == 0
