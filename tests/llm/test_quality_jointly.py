"""All quality rules certified together, with few labels."""

from colloquy.llm import quality

GOOD = "plain words that say something about a thing today"
JUNK = "wo### rd*** ju$$$ nk%%% an&&& oth### er*** li$$$ ne%%% of&&&"


def kept(spark, n, lost=0):
    """Ids kept of n good German documents, the first ``lost`` of them full of symbols, and 20 of junk."""
    texts = [(i, f"{JUNK if i < lost else GOOD} number {i} {i + 1} {i + 2} end", "de", 1) for i in range(n)]
    texts += [(10_000 + i, f"{JUNK} {i}", "de", 0) for i in range(20)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string, quality int")
    return {r["doc_id"] for r in quality.passing(docs, docs.select("doc_id", "quality")).collect()}


def test_few_labels_suffice(spark):
    assert kept(spark, 228) == set(range(228))
    assert len(kept(spark, 227)) == 227 + 20  # one label too few
    assert set(range(300)) <= kept(spark, 300, lost=6)  # stricter steps would lose too many and are not certified
