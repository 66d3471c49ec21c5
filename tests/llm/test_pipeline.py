"""The pipeline's stages against plain versions of their operators."""

from collections import Counter

import corpus_pipeline
from colloquy.llm import decontaminate, quality

from .test_simple_operators import check_places, mixed_plainly
from .test_text_operators import classes, fingerprint


def staged(spark, docs, sf_dir, path):
    """All stages as the driver runs them: written and read again."""
    out = []
    for k, (_, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, docs, sf_dir).write.parquet(f"{path}/{k}")
        docs = spark.read.parquet(f"{path}/{k}")
        out.append(docs)
    return out


def test_stages(spark, small, documents, labels, benchmark, tmp_path):
    good, single, clean, mixed, placed = staged(spark, documents, small, tmp_path)
    for frame in (good, single, clean, mixed):
        assert frame.columns == documents.columns
    ids = lambda frame: Counter(r["doc_id"] for r in frame.select("doc_id").collect())
    assert ids(good) == ids(quality.report(documents, labels).where("kept"))

    prints = {r["doc_id"]: fingerprint(r["text"]) for r in good.collect()}
    root = classes(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for i in sorted(prints):
        least.setdefault(root[prints[i]], i)
    assert ids(single) == Counter(least.values())

    leaked = {r["doc_id"] for r in decontaminate.report(single, benchmark).collect()}
    assert ids(clean) == Counter(i for i in ids(single) if i not in leaked)

    _, _, taken = mixed_plainly(clean.collect())
    copies, sizes = ids(mixed), {r["doc_id"]: len((r["text"] or "").split()) for r in clean.collect()}
    for i, (words,) in taken.items():
        if sizes[i]:
            assert abs(copies[i] - words / sizes[i]) <= 0.5
    rows = placed.collect()
    assert Counter(r["doc_id"] for r in rows) == copies
    check_places(rows, 40)


def test_edges(spark, small, edge, nothing, tmp_path):
    for k, docs in enumerate((edge, nothing)):
        frames = staged(spark, docs, small, f"{tmp_path}/{k}")
        assert frames[-1].columns == [*docs.columns, "shard", "slot"]
    assert frames[-1].count() == 0
