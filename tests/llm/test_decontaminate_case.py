"""Benchmark passages in other letter cases and with other white space."""

from colloquy.llm import decontaminate

from .test_text_operators import ITEM, planted


def test_case_and_white_space(spark):
    filler = "some words before it and some more of them here. "
    other = "entirely different words that only share the case of their letters with what the item says, and go on for a while"
    renamed = ITEM.replace("Anna Smith", "Maria Lopez").replace("Peter Jones", "Karl Weber")
    texts = [ITEM.upper(), filler + ITEM.upper(), ITEM.lower(), ITEM.title(), renamed.replace(" ", "  "), renamed.replace(" ", "\n"), other.upper(), other]
    docs, bench = planted(spark, texts)
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.report(docs, bench).collect()}
    assert found == {(i, 7) for i in range(6)}
    assert {r["doc_id"] for r in decontaminate.clean(docs, bench).collect()} == {6, 7}
