"""Whole licence texts, in files of their own, with other white space and comment marks; and one notice repeated over and over."""

import pytest

from colloquy.llm import licenses

WHOLE = [(label, text) for label, text, _ in licenses.NOTICES if len(text.split()) > 30]


@pytest.fixture(scope="module")
def found(spark):
    plain = "some words about a thing and its parts that no licence has ever used, all of them quite plain. " * 4
    rows = [(i, text) for i, (_, text) in enumerate(WHOLE)]
    rows += [(100 + i, plain + "\n".join(f"// {line}" for line in text.splitlines()).upper() + "\n" + plain) for i, (_, text) in enumerate(WHOLE)]
    rows += [(200 + i, " ".join(text.split()[: len(text.split()) // 4])) for i, (_, text) in enumerate(WHOLE)]
    rows += [(300, plain), (301, "Released under the MIT License. " * 3_000), (302, "under the Kernel license and the mıt license")]
    return {r["doc_id"]: r for r in licenses.report(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()}


def test_whole_texts(found):
    for i, (label, _) in enumerate(WHOLE):
        for k in (i, 100 + i):
            assert label in found[k]["labels"].split(","), (label, k)
            assert found[k]["score"] >= 0.5


def test_a_notice_repeated(found):
    row = found[301]
    assert (row["n_base"], row["first_word"], row["last_word"], row["labels"]) == (3_000, 3, 2_999 * 5 + 3, "mit")


def test_no_licence(found):
    assert found[300]["labels"] == "" and found[300]["score"] < 0.5
    assert found[302]["labels"] == "" and found[302]["n_base"] == 0  # only A-Z have a lower case here
