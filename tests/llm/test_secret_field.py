"""The field over whole texts: equal to decoding every token, and what it finds of kinds that no pattern lists."""

import random
import string

import numpy as np
import pytest

from colloquy.llm import secrets_crf

DRAW = random.Random(4)
LETTERS = string.ascii_letters + string.digits


def _of(alphabet, n):
    return "".join(DRAW.choice(alphabet) for _ in range(n))


@pytest.fixture(scope="module")
def field(spark):
    """Trained on values of the listed kinds among prose of the given table."""
    hexes = [f"old lines and {_of('0123456789abcdef', 40)} in them, number {i}" for i in range(250)]
    keys = [f"we had AKIA{_of(string.ascii_uppercase + string.digits, 16)} there once, see page {i}" for i in range(250)]
    assigned = [f"set password={_of(LETTERS, 14)} or token: {_of(LETTERS + '-_', 20)} before {i}" for i in range(250)]
    prose = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows = list(enumerate(hexes + keys + assigned + prose))
    return secrets_crf.fit(secrets_crf.scanned(spark.createDataFrame(rows, "doc_id long, text string")))


def plainly(field, text):
    """Viterbi over all tokens at once."""
    tokens = list(secrets_crf.TOKEN.finditer(text))
    out, inside = [], False
    if tokens:
        tags = field.decode([field.emissions([m[0] for m in tokens], secrets_crf.file_features(text))])[0]
        for m, tag in zip(tokens, tags):
            if tag == 2 and inside:
                out[-1] = (out[-1][0], m.end())
            elif tag:
                out.append(m.span())
            inside = tag > 0
    return out


def mixed(n):
    words = ["the", "Token", "key", "monkey.", "=", ":", "a1b2c3d4e5", _of(LETTERS, 24), _of("0123456789abcdef", 30), "password", "is", "(x)", "2024-01-02", "über", "漢字", "www.a.b/c?d=e", "###"]
    return " ".join(DRAW.choice(words) for _ in range(n))


def test_skipping_changes_nothing(spark, field):
    texts = [mixed(n) for n in (0, 1, 5, 40, 400) for _ in range(8)]
    texts += [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    found = secrets_crf.decoded(field, texts)
    assert found == [plainly(field, t) for t in texts] and any(found)


@pytest.mark.parametrize("seed", range(6))
def test_skipping_changes_nothing_for_any_field(field, seed):
    """Also with weights drawn at random, where tags begin and end anywhere."""
    draw = np.random.default_rng(seed)
    wild = secrets_crf.Field(field.index, draw.normal(0, 0.4, field.weights.shape) - np.array([0, 1, 1]) * draw.uniform(0, 2), draw.normal(0, 2, (3, 3)), draw.normal(0, 2, 3))
    texts = [mixed(n) for n in (1, 3, 30, 200) for _ in range(4)]
    assert secrets_crf.decoded(wild, texts) == [plainly(wild, t) for t in texts]


def test_secrets_of_other_kinds_in_prose(field):
    kinds = {
        "jwt": lambda: f"eyJ{_of(LETTERS, 20)}.{_of(LETTERS + '-_', 40)}.{_of(LETTERS, 30)}", "uuid": lambda: "-".join(_of("0123456789abcdef", n) for n in (8, 4, 4, 4, 12)),
        "github": lambda: f"ghp_{_of(LETTERS, 36)}",
    }
    plain = "We met on the hill and talked about the weather of last year, and nobody had a key to the house. " * 3
    for kind, make in kinds.items():
        found = 0
        for _ in range(100):
            value = make()
            text = f"{plain}Please remember that the password is {value} for the new server. {plain}"
            spans = secrets_crf.decoded(field, [text])[0]
            assert all(text[a:b] in value or value in text[a:b] for a, b in spans)  # nothing else is tagged
            found += any(text[a:b].startswith(value) for a, b in spans)
        assert found >= 60, (kind, found)
