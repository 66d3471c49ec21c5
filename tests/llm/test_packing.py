"""Packing: ids against the tokeniser, places by a full check, fullness against plain best fit."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from colloquy.llm import packing

PATH = public_tokenizers.path(packing.VOCABULARY)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check(docs, made, tokenizer, capacity=packing.CAPACITY):
    """Every piece is there once with its ids' checksum; sequences have neither gaps nor overlaps. Returns their lengths."""
    def pieces(doc_id, text):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END], "<u4")
        return [(doc_id, k, at, len(ids[at : at + capacity]), zlib.crc32(ids[at : at + capacity].tobytes())) for k, at in enumerate(range(0, len(ids), capacity))]

    rows = made.collect()
    order = lambda found: sorted(found, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))
    want = [piece for r in docs.collect() for piece in pieces(r["doc_id"], r["text"])]
    assert order((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == order(want)
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    lengths = []
    for found in places.values():
        end = 0
        for offset, length in sorted(found):
            assert offset == end
            end += length
        assert end <= capacity
        lengths.append(end)
    return lengths


TEXTS = ["", " ", "Hello, World!!", "İstanbul ΣΑΣ ς ﬁne", "á e ́x", "\x1c\x1d|\x85 b c", "don't I'LL <|endoftext|> <|startoftext|>x", "x" * 500, "漢字 123456 ½ ⅷ", "one. Two, THREE!? (four) \"five\". <|ENDOFTEXT|>. x<|endoftext|>, naïve, 6. 's. it's, A.B.C. ...", "​﻿ a b"]


@pytest.mark.parametrize("kept", [packing.KEPT_WORDS, 3])
def test_ids(tokenizer, documents, monkeypatch, kept):
    monkeypatch.setattr(packing, "KEPT_WORDS", kept)
    encode = packing.token_bytes.__wrapped__(PATH)
    draw = random.Random(1)
    texts = TEXTS + [draw.choice(" \n\t\r").join(draw.choices(TEXTS, k=5)) for _ in range(200)]
    texts += ["".join(draw.choices("aZ ß'.,)!\"ſ́̀\n Σ9!<|>é", k=30)) for _ in range(500)] + [r["text"] for r in documents.collect()]
    for text in texts:
        assert encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_best_fit():
    draw = random.Random(2)
    for _ in range(200):
        sizes = [draw.randint(1, 50) for _ in range(draw.randint(1, 60))]
        bins, offsets, fill = packing.best_fit(np.array(sizes), 50)
        plain: list[int] = []
        for size in sorted(sizes, reverse=True):
            rooms = [(50 - f, i) for i, f in enumerate(plain) if 50 - f >= size]
            if rooms:
                plain[min(rooms)[1]] += size
            else:
                plain.append(size)
        assert sorted(plain) == sorted(fill.tolist())
        for b in range(len(fill)):
            inside = sorted((offsets[i], sizes[i]) for i in np.flatnonzero(bins == b))
            assert [o for o, _ in inside] == [sum(s for _, s in inside[:k]) for k in range(len(inside))]


def test_given_table(documents, tokenizer):
    made = packing.pack(documents)
    lengths = check(documents, made, tokenizer)
    assert len(lengths) <= -(-sum(lengths) // packing.CAPACITY) + 1


@pytest.mark.parametrize("most", [packing.MOST, 3])
def test_tree(spark, documents, tokenizer, most):
    """Many tasks and short sequences, so that bins are merged over several levels; with parents in parts, too."""
    spread = documents.repartition(20)
    made = packing.pack(spread, capacity=512, block=4, fan=2, most=most, slack=0)
    lengths = check(spread, made, tokenizer, 512)
    if most > 3:
        plain = packing.best_fit(np.array([r["length"] for r in made.collect()]), 512)[2]
        assert len(lengths) <= 1.03 * len(plain) + 1


def test_edges(edge, nothing, tokenizer):
    made = packing.pack(edge)
    assert made.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    check(edge, made, tokenizer)
    assert packing.pack(nothing).count() == 0


def test_sequences(documents, tokenizer):
    made = packing.pack(documents)
    whole = {r["doc_id"]: [*tokenizer.encode(r["text"], add_special_tokens=False).ids, packing.END] for r in documents.collect()}
    ids = {r["sequence_id"]: r["ids"] for r in packing.sequences(documents, made).collect()}
    for r in made.collect():
        assert ids[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == whole[r["doc_id"]][r["start"] : r["start"] + r["length"]]
