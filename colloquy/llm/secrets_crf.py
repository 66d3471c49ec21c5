"""Secrets: fixed patterns, and a linear-chain conditional random field over tokens.

The patterns give the base spans. The field tags tokens as secret begin (B), inside (I) or outside (O) from their shape, the
neighbouring words and features of the file; Viterbi decoding gives the best tagging. It is trained here, by gradient ascent
on the likelihood of tags that the patterns' values give to a bounded sample of stretches (``MAX_STRETCHES`` of either kind with at
most ``MAX_TOKENS`` tokens, those with the smallest hashes; equal stretches count once).

One pass over the whole texts finds patterns and, for training, stretches: some words around each run of at least eight key characters that
has a digit or twenty characters, and around each word that announces a secret, in prose or before ``=`` or ``:``. Each value that a pattern finds is also learnt
in prose, after one of ``ANNOUNCEMENTS``, so that the field does not depend on the marks that patterns need.

A second pass decodes the whole texts. A token is cold if, whatever stands around it, tagging it costs more than any change of tags can gain; a
sequence of tags over cold tokens alone is then worse than O, and so is one that reaches over more than some number of them (:class:`Bounds`). So decoding the
tokens around the others, which are few, gives the tags of the whole text. Whether a token is cold after a cue, or else, is worked out once for each word.

Of equally good tags O comes first, then B. Texts of any length are read as a whole. Tagged spans that meet no base span are added with kind ``crf``. Positions are code points, ends exclusive. Nulls: a null
text is empty; rows are scanned one by one, repeated or not, with or without id. Without any base span in the table there
is nothing to learn from, and no span is added. An empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.text import require
from colloquy.session import ship, stage, work_path

MAX_STRETCHES, MAX_TOKENS = 1_500, 48
#: Margin of cold tokens; words whose kind a task keeps.
MARGIN, KEPT_WORDS = 0.5, 400_000
STEPS, RATE, RIDGE = 60, 0.2, 1e-3
#: Kinds in the order of listing, and their patterns.
KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}

RUN = re.compile(r"[A-Za-z0-9+/_=.-]{8,}")
ANNOUNCED_HERE = r"(?i)(?:pass|pwd|secret|token|key|auth|credential|bearer)[\w-]*[\"']?\s?[:=]"
ANNOUNCED = re.compile(ANNOUNCED_HERE, re.A)
DIGIT = re.compile(r"[0-9]")
KEY_LIKE = r"[A-Za-z0-9+/_=.-]*[0-9][A-Za-z0-9+/_=.-]{11,}"
TOKEN = re.compile(r"[\w+/.-]+={0,2}(?![\w+/.-])|[\w+/.-]+|\S")
BEFORE, AFTER = 48, 24
#: Words that announce a secret.
CUES = ("password", "passwd", "pwd", "secret", "token", "key", "apikey", "api", "auth", "bearer", "credential", "private", "access", "login")
_CUES = re.compile("|".join(CUES))
#: Ordinary words of Latin letters.
PLAIN = re.compile("[A-Z\u00c0-\u00d6\u00d8-\u00de]?[a-z\u00df-\u00f6\u00f8-\u00ff]{1,16}[.]?")
TAGS = ("O", "B", "I")
#: How prose announces a secret.
ANNOUNCEMENTS = (
    "the password is {} and", "use {} as the token", "log in with the key {} today", "my secret {} still works", "the api key was {}, I think", "sign requests with {} from now on",
    "send the header Authorization: Bearer {}", "export it as {} first", "das Passwort lautet {} und", "la clave es {} por ahora", "le mot de passe est {} pour tous",
)
_CUE_WORD = re.compile(r"(?ai)\b(?:password|passwd|pwd|secret|token|api key|apikey|credential|bearer|login)s?\b")

STRETCH = "array<struct<at:int,text:string,values:array<struct<start:int,end:int>>>>"
FOUND = f"doc_id long, base array<struct<kind:string,start:int,end:int>>, file array<string>, stretches {STRETCH}"


def base_spans(text: str) -> list[tuple[str, int, int, int, int]]:
    """(kind, start, end, start of the value, end of the value), by kind and start."""
    found = []
    if "=" in text or ":" in text:
        found += [("assign", *m.span(), *m.span(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [("access", *m.span(), *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    for run in RUN.finditer(text):
        if run.end() - run.start() >= LEAST["hex"]:
            for m in HEX.finditer(text, *run.span()):
                if m.end() - m.start() >= LEAST["hex"]:
                    found.append(("hex", *m.span(), *m.span()))
    return found


def stretches(text: str, values: Sequence[tuple[int, int]]) -> list[tuple[int, str, list[tuple[int, int]]]]:
    """(start, text, values inside, relative), widened to whole words, overlapping ones joined."""
    seeds = [m.span() for m in RUN.finditer(text) if m.end() - m.start() >= 20 or DIGIT.search(text, *m.span())]
    if "=" in text or ":" in text:
        seeds += [m.span() for m in ANNOUNCED.finditer(text)]
    seeds += [m.span() for m in _CUE_WORD.finditer(text)]
    joined: list[list[int]] = []
    for start, end in sorted([*seeds, *values]):
        start, end = max(0, start - BEFORE), min(len(text), end + AFTER)
        while start > 0 and not text[start - 1].isspace():
            start -= 1
        while end < len(text) and not text[end].isspace():
            end += 1
        if joined and start <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], end)
        else:
            joined.append([start, end])
    out, ordered, at = [], sorted(values), 0
    for start, end in joined:
        while at < len(ordered) and ordered[at][0] < start:
            at += 1
        inside = at
        while inside < len(ordered) and ordered[inside][0] < end:
            inside += 1
        out.append((start, text[start:end], [(a - start, b - start) for a, b in ordered[at:inside]]))
    return out


def file_features(text: str) -> list[str]:
    """Features of a text that all its tokens share."""
    marks = text.count("=") + text.count(":")
    return [
        f"file:marks={min(4, int(math.log2(1 + marks)))}",
        f"file:braces={'{' in text or ';' in text}",
        f"file:length={min(5, len(text) // 2000)}",
    ]


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
            base = base_spans(text)
            found = stretches(text, [(a, b) for *_, a, b in base])
            rows.append((
                doc_id, [{"kind": k, "start": a, "end": b} for k, a, b, _, _ in base],
                file_features(text) if found else [],
                [{"at": at, "text": t, "values": [{"start": a, "end": b} for a, b in inside]} for at, t, inside in found],
            ))
        out = pd.DataFrame(rows, columns=["doc_id", "base", "file", "stretches"])
        out["doc_id"] = out["doc_id"].astype("Int64")
        yield out


def scanned(docs: DataFrame) -> DataFrame:
    """Base spans and stretches of each row, stored."""
    require(docs, "doc_id", "text")
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return stage(rows.mapInPandas(_scan, FOUND), work_path(docs.sparkSession, "secret-stretches"))


def _shape(token: str) -> list[str]:
    n, kinds = len(token), Counter("d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "o" for c in token)
    turns = sum(a.isdigit() != b.isdigit() for a, b in zip(token, token[1:]))
    counts = Counter(token)
    bits = -sum(k / n * math.log2(k / n) for k in counts.values())
    row = ["kinds=" + "".join(sorted(kinds))]
    # one feature for each bound that is passed, so that lengths between those of the sample are judged, too
    row += [f"length>{b}" for b in (4, 8, 12, 16, 20, 24, 32, 48) if n > b]
    row += [f"bits>{b}" for b in (2, 3, 3.5, 4, 4.5, 5) if bits > b]
    row += [f"turns>{b}" for b in (1, 3, 5, 8) if turns > b]
    row += [f"digits={int(4 * kinds['d'] / n)}"] if kinds["d"] else []
    row += ["hex"] if n > 5 and all(c in "0123456789abcdef" for c in token) else []
    row += [f"{name}={min(token.count(c), 4)}" for name, c in (("dots", "."), ("dashes", "-"), ("slashes", "/")) if c in token]
    head = token[:4] if token[:4].isupper() and token[:4].isalpha() else token[0] if not token[0].isalnum() else ""
    return row + ([f"first={head}"] if head else [])


def features(tokens: Sequence[str], file: Sequence[str]) -> list[list[str]]:
    """Shape, neighbours and file features of each token; what holds for plain words has no feature."""
    shapes = [_shape(t) for t in tokens]
    lower = [t.lower() for t in tokens]
    cue = [any(c in w for c in CUES) and len(w) < 20 for w in lower]
    odd = [len(t) == 1 and not t.isalnum() for t in tokens]
    rows = []
    for i, shape in enumerate(shapes):
        row = ["bias", *shape]
        near = any(cue[max(0, i - 5) : i])
        mark = [t for t in tokens[max(0, i - 3) : i] if t in "=:"]
        row += ["cue"] * near + [f"mark={m}" for m in mark[-1:]] + ["cue+mark"] * bool(near and mark)
        row += [f"before={tokens[i - 1]}"] if i and odd[i - 1] else []
        row += [f"after={tokens[i + 1]}"] if i + 1 < len(tokens) and odd[i + 1] else []
        if len(tokens[i]) >= 8 and len(shape[0]) > len("kinds=l"):
            row += [f"cue+{x}" for x in shape[:1] if near] + [f"{shape[0]}&{f}" for f in file]
        rows.append(row)
    return rows


@dataclass
class Field:
    """Weights of (feature, tag), of tag pairs, and of first tags."""

    index: dict[str, int]
    weights: np.ndarray
    pairs: np.ndarray
    first: np.ndarray

    def emissions(self, tokens: Sequence[str], file: Sequence[str]) -> np.ndarray:
        get = self.index.get
        ids = [[k for k in map(get, row) if k is not None] for row in features(tokens, file)]
        return np.array([self.weights[row].sum(axis=0) for row in ids])

    def decode(self, batch: list[np.ndarray]) -> list[np.ndarray]:
        """Best tags of each sequence (Viterbi), all sequences of the batch at once, longest first."""
        order = sorted(range(len(batch)), key=lambda i: -len(batch[i]))
        longest = len(batch[order[0]]) if batch else 0
        score = np.array([batch[i][0] for i in order]).reshape(-1, 3) + self.first
        back = []
        for t in range(1, longest):
            alive = sum(1 for i in order if len(batch[i]) > t) if t == 1 else alive_at(batch, order, t, alive)
            paths = score[:alive, :, None] + self.pairs[None]
            back.append(paths.argmax(axis=1))
            score[:alive] = paths.max(axis=1) + np.array([batch[i][t] for i in order[:alive]])
        tags: list[np.ndarray] = [np.zeros(0, int)] * len(batch)
        for k, i in enumerate(order):
            path = [int(score[k].argmax())]
            for t in range(len(batch[i]) - 2, -1, -1):
                path.append(int(back[t][k, path[-1]]))
            tags[i] = np.array(path[::-1])
        return tags


def alive_at(batch: list[np.ndarray], order: list[int], t: int, alive: int) -> int:
    """How many of the sequences, longest first, are longer than t."""
    while alive and len(batch[order[alive - 1]]) <= t:
        alive -= 1
    return alive


def _cue(token: str) -> bool:
    return len(token) < 20 and _CUES.search(token.lower()) is not None


class Bounds:
    """Which tokens a field may tag at all, and how far around them it must be decoded.

    With d(x) the most that tag B or I of token x can gain over O, in any surroundings, a run of tags over x1 … xn gains ``enter + sum d(xi) +
    (n - 1) step`` at most over O, where ``enter`` and ``step`` come from the tag pairs. It is negative if every d is below both. A run that
    bridges k such tokens between two others gains less than ending and beginning anew once k MARGIN exceeds ``bridge``.
    """

    def __init__(self, field: Field) -> None:
        self.field = field
        pairs, first = field.pairs, field.first
        out = pairs[0, 0]
        enter = max(pairs[0, 1:].max(), first[1:].max() - first[0] + out)
        step = pairs[1:, 1:].max() - out
        self.limit = -(max(enter + max(pairs[1:, 0].max(), out) - 2 * out, step) + MARGIN)
        bridge = pairs[1:, 1:].max() + out - pairs[1:, 0].min() - pairs[0, 1:].min()
        self.reach = max(int(bridge / MARGIN) + 1, 1)
        gain = {f: field.weights[i, 1:] - field.weights[i, 0] for f, i in field.index.items()}
        none = np.zeros(2)
        self._gain = gain

        def best(*prefixes: str) -> np.ndarray:
            """The most that one feature of each prefix adds."""
            return sum((np.max([none, *[g for f, g in gain.items() if f.startswith(p)]], axis=0) for p in prefixes), none)

        self._around = best("mark=", "before=", "after=")
        self._cued = best("cue+mark") + np.maximum(gain.get("cue", none), 0)
        self._files = {kinds: best(*[f"{kinds}&file:{name}=" for name in ("marks", "braces", "length")]) for kinds in {f.split("&")[0] for f in gain if "&" in f}}
        self._tokens: dict[str, tuple[bool, bool]] = {}
        # ordinary words by capital, full stop and length: cold if every shape that such a word can have is
        self._plain = {(upper, dot, n) for upper in (False, True) for dot in (False, True) for n in range(1, 19) if self._cold(upper, dot, n)}
        self._marks = frozenset(m for m in ",;:!?" if not any(self.token(m)))

    def _cold(self, upper: bool, dot: bool, n: int) -> bool:
        none, kinds = np.zeros(2), "kinds=" + "l" + "o" * dot + "u" * upper
        kinds = "kinds=" + "".join(sorted(kinds.removeprefix("kinds=")))
        fixed = ["bias", kinds, *[f"length>{k}" for k in (4, 8, 12, 16) if n > k], *(["dots=1"] if dot else [])]
        ends = sum((self._gain.get(f, none) for f in fixed), self._around)
        if n >= 8 and len(kinds) > len("kinds=l"):
            ends = ends + self._files.get(kinds, none) + np.maximum(self._gain.get(f"cue+{kinds}", none), 0)
        ends = ends + self._cued
        steps = [k for k in (2, 3, 3.5, 4) if k < math.log2(max(n, 2)) + 1e-9]
        spread = [sum((self._gain.get(f"bits>{k}", none) for k in steps[:i]), none) for i in range(len(steps) + 1)]
        hexes = [none, self._gain.get("hex", none)] if not upper and not dot and n > 5 else [none]
        return all((ends + s + h).max() < self.limit for s in spread for h in hexes)

    def plain(self, token: str) -> bool:
        """Whether it is an ordinary word that is never tagged."""
        return (token[0].isupper(), token[-1] == ".", len(token)) in self._plain and PLAIN.fullmatch(token) is not None

    def token(self, token: str) -> tuple[bool, bool]:
        """Whether it may be tagged without a cue before it, and with one."""
        if self.plain(token):
            return False, False
        known = self._tokens.get(token)
        if known is None:
            if len(self._tokens) > KEPT_WORDS:
                self._tokens.clear()
            none, shape = np.zeros(2), _shape(token)
            plain = sum((self._gain.get(f, none) for f in ("bias", *shape)), none) + self._around
            cued = self._cued.copy()
            if len(token) >= 8 and len(shape[0]) > len("kinds=l"):
                plain = plain + self._files.get(shape[0], none)
                cued += np.maximum(self._gain.get(f"cue+{shape[0]}", none), 0)
            known = self._tokens[token] = (bool(plain.max() >= self.limit), bool((plain + cued).max() >= self.limit))
        return known

    def word(self, word: str) -> int:
        """1: has a token that may be tagged anywhere; 2: has a cue."""
        if self.plain(word) or len(word) > 1 and word[-1] in self._marks and self.plain(word[:-1]):
            return 2 * _cue(word)
        tokens = TOKEN.findall(word)
        return (1 if any(self.token(t)[0] for t in tokens) else 0) | (2 if any(map(_cue, tokens)) else 0)

    def windows(self, tokens: list[str]) -> list[tuple[int, int]]:
        """Ranges of tokens outside which all are O."""
        out: list[tuple[int, int]] = []
        last_cue = -6
        for i, t in enumerate(tokens):
            plain, cued = self.token(t)
            if plain or cued and i - last_cue <= 5:
                low, high = max(0, i - self.reach - 6), i + self.reach + 7
                if out and low <= out[-1][1]:
                    out[-1] = (out[-1][0], high)
                else:
                    out.append((low, high))
            if _cue(t):
                last_cue = i
        return out


def _tags(tokens: list[re.Match], values: list[tuple[int, int]]) -> list[int]:
    """B for the first token that meets a value, I for its further ones; O else."""
    tags, ends = [0] * len(tokens), -1
    for i, m in enumerate(tokens):
        for a, b in values:
            if m.start() < b and a < m.end():
                tags[i] = 2 if ends == a and i and tags[i - 1] else 1
                ends = a
                break
    return tags


def train(sample: list[tuple[str, list[tuple[int, int]], list[str]]]) -> Field:
    """Maximum likelihood with a ridge, by Adam; gradients from forward and backward sums over padded sequences."""
    rows, tags = [], []
    for text, values, file in sample:
        tokens = list(TOKEN.finditer(text))
        if tokens:
            rows.append(features([m[0] for m in tokens], file))
            tags.append(_tags(tokens, values))
    counts = Counter(f for seq in rows for row in seq for f in row)
    index = {f: i for i, f in enumerate(sorted(counts))}
    n, longest = len(rows), max(map(len, rows))
    width = max(len(row) for seq in rows for row in seq)
    ids = np.full((n, longest, width), len(index), np.int32)
    gold = np.zeros((n, longest), int)
    mask = np.zeros((n, longest), bool)
    for s, seq in enumerate(rows):
        mask[s, : len(seq)] = True
        gold[s, : len(seq)] = tags[s]
        for t, row in enumerate(seq):
            ids[s, t, : len(row)] = [index[f] for f in row]
    one = np.eye(3)[gold] * mask[..., None]
    gold_pairs = np.einsum("sti,stj->ij", one[:, :-1], one[:, 1:])
    params = [np.zeros((len(index) + 1, 3)), np.zeros((3, 3)), np.zeros(3)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for step in range(1, STEPS + 1):
        weights, pairs, first = params
        emit = weights[ids].sum(axis=2)
        forward = np.zeros((n, longest, 3))
        forward[:, 0] = emit[:, 0] + first
        for t in range(1, longest):
            new = _log_sum(forward[:, t - 1, :, None] + pairs, 1) + emit[:, t]
            forward[:, t] = np.where(mask[:, t, None], new, forward[:, t - 1])
        total = _log_sum(forward[:, -1], 1)
        backward = np.zeros((n, longest, 3))
        pair_sum = np.zeros((3, 3))
        for t in range(longest - 2, -1, -1):
            onward = emit[:, t + 1] + backward[:, t + 1]
            live = mask[:, t + 1, None]
            backward[:, t] = np.where(live, _log_sum(pairs + onward[:, None, :], 2), 0.0)
            both = np.exp(forward[:, t, :, None] + pairs + onward[:, None, :] - total[:, None, None])
            pair_sum += (both * live[..., None]).sum(axis=0)
        node = np.exp(forward + backward - total[:, None, None]) * mask[..., None]
        gap = one - node
        grad = np.zeros_like(weights)
        for tag in range(3):
            grad[:, tag] = np.bincount(ids.ravel(), np.repeat(gap[..., tag].ravel(), width), len(index) + 1)
        grad[-1] = 0
        grads = [grad / n - RIDGE * weights, (gold_pairs - pair_sum) / n - RIDGE * pairs, gap[:, 0].sum(axis=0) / n - RIDGE * first]
        for k, (p, g) in enumerate(zip(params, grads)):
            a, b = moments[k]
            a[...] = 0.9 * a + 0.1 * g
            b[...] = 0.99 * b + 0.01 * g * g
            p += RATE * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return Field(index, params[0], params[1], params[2])


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def fit(found: DataFrame) -> Field | None:
    """Learn from a bounded sample of the stretches; None without base spans."""
    every = found.select("file", F.explode("stretches").alias("s")).select("file", "s.text", "s.values")
    every = every.where(F.length("text") <= MAX_TOKENS * 8).withColumn("h", F.xxhash64("text")).withColumn("secret", F.size("values") > 0)
    # announced like a secret, but of no listed kind, or with something key-like: neither an example nor a counter-example
    every = every.where(F.col("secret") | ~(F.col("text").rlike(ANNOUNCED_HERE) | F.col("text").rlike(KEY_LIKE)))
    once = every.groupBy("h", "secret").agg(F.min(F.struct("text", "values", "file")).alias("s"))
    once = stage(once.select("h", "secret", "s.*"), work_path(found.sparkSession, "secret-sample"))
    sample = []
    for secret in (True, False):
        some = once.where(F.col("secret") == secret).orderBy("h", "text").limit(MAX_STRETCHES).collect()
        if secret and not some:
            return None
        sample += [(r["text"], [(v["start"], v["end"]) for v in r["values"]], r["file"]) for r in some]
    sample += [prose for k, x in enumerate(sample) for prose in _in_prose(k, *x)]
    return train([x for x in sample if sum(1 for _ in TOKEN.finditer(x[0])) <= MAX_TOKENS])


def _in_prose(k: int, text: str, values: list[tuple[int, int]], file: list[str]) -> Iterator[tuple[str, list[tuple[int, int]], list[str]]]:
    """The first value of a stretch after an announcement in prose, in a file of prose."""
    for a, b in values[:1]:
        before, after = ANNOUNCEMENTS[k % len(ANNOUNCEMENTS)].split("{}")
        yield before + text[a:b] + after, [(len(before), len(before) + b - a)], file_features("plain text")


def whole_text(bounds: Bounds, kinds: dict[str, int], text: str) -> list[list[re.Match]]:
    """The stretches of tokens to decode, so that all other tokens are known to be O; ``kinds`` are those of words seen before."""
    words = text.split()
    found = list(map(kinds.get, words))
    if None in found:
        if len(kinds) > KEPT_WORDS:
            kinds.clear()
        new = {w for w, k in zip(words, found) if k is None} if kinds else set(words)
        kinds.update((w, bounds.word(w)) for w in new)
        found = [kinds[w] for w in words]
        for w in new:
            if len(w) > 64:
                del kinds[w]
    if not any(found):
        return []
    tokens = list(TOKEN.finditer(text))
    return [tokens[a:b] for a, b in bounds.windows([m[0] for m in tokens])]


def decoded(field: Field, texts: Sequence[str]) -> list[list[tuple[int, int]]]:
    """Spans that the field tags in each whole text."""
    bounds, kinds = Bounds(field), {}
    return [_spans(field, bounds, kinds, text) for text in texts]


def _spans(field: Field, bounds: Bounds, kinds: dict[str, int], text: str) -> list[tuple[int, int]]:
    parts = whole_text(bounds, kinds, text)
    if not parts:
        return []
    file = file_features(text)
    out: list[tuple[int, int]] = []
    for tokens, tags in zip(parts, field.decode([field.emissions([m[0] for m in part], file) for part in parts])):
        inside = False
        for m, tag in zip(tokens, tags):
            if tag == 2 and inside:
                out[-1] = (out[-1][0], m.end())
            elif tag:
                out.append(m.span())
            inside = tag > 0
    return out


def _found(field: Field | None):
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bounds, kinds = Bounds(field) if field else None, {}
        for pdf in batches:
            spans = []
            for text in pdf["text"]:
                taken = [(kind, a, b) for kind, a, b, *_ in base_spans(text)]
                own = [x for x in _spans(field, bounds, kinds, text) if not any(x[0] < e and s < x[1] for _, s, e in taken)] if field else []
                spans.append([{"kind": k, "start": s, "end": e} for k, s, e in sorted(
                    [*taken, *(("crf", a, b) for a, b in own)], key=lambda x: (x[1], KINDS.index(x[0])))])
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "spans": spans})
    return of


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): all spans of each row, by start."""
    field = fit(scanned(docs))
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.mapInPandas(_found(field), "doc_id long, spans array<struct<kind:string,start:int,end:int>>")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: counts by kind, digest of the base spans, all spans."""
    spans = find(docs)

    def listed(only_base: bool):
        chosen = F.filter("spans", lambda s: s["kind"] != "crf") if only_base else F.col("spans")
        return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    return spans.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(listed(True), 256).alias("base_sha256"), listed(False).alias("spans"), count("crf").alias("n_crf"),
    )
