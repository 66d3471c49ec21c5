"""Toxic passages as maximum-scoring segments.

Lexicon: log-odds of a word between toxic and other labelled texts, shrunk by a Dirichlet prior that is proportional to the pooled
counts, kept where they are ``MIN_Z`` standard errors above zero. Other words score slightly below zero: the log-odds
of meeting no lexicon word. A linear scan (Ruzzo and Tompa) finds all maximal segments of a text's scores; between
lexicon words the score only falls, so that the scan goes over lexicon words and gaps.

Extreme values: under the word frequencies of the other texts, the best segment of n words exceeds S with probability
1 - exp(-K n e^(-lambda S)). lambda solves sum p e^(lambda s) = 1, K follows from the segments found in the other texts. A passage
is significant if K n e^(-lambda S) <= ``SIGNIFICANT``. A text's score is the logistic of lambda S - ln(K n) of its best
segment, fitted on the labelled texts.

Only labels of rows with crc32(id) mod 5 <> 0 are learnt from: at most ``MAX_LABELLED`` rows, those with the smallest hashes;
equal texts count once. The lexicon, the words of those rows at most, and the bins of the calibration, one a row at most, are bounded by that. Everything else covers all rows and whole texts. Neither label nor language, source or id
are inputs of a score.

Nulls: a null text is empty; an empty text has the score of a text without lexicon words; labels with a null id or mark are not
used; a null id counts as held out. Without labels of both kinds every score is the share of toxic labels (0 without
any). Repeated rows are scored one by one; empty tables give empty results; other columns are handed on, those named
like an output are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.llm.text import packed, require, unpacked
from colloquy.session import ship, stage, work_path

MAX_LABELLED = 20_000
PRIOR, MIN_Z = 0.1, 3.0
SIGNIFICANT = 0.05
SEED = 20_257
#: Calibration: bins of one unit of the normalised segment score.
X_BINS = 4
WORD = re.compile(r"[^\W\d_]+")

PASSAGES = "array<struct<start:int,end:int,score:double,e_value:double>>"


@dataclass
class Model:
    lexicon: dict[str, float] = field(default_factory=dict)
    gap: float = 0.0
    rate: float = 1.0
    k: float = 1.0
    intercept: float = -30.0
    slope: float = 0.0

    def normalised(self, best: float, n: int) -> float:
        return self.rate * best - math.log(self.k * max(n, 1))

    def probability(self, x: float) -> float:
        z = self.intercept + self.slope * x
        return 1 / (1 + math.exp(-z)) if z >= 0 else math.exp(z) / (1 + math.exp(z))  # neither overflows


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def segments(hits: list[tuple[int, float]], gap: float) -> list[tuple[int, int, float]]:
    """All maximal segments (first, last, score) of a sequence that scores -gap but at the hits (place, score).

    Candidates hold the sum before and after them; a new one joins the nearest earlier one that starts lower and
    ends no higher, along with all between.
    """
    done: list[tuple[int, int, float, float]] = []
    total, seen = 0.0, -1
    for at, score in hits:
        total -= gap * (at - seen - 1)
        first, before = at, total
        total += score
        seen = at
        while True:
            j = len(done) - 1
            while j >= 0 and done[j][2] >= before:
                j -= 1
            if j < 0 or done[j][3] >= total:
                break
            first, before = done[j][0], done[j][2]
            del done[j:]
        done.append((first, at, before, total))
    return [(a, b, after - before) for a, b, before, after in done]


def _tokens(text: str) -> list[str]:
    return WORD.findall(text.lower())


def _hits(tokens: list[str], model: Model) -> list[tuple[int, float]]:
    lexicon = model.lexicon
    return [(i, lexicon[w]) for i, w in enumerate(tokens) if w in lexicon]


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts with a word, by word and mark."""
    for pdf in batches:
        toxic, other = Counter(), Counter()
        for text, mark in zip(pdf["text"], pdf["toxic"]):
            (toxic if mark else other).update(set(_tokens(text)))
        listed = list(toxic.keys() | other.keys())
        yield pd.DataFrame({"word": listed, "t": [toxic[w] for w in listed], "o": [other[w] for w in listed]})


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of the labelled texts learnt from; at most ``MAX_LABELLED`` ids are broadcast."""
    spark = docs.sparkSession
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marks = marks.orderBy(F.xxhash64(F.lit(SEED), F.col("doc_id")), "doc_id").limit(MAX_LABELLED)
    marks = stage(marks.select(F.col("doc_id").alias("l_id"), "toxic"), work_path(spark, "toxic-labels"))
    found = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).join(F.broadcast(marks), F.col("doc_id") == F.col("l_id"))
    once = found.select("doc_id", "toxic", F.xxhash64("text").alias("h")).groupBy("h").agg(F.min("doc_id").alias("l_id"), F.max("toxic").alias("toxic"))
    once = stage(once.select("l_id", "toxic", "h"), work_path(spark, "toxic-texts"))
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).join(F.broadcast(once), F.col("doc_id") == F.col("l_id"))
    return texts.where(F.xxhash64("text") == F.col("h")).dropDuplicates(["h"]).select("text", "toxic")


def _lexicon(texts: DataFrame) -> tuple[list, int, int]:
    counts = texts.mapInPandas(_count, "word string, t long, o long").groupBy("word").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))
    counts = stage(counts, work_path(texts.sparkSession, "toxic-words"))
    total = counts.agg(F.sum("t").alias("t"), F.sum("o").alias("o")).first()
    n_t, n_o = total["t"] or 0, total["o"] or 0
    a, whole = F.lit(PRIOR) * (F.col("t") + F.col("o")), PRIOR * (n_t + n_o)
    y_t, y_o = F.col("t") + a, F.col("o") + a
    odds = F.log(y_t / (n_t + whole - y_t)) - F.log(y_o / (n_o + whole - y_o))
    z = odds / F.sqrt(1 / y_t + 1 / y_o)
    kept = counts.select("word", "t", "o", odds.alias("s"), z.alias("z")).where(F.col("z") >= MIN_Z)
    return kept.orderBy("word").collect(), n_t, n_o


def _rate(scores: list[tuple[float, float]], gap: float) -> float:
    """lambda > 0 of sum p e^(lambda s) = 1, by bisection; ``scores``: (s, p) of the lexicon."""
    rest = 1 - sum(p for _, p in scores)

    def excess(rate: float) -> float:
        return sum(p * math.exp(rate * s) for s, p in scores) + rest * math.exp(-rate * gap) - 1

    low, high = 1e-6, 1.0
    while excess(high) < 0 and high < 64:
        low, high = high, 2 * high
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return (low + high) / 2


def _best(model: Model):
    """(n, best segment, lexicon words) of each text."""
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for text, toxic in zip(pdf["text"], pdf["toxic"]):
                tokens = _tokens(text)
                hits = _hits(tokens, model)
                best = max((s for _, _, s in segments(hits, model.gap)), default=0.0)
                rows.append((toxic, len(tokens), best, len(hits)))
            yield pd.DataFrame(rows, columns=["toxic", "n", "best", "hits"])
    return of


def _logistic(bins: list[tuple[float, float, float]]) -> tuple[float, float]:
    """Intercept and slope from (x, rows, toxic rows), by Newton steps with a weak ridge; the slope is not negative."""
    a, b = 0.0, 0.0
    for _ in range(50):
        g0 = g1 = h00 = h01 = h11 = 0.0
        for x, n, t in bins:
            p = 1 / (1 + math.exp(-max(min(a + b * x, 30.0), -30.0)))
            w = n * p * (1 - p) + 1e-9
            g0, g1 = g0 + t - n * p, g1 + (t - n * p) * x
            h00, h01, h11 = h00 + w, h01 + w * x, h11 + w * x * x
        g0, g1, h00, h11 = g0 - 0.01 * a, g1 - 0.01 * b, h00 + 0.01, h11 + 0.01
        det = h00 * h11 - h01 * h01
        step_a, step_b = (h11 * g0 - h01 * g1) / det, (h00 * g1 - h01 * g0) / det
        scale = min(1.0, 5 / max(abs(step_a), abs(step_b), 1e-12))
        a, b = a + scale * step_a, b + scale * step_b
        if abs(step_a) + abs(step_b) < 1e-9:
            break
    return (a, b) if b >= 0 else (0.0, 0.0)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn lexicon, extreme-value constants and calibration."""
    require(docs, "doc_id", "text")
    require(labels, "doc_id", "toxic")
    spark = docs.sparkSession
    ship(spark)
    texts = stage(_labelled(docs, labels), work_path(spark, "toxic-sample"))
    words, n_t, n_o = _lexicon(texts)
    model = Model()
    if words:
        model.lexicon = {r["word"]: r["s"] for r in words}
        met = min(0.5, sum(r["t"] for r in words) / max(n_t, 1))
        model.gap = -math.log(1 - met)
        model.rate = _rate([(r["s"], (r["o"] + 0.5) / (n_o + 1)) for r in words], model.gap)
    found = stage(
        texts.mapInPandas(_best(model), "toxic int, n long, best double, hits long"), work_path(spark, "toxic-fit"),
    )
    if words:
        least = min(model.lexicon.values())
        other = found.where("toxic = 0").agg(F.sum("n").alias("n"), F.count_if(F.col("best") >= least).alias("found")).first()
        model.k = min(1.0, ((other["found"] or 0) + 1) / max(other["n"] or 1, 1) * math.exp(model.rate * least))
    # bins of the normalised score, of which there are some hundred
    x = F.lit(model.rate) * F.col("best") - F.log(F.lit(model.k) * F.greatest(F.col("n"), F.lit(1)))
    binned = F.round(x * X_BINS) / X_BINS
    bins = found.groupBy(binned.alias("x")).agg(F.count(F.lit(1)).alias("rows"), F.sum("toxic").alias("toxic")).collect()
    bins = sorted((r["x"], float(r["rows"]), float(r["toxic"])) for r in bins)
    rows, toxic = sum(n for _, n, _ in bins), sum(t for _, _, t in bins)
    if words and 0 < toxic < rows:
        model.intercept, model.slope = _logistic(bins)
    if not model.slope:
        share = (toxic + 1e-9) / (rows + 2e-9) if rows else 0.0
        model.intercept = max(min(math.log((share + 1e-12) / (1 - share + 1e-12)), 30.0), -30.0)
    return model


def _places(text: str) -> Sequence[int]:
    """For each character of the lower-case text, the place of the character it comes from; one may become two."""
    if len(text.lower()) == len(text):
        return range(len(text))
    return [i for i, c in enumerate(text) for _ in c.lower()]


def passages(text: str, model: Model) -> tuple[float, list[tuple[int, int, float, float]]]:
    """Probability, and the significant passages with their code points."""
    tokens = _tokens(text)
    found = segments(_hits(tokens, model), model.gap)
    x = model.normalised(max((s for _, _, s in found), default=0.0), len(tokens))
    kept = []
    if found:
        spans = [m.span() for m in WORD.finditer(text.lower())]
        place = _places(text)
        for first, last, score in found:
            e_value = model.k * len(tokens) * math.exp(-model.rate * score)
            if e_value <= SIGNIFICANT:
                kept.append((place[spans[first][0]], place[spans[last][1] - 1] + 1, score, e_value))
    return model.probability(x), kept


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All rows and columns with ``score`` and ``passages`` (code points, score, e-value).

    The model, of at most the words of ``MAX_LABELLED`` rows, is broadcast.
    """
    require(docs, "text")
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(f"score double, passages {PASSAGES}")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [passages(text, shared.value) for text in texts]
            yield pd.DataFrame({
                "score": [p for p, _ in found],
                "passages": [[dict(zip(("start", "end", "score", "e_value"), x)) for x in spans] for _, spans in found],
            })

    rows = docs.select(packed(docs), of(F.coalesce(F.col("text"), F.lit(""))).alias("found"))
    return rows.select(*unpacked(rows, ("score", "passages")), F.col("found.score").alias("score"), F.col("found.passages").alias("passages"))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: held out or not, score, verdict, number of significant passages."""
    model = fit(docs, labels)
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("passages").alias("n_passages"),
    )
