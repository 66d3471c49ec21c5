"""Quality rules with risk-controlled thresholds.

Each rule rejects a document whose signal lies above a cutoff. The candidate cutoffs of a rule are fixed values, from
lenient to strict. In each stratum (language; those not listed share one stratum) the labelled documents of good quality
are the holdout. A cutoff is certified if the exact binomial test rejects "more than ``risk`` of the good documents
would be lost", that is P(Bin(n, risk) <= k) <= level for k lost of n, which is the same as a Clopper-Pearson upper bound
below ``risk``. All rules are certified together: in one fixed sequence each step has a cutoff of every rule, from the most
lenient of all to the strictest of all, and k are the good documents lost to any rule, of those that the base rule leaves. Steps are tested in order
and testing stops at the first that fails, which needs no correction; ``delta`` is divided by the number of strata. So, with
probability 1 - delta, no stratum loses more than ``risk`` of its good documents to the rules. The cutoffs of the last certified step are used; a
stratum with none, for lack of labels, say, rejects nothing by them. 228 good labels of a stratum, none of them lost, suffice for all steps.

Nulls: a null text has no words (and fails the base rule); a null language is in the stratum of the rest; labels with a
null id or quality are not used. A document with several labels is good if all of them say so. Repeated rows are
judged one by one. Empty tables give empty results. All columns are handed on; those named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.llm.text import let, packed, require, unpacked, words
from colloquy.session import stage, work_path

STRATA = ("en", "de", "fr", "es")
RISK, DELTA = 0.02, 0.05
MIN_WORDS, MAX_REPEATED = 10, 20
#: Cutoffs of each rule from lenient to strict. A document above the cutoff is rejected.
CUTOFFS: Mapping[str, tuple[float, ...]] = {
    "symbols_per_word": (2.0, 1.0, 0.5, 0.25, 0.1),
    "marks_per_word": (2.0, 1.0, 0.5, 0.3),
    "duplicate_lines": (0.9, 0.8, 0.7, 0.6, 0.5),
    "capitals_per_letter": (0.9, 0.7, 0.5, 0.35),
    "word_length": (20.0, 15.0, 12.0, 10.0),
    "word_shortness": (-1.5, -2.0, -2.5, -3.0),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
WINDOW = 5


def _repeated(found: Column) -> Column:
    """Words covered by windows that occur twice or more; ``found``: the hashes of all windows in order.

    Sorting (hash, start) puts equal windows side by side; their starts, sorted again, are merged.
    """
    def covered(pairs: Column) -> Column:
        def twice(pair: Column, i: Column) -> Column:
            before, after = F.get(pairs, i - 1)["h"], F.get(pairs, i + 1)["h"]
            return F.coalesce(pair["h"] == before, F.lit(False)) | F.coalesce(pair["h"] == after, F.lit(False))

        starts = F.sort_array(F.transform(F.filter(pairs, twice), lambda pair: pair["i"]))
        return F.aggregate(
            starts, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
            lambda done, at: F.struct(
                (done["n"] + at + WINDOW - F.greatest(at, done["end"])).alias("n"), (at + WINDOW).alias("end")
            ),
        )["n"]

    pairs = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(found)) < F.size(found), let(pairs, covered)).otherwise(0).cast("bigint")


def signals(docs: DataFrame) -> DataFrame:
    """The rows, packed, with their counts and one column for each rule; whole texts, no shuffle."""
    require(docs, "doc_id", "text", "lang")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(packed(docs), "doc_id", "lang", text.alias("t"), words(F.col("text")).alias("w"))

    def hashed(word: Column, i: Column) -> Column:
        return F.xxhash64(word, *[F.get(F.col("w"), i + k) for k in range(1, WINDOW)])

    whole_windows = F.slice("w", F.lit(1), F.greatest(F.size("w") - (WINDOW - 1), F.lit(0)))
    lines = F.filter(F.split("t", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select("row", "doc_id", "lang", "t", "w", F.transform(whole_windows, hashed).alias("h"), lines.alias("lines"))

    def dropped(chars: str) -> Column:
        return F.length("t") - F.length(F.regexp_replace("t", chars, ""))

    rows = rows.select(
        "row", "doc_id", "lang",
        F.size("w").cast("bigint").alias("n_words"),
        F.length(F.regexp_replace("t", r"[\x20\x09-\x0D]+", "")).cast("bigint").alias("word_chars"),
        dropped(r"[#*$%&|<>]+").cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        _repeated(F.col("h")).alias("n_repeat_words"),
        F.size("lines").alias("n_lines"),
        dropped(r"[!?]+").alias("n_marks"),
        dropped(r"\p{Lu}+").alias("n_capitals"),
    )
    n = F.greatest(F.col("n_words"), F.lit(1))
    return rows.select(
        "row", "doc_id", "lang", *COUNTS,
        (F.col("n_symbols") / n).alias("symbols_per_word"),
        (F.col("n_marks") / n).alias("marks_per_word"),
        (F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))).alias("duplicate_lines"),
        (F.col("n_capitals") / F.greatest(F.col("word_chars"), F.lit(1))).alias("capitals_per_letter"),
        (F.col("word_chars") / n).alias("word_length"),
        (-F.col("word_chars") / n).alias("word_shortness"),
        # a filter on the signals must stay above them: pushed below, it would compute whole arrays anew for each element
        F.monotonically_increasing_id().alias("barrier"),
    )


def log_gamma(x: Column) -> Column:
    """Stirling's series, ten steps up, where it is exact to double precision for x >= 1."""
    z = x + F.lit(10.0)
    series = 1 / (12 * z) - 1 / (360 * F.pow(z, F.lit(3))) + 1 / (1260 * F.pow(z, F.lit(5))) - 1 / (1680 * F.pow(z, F.lit(7)))
    steps = sum((F.ln(x + F.lit(float(i))) for i in range(1, 10)), F.ln(x))
    return (z - 0.5) * F.ln(z) - z + F.lit(0.9189385332046727) + series - steps


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k): terms from k downward until they no longer count; 1 where k is not below the mean."""
    x, m = k.cast("double"), n.cast("double")
    first = F.exp(log_gamma(m + 1) - log_gamma(x + 1) - log_gamma(m - x + 1) + x * F.log(F.lit(p)) + (m - x) * F.log(F.lit(1 - p)))
    most = F.least(k, (F.sqrt(m * p) * 12 + 60).cast("bigint"))
    odds = (1 - p) / p

    def add(done: Column, i: Column) -> Column:
        at = x - i + 1
        term = done["term"] * at * odds / (m - at + 1)
        return F.struct(term.alias("term"), (done["sum"] + term).alias("sum"))

    terms = F.when(most > 0, F.sequence(F.lit(1).cast("bigint"), most)).otherwise(F.array().cast("array<bigint>"))
    total = F.aggregate(terms, F.struct(first.alias("term"), first.alias("sum")), add)["sum"]
    return F.when((n <= 0) | (x >= m * p), F.lit(1.0)).otherwise(total)


def stratum_of(lang: Column, strata: Sequence[str]) -> Column:
    return F.when(lang.isin(*strata), lang).otherwise(F.lit("other"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def _good(measured: DataFrame, labels: DataFrame, strata: Sequence[str]) -> DataFrame:
    """Measured documents with a good label, and their stratum."""
    require(labels, "doc_id", "quality")
    good = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy(F.col("doc_id").alias("l_id"))
    good = good.agg(F.min("quality").alias("quality")).where("quality = 1")
    return measured.join(good, F.col("doc_id") == F.col("l_id")).withColumn("stratum", stratum_of(F.col("lang"), strata))


def certified(measured: DataFrame, labels: DataFrame, strata: Sequence[str], risk: float, delta: float) -> DataFrame:
    """One row per stratum with labels: a cutoff, or null, for each rule, of the last step before one fails. At most ``len(strata) + 1`` rows.

    ``measured``: (doc_id, lang, counts, signals).
    """
    steps = range(max(len(cuts) for cuts in CUTOFFS.values()))
    at = [{rule: cuts[min(i, len(cuts) - 1)] for rule, cuts in CUTOFFS.items()} for i in steps]
    held = _good(measured, labels, strata).where(~base_failed())
    lost = [F.count_if(F.greatest(*[F.col(rule) > F.lit(cut) for rule, cut in at[i].items()])).alias(f"k_{i}") for i in steps]
    counts = held.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *lost)
    passes = [binomial_tail(F.col(f"k_{i}"), F.col("n"), risk) <= F.lit(delta / (len(strata) + 1)) for i in steps]
    counts = counts.select("stratum", F.array(*passes).alias("passes"))
    last = F.array_position(F.concat("passes", F.array(F.lit(False))), F.lit(False)) - 1
    cuts = F.get(F.array(*[F.struct(*[F.lit(cut).alias(rule) for rule, cut in cuts.items()]) for cuts in at]), last.cast("int") - 1)
    chosen = counts.select(F.col("stratum").alias("s"), cuts.alias("cuts"))
    return chosen.select("s", *[F.col(f"cuts.{rule}").alias(f"cut_{rule}") for rule in CUTOFFS])


def verdicts(measured: DataFrame, cuts: DataFrame, strata: Sequence[str]) -> DataFrame:
    """Adds ``base_failed`` and ``kept``. ``cuts`` has a row per stratum, of which there are few, and so is broadcast."""
    joined = measured.join(F.broadcast(cuts), stratum_of(F.col("lang"), strata) == F.col("s"), "left")
    above = F.lit(False)
    for rule in CUTOFFS:
        above = above | F.coalesce(F.col(rule) > F.col(f"cut_{rule}"), F.lit(False))
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~base_failed() & ~above)


def _measured(docs: DataFrame) -> DataFrame:
    narrow = signals(docs.select("doc_id", "text", "lang")).drop("row", "barrier")
    return stage(narrow, work_path(docs.sparkSession, "quality-signals"))


def report(docs: DataFrame, labels: DataFrame, strata: Sequence[str] = STRATA, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row per document: counts, base verdict, verdict."""
    measured = _measured(docs)
    cuts = stage(certified(measured, labels, strata, risk, delta), work_path(docs.sparkSession, "quality-cutoffs"))
    return verdicts(measured, cuts, strata).select("doc_id", *COUNTS, "base_failed", "kept")


def passing(docs: DataFrame, labels: DataFrame, strata: Sequence[str] = STRATA, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """The rows that are kept, with the input's columns.

    The signals of labelled documents come first; then each row is measured and judged where it is read, so that no
    text is shuffled.
    """
    cuts = stage(certified(_measured(docs), labels, strata, risk, delta), work_path(docs.sparkSession, "quality-cutoffs"))
    rows = verdicts(signals(docs), cuts, strata).where("kept and barrier >= 0").select("row")
    return rows.select(*unpacked(rows))
