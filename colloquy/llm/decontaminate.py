"""Benchmark decontamination by template canonicalisation.

A text becomes a sequence of tokens (runs of letters and digits). Numbers, number words, names (capitalised words that do not
start a sentence) and units become typed placeholders, other words lower case. An item's windows of ``WINDOW`` canonical
tokens, those with at least ``LITERALS`` words left, are its template; an item shorter than a window is one window as a
whole. Windows are joined by hash: a document's windows are made where it is read and joined with the benchmark's distinct
ones; Spark broadcasts those if they are below its threshold and shuffles both sides otherwise.

Names are found by capitals, which a text in capitals or in lower case does not have. So a second set of windows ignores case:
all words lower case, names among them, and only numbers and units replaced. Windows of either kind match, and tokens are alike if either form is.
Up to 64 characters of white space count as one blank where names are looked for.

A text is tokenised once: names carry a mark before their lower-case form, from which both forms follow. Tokens are hashed once, and windows
of 8 are joined from those of 4, 2 and 1.

Each match votes for an alignment (document, item, shift). The alignments of a document and an item together must
cover ``COVERAGE`` of the item's tokens. They are then read again from the text: at an alignment the item's placeholders
stand opposite values of the document. One alignment, or all together, must cover enough and be consistent. Consistency: one value of the item must always meet the same value, and
different values different ones. ``CONSISTENT`` of the placeholders must agree with the most frequent mapping. So a
question with other numbers and names is found, while text that merely shares a pattern is not.

Nulls: null texts are empty and match nothing. A contaminated row with a null id is reported with a null id and
removed by :func:`clean` like any other (rows are decided by id; those without one by their text). Items with equal text count
once, under their smallest id; null items are ignored. Texts of any length are tokenised as a whole. Of rival mappings that are equally frequent the first in order counts. Only
``doc_id`` and ``text`` are read; :func:`clean` hands on all columns, packed, so that no name clashes. Empty tables give empty results. Repeated rows count once
in the report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.llm.text import packed, require, unpacked
from colloquy.session import stage, work_path

WINDOW, LITERALS = 8, 4
COVERAGE, CONSISTENT = 0.5, 0.8
#: Unit names and number words that become placeholders.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms pound pounds ounce ounces ton tons "
    "ml liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years "
    "meter meters metre metres kilometer kilometers kilometre kilometres mph kmh percent degree degrees celsius fahrenheit dollar "
    "dollars cent cents euro euros usd eur gbp watt watts kwh volt volts joule joules newton newtons"
).split()
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion half third quarter twice double triple"
).split()
#: Placeholders: characters for private use, which count as blanks in texts.
NUMBER, NAME, UNIT = "\ue000", "\ue001", "\ue002"
NUMERAL = r"\p{N}+(?:[.,]\p{N}+)*"
RAW = NUMERAL + r"|[\p{L}\p{M}]+"
#: A capitalised word after blanks that follow a letter, digit or comma: not the start of a sentence. The capital is looked for first.
NAME_IN_TEXT = "\\p{Lu}(?<=[\\p{L}\\p{M}\\p{N},;:][\\s\\p{Z}]{1,64}\\p{Lu})[\\p{L}\\p{M}]*+"


def _plain(text: Column) -> Column:
    """The text without placeholders of its own, which are blanked."""
    whole = F.coalesce(text, F.lit(""))
    own = F.contains(whole, F.lit(NUMBER)) | F.contains(whole, F.lit(NAME)) | F.contains(whole, F.lit(UNIT))
    return F.when(own, F.regexp_replace(whole, f"[{NUMBER}{NAME}{UNIT}]", " ")).otherwise(whole)


def raw_tokens(text: Column) -> Column:
    return F.regexp_extract_all(_plain(text), F.lit(RAW), F.lit(0))


def marked_tokens(text: Column) -> Column:
    """The raw tokens in lower case, names after the mark ``NAME``."""
    return F.regexp_extract_all(F.lower(F.regexp_replace(_plain(text), NAME_IN_TEXT, f"{NAME}$0")), F.lit(f"{NAME}?[\\p{{L}}\\p{{M}}]+|{NUMERAL}"), F.lit(0))


def _typed(word: Column) -> Column:
    """Placeholder of a number or unit; numerals beyond ASCII are looked at closely where a word begins beyond ASCII."""
    numeral = (word >= "0") & (word < ":") | (word > "\x7f") & word.rlike(r"^\p{N}")
    return F.when(numeral | word.isin(*NUMBER_WORDS), F.lit(NUMBER)).when(word.isin(*UNITS), F.lit(UNIT)).otherwise(word)


def _named(token: Column) -> Column:
    return F.startswith(token, F.lit(NAME))


def canonical(token: Column) -> Column:
    """Form of a marked token with names as placeholders."""
    return F.when(_named(token), F.lit(NAME)).otherwise(_typed(token))


def caseless(token: Column) -> Column:
    """Form of a marked token with names as words."""
    return F.when(_named(token), _typed(F.substring(token, 2, 1 << 30))).otherwise(_typed(token))


def _windows(rows: DataFrame, hashes: str, length: int, name: str) -> DataFrame:
    """Adds the hashes of all windows of an array of token hashes, in order: joined from halves, a step a column, so that each is computed once."""
    blocks, bit = {1: hashes}, 1
    later = lambda column, k: F.slice(column, F.lit(k + 1), F.size(column))
    joined = lambda a, b: F.xxhash64(a, b)
    while 2 * bit <= length:
        rows = rows.withColumn(f"{name}_{2 * bit}", F.zip_with(blocks[bit], later(blocks[bit], bit), joined))
        bit *= 2
        blocks[bit] = f"{name}_{bit}"
    whole, done = F.col(blocks[bit]), bit
    for part in (4, 2, 1):
        if part < bit and length & part:
            whole, done = F.zip_with(whole, later(blocks[part], done), joined), done + part
    return rows.withColumn(name, F.slice(whole, F.lit(1), F.greatest(F.size(hashes) - (length - 1), F.lit(0))))


def windowed(tokenised: DataFrame, lengths: list[int]) -> DataFrame:
    """The other columns of a table with ``marked`` and, for each window, ``length``, ``at`` and its hashes ``x`` (canonical) and ``y`` (caseless)."""
    others = [c for c in tokenised.columns if c != "marked"]
    rows = tokenised.withColumn("cs", F.transform("marked", lambda w: F.xxhash64(canonical(w))))
    rows = rows.withColumn("ls", F.zip_with("marked", "cs", lambda w, c: F.when(_named(w), F.xxhash64(caseless(w))).otherwise(c)))
    for length in lengths:
        rows = _windows(_windows(rows, "cs", length, f"x{length}"), "ls", length, f"y{length}")
    if len(lengths) == 1:
        both = F.arrays_zip(F.col(f"x{lengths[0]}").alias("x"), F.col(f"y{lengths[0]}").alias("y"))
        return rows.select(*others, F.lit(lengths[0]).alias("length"), F.posexplode(both).alias("at", "z")).select(*others, "length", "at", "z.x", "z.y")
    every = F.concat(*[F.zip_with(f"x{n}", F.transform(f"y{n}", lambda y, i: F.struct(F.lit(n).alias("length"), i.alias("at"), y.alias("y"))), lambda x, r: r.withField("x", x)) for n in lengths])
    return rows.select(*others, F.explode(every).alias("z")).select(*others, "z.length", "z.at", "z.x", "z.y")


def templates(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items (item_id, raw, canonical, caseless, item_tokens), and their windows (item_id, length, at, h)."""
    require(benchmark, "item_id", "text")
    spark = benchmark.sparkSession
    unique = benchmark.where(F.col("text").isNotNull()).groupBy("text").agg(F.min("item_id").alias("item_id"))
    items = unique.select("item_id", raw_tokens(F.col("text")).alias("raw"), marked_tokens(F.col("text")).alias("marked"))
    items = items.select("item_id", "raw", "marked", F.transform("marked", canonical).alias("canonical"), F.transform("marked", caseless).alias("caseless"))
    items = stage(items.withColumn("item_tokens", F.size("marked")).where("item_tokens > 0"), work_path(spark, "bench-items"))
    fits = F.when(F.col("item_tokens") >= WINDOW, F.col("length") == WINDOW).otherwise(F.col("item_tokens") == F.col("length"))
    made = windowed(items.select("item_id", "canonical", "caseless", "item_tokens", "marked"), list(range(LITERALS, WINDOW + 1))).where(fits)

    def literal(form: str) -> Column:
        return F.size(F.filter(F.slice(form, F.col("at") + 1, F.col("length")), lambda w: ~w.isin(NUMBER, NAME, UNIT))) >= LITERALS

    either = [made.where(literal(form)).select("item_id", "length", "at", F.col(h).alias("h")) for form, h in (("canonical", "x"), ("caseless", "y"))]
    return items, stage(either[0].unionByName(either[1]).distinct(), work_path(spark, "bench-windows"))


def _covered(starts: Column) -> Column:
    """Tokens under windows (at, length), in order of start."""
    return F.aggregate(
        F.sort_array(starts), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda done, w: F.struct(
            (done["n"] + F.greatest(w["at"] + w["length"], done["end"]) - F.greatest(w["at"], done["end"])).alias("n"),
            F.greatest(w["at"] + w["length"], done["end"]).alias("end"),
        ),
    )["n"]


def _keys(docs: DataFrame) -> list[Column]:
    return [F.col("doc_id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("th")]


def candidates(docs: DataFrame, items: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc_id, th, item_id, covered, shifts) of the pairs whose windows cover enough of the item."""
    spark = docs.sparkSession
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect())  # at most WINDOW values
    if lengths:
        made = windowed(docs.select(*_keys(docs), marked_tokens(F.col("text")).alias("marked")), lengths)
        # windows without names are the same in both forms
        either = F.when(F.col("x") == F.col("y"), F.array("x")).otherwise(F.array("x", "y"))
        made = made.select("doc_id", "th", F.col("at").alias("pos"), F.explode(either).alias("h"))
    else:
        made = docs.select(*_keys(docs), F.lit(0).alias("pos"), F.lit(0).cast("bigint").alias("h")).limit(0)
    distinct = stage(windows.select(F.col("h").alias("b_h")).distinct(), work_path(spark, "bench-hashes"))
    hits = stage(made.join(distinct, F.col("h") == F.col("b_h"), "left_semi"), work_path(spark, "bench-hits"))
    named = windows.withColumnRenamed("h", "b_h")
    pairs = hits.join(named, F.col("h") == F.col("b_h")).groupBy("doc_id", "th", "item_id").agg(
        F.collect_set(F.struct("at", "length")).alias("starts"), F.collect_set(F.col("pos") - F.col("at")).alias("shifts"),
    )
    pairs = pairs.select("doc_id", "th", "item_id", "shifts", _covered(F.col("starts")).alias("covered"))
    sizes = items.select(F.col("item_id").alias("i"), "item_tokens")
    enough = pairs.join(sizes, F.col("item_id") == F.col("i")).drop("i").where(F.col("covered") >= COVERAGE * F.col("item_tokens"))
    return stage(enough, work_path(spark, "bench-candidates"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, th, item_id, covered, item_tokens, slots, agreeing) of the pairs that pass both tests."""
    require(docs, "doc_id", "text")
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    items, windows = templates(benchmark)
    pairs = candidates(docs, items, windows)
    wanted = stage(pairs.select(F.col("doc_id").alias("d"), F.col("th").alias("t")).distinct(), work_path(spark, "bench-wanted"))
    keyed = docs.select("text", *_keys(docs))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t"))
    texts = keyed.join(wanted, same, "left_semi").groupBy(F.col("doc_id").alias("d"), F.col("th").alias("t")).agg(F.min("text").alias("text"))
    read = texts.select("d", "t", raw_tokens(F.col("text")).alias("doc_raw"), marked_tokens(F.col("text")).alias("marked"))
    read = read.select("d", "t", "doc_raw", F.transform("marked", canonical).alias("doc_canonical"), F.transform("marked", caseless).alias("doc_caseless"))
    about = items.select(F.col("item_id").alias("i"), "raw", "canonical", "caseless")
    joined = pairs.join(read, same).join(about, F.col("item_id") == F.col("i"))

    def same_token(token: Column, i: Column, shift: Column) -> Column:
        either = (F.get("doc_canonical", i + shift) == token) | (F.get("doc_caseless", i + shift) == F.get("caseless", i))
        return F.coalesce(either, F.lit(False))

    def opposite(shift: Column) -> Column:
        def pair(token: Column, i: Column) -> Column:
            return F.when(same_token(token, i, shift) & token.isin(NUMBER, NAME, UNIT), F.struct(F.lower(F.get("raw", i)).alias("a"), F.lower(F.get("doc_raw", i + shift)).alias("b")))

        return F.array_compact(F.transform("canonical", pair))

    def alike(shift: Column) -> Column:
        return F.aggregate(
            F.transform("canonical", lambda token, i: same_token(token, i, shift).cast("int")),
            F.lit(0), lambda n, same: n + same,
        )

    # each alignment by itself, and all together: a text may follow the item with gaps
    alone = F.transform("shifts", lambda shift: F.struct(alike(shift).alias("covered"), opposite(shift).alias("filled")))
    together = F.struct(F.col("covered").alias("covered"), F.flatten(F.transform("shifts", opposite)).alias("filled"))
    joined = joined.select("doc_id", "th", "item_id", "item_tokens", F.explode(F.concat(alone, F.array(together))).alias("way"))
    joined = joined.select("doc_id", "th", "item_id", "way.covered", "item_tokens", "way.filled")
    counted = F.transform(F.array_distinct("filled"), lambda p: F.struct(p["a"].alias("a"), p["b"].alias("b"), F.size(F.filter("filled", lambda q: q == p)).alias("n")))
    joined = joined.select("doc_id", "th", "item_id", "covered", "item_tokens", F.size("filled").alias("slots"), counted.alias("seen"))

    def usual(p: Column) -> Column:
        """No other pair with one of its values is more frequent."""
        return ~F.exists("seen", lambda q: ((q["a"] == p["a"]) | (q["b"] == p["b"])) & (q["n"] > p["n"]))

    def first(p: Column) -> Column:
        """Of equally frequent rivals, the first in order counts."""
        return ~F.exists("seen", lambda q: ((q["a"] == p["a"]) | (q["b"] == p["b"])) & (q["n"] == p["n"]) & (F.concat_ws("\x1f", q["a"], q["b"]) < F.concat_ws("\x1f", p["a"], p["b"])))

    agreeing = F.aggregate(F.filter("seen", lambda p: usual(p) & first(p)), F.lit(0), lambda n, p: n + p["n"])
    judged = joined.select("doc_id", "th", "item_id", "covered", "item_tokens", "slots", agreeing.alias("agreeing"))
    judged = stage(judged, work_path(spark, "bench-judged"))
    passed = judged.where((F.col("covered") >= COVERAGE * F.col("item_tokens")) & (F.col("agreeing") >= CONSISTENT * F.col("slots")))
    best = passed.groupBy("doc_id", "th", "item_id").agg(F.max(F.struct("covered", "agreeing", "slots", "item_tokens")).alias("best"))
    return best.select("doc_id", "th", "item_id", "best.*")


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated document and item: tokens covered, placeholders, and those that agree."""
    return contaminated(docs, benchmark).select("doc_id", "item_id", "covered", "item_tokens", "slots", "agreeing")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that are not contaminated, with the input's columns."""
    found = contaminated(docs, benchmark).select(F.col("doc_id").alias("d"), F.col("th").alias("t")).distinct()
    found = stage(found, work_path(docs.sparkSession, "bench-found"))
    rows = docs.select(packed(docs), *_keys(docs))
    rest = rows.join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")), "left_anti").select("row")
    return rest.select(*unpacked(rest))
