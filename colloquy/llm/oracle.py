"""SQL counterparts, for DuckDB, of the queries that SQL can express."""

from __future__ import annotations

from colloquy.llm.clustering import CLUSTERS, ROUNDS, SCALE, SEED as CLUSTER_SEED, SIZE
from colloquy.llm.prefix_trie import GROUP, HEAD
from colloquy.llm.quality import CUTOFFS, DELTA, MAX_REPEATED, MIN_WORDS, RISK, STRATA
from colloquy.llm.urls import RULES

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op3_mix() -> str:
    """Levels by comparing all pairs of sources; words taken by plain running sums."""
    return f"""
WITH sized AS (
  SELECT doc_id, source, len({WORDS})::BIGINT AS size,
         ('0x' || substr(md5('20252|' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS key
  FROM documents),
total AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
placed AS (
  SELECT source, source_size, [3e0, 1e0, 2e0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
         source_size * 2e0 AS cap
  FROM total),
level AS (
  SELECT ((SELECT sum(source_size) FROM placed) * 1.5e0 - coalesce(sum(b.cap) FILTER (b.cap / b.weight < a.cap / a.weight), 0))
         / sum(b.weight) FILTER (b.cap / b.weight >= a.cap / a.weight) AS level
  FROM placed a, placed b GROUP BY a.source, a.cap, a.weight),
aimed AS (
  SELECT source, source_size, least(cap, (SELECT max(level) FROM level) * weight) AS target FROM placed),
planned AS (
  SELECT *, floor(target + 0.5)::BIGINT AS budget,
         CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS epochs
  FROM aimed),
ordered AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized)
SELECT o.doc_id, o.size, p.source_size, p.target,
       (p.epochs * o.size + greatest(0, least(o.size, p.budget - p.epochs * p.source_size - o.start)))::BIGINT AS taken
FROM ordered o JOIN planned p ON o.source IS NOT DISTINCT FROM p.source"""


def op5_quality() -> str:
    """Windows as strings, counted; binomial tails summed term by term."""
    n = "greatest(n_words, 1)"
    signals = {
        "symbols_per_word": f"n_symbols / {n}", "marks_per_word": f"n_marks / {n}",
        "duplicate_lines": "n_dup_lines / greatest(n_lines, 1)", "capitals_per_letter": "n_capitals / greatest(word_chars, 1)",
        "word_length": f"word_chars / {n}", "word_shortness": f"-word_chars / {n}",
    }
    steps = range(max(map(len, CUTOFFS.values())))
    above = [" OR ".join(f"{rule} > {cuts[min(i, len(cuts) - 1)]!r}::DOUBLE" for rule, cuts in CUTOFFS.items()) for i in steps]
    lost = " UNION ALL ".join(f"SELECT stratum, {i} AS step, count(*) AS n, count(*) FILTER ({a}) AS k FROM held GROUP BY stratum" for i, a in enumerate(above))
    rejected = " ".join(f"WHEN {i} THEN {a}" for i, a in enumerate(above))
    strata = ", ".join(f"'{s}'" for s in STRATA)
    return rf"""
WITH split AS (SELECT doc_id, lang, coalesce(text, '') AS t, {WORDS} AS w FROM documents),
grams AS (
  SELECT doc_id, unnest(range(1, len(w) - 3)) AS pos, w FROM split WHERE len(w) >= 5),
keyed AS (SELECT doc_id, pos, array_to_string(w[pos : pos + 4], ' ') AS gram FROM grams),
twice AS (SELECT doc_id, pos FROM keyed QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(pos, pos + 5)) AS place FROM twice) GROUP BY doc_id),
lined AS (
  SELECT doc_id, lang, t, w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM split),
counted AS (
  SELECT l.doc_id, CASE WHEN lang IN ({strata}) THEN lang ELSE 'other' END AS stratum, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         len(lines) AS n_lines, length(t) - length(regexp_replace(t, '[!?]', '', 'g')) AS n_marks,
         length(t) - length(regexp_replace(t, '\p{{Lu}}', '', 'g')) AS n_capitals
  FROM lined l LEFT JOIN covered c ON l.doc_id = c.doc_id),
measured AS (SELECT *, {", ".join(f"({e})::DOUBLE AS {rule}" for rule, e in signals.items())} FROM counted),
good AS (SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1),
held AS (SELECT * FROM measured JOIN good USING (doc_id) WHERE NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words)),
lost AS ({lost}),
tail AS (
  SELECT stratum, step, sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({RISK!r}::DOUBLE) + (n - i) * ln({1 - RISK!r}::DOUBLE))) AS tail
  FROM (SELECT *, unnest(range(k + 1)) AS i FROM lost) GROUP BY ALL),
passed AS (SELECT *, bool_and(tail <= {DELTA / (len(STRATA) + 1)!r}::DOUBLE) OVER (PARTITION BY stratum ORDER BY step) AS ok FROM tail),
chosen AS (SELECT stratum, max(step) AS step FROM passed WHERE ok GROUP BY stratum)
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words) AND NOT coalesce(CASE step {rejected} END, false) AS kept
FROM measured m LEFT JOIN chosen c ON m.stratum = c.stratum"""


def op6_urls() -> str:
    """Every rule compared with every URL."""
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
    return rf"""
WITH split AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rule AS (SELECT * FROM (VALUES {rules}) v(verdict, h, p)),
best AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
  FROM split JOIN rule ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT s.page_id, host, path, rule, coalesce(verdict, CASE WHEN host = '' THEN 'block' ELSE 'allow' END) AS verdict
FROM split s LEFT JOIN best b ON s.page_id = b.page_id"""


def op11_prefix_trie() -> str:
    """Every prefix of every conversation as a list; subtrees by listing all ancestors of each node. CRC32 bit by bit."""
    shift = "list_reduce([xor(a, b), 1, 1, 1, 1, 1, 1, 1, 1], lambda v, one: xor(v >> 1, (v & one) * 3988292384))"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ord(ch)::BIGINT)), lambda a, b: {shift}), 4294967295)"
    return f"""
WITH turn_of AS (
  SELECT conv_id, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS t,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(t ORDER BY pos) AS turns, {crc} % {HEAD + 1} AS h FROM turn_of GROUP BY conv_id),
conv AS (
  SELECT a.conv_id, list_concat(coalesce(b.turns, [])[1 : a.h], a.turns[a.h + 1 :]) AS turns
  FROM own a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % {GROUP}),
member AS (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM conv),
node AS (
  SELECT depth, turns[1 : depth] AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(turns) = depth), '') AS ends,
         coalesce((count(*) - 1) * strlen(any_value(turns[depth].text)), 0) AS saved
  FROM member GROUP BY depth, turns[1 : depth]),
linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id, count(k.depth) AS n_children
  FROM node n LEFT JOIN node p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[1 : n.depth - 1]
  LEFT JOIN node k ON k.depth = n.depth + 1 AND k.prefix[1 : n.depth] = n.prefix GROUP BY ALL),
above AS (SELECT *, unnest(range(0, depth + 1)) AS up FROM linked),
subtree AS (
  SELECT up AS depth, prefix[1 : up] AS prefix, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM above GROUP BY up, prefix[1 : up])
SELECT l.conv_id, l.depth::BIGINT AS depth, parent_conv_id, n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(ends) AS ends_sha256
FROM linked l JOIN subtree s ON l.depth = s.depth AND l.prefix = s.prefix"""


def op13_clusters() -> str:
    """All distances of each round, in integers."""
    def assigned(name: str, centroids: str) -> str:
        distance = f"list_sum(list_transform(range(1, {SIZE + 1}), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))"
        return f"{name} AS (SELECT rid, min({{'d': {distance}::BIGINT, 'c': c.c}}) AS best FROM vec v, {centroids} c GROUP BY rid)"

    def moved(name: str, before: str, assignment: str) -> str:
        return f"""{name}_sum AS (
  SELECT best.c AS c, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM (SELECT best, x, unnest(range(1, {SIZE + 1})) AS i FROM {assignment} JOIN vec USING (rid)) GROUP BY ALL),
{name}_new AS (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS x FROM {name}_sum GROUP BY c),
{name} AS (SELECT b.c, coalesce(m.x, b.x) AS x FROM {before} b LEFT JOIN {name}_new m ON b.c = m.c)"""

    rounds = []
    for n in range(ROUNDS):
        rounds += [assigned(f"a{n}", f"c{n}"), moved(f"c{n + 1}", f"c{n}", f"a{n}")]
    steps = ",\n".join([*rounds, assigned("last", f"c{ROUNDS}")])
    return f"""
WITH vec AS (
  SELECT vec_id, list_transform(embedding, lambda e: floor({SCALE} * e::DOUBLE)::BIGINT) AS x, row_number() OVER () AS rid
  FROM embeddings WHERE len(embedding) = {SIZE} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {SIZE}),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('{CLUSTER_SEED}:' || coalesce(vec_id::VARCHAR, '')), x) - 1 AS c, x FROM vec
  ORDER BY sha256('{CLUSTER_SEED}:' || coalesce(vec_id::VARCHAR, '')), x LIMIT {CLUSTERS}),
{steps}
SELECT vec_id, best.c::INT AS cluster, best.d::BIGINT AS distance, sum(best.d) OVER (PARTITION BY best.c)::BIGINT AS cluster_inertia,
       sum(best.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM last JOIN vec USING (rid) JOIN c{ROUNDS} c ON c.c = best.c"""


def all_sql() -> dict[str, str]:
    return {f.__name__: f() for f in (op3_mix, op5_quality, op6_urls, op11_prefix_trie, op13_clusters)}
