"""SQL counterparts of the queries, for DuckDB.

Stated independently of the Spark plans where that is possible: positions by plain row numbers, the order
of speech and the timeline by a recursion that goes turn by turn, noise feedback sample by sample.
"""

from __future__ import annotations

from dataclasses import dataclass

SEED = 42
_SQL: dict[str, str] = {}


def all_sql() -> dict[str, str]:
    return dict(_SQL)


def md5(purpose: str, *keys: str) -> str:
    parts = ", ".join(f"({k})::VARCHAR" for k in keys)
    return f"md5(concat_ws('|', '{SEED}', '{purpose}', {parts}))"


def lane(digest: str, index: str | int = 0) -> str:
    return f"(('0x' || substr({digest}, 1 + 8 * ({index}), 8))::BIGINT / 4294967296e0)"


def wide(purpose: str, *keys: str, at: str | int = 0) -> str:
    return f"(('0x' || substr({md5(purpose, *keys)}, 1 + 13 * ({at}), 13))::BIGINT / 4503599627370496e0)"


def u(purpose: str, *keys: str, at: str | int = 0) -> str:
    return lane(md5(purpose, *keys), at)


def span(x: str, low: float, high: float) -> str:
    return f"({low!r}::DOUBLE + '{float(high) - float(low)!r}'::DOUBLE * {x})"


def whole(x: str) -> str:
    return f"trunc({x})::BIGINT"


def floor(x: str) -> str:
    return f"floor({x})::BIGINT"


def centis(samples: str, rate: int = 16000) -> str:
    return f"((({samples}) * 100 + {rate // 2}) // {rate})::BIGINT"


def seconds(samples: str, rate: int = 16000) -> str:
    return f"({centis(samples, rate)} / 100e0)"


def micro(array: str) -> str:
    return f"array_to_string(list_transform({array}, lambda x: round(x::DOUBLE * 1e6)::BIGINT), ',')"


@dataclass(frozen=True)
class Knobs:
    rate: int = 16000
    reserve: int = 1000
    overlap: float = 0.3
    simultaneous: float = 0.25
    noise: float = 0.55
    volume: tuple[float, float] = (0.7, 1.3)
    target_count: int = 30


DEFAULT = Knobs()
PLAIN = Knobs(32, 10, 0.0, 0.0, 0.0)
OVERLAP = Knobs(32, 10, 1.0, 0.0, 0.0)
LOUD = Knobs(32, 10, 0.3, 1.0, 0.0, (3.0, 5.0))
NOISY = Knobs(32, 10)

NOISE = "['white', 'pink', 'brown', 'crowd', 'cafe', 'static', 'hum']"

DOCUMENTS = "SELECT doc_id AS utt_id, source AS speaker_id, text, (1600 + 16 * n_chars)::BIGINT AS n_samples FROM documents"
GAPPY = """SELECT doc_id AS utt_id, nullif(source, 'src0') AS speaker_id,
  CASE WHEN doc_id % 7 <> 0 THEN text END AS text,
  (CASE WHEN doc_id % 11 = 0 THEN 0 ELSE 1600 + 16 * n_chars END)::BIGINT AS n_samples FROM documents"""
EVENTS = """SELECT event_id AS utt_id, user_id::VARCHAR AS speaker_id, event_type AS text,
  (1600 + trunc(value * 160))::BIGINT AS n_samples FROM events"""
WAVES = """SELECT vec_id AS utt_id, label::VARCHAR AS speaker_id, NULL::VARCHAR AS text, 64::BIGINT AS n_samples,
  embedding::FLOAT[] AS audio FROM embeddings"""

SEGMENTS = """seg AS (
  SELECT conv_id AS track_id, turn AS seg_idx,
    (CASE role WHEN 'user' THEN 1 WHEN 'assistant' THEN 2 ELSE 3 END)::BIGINT AS speaker_id,
    (800 * length(text))::BIGINT AS n_samples, text,
    sum(800 * length(text)) OVER (PARTITION BY conv_id ORDER BY turn)::BIGINT AS cum_after
  FROM conversations)"""


def spec_from(ids: str, k: Knobs = DEFAULT) -> str:
    """CTE ``spec`` for the track ids of a query."""
    shape, mood = "shape", "mood"
    return f"""
ids AS ({ids}),
spec0 AS (SELECT track_id, {md5('spec', 'track_id')} AS shape, {md5('mood', 'track_id')} AS mood FROM ids),
spec1 AS (SELECT *,
    CASE WHEN {lane(shape)} <= '0.4'::DOUBLE THEN 'dialogue'
         WHEN {lane(shape)} <= '{0.4 + 0.2!r}'::DOUBLE THEN 'monologue'
         WHEN {lane(shape)} <= '{0.4 + 0.2 + 0.2!r}'::DOUBLE THEN 'group_discussion'
         WHEN {lane(shape)} <= '{0.4 + 0.2 + 0.2 + 0.2!r}'::DOUBLE THEN 'interview' ELSE 'dialogue' END AS pattern
  FROM spec0),
spec AS (SELECT track_id, pattern,
    (CASE pattern WHEN 'monologue' THEN 1 WHEN 'group_discussion' THEN 3 + {floor(lane(shape, 1) + ' * 2')}
      ELSE 2 END)::BIGINT AS n_spk,
    {whole(span(lane(shape, 2), 30, 60) + f' * {float(k.rate)}')} AS target_samples,
    {lane(shape, 3)} < '0.2'::DOUBLE AS use_short,
    {lane(mood, 0)} < '{k.simultaneous}'::DOUBLE AS want_sim,
    {lane(mood, 1)} < '{k.noise}'::DOUBLE AS want_noise,
    CASE WHEN {lane(mood, 1)} < '{k.noise}'::DOUBLE THEN {span(lane(mood, 2), 10, 30)} END AS snr_db,
    CASE WHEN {lane(mood, 1)} < '{k.noise}'::DOUBLE
      THEN ({NOISE})[1 + {floor(lane(mood, 3) + ' * 7')}] END AS noise_type
  FROM spec1)"""


REQUESTS = "SELECT c_custkey::BIGINT AS track_id FROM customer"


def volume(track: str, spk: str, k: Knobs = DEFAULT) -> str:
    return span(u("volume", track, spk), *k.volume)


def slots(utterances: str, k: Knobs = DEFAULT) -> str:
    """CTEs up to ``slots``: which utterance seeds which speaker position."""
    return spec_from(REQUESTS, k) + f""",
utt AS ({utterances}),
idx AS MATERIALIZED (SELECT utt_id, speaker_id, n_samples, n_samples <= {k.rate} AS is_short,
    row_number() OVER (ORDER BY utt_id) - 1 AS utt_no,
    row_number() OVER (PARTITION BY speaker_id ORDER BY utt_id) - 1 AS s_rank,
    count(*) OVER (PARTITION BY speaker_id) AS s_n,
    count(*) FILTER (n_samples <= {k.rate}) OVER (PARTITION BY speaker_id ORDER BY utt_id) - 1 AS short_rank,
    count(*) FILTER (n_samples <= {k.rate}) OVER (PARTITION BY speaker_id) AS short_n,
    count(*) FILTER (n_samples <= {k.rate}) OVER (ORDER BY utt_id) - 1 AS any_short_rank,
    count(*) FILTER (n_samples <= {k.rate}) OVER () AS any_short_n,
    count(*) OVER () AS all_n
  FROM utt WHERE n_samples > 0),
total AS (SELECT count(*) AS n FROM idx),
seed_steps AS (
  SELECT track_id, n_spk, n, 0::BIGINT AS i, []::BIGINT[] AS got FROM spec, total WHERE n_spk <= n
  UNION ALL
  SELECT track_id, n_spk, n, i + 1,
    list_append(got, CASE WHEN list_contains(got, t) THEN n - n_spk + i ELSE t END)
  FROM (SELECT *, {floor(wide('seed', 'track_id', 'i') + ' * (n - n_spk + i + 1)')} AS t
        FROM seed_steps WHERE i < n_spk)),
slots AS MATERIALIZED (
  SELECT s.track_id, row_number() OVER (PARTITION BY s.track_id ORDER BY {md5('slot', 's.track_id', 's.utt_no')}) - 1 AS spk,
    idx.*
  FROM (SELECT track_id, unnest(got) AS utt_no FROM seed_steps WHERE i = n_spk) s JOIN idx USING (utt_no))"""


def pools(utterances: str, k: Knobs = DEFAULT) -> str:
    """CTEs up to ``pools``."""
    return slots(utterances, k) + f""",
want AS (
  SELECT s.track_id, s.spk, s.speaker_id,
    CASE WHEN use_short AND (CASE WHEN s.speaker_id IS NULL THEN any_short_n ELSE short_n END) - is_short::INT > 0
      THEN 1 ELSE 0 END AS kind,
    s.utt_no, s.s_rank, s.s_n, s.short_rank, s.short_n, s.any_short_rank, s.any_short_n, s.all_n, s.is_short
  FROM slots s JOIN spec USING (track_id)),
draw AS (
  SELECT track_id, spk, speaker_id, kind,
    (CASE WHEN kind = 1 THEN (CASE WHEN speaker_id IS NULL THEN any_short_n ELSE short_n END) - is_short::INT
      ELSE (CASE WHEN speaker_id IS NULL THEN all_n ELSE s_n END) - 1 END)::BIGINT AS n,
    CASE WHEN kind = 0 THEN (CASE WHEN speaker_id IS NULL THEN utt_no ELSE s_rank END)
      WHEN is_short THEN (CASE WHEN speaker_id IS NULL THEN any_short_rank ELSE short_rank END) END AS own
  FROM want),
pool_steps AS (
  SELECT *, least({k.target_count}, n)::BIGINT AS k, 0::BIGINT AS i, []::BIGINT[] AS got FROM draw
  UNION ALL
  SELECT track_id, spk, speaker_id, kind, n, own, k, i + 1,
    list_append(got, CASE WHEN list_contains(got, t) THEN n - k + i ELSE t END)
  FROM (SELECT *, {floor(wide('pool', 'track_id', 'spk', 'i // 2', at='i % 2') + ' * (n - k + i + 1)')} AS t
        FROM pool_steps WHERE i < k)),
picked AS (
  SELECT track_id, spk, speaker_id, kind, pool_rank, got[pool_rank] + (CASE WHEN got[pool_rank] >= own THEN 1 ELSE 0 END) AS pos
  FROM (SELECT *, unnest(range(1, len(got) + 1)) AS pool_rank FROM pool_steps WHERE i = k)),
pools AS MATERIALIZED (
  SELECT track_id, spk, 0::BIGINT AS pool_rank, utt_id, n_samples FROM slots
  UNION ALL
  SELECT p.track_id, p.spk, p.pool_rank::BIGINT, i.utt_id, i.n_samples FROM picked p JOIN idx i
    ON p.speaker_id = i.speaker_id AND p.kind = 0 AND p.pos = i.s_rank
  UNION ALL
  SELECT p.track_id, p.spk, p.pool_rank::BIGINT, i.utt_id, i.n_samples FROM picked p JOIN idx i
    ON p.speaker_id = i.speaker_id AND p.kind = 1 AND i.is_short AND p.pos = i.short_rank
  UNION ALL
  SELECT p.track_id, p.spk, p.pool_rank::BIGINT, i.utt_id, i.n_samples FROM picked p JOIN idx i
    ON p.speaker_id IS NULL AND p.kind = 0 AND p.pos = i.utt_no
  UNION ALL
  SELECT p.track_id, p.spk, p.pool_rank::BIGINT, i.utt_id, i.n_samples FROM picked p JOIN idx i
    ON p.speaker_id IS NULL AND p.kind = 1 AND i.is_short AND p.pos = i.any_short_rank)"""


def next_speaker(pattern: str = "pattern", t: str = "t", n: str = "n") -> str:
    """Who speaks at turn ``t`` after ``prev``, who has spoken ``consec`` turns in a row."""
    uu, vv = u("turn", "track_id", t), u("turn", "track_id", t, at=1)
    return f"""(CASE {pattern}
      WHEN 'monologue' THEN 0
      WHEN 'dialogue' THEN (CASE WHEN {t} < 2 THEN {t} ELSE 1 - prev END)
      WHEN 'interview' THEN (CASE WHEN {t} < 2 THEN {t} WHEN prev = 0 THEN 1
        WHEN {uu} < '0.8'::DOUBLE THEN 0 ELSE prev END)
      ELSE (CASE WHEN {t} < {n} THEN {t} WHEN consec < 2 AND {uu} < '0.3'::DOUBLE THEN prev
        ELSE (prev + 1 + {floor(f'{vv} * ({n} - 1)')}) % {n} END) END)::BIGINT"""


def turns(utterances: str, k: Knobs = DEFAULT) -> str:
    """CTEs up to ``turns``: every track planned turn by turn."""
    gap = md5("gap", "track_id", "t")
    partner = md5("partner", "track_id", "t")
    long_ms = span(lane("gap", 3), 2, 5) + " * 1000e0"
    short_ms = span(lane("gap", 3), 200, 1200)
    return pools(utterances, k) + f""",
sizes AS MATERIALIZED (
  SELECT track_id, count(*) AS n, list(size ORDER BY spk) AS sizes, list(total ORDER BY spk) AS totals
  FROM (SELECT track_id, spk, count(*) AS size, sum(n_samples)::BIGINT AS total FROM pools GROUP BY ALL) GROUP BY 1),
rounds AS MATERIALIZED (
  SELECT track_id, spk, utt_id, n_samples, sizes[spk + 1] AS size,
    unnest(range(target_samples // totals[spk + 1] + 1)) AS round
  FROM pools JOIN sizes USING (track_id) JOIN spec USING (track_id)),
deck AS MATERIALIZED (
  SELECT track_id, spk, utt_id, n_samples,
    round * size + row_number() OVER (PARTITION BY track_id, spk, round
      ORDER BY {md5('pick', 'track_id', 'spk', 'round', 'utt_id')}, utt_id) - 1 AS nth
  FROM rounds),
walk AS (
  SELECT track_id, pattern, n, sizes, target_samples, want_sim, 0::BIGINT AS t, NULL::BIGINT AS prev,
    0::BIGINT AS consec, list_transform(sizes, lambda x: 0::BIGINT) AS used, 0::BIGINT AS cum, 99::BIGINT AS since,
    NULL::BIGINT AS spk, NULL::BIGINT AS utt_id, NULL::BIGINT AS n_samples, NULL::VARCHAR AS kind,
    false AS sim_eligible, 0::BIGINT AS pause, NULL::DOUBLE AS ov_pct, NULL::BIGINT AS sim_spk,
    NULL::BIGINT AS sim_utt_id, NULL::BIGINT AS sim_samples, 0::BIGINT AS cum_before
  FROM spec JOIN sizes USING (track_id)
  UNION ALL
  SELECT track_id, pattern, n, sizes, target_samples, want_sim, t + 1, spk,
    CASE WHEN spk = prev THEN consec + 1 ELSE 1 END,
    list_transform(used, lambda x, i: CASE WHEN i = spk + 1 THEN x + 1 ELSE x END),
    cum + pause + n_samples,
    CASE WHEN n_samples > coalesce(sim_samples, 0) THEN 0 ELSE since + 1 END,
    spk, utt_id, n_samples, kind, eligible, pause,
    CASE WHEN kind = 'overlap' THEN {span(lane('gap', 1), 0.1, 0.3)} END, CASE WHEN kind = 'simultaneous' THEN other END,
    CASE WHEN kind = 'simultaneous' THEN other_utt END, sim_samples, cum
  FROM (
    SELECT *, (CASE
        WHEN kind <> 'pause' THEN 0
        WHEN cum + drawn <= target_samples - {k.reserve} THEN drawn
        WHEN target_samples - cum > {k.reserve} THEN least(drawn, target_samples - cum - {k.reserve})
        ELSE 0 END)::BIGINT AS pause,
      CASE WHEN kind = 'simultaneous' THEN together END AS sim_samples
    FROM (
      SELECT *, CASE WHEN t = 0 THEN 'plain' WHEN eligible THEN 'simultaneous'
          WHEN {lane('gap', 0)} < '{k.overlap}'::DOUBLE THEN 'overlap' ELSE 'pause' END AS kind,
        {whole(f"(CASE WHEN {lane('gap', 2)} < '0.1'::DOUBLE THEN {long_ms} ELSE {short_ms} END) * {float(k.rate)}::DOUBLE / 1000e0")} AS drawn
      FROM (
        SELECT a.* EXCLUDE (sim_eligible, pause, ov_pct, sim_spk, sim_utt_id, sim_samples, cum_before, kind, want_sim),
          a.want_sim, o.utt_id AS other_utt,
          least({whole(span(lane('partner', 2), 0.5, 3) + f' * {float(k.rate)}')}, a.n_samples, o.n_samples) AS together,
          a.want_sim AND a.n > 1 AND t > 0 AND since < 5 AS eligible
        FROM (
          SELECT w.* EXCLUDE (utt_id, n_samples), d.utt_id, d.n_samples,
            CASE WHEN n > 1 THEN (w.spk + 1 + {floor(lane('partner', 0) + ' * (n - 1)')}) % n END AS other
          FROM (SELECT * EXCLUDE (spk), {next_speaker()} AS spk, {gap} AS gap, {partner} AS partner
                FROM walk WHERE cum < target_samples) w
          JOIN deck d ON d.track_id = w.track_id AND d.spk = w.spk AND d.nth = w.used[w.spk + 1]) a
        LEFT JOIN pools o ON o.track_id = a.track_id AND o.spk = a.other
          AND o.pool_rank = {floor(lane('a.partner', 1) + ' * a.sizes[a.other + 1]')})))),
turns AS (
  SELECT track_id, t - 1 AS turn, pattern, n AS n_spk, target_samples, want_sim, spk, utt_id, n_samples, kind,
    sim_eligible, pause, ov_pct, sim_spk, sim_utt_id, sim_samples, cum_before, cum AS cum_after,
    n_samples > coalesce(sim_samples, 0) AS spoken
  FROM walk WHERE t > 0)"""


EVENT_ROWS = f""",
event0 AS (
  SELECT track_id, turn, 0 AS pos, 'pause' AS kind, NULL::BIGINT AS spk, NULL::BIGINT AS utt_id, NULL::DOUBLE AS volume,
    NULL::BIGINT AS start_samples, NULL::BIGINT AS n_samples, NULL::BIGINT AS trim_start, pause AS duration_samples,
    NULL::DOUBLE AS overlap_percent, NULL::BIGINT AS sim_spk, NULL::BIGINT AS sim_utt_id
  FROM turns WHERE pause > 0
  UNION ALL
  SELECT track_id, turn, 0, 'overlap', NULL, NULL, NULL, NULL, NULL, NULL, NULL, round(ov_pct, 9), NULL, NULL
  FROM turns WHERE kind = 'overlap'
  UNION ALL
  SELECT track_id, turn, 0, 'simultaneous', spk, utt_id, NULL, cum_before, NULL, NULL, sim_samples, NULL, sim_spk, sim_utt_id
  FROM turns WHERE kind = 'simultaneous'
  UNION ALL
  SELECT track_id, turn, 1, 'segment', spk, utt_id, round({volume('track_id', 'spk')}, 9), cum_before, n_samples,
    sim_samples, NULL, NULL, NULL, NULL
  FROM turns WHERE spoken),
event AS (
  SELECT track_id, row_number() OVER (PARTITION BY track_id ORDER BY turn, pos) - 1 AS event_idx, * EXCLUDE (track_id, turn, pos)
  FROM event0)"""


def _difficulty(n: str, overlaps: str, simultaneous: str, noise: str, mean: str) -> str:
    score = f"({n} + ({overlaps})::INT + ({simultaneous})::INT + ({noise})::INT + (({mean}) < 2)::INT)"
    return f"CASE WHEN {score} <= 2 THEN 'easy' WHEN {score} <= 4 THEN 'medium' ELSE 'hard' END"


def flat_rows(turn_cte: str, n_spk: str = "n_spk", noise: bool = True) -> str:
    """SELECT of flat track rows from ``turn_cte`` and ``spec``."""
    seg = f"""concat_ws(':', spk + 1, {centis('cum_before')}, {centis('cum_after')}, {centis('n_samples')})"""
    sim = f"""concat_ws(':', spk + 1, sim_spk + 1, {centis('cum_before')}, {centis('cum_before + sim_samples')}, {centis('sim_samples')})"""
    vol = f"concat_ws(':', s + 1, round({volume('track_id', 's')} * 100)::BIGINT)"
    return f"""
SELECT r.track_id, {seconds('total')} AS duration, num_speakers, 16000::BIGINT AS sampling_rate,
  pattern AS conversation_type,
  {_difficulty('num_speakers', 'has_overlaps', 'has_simultaneous', 'want_noise', 'mean')} AS difficulty,
  has_overlaps, has_simultaneous, want_noise AS has_noise,
  {'noise_type' if noise else 'NULL::VARCHAR'} AS noise_type, {'round(snr_db, 2)' if noise else 'NULL::DOUBLE'} AS snr,
  speakers, volumes AS speaker_volumes, coalesce(sims, '') AS simultaneous_segments
FROM (
  SELECT track_id, max(cum_after) AS total, count(DISTINCT spk) FILTER (spoken) AS num_speakers,
    bool_or(kind = 'overlap') AS has_overlaps, bool_or(kind = 'simultaneous') AS has_simultaneous,
    sum({centis('n_samples')}) FILTER (spoken) / (count(*) FILTER (spoken) * 100) AS mean,
    string_agg({seg}, ',' ORDER BY turn) FILTER (spoken) AS speakers,
    string_agg({sim}, ',' ORDER BY turn) FILTER (kind = 'simultaneous') AS sims
  FROM {turn_cte} GROUP BY 1) r
JOIN spec USING (track_id)
JOIN (SELECT track_id, string_agg({vol}, ',' ORDER BY s) AS volumes
      FROM (SELECT DISTINCT track_id, unnest(range({n_spk})) AS s FROM {turn_cte}) GROUP BY 1) v USING (track_id)"""


CONVERSATION_TURNS = """,
cturns AS (
  SELECT track_id, seg_idx AS turn, speaker_id - 1 AS spk, 3::BIGINT AS n_spk, n_samples, text,
    CASE WHEN track_id % 3 = 0 AND seg_idx = 1 THEN 'overlap' ELSE 'plain' END AS kind,
    NULL::BIGINT AS sim_spk, NULL::BIGINT AS sim_samples, cum_after - n_samples AS cum_before, cum_after, true AS spoken
  FROM seg)"""


def with_(ctes: str, select: str) -> str:
    return f"WITH RECURSIVE {ctes.strip()}\n{select}"


def sql(name: str, text: str) -> None:
    _SQL[name] = text


# --- sources, draws, specifications -------------------------------------------------------------------

sql("src_utterances", f"SELECT utt_id, speaker_id, text, n_samples FROM ({DOCUMENTS} WHERE lang = 'en')")
sql("src_audio_array", f"""
SELECT utt_id, 'bare' AS form, {micro('audio')} AS samples FROM ({WAVES})
UNION ALL SELECT utt_id, 'wrapped', {micro('audio')} FROM ({WAVES}) WHERE utt_id % 5 <> 0""")
sql("src_count_back", "SELECT count(DISTINCT conv_id) AS n_rows FROM conversations")
sql("src_json_compat", f"""WITH {SEGMENTS}
SELECT track_id, row_number() OVER (PARTITION BY track_id ORDER BY seg_idx) - 1 AS pos, speaker_id,
  {seconds('cum_after - n_samples')} AS start, {seconds('cum_after')} AS end, {seconds('n_samples')} AS duration, text,
  0.75e0 + speaker_id / 8e0 AS volume FROM seg""")
sql("flt_usable", f"SELECT utt_id, speaker_id, n_samples FROM ({GAPPY}) WHERE n_samples > 0")
sql("flt_short_fallback", f"""
SELECT utt_id, speaker_id, n_samples FROM (
  SELECT *, min(n_samples) OVER (PARTITION BY speaker_id) AS least FROM ({DOCUMENTS}))
WHERE n_samples <= 2400 OR least > 2400""")
_U = u("volume", "utt_id", "0")
sql("rnd_uniform", f"""
SELECT utt_id, round({_U}, 9) AS u, round({span(_U, 0.7, 1.3)}, 9) AS volume,
  {whole(span(_U, 0.5, 3.0) + ' * 16000e0')} AS samples FROM ({DOCUMENTS})""")
sql("rnd_weighted_choice", f"""WITH {spec_from('SELECT doc_id AS track_id FROM documents').strip()}
SELECT track_id AS utt_id, pattern FROM spec""")
sql("rnd_choice", f"""
SELECT utt_id, ({NOISE})[1 + {floor(u('choice', 'utt_id') + ' * 7')}] AS noise_type,
  2 + {floor(u('choice', 'utt_id', at=1) + ' * 3')} AS n_spk FROM ({DOCUMENTS})""")
sql("rnd_sample_n", with_(slots(DOCUMENTS), "SELECT track_id, spk, utt_id FROM slots"))
sql("spec_tracks", with_(spec_from(REQUESTS), "SELECT * REPLACE (round(snr_db, 9) AS snr_db) FROM spec"))
sql("spec_prob_check", """
WITH n AS (SELECT count(*) AS docs FROM documents),
shares AS (
  SELECT 'language' AS name, count(*) / docs AS p FROM documents, n GROUP BY lang, docs
  UNION ALL SELECT 'quality', count(*) / docs FROM labels, n GROUP BY quality, docs)
SELECT name, count(*) AS n, round(sum(p), 9) AS total, sum(p) BETWEEN 0.99 AND 1.01 AS ok FROM shares GROUP BY 1""")

# --- pools, order of speech, planner ---------------------------------------------------------------------

sql("pool_build", with_(pools(DOCUMENTS), "SELECT * FROM pools"))
sql("pool_null_speaker", with_(pools(GAPPY), "SELECT * FROM pools"))
_DOC, _EVT = turns(DOCUMENTS), turns(EVENTS)
sql("pool_pick", with_(_DOC, "SELECT track_id, turn, spk, utt_id, n_samples FROM turns"))


def _order(pattern: str | None) -> str:
    count = {"monologue": "1", "dialogue": "2", "interview": "2",
             "group_discussion": f"3 + {floor(u('spec', 'track_id', at=1) + ' * 2')}"}
    source = "spec" if pattern is None else (
        f"(SELECT track_id, '{pattern}' AS pattern, ({count[pattern]})::BIGINT AS n_spk FROM ids)")
    return with_(spec_from(REQUESTS) + f""",
said AS (
  SELECT track_id, pattern, n_spk AS n, 0::BIGINT AS t, NULL::BIGINT AS prev, 0::BIGINT AS consec FROM {source}
  UNION ALL
  SELECT track_id, pattern, n, t + 1, spk, CASE WHEN spk = prev THEN consec + 1 ELSE 1 END
  FROM (SELECT *, {next_speaker()} AS spk FROM said WHERE t < 12 + track_id % 20))""",
        "SELECT track_id, t - 1 AS turn, pattern, n AS n_spk, prev AS spk FROM said WHERE t > 0")


for _name, _pattern in (("pat_monologue", "monologue"), ("pat_dialogue", "dialogue"), ("pat_interview", "interview"),
                        ("pat_group", "group_discussion"), ("pat_all", None)):
    sql(_name, _order(_pattern))

sql("pat_custom", with_(spec_from(REQUESTS) + """,
walked AS (
  SELECT track_id, n_spk AS n, 0::BIGINT AS turn, 0::BIGINT AS spk, NULL::BIGINT AS prev FROM spec
  UNION ALL
  SELECT track_id, n, turn + 1, (spk + CASE WHEN (spk - prev + n) % n = 1 % n AND n > 1 THEN 2 ELSE 1 END) % n, spk
  FROM walked WHERE turn < 11 + track_id % 20)""", """
SELECT track_id, turn, 'stepwise' AS pattern, n AS n_spk, spk FROM walked
UNION ALL SELECT track_id, turn, 'round_robin', 3, turn % 3 FROM walked"""))

sql("plan_timeline", with_(_DOC, "SELECT track_id, turn, kind, n_samples, pause, cum_before, cum_after FROM turns"))
sql("plan_pause", with_(_EVT, "SELECT track_id, turn, pause FROM turns WHERE kind = 'pause'"))
sql("plan_overlap", with_(_EVT, "SELECT track_id, turn, round(ov_pct, 9) AS ov_pct FROM turns WHERE kind = 'overlap'"))
sql("plan_sim_eligible", with_(_EVT, "SELECT track_id, turn, want_sim, kind, sim_eligible FROM turns"))
sql("sim_partner", with_(_DOC, """
SELECT track_id, turn, spk, utt_id, sim_spk, sim_utt_id, sim_samples FROM turns WHERE kind = 'simultaneous'"""))
sql("turn_text", with_(_DOC, """
SELECT track_id, turn, utt_id, utt.speaker_id AS source_speaker_id, text FROM turns LEFT JOIN utt USING (utt_id)"""))
sql("plan_events", with_(_EVT + EVENT_ROWS, "SELECT * FROM event"))
sql("ov_asof_prev", with_(_EVT + EVENT_ROWS, """
SELECT o.track_id, o.event_idx, o.overlap_percent, s.event_idx AS prev_event_idx, s.utt_id AS prev_utt_id,
  s.n_samples - coalesce(s.trim_start, 0) AS prev_samples
FROM (SELECT * FROM event WHERE kind = 'overlap') o
ASOF LEFT JOIN (SELECT * FROM event WHERE kind = 'segment') s
  ON o.track_id = s.track_id AND o.event_idx > s.event_idx"""))
sql("plan_segments", with_(_DOC, f"""
SELECT track_id, turn AS seg_idx, spk + 1 AS speaker_id, {seconds('cum_before')} AS start, {seconds('cum_after')} AS end,
  {seconds('turns.n_samples')} AS duration, {seconds('cum_before + pause')} AS speech_start, text
FROM turns JOIN utt USING (utt_id) WHERE spoken"""))
_SIMS = f"""SELECT track_id, turn AS seg_idx, {seconds('cum_before')} AS start,
  {seconds('cum_before + sim_samples')} AS end, spk + 1 AS speaker1_id, sim_spk + 1 AS speaker2_id,
  {seconds('sim_samples')} AS duration FROM turns WHERE kind = 'simultaneous'"""
sql("plan_sim_segments", with_(_EVT, _SIMS))
sql("all_activity", with_(_EVT, f"""
SELECT track_id, {seconds('cum_before')} AS start, {seconds('cum_after')} AS end, spk + 1 AS speaker_id, 'segment' AS source
FROM turns WHERE spoken
UNION ALL
SELECT track_id, start, "end", unnest([speaker1_id, speaker2_id]), 'simultaneous' FROM ({_SIMS})"""))
sql("set_unused", with_(_DOC, """
SELECT track_id, spk, utt_id FROM pools p WHERE NOT EXISTS (
  SELECT 1 FROM turns t WHERE t.track_id = p.track_id AND t.spk = p.spk AND t.utt_id = p.utt_id)"""))
sql("vol_default", f"""WITH {SEGMENTS}
SELECT track_id, seg_idx,
  round(CASE WHEN speaker_id < 3 THEN {volume('track_id', 'speaker_id - 1')} ELSE 1e0 END, 9) AS volume FROM seg""")

# --- aggregation and quality --------------------------------------------------------------------------------

sql("agg_speaker_index", f"""
SELECT speaker_id, utt_id // 256 AS chunk, count(*) AS n, string_agg(utt_id::VARCHAR, ',' ORDER BY utt_id) AS utt_ids
FROM ({GAPPY}) GROUP BY 1, 2""")
sql("agg_metadata", f"SELECT utt_id, speaker_id, text FROM ({GAPPY})")
sql("agg_unique_speakers", f"SELECT count(DISTINCT coalesce(speaker_id, '-')) AS n_speakers FROM ({GAPPY})")
sql("agg_actual_speakers", """
SELECT conv_id AS track_id, count(DISTINCT role) AS num_speakers, count(DISTINCT role) <> 3 AS speakers_differ
FROM conversations GROUP BY 1""")
sql("agg_avg_segment", f"""WITH {SEGMENTS}
SELECT track_id, round(avg({centis('n_samples')} / 100), 6) AS mean_seconds FROM seg GROUP BY 1""")
sql("agg_difficulty", f"""WITH {SEGMENTS}
SELECT track_id, {_difficulty('n', 'track_id % 3 = 0', 'track_id % 5 = 0', 'track_id % 2 = 0', 'mean')} AS difficulty
FROM (SELECT track_id, count(DISTINCT speaker_id) AS n, sum({centis('n_samples')}) / (100 * count(*)) AS mean
      FROM seg GROUP BY 1)""")
_TIME = f"""WITH {SEGMENTS}, times AS (
  SELECT track_id, speaker_id, sum({centis('n_samples')})::BIGINT AS centis, count(*) AS n_segments FROM seg GROUP BY 1, 2)"""
_TWO = "printf('%d.%02d', {0} // 100, {0} % 100)"
_SHORT = f"printf('Speaker %d has duration %ss < 20.0s', speaker_id, {_TWO.format('centis')})"
sql("val_speaker_time", f"{_TIME} SELECT * FROM times")
sql("val_min_duration", f"{_TIME} SELECT track_id, speaker_id, {_SHORT} AS warning FROM times WHERE centis < 2000")
sql("val_imbalance", f"""{_TIME}
SELECT track_id, max(centis) AS max_centis, sum(centis)::BIGINT AS total_centis,
  round(max(centis) / sum(centis), 9) AS max_share, max(centis) / sum(centis) > 0.4 AS imbalanced
FROM times GROUP BY 1""")
sql("val_report", f"""{_TIME},
report AS (
  SELECT track_id, count(*) AS n_found, max(centis) AS most, sum(centis)::BIGINT AS total,
    string_agg({_SHORT}, '; ' ORDER BY speaker_id) FILTER (centis < 2000) AS short
  FROM times GROUP BY 1)
SELECT track_id, n_found, 3::BIGINT AS expected_speakers, coalesce(concat_ws('; ', short, uneven, few), '') AS warnings,
  coalesce(concat_ws('; ', short, uneven, few), '') = '' AS is_valid
FROM (SELECT *,
    CASE WHEN most / total > 0.6 THEN 'Speaker imbalance: max ratio '
      || {_TWO.format('((200 * most + total) // (2 * total))')} || ' > 0.6' END AS uneven,
    CASE WHEN n_found < 3 THEN printf('Only %d speakers found, expected 3', n_found) END AS few
  FROM report)""")
sql("agg_dataset_stats", with_(_DOC, f"""
SELECT conversation_type, difficulty, count(*) AS n_tracks, min(duration) AS min_duration, max(duration) AS max_duration,
  count(*) FILTER (has_overlaps) AS n_overlaps, count(*) FILTER (has_simultaneous) AS n_simultaneous,
  count(*) FILTER (has_noise) AS n_noise
FROM ({flat_rows('turns')}) GROUP BY 1, 2"""))
sql("agg_run_totals", """
SELECT count(*) AS requested, count(c.id) AS produced, count(*) - count(c.id) AS failed
FROM customer LEFT JOIN (SELECT DISTINCT conv_id AS id FROM conversations) c ON c.id = c_custkey""")
sql("track_rows", with_(_DOC, flat_rows("turns")))
sql("str_incremental", _SQL["track_rows"])
sql("track_summary", with_(_DOC, f"""
SELECT track_id, conversation_type, num_speakers, duration, difficulty, n_segments, round(most / total, 9) AS max_share,
  least >= 300 AND most / total <= 0.4 AS is_valid
FROM ({flat_rows('turns')}) JOIN (
  SELECT track_id, sum(n)::BIGINT AS n_segments, max(centis) AS most, min(centis) AS least, sum(centis)::BIGINT AS total
  FROM (SELECT track_id, spk, count(*) AS n, sum({centis('n_samples')})::BIGINT AS centis FROM turns WHERE spoken GROUP BY 1, 2)
  GROUP BY 1) USING (track_id)"""))
sql("seg_explode", f"""WITH {SEGMENTS}
SELECT track_id, speaker_id, {seconds('cum_after - n_samples')} AS start, {seconds('cum_after')} AS end,
  {seconds('n_samples')} AS duration, text FROM seg""")

# --- waveforms ------------------------------------------------------------------------------------------------

_D = f"(SELECT utt_id, audio::DOUBLE[] AS audio FROM ({WAVES}))"
sql("dsp_gain", f"""
SELECT utt_id, {micro('list_transform(audio, lambda x: x * v)')} AS samples
FROM (SELECT *, {volume('utt_id', '0')} AS v FROM {_D})""")
sql("dsp_trim", f"SELECT utt_id, coalesce({micro('audio[utt_id % 70 + 1:]')}, '') AS samples FROM {_D}")
sql("dsp_silence", f"""
SELECT utt_id, {micro('list_concat(list_transform(range(utt_id % 50), lambda x: 0e0), audio)')} AS samples FROM {_D}""")
sql("dsp_power", f"SELECT utt_id, round(list_sum(list_transform(audio, lambda x: x * x)) / len(audio), 9) AS power FROM {_D}")
sql("dsp_peak", f"SELECT utt_id, round(list_max(list_transform(audio, lambda x: abs(x))), 9) AS peak FROM {_D}")
_LOUD = f"(SELECT utt_id, list_transform(audio, lambda x: x * 3e0) AS audio FROM {_D})"


def _limited(array: str) -> str:
    """Divide by the peak if it exceeds 1; the peak is bound once per row."""
    peak = f"greatest(1e0, list_max(list_transform({array}, lambda y: abs(y))))"
    return f"list_transform([{peak}], lambda top: list_transform({array}, lambda x: x / top))[1]"


sql("dsp_normalize", f"SELECT utt_id, {micro(_limited('audio'))} AS samples FROM {_LOUD}")
sql("dsp_duration", f"SELECT utt_id, {seconds('len(audio) * (utt_id % 25 + 1)')} AS duration FROM ({WAVES})")
sql("dsp_pcm16", f"""
SELECT utt_id, {micro('list_transform(audio, lambda x: greatest(-32768e0, least(32767e0, round(x * 32767e0))) / 32768e0)')} AS samples
FROM {_LOUD}""")
sql("dsp_snr_mix", f"""
WITH pair AS (
  SELECT s.utt_id, s.audio AS sig, n.audio AS noi, {span(u('snr', 's.utt_id'), 10, 30)} AS wanted,
    list_avg(list_transform(s.audio, lambda x: x * x)) AS ps, list_avg(list_transform(n.audio, lambda x: x * x)) AS pn
  FROM {_D} s JOIN {_D} n ON n.utt_id = s.utt_id + 1),
mixed AS (
  SELECT *, list_transform(sig, lambda x, i: x + noi[i] * sqrt(ps / pow(10e0, wanted / 10e0) / pn)) AS mix FROM pair)
SELECT utt_id, round(wanted, 6) AS wanted, round(wanted, 6) AS reached, {micro(_limited('mix'))} AS samples FROM mixed""")


def _wave_sql(k: Knobs) -> str:
    """Waveforms chunk by chunk: silence, simultaneous mix, segment with its overlapped tail."""
    return with_(turns(WAVES, k) + f""",
heard AS (
  SELECT t.*, {volume('t.track_id', 't.spk', k)} AS v, a.audio::DOUBLE[] AS own, b.audio::DOUBLE[] AS other,
    CASE WHEN t.kind = 'simultaneous' THEN {volume('t.track_id', 't.sim_spk', k)} END AS v2
  FROM turns t JOIN utt a ON a.utt_id = t.utt_id LEFT JOIN utt b ON b.utt_id = t.sim_utt_id),
segs AS (
  SELECT track_id, turn, list_transform(own[coalesce(sim_samples, 0) + 1:], lambda x: x * v) AS chunk,
    lead(CASE WHEN kind = 'overlap' THEN ov_pct END) OVER w AS next_pct,
    lead(list_transform(own, lambda x: x * v)) OVER w AS next_full
  FROM heard WHERE spoken WINDOW w AS (PARTITION BY track_id ORDER BY turn)),
tails AS (
  SELECT *, CASE WHEN next_pct IS NULL THEN 0
    ELSE least(trunc(len(chunk) * next_pct)::BIGINT, len(chunk), len(next_full)) END AS m FROM segs),
chunks AS (
  SELECT track_id, turn, 0 AS pos, list_transform(range(pause), lambda x: 0e0) AS chunk FROM heard WHERE pause > 0
  UNION ALL
  SELECT track_id, turn, 1, {_limited('mixed')} FROM (
    SELECT track_id, turn, list_transform(own[:sim_samples], lambda x, i: (x * v + other[i] * v2) / 2e0) AS mixed
    FROM heard WHERE kind = 'simultaneous')
  UNION ALL
  SELECT track_id, turn, 2, list_transform(chunk,
    lambda x, i: CASE WHEN i > len(chunk) - m THEN (x + next_full[i - len(chunk) + m]) / 2e0 ELSE x END) FROM tails),
whole AS (SELECT track_id, flatten(list(chunk ORDER BY turn, pos)) AS audio FROM chunks GROUP BY 1)""",
        f"SELECT track_id, {micro('list_transform(' + _limited('audio') + ', lambda z: z::FLOAT)')} AS samples FROM whole")


sql("dsp_concat", _wave_sql(PLAIN))
sql("dsp_overlap", _wave_sql(OVERLAP))
sql("dsp_simultaneous", _wave_sql(LOUD))
sql("track_waveforms", with_(turns(WAVES, NOISY), """
SELECT track_id, max(cum_after) AS n_samples, any_value(round(snr_db, 6)) AS snr, true AS within_range
FROM turns JOIN spec USING (track_id) GROUP BY track_id"""))

_NOISY = turns(WAVES, NOISY)
sql("dataset_written", with_(_NOISY, f"""
SELECT track_id, pattern AS conversation_type, n AS num_speakers,
  {_difficulty('n', 'has_o', 'has_s', 'want_noise', 'mean')} AS difficulty, noise_type,
  round(round(snr_db, 2), 1) AS snr, total AS n_samples, n_segments
FROM (
  SELECT track_id, max(cum_after) AS total, count(DISTINCT spk) FILTER (spoken) AS n, count(*) FILTER (spoken) AS n_segments,
    bool_or(kind = 'overlap') AS has_o, bool_or(kind = 'simultaneous') AS has_s, 2.0 AS mean
  FROM turns GROUP BY 1) JOIN spec USING (track_id)"""))


sql("generate_with_failures", with_(_NOISY, """
SELECT track_id, coalesce(reason, 'good') AS status, CASE WHEN reason IS NULL THEN total END AS n_samples
FROM (SELECT track_id, max(cum_after)::BIGINT AS total FROM turns GROUP BY 1) LEFT JOIN (
  SELECT track_id, min(CASE WHEN utt_id % 89 <> 0 OR utt_id % 97 = 0 OR utt_id % 101 = 0 THEN 'audio missing' ELSE 'audio too short' END) AS reason
  FROM (
    SELECT track_id, utt_id, n_samples AS needed FROM turns WHERE spoken
    UNION ALL SELECT track_id, utt_id, sim_samples FROM turns WHERE kind = 'simultaneous'
    UNION ALL SELECT track_id, sim_utt_id, sim_samples FROM turns WHERE kind = 'simultaneous')
  WHERE utt_id % 97 = 0 OR utt_id % 101 = 0 OR utt_id % 89 = 0 AND needed > 32
  GROUP BY 1) USING (track_id)"""))


def _hash32(x: str, alias: str) -> str:
    """Nested selects that hash column ``x`` (a 32-bit counter) step by step into ``alias``."""
    mult = "(({0})::HUGEINT * {1} % 4294967296)::BIGINT"
    return (f"SELECT * EXCLUDE (h4), xor(h4, h4 >> 16) AS {alias} FROM (SELECT * EXCLUDE (h3), {mult.format('xor(h3, h3 >> 15)', 0x846CA68B)} AS h4 "
            f"FROM (SELECT *, {mult.format(f'xor({x}, {x} >> 16)', 0x7FEB352D)} AS h3 FROM ")


def _uniform(source: str, stream: int, alias: str) -> str:
    """Two rounds of hashing; the parts of the key enter by exclusive or, one before each round."""
    counter = f"((i::HUGEINT * {0x9E3779B9} + {stream * 0x85EBCA6B}) % 4294967296)::BIGINT"
    first = f"(SELECT *, xor({counter}, key >> 32) AS x0 FROM ({source}))"
    second = f"(SELECT * EXCLUDE (ha), xor(ha, key & 4294967295) AS x1 FROM ({_hash32('x0', 'ha')}{first}))))"
    return f"SELECT * EXCLUDE (x0, x1, hh), hh AS {alias}_h, (hh + 0.5e0) / 4294967296e0 AS {alias} FROM ({_hash32('x1', 'hh')}{second})))"


_CLIPS = f"""SELECT conv_id, turn, n, key, unnest(range(n)) AS i FROM (
  SELECT conv_id, turn, length(text) AS n, ('0x' || substr({md5('clip', 'conv_id', 'turn')}, 1, 15))::BIGINT AS key FROM conversations)"""


def _gauss(radius: int, angle: int, alias: str, source: str) -> str:
    inner = _uniform(_uniform(source, radius, "ua"), angle, "ub")
    return f"SELECT * EXCLUDE (ua, ub, ua_h, ub_h), sqrt(-2e0 * ln(ua)) * cos(2e0 * pi() * ub) AS {alias} FROM ({inner})"


def _clip_sql(ctes: str, source: str) -> str:
    return f"""WITH RECURSIVE {ctes}
SELECT conv_id, turn, n, string_agg((round(x / CASE WHEN top > 0 THEN top ELSE 1 END * 1e6)::BIGINT)::VARCHAR, ',' ORDER BY i) AS samples
FROM (SELECT *, max(abs(x)) OVER (PARTITION BY conv_id, turn) AS top FROM {source}) GROUP BY 1, 2, 3"""


_WHITE = f"white AS ({_gauss(0, 1, 'x', _CLIPS)})"
_FORWARD = " + ".join(
    f"({c}) * lag(w, {j}) OVER q" if j else f"{c} * w"
    for j, c in enumerate((0.99886, 0.99332, 0.969, 0.8665, 0.55, 0.7616, -0.0036))
)
_PINK = f"""pwhite AS ({_gauss(6, 7, 'w', _CLIPS)}),
fir AS (SELECT conv_id, turn, n, i, {_FORWARD} AS f FROM pwhite WINDOW q AS (PARTITION BY conv_id, turn ORDER BY i)),
feed AS (
  SELECT conv_id, turn, n, 5::BIGINT AS i, 0e0 AS x, 0e0 AS p2, 0e0 AS p3, 0e0 AS p4, 0e0 AS p5
  FROM fir WHERE i = 0
  UNION ALL
  SELECT p.conv_id, p.turn, p.n, f.i,
    f.f + 0.49448 * p.x - 0.01681 * p.p2 - 0.00972 * p.p3 - 0.00001 * p.p4 + 0.0036 * p.p5, p.x, p.p2, p.p3, p.p4
  FROM feed p JOIN fir f ON f.conv_id = p.conv_id AND f.turn = p.turn AND f.i = p.i + 1),
pink AS (
  SELECT conv_id, turn, n, i, x FROM feed WHERE i > 5
  UNION ALL SELECT conv_id, turn, n, i, 0e0 FROM fir WHERE i <= 5)"""
sql("noise_white", _clip_sql(_WHITE, "white"))
sql("noise_pink", _clip_sql(_PINK, "pink"))
sql("noise_brown", _clip_sql(
    _WHITE + ", brown AS (SELECT conv_id, turn, n, i, sum(x) OVER (PARTITION BY conv_id, turn ORDER BY i) AS x FROM white)",
    "brown"))
sql("noise_crowd", _clip_sql(_WHITE + ", " + _PINK + """,
crowd AS (
  SELECT conv_id, turn, n, i, 0.7 * w.x + 0.3 * p.x / CASE WHEN p.top > 0 THEN p.top ELSE 1 END AS x
  FROM white w JOIN (SELECT *, max(abs(x)) OVER (PARTITION BY conv_id, turn) AS top FROM pink) p USING (conv_id, turn, n, i))""",
    "crowd"))
sql("noise_static", _clip_sql(f"""white AS ({_uniform(_uniform(_uniform(_gauss(0, 1, 'z', _CLIPS), 2, 'place'), 3, 'side'), 4, 'height')}),
crackle AS (
  SELECT conv_id, turn, n, i, CASE WHEN nth <= n // 100
    THEN (CASE WHEN side < 0.5 THEN -1 ELSE 1 END) * (2e0 + 3e0 * height) ELSE z END AS x
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY place_h) AS nth FROM white))""", "crackle"))
sql("noise_hum", _clip_sql(f"""clips AS ({_CLIPS}),
pitch AS (SELECT conv_id, turn, 50e0 + (2e0 * p - 1e0) * 5e0 AS hz FROM ({_uniform('SELECT conv_id, turn, key, i FROM clips WHERE i = 0', 5, 'p')})),
hum AS (
  SELECT conv_id, turn, n, i, sin(a) + 0.3 * sin(2 * a) + 0.1 * sin(3 * a) AS x
  FROM (SELECT *, 2e0 * pi() * hz * (i / 16000e0) AS a FROM clips JOIN pitch USING (conv_id, turn)))""", "hum"))

sql("noise_custom", _clip_sql(f"""clips AS ({_CLIPS}),
square AS (SELECT conv_id, turn, n, i, CASE WHEN (i // 8 + key) % 2 = 0 THEN 0.5e0 ELSE -0.5e0 END AS x FROM clips)""", "square"))

# --- sinks and the rest -------------------------------------------------------------------------------------------

_CONV = f"{SEGMENTS}{CONVERSATION_TURNS}, {spec_from('SELECT DISTINCT conv_id AS track_id FROM conversations').strip()}"
sql("snk_parquet_roundtrip", f"WITH {_CONV} {flat_rows('cturns')}")
sql("snk_schema_project", f"WITH {_CONV} {flat_rows('cturns', noise=False)}")
sql("snk_shard_assign", f"""WITH {SEGMENTS},
size AS (SELECT track_id, (sum(n_samples) * 2 + 1044)::BIGINT AS bytes FROM seg GROUP BY 1),
room AS (SELECT 16777216 - coalesce(max(bytes), 0) AS room FROM size WHERE bytes <= 8388608),
run AS (SELECT *, coalesce(sum(CASE WHEN bytes <= 8388608 THEN bytes ELSE 0 END) OVER (
    ORDER BY track_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
    coalesce(sum(CASE WHEN bytes > 8388608 THEN 1 ELSE 0 END) OVER (
    ORDER BY track_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS big,
    sum(CASE WHEN bytes <= 8388608 THEN bytes ELSE 0 END) OVER ()::BIGINT AS small FROM size)
SELECT track_id, bytes, (CASE WHEN bytes <= 8388608 THEN before // room ELSE small // room + 1 + big END)::BIGINT AS shard
FROM run, room""")
sql("snk_jsonl_metadata", f"""WITH {_CONV}
SELECT track_id, duration, printf('audio/track-%05d.wav', row_number() OVER (ORDER BY track_id) - 1) AS audio_path,
  text AS first_text, noise_type IS NOT NULL AS names_noise
FROM ({flat_rows('cturns')}) JOIN (SELECT track_id, arg_min(text, seg_idx) AS text FROM seg GROUP BY 1) USING (track_id)""")
sql("snk_audio_path", """
SELECT c_custkey::BIGINT AS track_id, printf('audio/track-%05d.wav', row_number() OVER (ORDER BY c_custkey) - 1) AS audio_path
FROM customer WHERE c_acctbal > 0""")
sql("snk_wav_files", """
SELECT vec_id AS track_id, printf('audio/track-%05d.wav', row_number() OVER (ORDER BY vec_id) - 1) AS audio_path,
  (44 + 2 * len(embedding))::BIGINT AS bytes FROM embeddings""")
sql("snk_batch_manifest", """
WITH b AS (SELECT c_custkey::BIGINT AS track_id, trunc(c_acctbal * 100)::BIGINT AS cents,
  ((row_number() OVER (ORDER BY c_custkey) - 1) // 50 + 1)::BIGINT AS batch_no FROM customer)
SELECT track_id, batch_no FROM b WHERE batch_no IN (SELECT batch_no FROM b GROUP BY 1 HAVING sum(cents) > 20000000)""")
_LEDGER = """
run AS (SELECT *, row_number() OVER (ORDER BY track_id) - 1 AS track_no,
  coalesce(sum(CASE WHEN bytes <= {limit} THEN bytes ELSE 0 END) OVER (ORDER BY track_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
  sum(CASE WHEN bytes <= {limit} THEN 0 ELSE 1 END) OVER (ORDER BY track_id) AS large FROM size),
placed AS (SELECT track_id, (CASE WHEN bytes <= {limit} THEN before // {room} ELSE -large END)::BIGINT AS shard, track_no::BIGINT AS track_no,
  printf('audio/track-%05d.wav', track_no) AS audio_path FROM run)"""
sql("snk_ledger", f"""WITH {_CONV},
size AS (SELECT track_id, (sum(n_samples) * 2 + 1044)::BIGINT AS bytes FROM seg GROUP BY 1),
{_LEDGER.format(limit=524288, room=4194304 - 524288).strip()},
total AS (SELECT count(DISTINCT track_id) AS n FROM seg)
SELECT track_id, (CASE WHEN track_id < n // 3 THEN 0 WHEN track_id < n // 2 THEN 2 WHEN track_id < n // 2 + 1 THEN 3 ELSE 4 END)::BIGINT AS batch_no,
  shard, track_no, audio_path, duration FROM placed JOIN ({flat_rows('cturns')}) USING (track_id), total""")
sql("snk_replace", f"""WITH {_CONV}, dur AS (SELECT track_id, duration FROM ({flat_rows('cturns')}))
SELECT track_id, duration, 'former' AS version FROM dur WHERE track_id % 2 = 0 UNION ALL SELECT track_id, duration, 'new' FROM dur""")
sql("snk_layout", """
SELECT 'ZSTD' AS codecs, count(DISTINCT conv_id)::BIGINT AS tracks, true AS dictionaries, true AS groups_bounded FROM conversations""")
sql("src_damaged", """
SELECT vec_id AS utt_id, label::VARCHAR AS speaker_id, NULL::VARCHAR AS damaged FROM embeddings
UNION ALL SELECT NULL, NULL, unnest(['truncated: no readable footer', 'other: no readable footer'])""")
sql("agg_speaker_sketch", f"""
SELECT count(DISTINCT speaker_id)::BIGINT AS n_exact, count(*)::BIGINT AS n_utterances, true AS within_bound FROM ({EVENTS})""")
sql("dsp_concat_bucketed", _SQL["dsp_concat"])
sql("str_published", with_(_DOC, f""", size AS (SELECT track_id, (max(cum_after) * 2 + 1044)::BIGINT AS bytes FROM turns GROUP BY 1),
{_LEDGER.format(limit=4194304, room=33554432 - 4194304).strip()}
SELECT track_id, shard, track_no, audio_path, duration, num_speakers FROM placed JOIN ({flat_rows('turns')}) USING (track_id)"""))
sql("snk_text_default", """
SELECT conv_id AS track_id, turn, CASE WHEN turn % 2 = 0 THEN text ELSE '' END AS text FROM conversations""")
sql("scalar_suite", f"""
SELECT utt_id, {seconds('n_samples')} AS seconds, {whole('x * 1.5e0')} AS truncated,
  round(pow(10e0, x / 100e0), 6) AS power_of_ten, round(log10(x), 6) AS log10, round(sqrt(x), 6) AS root,
  round(sin(x * 2e0 * pi()), 6) AS sine, abs(n_samples - 16000) AS distance,
  least(n_samples, 16000) AS at_most, greatest(n_samples, 16000) AS at_least,
  printf('track-%05d.wav', utt_id) AS file_name, {_TWO.format(centis('n_samples'))} AS two_decimals,
  starts_with(speaker_id, 'src1') AS starts, ends_with(speaker_id, '1') AS ends, speaker_id AS via_json,
  CASE WHEN speaker_id = 'src0' THEN '' ELSE speaker_id END AS with_default
FROM (SELECT *, n_samples / 16000e0 AS x FROM ({DOCUMENTS}))""")
