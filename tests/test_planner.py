"""The windowed planner against a plain loop, and its edge cases."""

import random

import pytest
from pyspark.sql import functions as F

from colloquy.operators import labels, turns as planner
from colloquy.operators.patterns import Pattern, assign_speakers, assign_speakers_sequential, register
from colloquy.params import TrackParams
from colloquy.plans.tracks import plan
from colloquy.sources import adapters

P = TrackParams()


def loop(rows, target, reserve):
    """One track, one turn at a time: (kind, n_samples, sim_samples or None, drawn pause) to placed turns."""
    cum, since, out = 0, None, []
    for turn, (n, together, overlap, pause) in enumerate(rows):
        if cum >= target:
            break
        recent = since is not None and since < 5
        if turn == 0:
            kind, used = "plain", 0
        elif together is not None and recent:
            kind, used = "simultaneous", 0
        elif overlap:
            kind, used = "overlap", 0
        else:
            kind, used = "pause", pause
            if cum + pause > target - reserve:
                left = target - cum
                used = min(pause, left - reserve) if left > reserve else 0
        swallowed = kind == "simultaneous" and together >= n
        since = (since or 0) + 1 if swallowed else 0
        out.append((turn, kind, used, cum, cum + used + n))
        cum += used + n
    return out


def spark_side(spark, tracks, target, reserve, monkeypatch):
    """The same inputs through ``decide_kinds`` and ``timeline``, with the draws replaced."""
    data = [
        (t, i, n, together, overlap, pause, target)
        for t, rows in enumerate(tracks) for i, (n, together, overlap, pause) in enumerate(rows)
    ]
    frame = spark.createDataFrame(
        data, "track_id bigint, turn bigint, n_samples bigint, sim_samples bigint, _ov boolean, _pause bigint, target_samples bigint"
    ).withColumns({"sim_spk": F.lit(1).cast("bigint"), "sim_utt_id": F.lit(1).cast("bigint")})
    # lane 0 decides on overlap, lane 2 on a long pause, lane 3 gives the length in [200, 1200) ms
    lanes = {
        0: F.when(F.col("_ov"), 0.0).otherwise(0.99), 1: F.lit(0.5), 2: F.lit(0.99),
        3: (F.col("_pause") / 16.0 + 0.001 - 200.0) / 1000.0,
    }
    monkeypatch.setattr(planner.rng, "digest", lambda *a: F.lit(""))
    monkeypatch.setattr(planner.rng, "lane", lambda d, i=0: lanes[i])
    p = TrackParams(end_reserve=reserve)
    placed = planner.timeline(planner.decide_kinds(frame, p), p).select(
        "track_id", "turn", "kind", "pause", "cum_before", "cum_after"
    ).collect()
    out = [[] for _ in tracks]
    for r in sorted(placed, key=lambda r: (r.track_id, r.turn)):
        out[r.track_id].append((r.turn, r.kind, r.pause, r.cum_before, r.cum_after))
    return out


def test_random_tracks_match_a_loop(spark, monkeypatch):
    rnd = random.Random(7)
    target, reserve, tracks = 120_000, 1000, []
    for _ in range(400):
        simultaneous, short = rnd.random() < 0.5, rnd.random() < 0.5
        rows = []
        for turn in range(60):
            n = rnd.randint(2000, 6000 if short else 30_000)
            together = min(n, rnd.randint(1500, 20_000)) if simultaneous and turn > 0 else None
            rows.append((n, together, rnd.random() < 0.3, rnd.randint(3200, 19_000)))
        tracks.append(rows)
    assert spark_side(spark, tracks, target, reserve, monkeypatch) == [loop(t, target, reserve) for t in tracks]


@pytest.mark.parametrize("left", [999, 1000, 1001, 5000])
def test_pause_is_clamped_near_the_end(spark, monkeypatch, left):
    target = 50_000
    tracks = [[(target - left, None, False, 4000), (500, None, False, 4000), (700, None, False, 4000), (9000, None, False, 4000)]]
    got = spark_side(spark, tracks, target, 1000, monkeypatch)
    assert got == [loop(tracks[0], target, 1000)]
    assert got[0][1][2] == max(0, min(4000, left - 1000))


@pytest.mark.parametrize("length", [4, 5, 6, 11, 12, 13])
def test_runs_of_swallowed_blocks(spark, monkeypatch, length):
    rows = [(3000, None, False, 4000)] + [(3000, 3000, False, 4000)] * length + [(3000, 1000, True, 4000)] * 3
    got = spark_side(spark, [rows], 10**6, 1000, monkeypatch)
    assert got == [loop(rows, 10**6, 1000)]


def test_planned_tracks_hold_together(spark, small):
    made = plan(adapters.event_utterances(spark, small), adapters.track_requests(spark, small), P)
    pools = made.pools.collect()
    members = {}
    for r in pools:
        members.setdefault((r.track_id, r.spk), set()).add(r.utt_id)
    assert all(len(m) <= 31 for m in members.values())
    assert len(pools) == sum(len(m) for m in members.values())
    by_track = {}
    for r in made.turns.collect():
        by_track.setdefault(r.track_id, []).append(r)
    assert set(by_track) == {r.track_id for r in made.requests.collect()}
    for rows in by_track.values():
        rows.sort(key=lambda r: r.turn)
        assert [r.turn for r in rows] == list(range(len(rows)))
        assert rows[0].cum_before == 0
        assert all(a.cum_after == b.cum_before for a, b in zip(rows, rows[1:]))
        assert rows[-1].cum_before < rows[-1].target_samples <= rows[-1].cum_after
        seen = {}
        for r in rows:
            pool, used = members[(r.track_id, r.spk)], seen.setdefault(r.spk, [])
            assert r.utt_id in pool
            lap = used[len(used) - len(used) % len(pool):]
            assert r.utt_id not in lap
            used.append(r.utt_id)
        if rows[0].pattern == "dialogue":
            assert [r.spk for r in rows] == [r.turn % 2 for r in rows]
        if rows[0].pattern == "group_discussion":
            said = [r.spk for r in rows]
            assert all(len(set(said[i:i + 3])) > 1 for i in range(len(said) - 2))


def test_partitioning_does_not_change_tracks(spark, small):
    requests = adapters.track_requests(spark, small)

    def result(partitions, block):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        made = plan(adapters.document_utterances(spark, small), requests.repartition(partitions), TrackParams(id_block=block))
        return sorted(map(tuple, made.turns.select("track_id", "turn", "utt_id", "kind", "pause", "cum_after").collect()))

    try:
        assert result(1, 1_000_000) == result(16, 7)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_one_utterance_per_speaker_and_long_utterances(spark):
    """Pools of one are reused; an utterance longer than the target ends the track."""
    utterances = spark.createDataFrame(
        [(0, "a", "x", 40_000), (1, "b", "y", 2_000_000), (2, "c", None, 30_000), (3, "d", "w", 25_000)],
        "utt_id bigint, speaker_id string, text string, n_samples bigint",
    )
    made = plan(utterances, spark.range(60).withColumnRenamed("id", "track_id"), P)
    turns = made.turns.collect()
    assert {r.track_id for r in turns} == set(range(60))
    for r in turns:
        if r.n_samples == 2_000_000:
            assert r.cum_after - r.cum_before >= 2_000_000
    texts = labels.segments(labels.with_text(made.turns, utterances), P).where("text is null").count()
    assert texts > 0


def test_tracks_without_enough_utterances_are_not_produced(spark):
    utterances = spark.createDataFrame([(0, "a", "x", 40_000)], "utt_id bigint, speaker_id string, text string, n_samples bigint")
    made = plan(utterances, spark.range(40).withColumnRenamed("id", "track_id"), P)
    assert {r.pattern for r in made.turns.select("pattern").distinct().collect()} == {"monologue"}


def test_speaker_with_most_of_the_data(spark):
    """A hot speaker: numbering stays exact and pools stay whole."""
    utterances = spark.range(20_000).select(
        F.col("id").alias("utt_id"), F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("speaker_id"),
        F.lit("t").alias("text"), (F.lit(1000) + F.col("id") % 40_000).alias("n_samples"),
    )
    made = plan(utterances, spark.range(100).withColumnRenamed("id", "track_id"), TrackParams(id_block=500))
    index = made.index.where("speaker_id = 'hot'").orderBy("utt_id").collect()
    assert [r.s_rank for r in index] == list(range(len(index)))
    owner = {r.utt_id: r.speaker_id for r in made.index.collect()}
    groups = {}
    for r in made.pools.collect():
        groups.setdefault((r.track_id, r.spk), []).append(r.utt_id)
    assert all(len(g) == 31 and len(set(g)) == 31 and len({owner[u] for u in g}) == 1 for g in groups.values())


def test_custom_patterns(spark):
    register("round_robin", Pattern((3, 3), lambda t: t.turn % t.n))
    frame = spark.range(5).select(
        F.col("id").alias("track_id"), F.lit("round_robin").alias("pattern"), F.lit(3).cast("bigint").alias("n_spk"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(9).cast("bigint"))).alias("turn"), F.lit(0.1).alias("u"), F.lit(0.2).alias("v"),
    )
    windowed = sorted(map(tuple, assign_speakers(frame).select("track_id", "turn", "spk").collect()))

    def choose(turn, n, u, v, spoken):
        return (spoken[-1] + 1) % n if spoken else 0

    looped = sorted(map(tuple, assign_speakers_sequential(frame, choose).select("track_id", "turn", "spk").collect()))
    assert windowed == looped == [(i, t, t % 3) for i in range(5) for t in range(10)]
    with pytest.raises(Exception, match="unknown pattern"):
        assign_speakers(frame.withColumn("pattern", F.lit("none"))).collect()
