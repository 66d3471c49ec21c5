"""Speaker pools: the utterances each speaker of a track may use.

No candidate lists are formed. Utterances are numbered once (over the dataset and within their speaker);
a slot then draws distinct *positions* and fetches them with one equi-join. The join key includes
the position, so a speaker that owns a third of the data is spread over all partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rng
from ..params import TrackParams
from ..session import by_track
from ..sources.utterances import usable
from .numbering import running_totals
from .specs import with_spec

_ALL, _SHORT = 0, 1
#: Tracks whose pools a task draws, about.
_TASK_TRACKS = 20_000


def utterance_index(utterances: DataFrame, p: TrackParams) -> DataFrame:
    """Number the usable utterances; the one frame the planner needs of the source.

    ``utt_no`` counts over the dataset, ``s_rank`` within the speaker, ``short_rank`` among the short
    ones of the speaker, ``all_short_rank`` among all short ones. ``*_total`` are the group sizes.
    """
    narrow = usable(utterances, p.null_speaker).select("utt_id", "speaker_id", "n_samples")
    narrow = narrow.withColumn("is_short", F.col("n_samples") <= p.short_max_samples)
    one, short = F.lit(1), F.col("is_short").cast("int")
    return running_totals(narrow, "utt_id", p.id_block, {
        "utt_no": ((), one),
        "all_short_rank": ((), short),
        "s_rank": (("speaker_id",), one),
        "short_rank": (("speaker_id",), short),
    })


def sample_utterances(df: DataFrame, index: DataFrame, n: Column, p: TrackParams) -> DataFrame:
    """Give each track ``n`` distinct utterance numbers in random order, as rows ``(…, spk, utt_no)``.

    Tracks that ask for more utterances than there are get none.
    """
    available = index.agg(F.count("*")).scalar()
    counted = df.withColumn("_available", available).where(n <= F.col("_available"))
    picked = rng.distinct_below(
        F.col("_available"), n, lambda i: rng.wide01(p.seed, "seed", "track_id", i)
    )
    keyed = F.transform(
        picked, lambda x: F.struct(rng.digest(p.seed, "slot", "track_id", x).alias("k"), x.alias("utt_no"))
    )
    return counted.select(
        *df.columns, F.posexplode(F.array_sort(keyed)).alias("spk", "_slot")
    ).select(*df.columns, F.col("spk").cast("bigint").alias("spk"), F.col("_slot.utt_no").alias("utt_no"))


def slot_volume(p: TrackParams, track_id: Column | str, spk: Column | str) -> Column:
    """Volume of a speaker position: a function of the track and the position, so never joined back."""
    return rng.between(rng.uniform01(p.seed, "volume", track_id, spk), p.volume_min, p.volume_max)


def speaker_slots(requests: DataFrame, index: DataFrame, p: TrackParams) -> DataFrame:
    """One row per (track, speaker position): the seed utterance, its speaker and a volume."""
    n_tracks = requests.count()
    wanted = with_spec(by_track(requests.select("track_id"), rows=n_tracks, task_rows=_TASK_TRACKS), p).select("track_id", "use_short", "n_spk")
    slots = sample_utterances(wanted, index, F.col("n_spk"), p)
    # dealt anew: the join leaves few partitions, as its rows are narrow, but each of them becomes a pool
    found = by_track(slots.join(index, "utt_no"), rows=n_tracks, task_rows=_TASK_TRACKS)
    return found.withColumn("volume", slot_volume(p, "track_id", "spk"))


def _draws(slots: DataFrame, p: TrackParams) -> DataFrame:
    """Positions of each slot's pool: the seed's own at rank 0, then the drawn ones.

    Positions count within the speaker (within the dataset for a seed without speaker), among all utterances or
    among the short ones.
    """
    anyone = F.col("speaker_id").isNull()
    n_all = F.when(anyone, F.col("utt_no_total")).otherwise(F.col("s_rank_total"))
    n_short = F.when(anyone, F.col("all_short_rank_total")).otherwise(F.col("short_rank_total"))
    own_all = F.when(anyone, F.col("utt_no")).otherwise(F.col("s_rank"))
    own_short = F.when(anyone, F.col("all_short_rank")).otherwise(F.col("short_rank"))
    short_left = n_short - F.col("is_short").cast("int")
    out = slots.withColumn("_kind", F.when(F.col("use_short") & (short_left > 0), _SHORT).otherwise(_ALL))
    short = F.col("_kind") == _SHORT
    out = out.withColumns({
        "_n": F.when(short, short_left).otherwise(n_all - 1),
        "_own": F.when(~short, own_all).when(F.col("is_short"), own_short),
        "_seed": own_all,
    })
    out = out.withColumn("_k", F.least(F.lit(p.target_count).cast("bigint"), F.col("_n")))
    picked = rng.bind(
        rng.wide_digests(p.seed, "pool", p.target_count, "track_id", "spk"),
        lambda many: rng.distinct_below(F.col("_n"), F.col("_k"), lambda i: rng.wide_nth(many, i)),
    )

    def place(rank: Column, kind: Column, position: Column) -> Column:
        return F.struct(
            rank.cast("bigint").alias("pool_rank"), kind.cast("int").alias("kind"), position.cast("bigint").alias("position")
        )

    others = F.transform(
        picked, lambda x, i: place(i + 1, F.col("_kind"), x + F.when(x >= F.col("_own"), 1).otherwise(0))
    )
    seed = F.array(place(F.lit(0), F.lit(_ALL), F.col("_seed")))
    return out.select("track_id", "spk", "speaker_id", F.inline(F.concat(seed, others)))


def _members(index: DataFrame, by_all: str, by_short: str, *keys: str) -> DataFrame:
    """Each utterance under its position among all and, if short, among the short ones."""
    places = F.array(
        F.struct(F.lit(_ALL).alias("kind"), F.col(by_all).alias("position")),
        F.when(F.col("is_short"), F.struct(F.lit(_SHORT).alias("kind"), F.col(by_short).alias("position"))),
    )
    return index.select(
        *keys, "utt_id", "n_samples", F.explode(F.array_compact(places)).alias("_p")
    ).select(*keys, "utt_id", "n_samples", "_p.kind", "_p.position")


def build_pools(slots: DataFrame, index: DataFrame, p: TrackParams) -> DataFrame:
    """Pools ``(track_id, spk, pool_rank, utt_id, n_samples)``: the seed at rank 0 and up to
    ``target_count`` other utterances of its speaker (short ones only, if wanted and there are any).
    """
    columns = ["track_id", "spk", "pool_rank", "utt_id", "n_samples"]
    draws = _draws(slots, p)
    pools = draws.where(F.col("speaker_id").isNotNull()).join(
        _members(index.where(F.col("speaker_id").isNotNull()), "s_rank", "short_rank", "speaker_id"),
        ["speaker_id", "kind", "position"],
    ).select(*columns)
    if p.null_speaker == "any":
        anyone = draws.where(F.col("speaker_id").isNull()).join(
            _members(index, "utt_no", "all_short_rank"), ["kind", "position"]
        )
        pools = pools.unionByName(anyone.select(*columns))
    return pools


def short_or_all(utterances: DataFrame, max_samples: int) -> DataFrame:
    """Short utterances of each speaker; all of them for a speaker without any."""
    filled = utterances.where(F.col("n_samples") > 0)
    short = filled.where(F.col("n_samples") <= max_samples)
    without = filled.join(short.select("speaker_id").distinct(), "speaker_id", "left_anti")
    return short.unionByName(without.select(*short.columns))


def speaker_index(utterances: DataFrame, chunk: int = 10_000) -> DataFrame:
    """Utterance ids of each speaker in dataset order, in pieces of at most ``chunk`` ids.

    A piece covers one id range, so its list is bounded however much one speaker owns.
    """
    return utterances.groupBy(
        "speaker_id", F.floor(F.col("utt_id") / chunk).cast("bigint").alias("chunk")
    ).agg(F.sort_array(F.collect_list("utt_id")).alias("utt_ids"))


def unique_speakers(utterances: DataFrame, approximate: bool = False) -> DataFrame:
    """Number of speakers; a missing speaker counts as one."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return utterances.agg(
        (count("speaker_id") + F.max(F.col("speaker_id").isNull().cast("int"))).cast("bigint").alias("n_speakers")
    )
