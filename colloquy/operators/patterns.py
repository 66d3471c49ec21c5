"""Who speaks next, as window expressions over the turns of a track.

A pattern says three things about a turn: whether it may extend a run (``flag``), how far the
speaker moves (``step``, given the position in the run), and who speaks (``speaker``, given position and
the running sum of steps). The reference order of speech is a small state machine whose only memory is
the parity of the current run and the walk so far, so two windows over (track, turn) replace it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rng
from ..session import by_track

# Chance that the interviewer asks again, that a group speaker goes on; speaker counts.
ASK_AGAIN = 0.8
GO_ON = 0.3
OTHER_SPEAKERS = (2, 4)


@dataclass(frozen=True)
class Turn:
    """Columns a pattern may use."""

    turn: Column
    n: Column
    u: Column
    v: Column
    run: Column
    walk: Column


@dataclass(frozen=True)
class Pattern:
    speakers: tuple[int, int]
    speaker: Callable[[Turn], Column]
    flag: Callable[[Turn], Column] = lambda t: F.lit(False)
    step: Callable[[Turn], Column] = lambda t: F.lit(0).cast("bigint")


_PATTERNS: dict[str, Pattern] = {}


def register(name: str, pattern: Pattern) -> None:
    """Make a pattern available by name."""
    _PATTERNS[name] = pattern


def unregister(name: str) -> None:
    """Forget a pattern."""
    _PATTERNS.pop(name, None)


class _SpeakerRange:
    other = OTHER_SPEAKERS

    @staticmethod
    def known() -> dict[str, tuple[int, int]]:
        return {name: p.speakers for name, p in _PATTERNS.items()}


speaker_range = _SpeakerRange()


def _odd(c: Column) -> Column:
    return c % 2 == 1


register("monologue", Pattern((1, 1), lambda t: F.lit(0).cast("bigint")))
register("dialogue", Pattern((2, 2), lambda t: t.turn % 2))
register("interview", Pattern(
    (2, 2),
    flag=lambda t: (t.turn >= 2) & (t.u < F.lit(ASK_AGAIN)),
    speaker=lambda t: F.when(t.turn < 2, t.turn).when(_odd(t.run), 0).otherwise(1).cast("bigint"),
))
register("group_discussion", Pattern(
    (3, 4),
    flag=lambda t: (t.turn >= t.n) & (t.u < F.lit(GO_ON)),
    step=lambda t: F.when((t.turn < t.n) | _odd(t.run), 0).otherwise(rng.below(t.v, t.n - 1) + 1).cast("bigint"),
    speaker=lambda t: F.when(t.turn < t.n, t.turn).otherwise((t.n - 1 + t.walk) % t.n).cast("bigint"),
))


def _by_name(get: Callable[[Pattern], Column]) -> Column:
    chain = None
    for name, pattern in _PATTERNS.items():
        chain = (F if chain is None else chain).when(F.col("pattern") == name, get(pattern))
    return chain.otherwise(F.raise_error(F.concat(F.lit("unknown pattern: "), F.col("pattern"))))


def assign_speakers(turns: DataFrame) -> DataFrame:
    """Add ``spk`` to turns ``(track_id, turn, pattern, n_spk, u, v)``; one exchange, one sort."""
    order = Window.partitionBy("track_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    t = Turn(F.col("turn"), F.col("n_spk"), F.col("u"), F.col("v"), F.col("_run"), F.col("_walk"))
    out = turns.withColumn("_flag", _by_name(lambda p: p.flag(t)))
    last_break = F.coalesce(F.max(F.when(~F.col("_flag"), F.col("turn"))).over(order), F.lit(-1))
    out = out.withColumn("_run", F.col("turn") - last_break)
    out = out.withColumn("_step", _by_name(lambda p: p.step(t)))
    out = out.withColumn("_walk", F.sum("_step").over(order))
    return out.withColumn("spk", _by_name(lambda p: p.speaker(t))).drop("_flag", "_run", "_step", "_walk")


def assign_speakers_sequential(
    turns: DataFrame, choose: Callable[[int, int, float, float, list[int]], int]
) -> DataFrame:
    """Extension point for an order of speech that has no window form.

    ``choose(turn, n_spk, u, v, spoken)`` returns the next speaker; ``spoken`` is the list so far. Turns are partitioned by
    track and sorted; they pass in batches, whatever the number of tracks, and the list goes on from one batch to the next.
    """
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in turns.schema.fields)

    def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        track, spoken = object(), []
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("track_id", "turn", "n_spk", "u", "v")]
            chosen = []
            for own, *values in zip(*columns):
                if own != track:
                    track, spoken = own, []
                spoken.append(int(choose(*[math.nan if x is None else x for x in values], spoken)))
                chosen.append(spoken[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chosen, pa.int64())], [*batch.schema.names, "spk"])

    ordered = by_track(turns).sortWithinPartitions("track_id", F.asc_nulls_last("turn"))
    return ordered.mapInArrow(in_order, f"{fields}, spk bigint")
