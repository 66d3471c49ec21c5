"""Waveforms of planned tracks.

Positions, lengths, gains and overlaps are all decided relationally; audio is joined last and only
the needed slice of each utterance travels to its track. The one imperative step adds slices into a
buffer, one track at a time; a track's buffer is bounded by its target duration plus one utterance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions import kernels, rng
from ..params import TrackParams
from ..session import by_task, by_track, stage, tasks_for, work_path
from ..sources.utterances import at_rate, audio_array
from .labels import has_segment
from .pools import slot_volume
from .specs import with_spec

_BYTES = 4
#: Samples of one batch that leaves a task, about.
_BATCH_SAMPLES = 1 << 22
#: Samples that the pieces of a task hold, about, and its pieces at most.
_TASK_SAMPLES = 1 << 25
_TASK_PIECES = 500_000

_PIECE = (
    ("utt_id", "bigint"), ("position", "bigint"), ("offset", "bigint"), ("length", "bigint"),
    ("gain", "double"), ("half_tail", "bigint"), ("block", "bigint"),
)


def _piece(**values: Column) -> Column:
    fallback = {"offset": 0, "half_tail": 0, "block": -1}
    return F.struct(*[
        (values[name] if name in values else F.lit(fallback[name])).cast(kind).alias(name) for name, kind in _PIECE
    ])


def pieces(turns: DataFrame, p: TrackParams) -> DataFrame:
    """Which slice of which utterance sounds where: one row per slice.

    An overlap averages the end of the previous segment with the start of the next utterance, which is
    then played in full as well.
    """
    trim = F.coalesce(F.col("sim_samples"), F.lit(0))
    order = Window.partitionBy("track_id").orderBy("turn")
    ahead = order.rowsBetween(1, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    t = turns.withColumns({
        "total_samples": F.max("cum_after").over(Window.partitionBy("track_id")),
        "_volume": slot_volume(p, "track_id", "spk"),
        "_length": F.when(has_segment(), F.col("n_samples") - trim),
    })
    segment = F.struct("kind", "ov_pct", F.col("n_samples").alias("n"))
    t = t.withColumns({
        "_next": F.first(F.when(F.col("_length").isNotNull(), segment), ignorenulls=True).over(ahead),
        "_prev": F.last(
            F.when(F.col("_length").isNotNull(), F.struct(F.col("cum_after").alias("end"), F.col("_length").alias("n"))),
            ignorenulls=True,
        ).over(before),
    })

    def shared(previous: Column, percent: Column, following: Column) -> Column:
        return F.least((previous * percent).cast("bigint"), previous, following)

    head = shared(F.col("_prev.n"), F.col("ov_pct"), F.col("n_samples"))
    tail = F.when(
        F.col("_next.kind") == "overlap", shared(F.col("_length"), F.col("_next.ov_pct"), F.col("_next.n"))
    ).otherwise(0)
    simultaneous = F.col("kind") == "simultaneous"
    parts = F.array(
        F.when(F.col("_length").isNotNull(), _piece(
            utt_id=F.col("utt_id"), position=F.col("cum_before") + F.col("pause") + trim, offset=trim,
            length=F.col("_length"), gain=F.col("_volume"), half_tail=tail,
        )),
        F.when((F.col("kind") == "overlap") & (head > 0), _piece(
            utt_id=F.col("utt_id"), position=F.col("_prev.end") - head, length=head, gain=F.col("_volume") / 2.0,
        )),
        F.when(simultaneous, _piece(
            utt_id=F.col("utt_id"), position=F.col("cum_before"), length=F.col("sim_samples"),
            gain=F.col("_volume") / 2.0, block=F.col("turn"),
        )),
        F.when(simultaneous, _piece(
            utt_id=F.col("sim_utt_id"), position=F.col("cum_before"), length=F.col("sim_samples"),
            gain=slot_volume(p, "track_id", "sim_spk") / 2.0, block=F.col("turn"),
        )),
    )
    keys = ["shard"] if "shard" in turns.columns else []
    return t.select(*keys, "track_id", "total_samples", F.inline(F.array_compact(parts)))


def wanted_audio(piece_rows: DataFrame, audio: DataFrame, p: TrackParams) -> DataFrame:
    """The audio rows that some piece needs, at the wanted rate: everything else is left where it is read."""
    ids = piece_rows.select("utt_id").distinct()
    return at_rate(audio, p.sampling_rate).join(ids, "utt_id", "left_semi")


def find_gaps(piece_rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(track_id, reason) of tracks with a piece whose audio is missing or shorter than the piece needs.

    Known before any audio moves, so that such a track reaches neither the mixing nor the data. Stored lengths come from
    a column ``n_samples`` of the audio table where it has one, else the samples are measured where they are read.
    """
    if "n_samples" in wanted.columns:
        stored = F.when(F.col("audio").isNotNull(), F.col("n_samples"))
    elif dict(wanted.dtypes)["audio"] == "binary":
        stored = F.floor(F.octet_length("audio") / _BYTES)
    else:
        stored = F.size(audio_array(wanted))
    lengths = wanted.select("utt_id", stored.cast("bigint").alias("stored")).groupBy("utt_id").agg(F.max("stored").alias("stored"))
    needs = piece_rows.groupBy("track_id", "utt_id").agg(F.max(F.col("offset") + F.col("length")).alias("needed"))
    reason = F.when(F.coalesce(F.col("stored"), F.lit(-1)) < 0, F.lit("audio missing")).otherwise(F.lit("audio too short"))
    bad = needs.join(lengths, "utt_id", "left").where("stored is null or stored < needed")
    return bad.groupBy("track_id").agg(F.min(reason).alias("reason"))


def pack_audio(audio: DataFrame) -> DataFrame:
    """``(utt_id, audio)`` with the samples as little-endian 32-bit floats in one binary value.

    Samples may be a bare array or a struct with an ``array`` field.

    Joins, shuffles and Python hand-over copy a binary value as a block; an array they touch sample by
    sample. A stored table in this form (bucketed by ``utt_id``) saves the step altogether.
    """
    if dict(audio.dtypes)["audio"] == "binary":
        return audio.select("utt_id", "audio")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [x.astype("<f4").tobytes() for x in _lists(pa.chunked_array([batch.column("audio")]))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("utt_id"), pa.array(packed, pa.binary())], ["utt_id", "audio"]
            )

    ready = audio.select("utt_id", audio_array(audio).alias("audio")).where(F.col("audio").isNotNull())
    return ready.mapInArrow(pack, "utt_id bigint, audio binary")


def store_bucketed(audio: DataFrame, table: str, buckets: int, path: str | None = None) -> DataFrame:
    """Store audio as a table, packed and bucketed by ``utt_id``, and return that table.

    Joins on ``utt_id`` then read each bucket where it lies: only the other side is shuffled. Choose as many buckets as a run has shuffle
    partitions, or a multiple; a bucket should fit a task. The table is replaced where it exists; its files lie in ``path``, or in the warehouse.
    """
    writer = pack_audio(audio).repartition(buckets, "utt_id").write.mode("overwrite").format("parquet").bucketBy(buckets, "utt_id").sortBy("utt_id")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return audio.sparkSession.table(table)


def cut_slices(piece_rows: DataFrame, audio: DataFrame) -> DataFrame:
    """Fetch the slice of each piece, as packed samples, from packed ``(utt_id, audio)``.

    Always a merge join: audio is never broadcast, whatever its compressed size suggests. With audio bucketed
    by ``utt_id`` only the piece rows move.
    """
    keys = ["shard"] if "shard" in piece_rows.columns else []
    return piece_rows.join(audio.hint("merge"), "utt_id").select(
        *keys, "track_id", "total_samples", "position", "gain", "half_tail", "block",
        F.substring("audio", F.col("offset").cast("int") * _BYTES + 1, F.col("length").cast("int") * _BYTES).alias("chunk"),
    )


def cut_slices_by_task(piece_rows: DataFrame, audio: DataFrame, n_pieces: int, n_samples: int) -> DataFrame:
    """As :func:`cut_slices`, with the pieces dealt to tasks by track and sorted by it. The pieces are read twice and should be stored.

    Pieces travel without audio, and each utterance once to every task that needs it, up to the last sample that is needed there; a task looks it up in a hash
    table. So the shuffle does not grow with pieces times samples where utterances are used often, and no audio is sorted with the pieces. A task
    holds the audio of its pieces, some :data:`_TASK_SAMPLES` samples at most.
    """
    spark = piece_rows.sparkSession
    n_tasks = max(tasks_for(spark, n_pieces, _TASK_PIECES), tasks_for(spark, n_samples, _TASK_SAMPLES))
    dealt = piece_rows.withColumn("_task", F.pmod(F.hash("track_id"), F.lit(n_tasks)))
    # in all shuffle partitions, given outright: the rows are narrow, but each of them becomes audio
    needed = dealt.repartition(tasks_for(spark, 0, 1), "utt_id").groupBy("utt_id", "_task").agg(F.max(F.col("offset") + F.col("length")).alias("_needed"))
    sent = needed.join(audio.hint("merge"), "utt_id").select("_task", "utt_id", F.substring("audio", 1, F.col("_needed").cast("int") * _BYTES).alias("audio"))
    # sorted by a window that stays in the plan: a bare sort below a join would be taken out
    nth = F.row_number().over(Window.partitionBy("_task", "track_id").orderBy("position"))
    in_order = by_task(dealt, n_tasks).withColumn("_nth", nth).where("_nth > 0")
    return in_order.join(by_task(sent, n_tasks).hint("shuffle_hash"), ["_task", "utt_id"]).select(
        "track_id", "total_samples", "position", "gain", "half_tail", "block",
        F.substring("audio", F.col("offset").cast("int") * _BYTES + 1, F.col("length").cast("int") * _BYTES).alias("chunk"),
    )


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for part in column.chunks:
        values = part.values.to_numpy(zero_copy_only=False)
        bounds = part.offsets.to_numpy()
        out += [values[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    return out


def mix_down(
    slices: DataFrame, p: TrackParams, noise: bool = True, rows: DataFrame | None = None, n_shards: int | None = None,
    first_shard: int = 0, in_order: bool = False,
) -> DataFrame:
    """Add the slices of each track into one waveform, add its noise, limit the peak.

    Returns ``(track_id, audio, snr)``; ``snr`` is the measured ratio, null without noise. With a ``shard`` column
    the slices are partitioned by shard, one task for each of ``n_shards`` from ``first_shard`` on, so that a finished track is already where its file is written.
    ``rows`` (same keys, any further columns) travel with the slices and come back as the struct ``row``: the
    finished audio needs no join. ``in_order`` says that the slices of a track are together already, as :func:`cut_slices_by_task` leaves them.
    """
    sampling_rate, known = p.sampling_rate, kernels.makers()
    keys = ["shard", "track_id"] if "shard" in slices.columns else ["track_id"]
    row_type = None
    if rows is not None:
        carried = [c for c in rows.columns if c not in keys]
        tagged = rows.select(*keys, F.struct(*carried).alias("row"))
        # the same type with every part nullable, as declared to the grouped function
        row_type = T.StructType.fromDDL(f"row {tagged.schema['row'].dataType.simpleString()}")["row"].dataType
        arrow_row_type = to_arrow_type(row_type)
        slices = slices.unionByName(tagged, allowMissingColumns=True)
    planned = with_spec(slices, p).select(
        *keys, "total_samples", "position", "gain", "half_tail", "block", "chunk",
        *(["row"] if row_type else []),
        (F.col("noise_type") if noise else F.lit(None).cast("string")).alias("noise_type"), "snr_db",
        F.conv(F.substring(rng.digest(p.seed, "noise", "track_id"), 1, 15), 16, 10).cast("bigint").alias("noise_key"),
    )
    if n_shards:
        planned = planned.repartitionById(n_shards, (F.col("shard") - first_shard).cast("int"))
    elif not in_order:
        planned = by_track(planned, keys[0])

    def one_track(table: pa.Table) -> pa.Table:
        first = {name: table.column(name)[0].as_py() for name in (*keys, "noise_type", "snr_db", "noise_key")}
        heard = table.filter(pc.is_valid(table.column("position")))
        numbers = {name: heard.column(name).to_numpy() for name in ("position", "gain", "half_tail", "block")}
        # fixed order of additions: sums of floats must not depend on how rows arrived
        order = np.lexsort((numbers["gain"], numbers["block"], numbers["position"]))
        chunks = [np.frombuffer(x.as_buffer(), "<f4") for x in heard.column("chunk")]
        wave = kernels.lay_pieces(
            heard.column("total_samples")[0].as_py(), [chunks[i] for i in order],
            *[numbers[name][order] for name in ("position", "gain", "half_tail", "block")],
        )
        snr = None
        if first["noise_type"] is not None:
            added = kernels.noise(first["noise_type"], first["noise_key"], len(wave), sampling_rate, known)
            wave, snr = kernels.mix_at_snr(wave, added, first["snr_db"])
        wave = kernels.limit_peak(wave).astype(np.float32)
        out = {name: pa.array([first[name]], pa.int64()) for name in keys}
        out["audio"] = pa.ListArray.from_arrays(pa.array([0, len(wave)], pa.int32()), pa.array(wave))
        out["snr"] = pa.array([snr], pa.float64())
        if row_type:
            out["row"] = table.filter(pc.is_valid(table.column("row"))).column("row").combine_chunks().cast(arrow_row_type)
        return pa.table(out)

    schema = ", ".join(f"{k} bigint" for k in keys) + ", audio array<float>, snr double"
    if row_type:
        schema += f", row {row_type.simpleString()}"

    def one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Tracks one after the other; the last one of a batch may go on in the next."""
        def out(made: list[pa.Table]) -> Iterator[pa.RecordBatch]:
            return iter(pa.concat_tables(made).combine_chunks().to_batches())

        open_track, made, size = None, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if open_track is not None:
                table = pa.concat_tables([open_track, table])
            ids = list(zip(*[table.column(name).to_pylist() for name in keys]))
            starts = [0, *[i for i in range(1, len(ids)) if ids[i] != ids[i - 1]]]
            for start, end in zip(starts, starts[1:]):
                made.append(one_track(table.slice(start, end - start)))
                size += len(made[-1].column("audio")[0])
                if size >= _BATCH_SAMPLES:
                    yield from out(made)
                    made, size = [], 0
            open_track = table.slice(starts[-1])
        if open_track is not None:
            made.append(one_track(open_track))
        if made:
            yield from out(made)

    return (planned if in_order else planned.sortWithinPartitions(*keys)).mapInArrow(one_by_one, schema)


def build_waveforms(turns: DataFrame, audio: DataFrame, p: TrackParams, noise: bool = True) -> DataFrame:
    """Turns to waveforms, of the tracks that have all their audio.

    The pieces, which carry no audio, are stored once: the audio wanted, the gaps and the slices all follow from them. The tracks with gaps
    are stored, too, as the pieces that go into the mix are read twice.
    """
    spark = turns.sparkSession
    piece_rows = stage(pieces(turns, p), work_path(spark, "pieces"))
    wanted = wanted_audio(piece_rows, audio, p)
    gaps = stage(find_gaps(piece_rows, wanted).select("track_id"), work_path(spark, "gaps"))
    whole = piece_rows.join(gaps, "track_id", "left_anti")
    n_pieces, n_samples = piece_rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    return mix_down(cut_slices_by_task(whole, pack_audio(wanted), n_pieces, n_samples), p, noise, in_order=True)


def noise_clips(df: DataFrame, kind: Column, key: Column, n: Column, sampling_rate: int) -> DataFrame:
    """Add ``noise`` (``array<double>``, unit peak): ``n`` samples of a kind from a 60-bit key.

    A task holds a bounded number of samples, and one clip at least.
    """
    wide = by_track(df.withColumns({"_kind": kind, "_key": key, "_n": n}), "_key")
    names, known = list(df.columns), kernels.makers()

    def clips(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(batch: pa.RecordBatch, start: int, made: list[np.ndarray]) -> pa.RecordBatch:
            bounds = np.concatenate(([0], np.cumsum([len(x) for x in made], dtype=np.int64))).astype(np.int32)
            kept = [batch.column(name).slice(start, len(made)) for name in names]
            return pa.RecordBatch.from_arrays([*kept, pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(made)))], [*names, "noise"])

        for batch in batches:
            start, made, size = 0, [], 0
            for k, s, c in zip(batch.column("_kind"), batch.column("_key"), batch.column("_n")):
                made.append(kernels.noise(k.as_py(), s.as_py(), c.as_py(), sampling_rate, known))
                size += len(made[-1])
                if size >= _BATCH_SAMPLES:
                    yield out(batch, start, made)
                    start, made, size = start + len(made), [], 0
            if made:
                yield out(batch, start, made)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return wide.mapInArrow(clips, f"{fields}, noise array<double>")
