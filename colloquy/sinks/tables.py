"""Storing track tables: shards by size, schema, JSON lines, manifests."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.numbering import running_totals
from ..operators.rows import TRACK_COLUMNS
from ..params import ROW_OVERHEAD_BYTES
from ..session import discard, qualified, stage, work_path

# Shard size, tracks per committed batch, compression.
SHARD_MEGABYTES = 100
BATCH_TRACKS = 50
COMPRESSION = "zstd"
COMPRESSION_LEVEL = 9
#: Row groups are cut by size, so that a reader holds a part of a shard only.
ROW_GROUP_BYTES = 16 << 20
#: Planned bytes of the shards that a task writes one after the other, at most.
TASK_BYTES = 1 << 30


def row_bytes(audio_bytes: Column) -> Column:
    """Estimated stored size of a track."""
    return audio_bytes + F.lit(ROW_OVERHEAD_BYTES)


def wav_bytes(n_samples: Column) -> Column:
    """Size of a 16-bit mono WAV file."""
    return n_samples * 2 + F.lit(44)


def assign_shards(sizes: DataFrame, max_bytes: int, id_col: str = "track_id", width: int = 1_000_000) -> DataFrame:
    """Add ``shard`` to ``(id, bytes)`` rows so that no shard exceeds ``max_bytes``.

    Rows up to half the limit fill shards in id order by running size, with room for the largest such row; a
    larger row has a shard of its own. Both follow from running sums over id blocks, never from one task.
    """
    small = F.col("bytes") <= F.lit(max_bytes / 2)
    placed = running_totals(
        sizes.withColumn("_small", small), id_col, width, {
            "_before": ((), F.when(F.col("_small"), F.col("bytes")).otherwise(0)),
            "_large": ((), F.when(F.col("_small"), 0).otherwise(1)),
        },
    )
    room = sizes.where(small).agg(F.lit(max_bytes) - F.coalesce(F.max("bytes"), F.lit(0))).scalar()
    slot = F.floor(F.col("_before") / F.col("_room")).cast("bigint")
    after_small = F.floor(F.col("_before_total") / F.col("_room")).cast("bigint") + 1
    return placed.withColumn("_room", room).withColumn(
        "shard", F.when(F.col("_small"), slot).otherwise(after_small + F.col("_large"))
    ).select(*sizes.columns, "shard")


def count_shards(shards: DataFrame) -> int:
    """Number of shards of rows with a ``shard``; one at least."""
    return (shards.agg(F.max("shard")).first()[0] or 0) + 1


def shards_to_task(spark: SparkSession, n_shards: int, max_bytes: int) -> int:
    """How many shards a task may write: as many as keep all shuffle partitions busy, within :data:`TASK_BYTES`."""
    return max(1, min(n_shards // int(spark.conf.get("spark.sql.shuffle.partitions")), TASK_BYTES // max_bytes))


def deal_shards(shards: DataFrame, n_buckets: int) -> DataFrame:
    """``(shard, _task)`` of the distinct shards, so that those of a task fall into different buckets of ``n_buckets``."""
    bucket = F.pmod(F.hash("shard"), F.lit(n_buckets))  # as Spark's bucketed writer has it
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("shard")) - 1
    numbers = shards.select(F.col("shard").cast("bigint").alias("shard")).distinct()
    return numbers.withColumn("_bucket", bucket).select("shard", rank.alias("_task"))


def write_dealt(rows: DataFrame, tasks: DataFrame, n_buckets: int, path: str, order: str, append: bool = False, **options: object) -> None:
    """Write rows with a ``shard`` as one Parquet file per shard in one folder, replacing what was there or, with ``append``, beside it.

    ``tasks`` is what :func:`deal_shards` made of their shards. A bucketed writer begins a file wherever the bucket changes. As no
    two shards of a task share a bucket, it writes several shards, and yet a file for each.
    """
    spark, columns = rows.sparkSession, rows.columns
    options = {"compression": COMPRESSION, "parquet.compression.codec.zstd.level": COMPRESSION_LEVEL} | options
    n_tasks = (tasks.agg(F.max("_task")).first()[0] or 0) + 1
    placed = rows.join(tasks, "shard").repartitionById(n_tasks, F.col("_task").cast("int")).select(*columns)
    if n_buckets == 1:  # a shard to a task; also where there are no rows, of which the schema is stored
        placed.sortWithinPartitions(order).write.mode("append" if append else "overwrite").options(**options).parquet(path)
        return
    name, place = f"shards_{uuid.uuid4().hex}", qualified(spark, path).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({rows.schema.toDDL()}) USING parquet OPTIONS ({', '.join(f"'{k}' = '{v}'" for k, v in options.items())}) "
        f"CLUSTERED BY (shard) SORTED BY (shard, {order}) INTO {n_buckets} BUCKETS LOCATION '{place}'"
    )
    try:
        placed.write.insertInto(name, overwrite=not append)
    finally:
        spark.sql(f"DROP TABLE {name}")  # the files stay


def to_track_schema(tracks: DataFrame, keep: tuple[str, ...] = ("track_id",)) -> DataFrame:
    """Exactly the stored columns and types, in order; absent optional columns become null."""
    have = set(tracks.columns)
    columns = [
        (F.col(name) if name in have else F.lit(None)).cast(kind).alias(name) for name, kind in TRACK_COLUMNS
    ]
    return tracks.select(*[k for k in keep if k in have], *columns)


def fill_texts(speakers: Column) -> Column:
    """Null segment texts become empty strings."""
    return F.transform(speakers, lambda s: s.withField("text", F.coalesce(s["text"], F.lit(""))))


def write_tracks(
    tracks: DataFrame, path: str, sizes: DataFrame | None = None, max_megabytes: int = SHARD_MEGABYTES,
    row_group_bytes: int = ROW_GROUP_BYTES,
) -> DataFrame:
    """Write track rows as one Parquet file per shard, replacing what was there; returns the manifest.

    There is one file for a shard and no folder, however many shards there are. Rows that have a ``shard`` column are
    taken to be partitioned by its value (:meth:`DataFrame.repartitionById`) and are written where they are, a shard by a task.
    Others get one from ``sizes``, ``(track_id, bytes)``, and a task writes several shards. Take that from the planned sample counts where tracks are
    costly; without it the rows are measured, which evaluates ``tracks`` twice.
    """
    spark = tracks.sparkSession
    if "shard" not in tracks.columns:
        shaped = to_track_schema(tracks).withColumn("speakers", fill_texts(F.col("speakers")))
        if sizes is None:
            measured = wav_bytes(F.coalesce(F.size("audio.array"), F.lit(0)).cast("bigint"))
            sizes = tracks.select("track_id", row_bytes(measured).alias("bytes"))
        max_bytes = max_megabytes * 1024 * 1024
        shards = stage(assign_shards(sizes, max_bytes).select("track_id", "shard"), shards_at := work_path(spark, "shards"))
        n_buckets = shards_to_task(spark, count_shards(shards), max_bytes)
        write_dealt(
            shaped.join(shards, "track_id"), deal_shards(shards, n_buckets), n_buckets, path, "track_id", **{"parquet.block.size": row_group_bytes},
        )
        discard(spark, shards_at)
    else:
        write_part(tracks, path, row_group_bytes=row_group_bytes)
    return manifest(spark, path)


def write_part(tracks: DataFrame, path: str, append: bool = False, last: bool = True, row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """Write track rows that are partitioned by their ``shard`` where they are, replacing what was there or, with ``append``, beside it.

    The mark of success is left to the last part.
    """
    shaped = to_track_schema(tracks, keep=("shard", "track_id"))
    shaped = shaped.withColumn("speakers", fill_texts(F.col("speakers")))
    (
        shaped.sortWithinPartitions("shard", "track_id")
        .write.mode("append" if append else "overwrite")
        .option("compression", COMPRESSION)
        .option("parquet.compression.codec.zstd.level", COMPRESSION_LEVEL)
        .option("parquet.block.size", row_group_bytes)
        .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", str(last).lower())
        .parquet(path)
    )


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Files of a written track table with their row counts."""
    stored = spark.read.schema("track_id bigint, shard bigint").parquet(path)  # given, as a run may have made no track
    return stored.groupBy("shard", F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("tracks"), F.first("_metadata.file_size").alias("bytes")
    )


def count_back(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a written table, from file footers only."""
    return spark.read.parquet(path).agg(F.count("*").alias("n_rows"))


def _numbered(tracks: DataFrame, ids: DataFrame | None, width: int) -> DataFrame:
    """Add ``_no``, the position in track order. Only ids are numbered; wide rows are joined to the result."""
    numbers = running_totals(
        (tracks if ids is None else ids).select("track_id"), "track_id", width, {"_no": ((), F.lit(1))}
    ).drop("_no_total")
    return numbers if tracks.columns == ["track_id"] else tracks.join(numbers, "track_id")


def numbered_paths(tracks: DataFrame, ids: DataFrame | None = None, width: int = 1_000_000) -> DataFrame:
    """Add ``audio_path``: consecutive file names in track order, without gaps for failed tracks.

    Pass the planned ``ids`` where ``tracks`` is costly, or it is evaluated once more for its ids.
    """
    path = F.format_string("audio/track-%05d.wav", F.col("_no"))
    return _numbered(tracks, ids, width).withColumn("audio_path", path).drop("_no")


def write_json_lines(tracks: DataFrame, path: str) -> None:
    """Metadata as JSON lines: no audio, absent optional values left out."""
    dropped = tracks.drop("audio") if "audio" in tracks.columns else tracks
    dropped.write.mode("overwrite").option("ignoreNullFields", "true").json(path)


def with_batch_no(
    tracks: DataFrame, size: int = BATCH_TRACKS, ids: DataFrame | None = None, width: int = 1_000_000
) -> DataFrame:
    """Add ``batch_no`` (from 1): consecutive tracks in batches of ``size``."""
    batch = F.floor(F.col("_no") / size).cast("bigint") + 1
    return _numbered(tracks, ids, width).withColumn("batch_no", batch).drop("_no")


def committed_only(metadata: DataFrame, commits: DataFrame) -> DataFrame:
    """Metadata of the batches that were committed."""
    return metadata.join(commits.select("batch_no"), "batch_no", "left_semi")


def from_json_records(records: DataFrame) -> DataFrame:
    """Read older records: ``speakers`` as JSON text, ``speaker_volumes`` as a JSON object by speaker."""
    speakers = F.from_json("speakers", "array<struct<speaker_id:bigint,start:double,end:double,duration:double,text:string>>")
    volumes = F.transform(
        F.map_entries(F.from_json("speaker_volumes", "map<string,double>")),
        lambda e: F.struct(e["key"].cast("bigint").alias("speaker_id"), e["value"].alias("volume")),
    )
    return records.withColumns({"speakers": fill_texts(speakers), "speaker_volumes": volumes})
