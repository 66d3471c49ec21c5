"""Reading tables some of whose files are damaged: good rows go on, bad files are listed with the reason."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A file without rows is parsed if it is no longer than this; a longer one has data that no footer leads to.
SMALL = 1 << 20
QUARANTINE = "file string, length bigint, rows_stored bigint, rows_read bigint, reason string"


def _parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Files that are sound but have no rows."""
    for batch in batches:
        empty = []
        for path, content in zip(batch["file"], batch["content"]):
            try:
                if pq.ParquetFile(pa.BufferReader(content)).metadata.num_rows == 0:
                    empty.append(path)
            except (pa.ArrowException, OSError):
                pass
        yield pd.DataFrame({"empty_file": pd.Series(empty, dtype="object")})


def read_tolerantly(spark: SparkSession, path: str, schema: str | T.StructType, pages: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows of the sound files, damaged files) of a Parquet folder; the second is ``QUARANTINE``.

    A file whose footer cannot be read has no rows. A file with a sound footer and a damaged page would give its first rows only; so
    all pages of the wanted columns are decoded once, the rows of each file are counted against its footer, and rows of a
    file that falls short are left out as a whole. ``pages=False`` leaves that pass out, and then a damaged page shows as missing rows.
    Row counts per file are summed where the files are read; the damaged files are joined by name.
    """
    reader = spark.read.option("ignoreCorruptFiles", "true").schema(schema)
    scan = reader.parquet(path)
    names = scan.columns
    file = F.col("_metadata.file_path").alias("file")
    glob = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    listed = glob.load(path).select(file, "length")
    stored = scan.select(file).groupBy(F.col("file").alias("s_file")).agg(F.count(F.lit(1)).alias("rows_stored"))  # from footers
    known = listed.join(stored, F.col("file") == F.col("s_file"), "left").drop("s_file")
    if pages:
        decoded = scan.select(file, F.xxhash64(*[F.col(f"`{c}`") for c in names]).alias("h")).groupBy(F.col("file").alias("d_file"))
        decoded = decoded.agg(F.count("h").alias("rows_read"), F.bit_xor("h").alias("digest"))
        known = known.join(decoded.where("digest is not null or rows_read >= 0").drop("digest"), F.col("file") == F.col("d_file"), "left").drop("d_file")
    else:
        known = known.withColumn("rows_read", F.col("rows_stored"))

    doubtful = [r["file"] for r in known.where(F.col("rows_stored").isNull() & (F.col("length") <= SMALL)).select("file").collect()]
    sound = spark.createDataFrame([], "empty_file string")
    for at in range(0, len(doubtful), 1_000):
        content = glob.load(doubtful[at : at + 1_000]).select(file, "content")
        sound = sound.unionByName(content.mapInPandas(_parsed, "empty_file string"))
    reason = F.when(F.col("rows_stored").isNull(), F.lit("no readable footer")).when(
        F.coalesce("rows_read", F.lit(0)) < F.col("rows_stored"),
        F.format_string("%d of %d rows readable", F.coalesce("rows_read", F.lit(0)), "rows_stored"),
    )
    judged = known.join(sound, F.col("file") == F.col("empty_file"), "left_anti").withColumn("reason", reason).where("reason is not null")
    bad = judged.select("file", "length", "rows_stored", "rows_read", "reason")
    good = scan.select("*", F.col("_metadata.file_path").alias("_file")).join(bad.select(F.col("file").alias("_bad")), F.col("_file") == F.col("_bad"), "left_anti")
    return good.drop("_file"), bad
