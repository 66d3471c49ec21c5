"""What the footers of stored Parquet files say: codec, dictionaries, row groups."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession

FOOTERS = "file string, row_group int, rows bigint, bytes bigint, codecs string, dictionary_columns int, columns int"


def _groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for path, content in zip(batch["file"], batch["content"]):
            footer = pq.ParquetFile(pa.BufferReader(content)).metadata
            for g in range(footer.num_row_groups):
                group = footer.row_group(g)
                columns = [group.column(c) for c in range(group.num_columns)]
                rows.append((path, g, group.num_rows, group.total_byte_size, ",".join(sorted({c.compression for c in columns})), sum(c.has_dictionary_page for c in columns), len(columns)))
        yield pd.DataFrame(rows, columns=["file", "row_group", "rows", "bytes", "codecs", "dictionary_columns", "columns"])


def row_groups(spark: SparkSession, path: str) -> DataFrame:
    """One row per row group of the files below ``path``, for shards that a task can hold: a task reads one whole file at a time."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    return files.selectExpr("_metadata.file_path AS file", "content").mapInPandas(_groups, FOOTERS)
