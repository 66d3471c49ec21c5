"""A stored table that is replaced as a whole: the new one is written beside the old, then a commit record points to it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import discard
from .commits import CommitLog


class Versions:
    """Versions of a table below one folder. A job that dies halfway leaves the former version readable."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.commits = CommitLog(spark, f"{self.path}/commits")

    def current(self) -> str | None:
        """Folder of the version that readers see."""
        last = self.commits.last()
        return f"{self.path}/versions/{last['version']}" if last else None

    def replace(self, write: Callable[[str], object]) -> str:
        """Let ``write`` store a table in the folder it is given, then point readers to it; returns that folder."""
        name = uuid.uuid4().hex
        folder = f"{self.path}/versions/{name}"
        write(folder)
        numbers = self.commits.numbers()
        self.commits.put(numbers[-1] + 1 if numbers else 0, {"version": name})
        return folder

    def read(self) -> DataFrame:
        folder = self.current()
        if folder is None:
            raise FileNotFoundError(f"{self.path} has no version yet")
        return self.spark.read.parquet(folder)

    def vacuum(self) -> int:
        """Delete all versions but the current one, also those of jobs that died; returns how many. Readers of older versions must be done."""
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/versions")
        fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = [f"{self.path}/versions/{entry.getPath().getName()}" for entry in fs.listStatus(folder)] if fs.exists(folder) else []
        old = [path for path in found if path != self.current()]
        discard(self.spark, *old)
        return len(old)
