"""Session helpers: SQL settings the plans rely on, and the shared work folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable
from typing import ClassVar

from pyspark.sql import DataFrame, SparkSession

_SQL_CONF = {
    # every planner frame is hash-partitioned by track_id; let joins on (track_id, ...) keep that
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # shuffle files go with the job that made them, not when the driver's garbage collection comes to them
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # what arrives sorted by its keys is aggregated as it comes, not collected and sorted once more
    "spark.sql.execution.replaceHashWithSortAgg": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL options the plans are designed for."""
    for key, value in _SQL_CONF.items():
        spark.conf.set(key, value)
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once, so that tasks can import it from any working folder."""
    application = spark.sparkContext.applicationId
    if getattr(ship, "_done", None) != application:
        package = os.path.dirname(os.path.abspath(__file__))
        base = os.path.join(tempfile.mkdtemp(prefix="colloquy-"), "colloquy")
        archive = shutil.make_archive(base, "zip", os.path.dirname(package), os.path.basename(package))
        spark.sparkContext.addPyFile(archive)
        ship._done = application


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can write to: ``spark.checkpoint.dir``.

    Where it is unset, a local master gets a temporary one; on a cluster that would lose data, and is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"spark.checkpoint.dir is unset: with master {master} working tables need a folder that executors share")
    local = getattr(shared_folder, "_local", None)
    if local is None:
        local = shared_folder._local = tempfile.mkdtemp(prefix="colloquy-")
    return local


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, inside the innermost open workspace."""
    inside = Workspace.open_folders[-1] if Workspace.open_folders else f"{shared_folder(spark)}/colloquy"
    return f"{inside}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, path: str) -> DataFrame:
    """Cut lineage by writing a table to shared storage and reading it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete working tables that nothing reads any more."""
    for path in paths:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, from the root on."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toString()


class Workspace:
    """Working tables of one job, in a folder of its own below the shared one, deleted on leaving.

    ``with Workspace(spark, "job") as work: ... work.stage(df, "name")``. Fresh paths asked for inside are in the folder, too. What outlives the
    job is staged to a path made before.
    """

    open_folders: ClassVar[list[str]] = []

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.folder, self.made = spark, work_path(spark, name), 0

    def __enter__(self) -> Workspace:
        self.open_folders.append(self.folder)
        return self

    def __exit__(self, *_: object) -> None:
        self.open_folders.remove(self.folder)
        discard(self.spark, self.folder)

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        self.made += 1
        return stage(df, f"{self.folder}/{self.made:03d}-{name}")


def settled(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The stored result of a job, whose working tables are deleted."""
    path = work_path(spark, name)
    with Workspace(spark, name):
        return stage(make(), path)


#: Rows of a task by track, about: what a planner task sorts then stays in memory.
TASK_ROWS = 500_000


def by_track(df: DataFrame, key: str = "track_id", rows: int = 0, task_rows: int = TASK_ROWS) -> DataFrame:
    """Hash-partition by track over all shuffle partitions, or over more, if ``rows`` ask for it.

    The number is given outright: rows are narrow but costly to expand, so partitions must not be
    merged for being small; and it grows with the rows, so that a task does not.
    """
    return df.repartition(tasks_for(df.sparkSession, rows, task_rows), key)


def tasks_for(spark: SparkSession, rows: int, task_rows: int) -> int:
    """All shuffle partitions, or more, if ``rows`` ask for it."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // task_rows))


def by_task(df: DataFrame, n_tasks: int) -> DataFrame:
    """Partition by the number in ``_task``."""
    return df.repartitionById(n_tasks, "_task")
