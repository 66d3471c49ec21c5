"""Centroid clustering in integers, with bounds that follow the moved centroids by planar geometry.

Vectors become integers (``floor(SCALE * x)``), so that distances, sums and ties are exact whatever the partitioning. A vector
carries its cluster, an upper bound of the distance to its centroid and a lower bound of the distance to every other one. After
a round the centroids move, and the upper bound grows by the own centroid's way. The lower bound shrinks by less than the longest way:
all vectors of a cluster lie in a sphere (the centroid, the largest upper bound). For a centroid that moves from a to b, the
distance of a vector x falls by at most ``|b - a| cos(t)``, where t is the angle between b - a and x - m at the midpoint m of a and b:

    |x-a| - |x-b| = 2 (x-m)·(b-a) / (|x-a| + |x-b|)   and   |x-a| + |x-b| >= 2 |x-m|.

The smallest angle over the sphere follows in the plane of a, b and the sphere's centre: the centre's angle less asin(radius / distance from m);
a sphere that holds m gives the whole way, one that lies behind m nothing. Per cluster the largest such fall of the other centroids counts.

A vector whose upper bound is below its lower bound stays where it is. Else the upper bound is made exact; if that is not
enough, the vector is ambiguous and all centroids are measured, in integers, ties going to the smaller number. Bounds
are rounded away from each other, so a tie always counts as ambiguous.

The vectors are written once, with their first assignment, and again with each new one: a round is one pass without a
shuffle. Only sums of each cluster travel; k centroids are all that the driver and the tasks hold.

Nulls: vectors that are null, have another number of components, or hold a null or non-finite one are left out; a null id is
hashed as an empty text when start centroids are chosen, ties of the hash going by components. With fewer vectors than centroids
there are fewer centroids. Repeated rows are clustered one by one; equal start centroids leave the later one empty. An empty table gives an empty
result. Components beyond ``LARGEST`` in the integers raise an error, as squared distances would leave 64 bits. Other columns are not used, so their names don't matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.text import require
from colloquy.session import Workspace, discard, ship, stage, work_path

SIZE, CLUSTERS, ROUNDS, SCALE, SEED = 64, 16, 3, 64, 1
LARGEST = 1 << 27
#: Relative rounding of the bounds.
LOOSE = 1e-9
STATE = "vec_id bigint, x array<int>, cluster int, distance bigint, upper double, lower double, scans int"


@dataclass
class Clustered:
    """(vec_id, cluster, distance, scans) of each vector, stored; centroids; what each pass did: (vectors scanned, of all)."""

    vectors: DataFrame
    centroids: np.ndarray
    passes: list[tuple[int, int]] = field(default_factory=list)


def integers(table: DataFrame, id_col: str, vector_col: str, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """(vec_id, x) of the vectors that count, as integers."""
    require(table, id_col, vector_col)
    vector = F.col(vector_col)
    finite = ~F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    whole = F.transform(vector, lambda v: F.floor(v.cast("double") * F.lit(float(scale))))
    checked = F.when(
        F.exists(vector, lambda v: F.abs(v.cast("double")) * scale > LARGEST),
        F.raise_error(F.lit(f"a component exceeds {LARGEST} / {scale}")).cast("array<int>"),
    ).otherwise(F.transform(whole, lambda v: v.cast("int")))
    return table.where(vector.isNotNull() & (F.size(vector) == size)).where(finite).select(F.col(id_col).cast("bigint").alias("vec_id"), checked.alias("x"))


def starts(vectors: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The k vectors with the smallest hashes, in that order."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = vectors.select(key.alias("key"), "x").orderBy("key", "x").limit(k).collect()
    return np.array([r["x"] for r in rows], np.int64)


def falls(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far each centroid moved, and by how much at most the distances of each cluster's vectors to other centroids fell.

    ``radius``: of the sphere around each old centroid that holds the cluster's vectors; negative for a cluster without any.
    """
    a, b = old.astype(np.float64), new.astype(np.float64)
    way = np.sqrt(((b - a) ** 2).sum(axis=1))
    most = np.zeros(len(a))
    for i in np.flatnonzero(radius >= 0):
        for j in np.flatnonzero(way > 0):
            if i != j:
                middle = (a[j] + b[j]) / 2
                away = a[i] - middle
                reach = math.sqrt(away @ away)
                if reach <= radius[i] * (1 + LOOSE):
                    fall = way[j]
                else:
                    angle = math.acos(max(-1.0, min(1.0, away @ (b[j] - a[j]) / (reach * way[j]))))
                    nearest = max(0.0, angle - math.asin(min(1.0, radius[i] * (1 + LOOSE) / reach)))
                    fall = way[j] * max(0.0, math.cos(nearest))
                # angles are rounded at about 1e-8 near 0 and 180 degrees
                most[i] = max(most[i], min(way[j], fall + 1e-6 * way[j]) * (1 + LOOSE))
    return way * (1 + LOOSE), most


def _measured(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, ...]:
    """Exact assignment of the rows of x: cluster, squared distance, upper and lower bound."""
    far = np.stack([((x - c) ** 2).sum(axis=1) for c in centroids], axis=1)
    cluster = far.argmin(axis=1)  # the first of equals
    best = far[np.arange(len(x)), cluster]
    far[np.arange(len(x)), cluster] = np.iinfo(np.int64).max
    second = np.sqrt(far.min(axis=1).astype(np.float64)) if far.shape[1] > 1 else np.full(len(x), np.inf)
    return cluster, best, np.sqrt(best.astype(np.float64)) * (1 + LOOSE), second * (1 - LOOSE)


def _matrix(x: pd.Series) -> np.ndarray:
    return np.stack(x.to_numpy()).astype(np.int64)


def first_pass(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Every vector with its exact cluster and bounds."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                cluster, best, upper, lower = _measured(_matrix(batch["x"]), centroids)
                yield pd.DataFrame({"vec_id": batch["vec_id"].astype("Int64"), "x": batch["x"], "cluster": cluster, "distance": best, "upper": upper, "lower": lower, "scans": 1})

    return vectors.select("vec_id", "x").mapInPandas(run, STATE)


def next_pass(state: DataFrame, centroids: np.ndarray, way: np.ndarray, most: np.ndarray) -> DataFrame:
    """The assignment to moved centroids; vectors that the bounds cannot settle are measured."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x, own = _matrix(batch["x"]), batch["cluster"].to_numpy(np.int64)
            lower = batch["lower"].to_numpy() - most[own]
            lower = np.where(lower > 0, lower * (1 - LOOSE), 0.0)
            upper = (batch["upper"].to_numpy() + way[own]) * (1 + LOOSE)
            distance, scans = batch["distance"].to_numpy(np.int64).copy(), batch["scans"].to_numpy(np.int64).copy()
            open_ = np.flatnonzero(upper >= lower)
            distance[open_] = ((x[open_] - centroids[own[open_]]) ** 2).sum(axis=1)
            upper[open_] = np.sqrt(distance[open_].astype(np.float64)) * (1 + LOOSE)
            open_ = open_[upper[open_] >= lower[open_]]
            if len(open_):
                own = own.copy()
                own[open_], distance[open_], upper[open_], lower[open_] = _measured(x[open_], centroids)
                scans[open_] += 1
            yield pd.DataFrame({"vec_id": batch["vec_id"].astype("Int64"), "x": batch["x"], "cluster": own, "distance": distance, "upper": upper, "lower": lower, "scans": scans})

    return state.mapInPandas(run, STATE)


def moved(state: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """New centroids, floor(sum / count) of each component, and the radius of each cluster's sphere."""
    width = centroids.shape[1]
    sums = state.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.max("upper").alias("radius"), *[F.sum(F.get("x", F.lit(i)).cast("bigint")).alias(f"s{i}") for i in range(width)])
    new, radius = centroids.copy(), np.full(len(centroids), -1.0)
    for row in sums.collect():  # at most one a centroid
        new[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(width)]
        radius[row["cluster"]] = row["radius"]
    return new, radius


def cluster(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> Clustered | None:
    """Rounds of assignment and moved centroids, and a last assignment; None where there is no vector. ``vectors``: (vec_id, x)."""
    spark = vectors.sparkSession
    ship(spark)
    centroids = starts(vectors, k, seed)
    if not len(centroids):
        return None
    out = work_path(spark, "clustered")
    with Workspace(spark, "clustering") as work:
        state = work.stage(first_pass(vectors, centroids), "pass")
        done = [state.agg(F.count(F.lit(1)), F.count(F.lit(1))).first()]
        for n in range(rounds):
            new, radius = moved(state, centroids)
            way, most = falls(centroids, new, radius)
            centroids, before = new, state
            state = work.stage(next_pass(before, centroids, way, most), "pass")
            done.append(state.agg(F.sum("scans"), F.count(F.lit(1))).first())
            discard(spark, f"{work.folder}/{work.made - 1:03d}-pass")
        # bounds leave the distances of settled vectors as they were
        final = stage(exact(state, centroids), out)
    scans = [row[0] for row in done]
    passes = [(scans[0], done[0][1])] + [(late - early, row[1]) for early, late, row in zip(scans, scans[1:], done[1:])]
    return Clustered(final, centroids, passes)


def exact(state: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance, scans) with the distance to the own centroid."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                own = batch["cluster"].to_numpy(np.int64)
                distance = ((_matrix(batch["x"]) - centroids[own]) ** 2).sum(axis=1)
                yield pd.DataFrame({"vec_id": batch["vec_id"].astype("Int64"), "cluster": own, "distance": distance, "scans": batch["scans"]})

    return state.select("vec_id", "x", "cluster", "scans").mapInPandas(run, "vec_id bigint, cluster int, distance bigint, scans int")


def report(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector: cluster, squared distance, inertia of the cluster and of all, and a digest of its centroid."""
    spark = table.sparkSession
    made = cluster(integers(table, id_col, vector_col))
    if made is None:
        return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string, scans int")
    sums = made.vectors.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    totals = {r["cluster"]: r["cluster_inertia"] for r in sums.collect()}  # at most one a centroid
    rows = [(i, totals[i], sum(totals.values()), ",".join(map(str, c.tolist()))) for i, c in enumerate(made.centroids) if i in totals]
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, components string")
    about = about.select("cluster", "cluster_inertia", "inertia", F.sha2(F.col("components").cast("binary"), 256).alias("centroid_sha256"))
    return made.vectors.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "scans")
