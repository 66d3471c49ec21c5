"""Clustering against plain rounds; bounds against distances; pruning on vectors with clusters."""

import hashlib

import numpy as np
import pytest

from colloquy.llm import clustering

SCHEMA = "vec_id bigint, embedding array<float>, label int, x string, cluster string, distance string"


def plainly(rows, size=64):
    """vec_id, integers → cluster, distance, and the centroids, with exact integers."""
    kept = []
    for vec_id, vector in rows:
        if vector is not None and len(vector) == size and all(v is not None and np.isfinite(v) for v in vector):
            kept.append((vec_id, [int(np.floor(64 * float(np.float32(v)))) for v in vector]))
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(x) for _, x in order[:16]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), i) for i, c in enumerate(centroids))

    for _ in range(3):
        own = [nearest(x)[1] for _, x in kept]
        for i in range(len(centroids)):
            inside = [x for (_, x), o in zip(kept, own) if o == i]
            if inside:
                centroids[i] = [sum(c) // len(inside) for c in zip(*inside)]
    return [(vec_id, *nearest(x)[::-1]) for vec_id, x in kept], centroids


def check(spark, rows):
    frame = spark.createDataFrame([(i, v, 0, "own", "own", "own") for i, v in rows], SCHEMA).repartition(3)
    made = clustering.report(frame)
    assert made.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "scans"]
    want, centroids = plainly(rows)
    inertia = [sum(d for _, c, d in want if c == i) for i in range(16)]
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    order = lambda found: sorted(found, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))
    got = order(tuple(r)[:-1] for r in made.collect())
    assert got == order((i, c, d, inertia[c], sum(inertia), shas[c]) for i, c, d in want)


def test_given_table(spark, small):
    check(spark, [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()])


def test_edges(spark):
    """Nulls, wrong sizes, repeated rows and ties."""
    draw = np.random.default_rng(1)
    rows = [(i, draw.integers(-2, 3, 64).astype(float).tolist()) for i in range(40)]
    rows += [(1, rows[1][1])] * 3 + [(None, rows[5][1]), (None, rows[6][1]), (50, None), (51, [0.5] * 63), (52, [0.5] * 63 + [None]), (53, [float("nan")] * 64), (54, [float("inf")] * 64), (55, [])]
    rows += [(100 + i, [0.25] * 64) for i in range(60)]
    check(spark, rows)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_vectors(spark, n):
    check(spark, [(i, [float(i)] * 64) for i in range(n)])


def test_too_large(spark):
    frame = spark.createDataFrame([(0, [1e30] * 64)], "vec_id bigint, embedding array<float>")
    with pytest.raises(Exception, match="exceeds"):
        clustering.report(frame).collect()


def test_falls_bound_every_vector():
    """No vector of a sphere comes nearer to a moved centroid by more than the bound, and the bound is often below the way."""
    draw = np.random.default_rng(2)
    less = 0
    for _ in range(60):
        size = int(draw.integers(1, 6))
        old = draw.normal(0, 10, (4, size))
        new = old + draw.normal(0, draw.choice([0.1, 3, 20]), (4, size))
        radius = np.abs(draw.normal(0, draw.choice([0.5, 5, 30]), 4))
        way, most = clustering.falls(old, new, radius)
        for i in range(4):
            spread = draw.normal(size=(4000, size))
            inside = old[i] + spread / np.linalg.norm(spread, axis=1, keepdims=True) * radius[i] * draw.random((4000, 1)) ** draw.choice([0.01, 1])
            for j in range(4):
                if i != j:
                    fell = np.linalg.norm(inside - old[j], axis=1) - np.linalg.norm(inside - new[j], axis=1)
                    assert fell.max() <= most[i] + 1e-9
            less += most[i] < max(way[j] for j in range(4) if j != i) * 0.99
    assert less > 60


def test_settled_vectors_are_not_scanned(spark):
    draw = np.random.default_rng(3)
    centres = draw.normal(0, 30, (16, 64))
    rows = [(i, (centres[i % 16] + draw.normal(0, 0.5, 64)).tolist()) for i in range(800)]
    vectors = clustering.integers(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), "vec_id", "embedding")
    made = clustering.cluster(vectors)
    assert [n for _, n in made.passes] == [800] * 4
    assert made.passes[-1][0] < 200
    plain = clustering.first_pass(vectors, made.centroids).collect()
    assert {(r["vec_id"], r["cluster"], r["distance"]) for r in plain} == {(r["vec_id"], r["cluster"], r["distance"]) for r in made.vectors.collect()}
