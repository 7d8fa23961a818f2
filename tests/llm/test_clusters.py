"""Clustering with heaps of bounds against plain Lloyd rounds in Python integers."""

from hashlib import sha256
from math import floor, inf, isfinite, nan

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortspark.llm.clusters import cluster_vectors, drifts, first_centroids, integer_vectors, op12_clusters, squares


def lloyd(x, centroids, rounds):
    def assign():
        return [min(range(len(centroids)), key=lambda j: (sum((a - b) ** 2 for a, b in zip(v, centroids[j])), j)) for v in x]

    for _ in range(rounds):
        label = assign()
        for j in range(len(centroids)):
            own = [v for v, c in zip(x, label) if c == j]
            if own:
                centroids = [*centroids[:j], [sum(column) // len(own) for column in zip(*own)], *centroids[j + 1 :]]
    return assign(), centroids


def check(spark, x, k, rounds):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(x)], "vec_id long, x array<int>").repartition(3)
    starts = first_centroids(frame, k)
    order = sorted(range(len(x)), key=lambda i: (sha256(f"3:{i}".encode()).hexdigest(), x[i]))[:k]
    assert starts == [x[i] for i in order]
    result = cluster_vectors(frame, starts, rounds)
    label, centroids = lloyd(x, starts, rounds)
    found = {r.vec_id: r for r in result.members.collect()}
    assert [found[i].cluster for i in range(len(x))] == label
    assert result.centroids == centroids
    assert all(found[i].distance == sum((a - b) ** 2 for a, b in zip(v, centroids[label[i]])) for i, v in enumerate(x))
    return result


def test_blobs(spark):
    """Separate blobs settle: most vectors are never rescanned after the first rounds."""
    rng = np.random.default_rng(1)
    x = [list(map(int, rng.integers(-9, 10, 3) + 400 * (i % 5))) for i in range(300)]
    result = check(spark, x, 5, 10)
    assert result.rescanned[0] == 300 and sum(result.rescanned) < 300 * 5


@pytest.mark.parametrize("seed", range(3))
def test_overlapping_vectors_with_ties(spark, seed):
    """Small integers in few dimensions: many equal distances and equal vectors, also among the first centroids."""
    rng = np.random.default_rng(seed)
    x = rng.integers(-3, 4, (200, 2 + seed)).tolist()
    result = check(spark, x, 8, 10)
    assert len(result.rescanned) <= 11 and result.rescanned[-1] < 200


def test_single_centroid_copies_and_few_vectors(spark):
    check(spark, [[1, 2], [3, 5], [-4, -4]], 1, 4)
    check(spark, [[7, 7]] * 30 + [[1, 1]], 4, 3)
    check(spark, [[1, 2], [3, 5]], 8, 10)


def test_largest_components(spark):
    top = 1 << 27
    check(spark, [[top] * 64, [-top] * 64, [top] * 63 + [0], [0] * 64], 2, 3)


def test_empty(spark):
    frame = spark.createDataFrame([], "vec_id long, x array<int>")
    assert first_centroids(frame) == [] and cluster_vectors(frame, []).members.isEmpty()
    assert cluster_vectors(frame, [[1, 2]]).members.isEmpty()


def test_integer_vectors(spark):
    good = [0.25, -0.0004, 1e30, -1e30]
    rows = [(1, good), (1, good), (None, good), (2, None), (3, []), (4, good[:3]), (5, [*good[:3], None]), (6, [*good[:3], nan]), (7, [*good[:3], inf])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"x": F.lit(1), "cluster": F.lit("y")})
    found = integer_vectors(frame, dims=4).collect()
    assert sorted(str(r.vec_id) for r in found) == ["1", "1", "None"]
    assert all(list(r.x) == [256, -1, 1 << 27, -(1 << 27)] for r in found)
    starts = first_centroids(integer_vectors(frame, dims=4), 2)
    members = cluster_vectors(integer_vectors(frame, dims=4), starts).members.collect()
    assert [(r.cluster, r.distance) for r in members] == [(0, 0)] * 3


def test_floor_of_single_precision(spark):
    values = [float(np.float32(v)) for v in np.random.default_rng(5).normal(size=64)]
    frame = spark.createDataFrame([(1, values)], "vec_id long, embedding array<float>")
    assert all(isfinite(v) for v in values)
    assert list(integer_vectors(frame).head().x) == [floor(v * 1024) for v in values]


def test_bounds():
    before, after = [[0, 0], [10, 0], [0, 10]], [[3, 4], [10, 1], [0, 10]]
    assert drifts(before, after) == pytest.approx([6, 6, 5])
    assert squares(np.array([[1, 1]]), np.array(before)).tolist() == [[2, 82, 82]]


def test_query_on_whole_table(spark):
    rows = op12_clusters(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 500 and len({r.inertia for r in rows}) == 1 and rows[0].inertia == sum(r.distance for r in rows)
