"""Whitening against exact rational statistics and a plain eigendecomposition."""

from fractions import Fraction
from math import inf, nan

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortspark.llm.whitening import (
    covariance,
    deviations,
    eigenvectors,
    fit_whitening,
    identity_error,
    integer_vectors,
    op13_whitening,
    products,
    whiten,
)

SF = "/root/testdata/sf0.001"


def exact_covariance(rows):
    n, d = len(rows), len(rows[0])
    mean = [Fraction(sum(r[i] for r in rows), n) for i in range(d)]
    return [[sum((r[i] - mean[i]) * (r[j] - mean[j]) for r in rows) / n for j in range(d)] for i in range(d)]


def frame_of(spark, rows):
    return spark.createDataFrame([(i, [int(v) for v in r]) for i, r in enumerate(rows)], "vec_id long, x array<long>").repartition(3)


def test_query_against_plain_eigenvectors(spark):
    stored = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    x = {r.vec_id: [int(np.floor(64 * float(c))) + 1_000_000 for c in r.embedding] for r in stored}
    fit = np.array(sorted(set(map(tuple, x.values()))), float)
    values, vectors = np.linalg.eigh(np.cov((fit - fit.mean(axis=0)).T, bias=True))
    values, vectors = values[::-1], vectors[:, ::-1]
    total, sums = np.trace(np.cov(fit.T, bias=True)), fit.sum(axis=0)
    seen, signs = 0, {}
    for r in op13_whitening(spark, SF).collect():
        c = r.component - 1
        expected = (np.array(x[r.vec_id]) - fit.mean(axis=0)) @ vectors[:, c] / np.sqrt(values[c])
        sign = signs.setdefault(c, np.sign(expected * r.whitened))
        assert r.whitened == pytest.approx(sign * expected, abs=1e-7)
        assert r.n == len(fit) and r.explained == pytest.approx(values[c] / total, rel=1e-9) and r.identity_error < 1e-9
        assert r.deviation == sum((r.n * v - int(s)) ** 2 for v, s in zip(x[r.vec_id], sums))
        seen += 1
    assert seen == 16 * len(stored)


def test_covariance_is_exact(spark):
    rng = np.random.default_rng(0)
    rows = (rng.integers(-50, 50, (90, 5)) + 10**6).tolist()
    n, sums, scaled = covariance(frame_of(spark, rows).select("x").distinct())
    distinct = [list(r) for r in set(map(tuple, rows))]
    expected = exact_covariance(distinct)
    assert n == len(distinct) and sums == [sum(c) for c in zip(*distinct)]
    assert all(Fraction(scaled[i, j], n * n) == expected[i][j] for i in range(5) for j in range(5))


def test_large_entries_are_exact(spark):
    rows = [[1 << 45, 3, -5], [-(1 << 45), 1 << 44, 7], [12345, -(1 << 45), 1], [0, 0, 0]]
    n, _, scaled = covariance(frame_of(spark, rows).select("x"))
    expected = exact_covariance(rows)
    assert all(Fraction(scaled[i, j], n * n) == expected[i][j] for i in range(3) for j in range(3))
    z = np.array(rows, np.int64)
    assert products(z)[0, 0] == 2 * (1 << 90) + 12345**2
    assert deviations(z, n, [int(v) for v in z.sum(axis=0)])[0] is None
    assert deviations(np.array([[3, 4]]), 2, [1, 1]) == [25 + 49]


def residual(a, values, vectors):
    return max(np.abs(a @ vectors - vectors * values).max() / np.abs(a).max(), np.abs(vectors.T @ vectors - np.eye(len(a))).max())


@pytest.mark.parametrize("spectrum", ["apart", "equal", "clustered", "near", "low rank"])
def test_refinement(spectrum):
    """Equal eigenvalues, and clusters closer together than single precision can tell, end at far beyond double's residual."""
    rng = np.random.default_rng(3)
    d = 24
    true = {
        "apart": np.arange(1, d + 1.0),
        "equal": np.repeat([5.0, 2.0, 1.0], 8),
        "clustered": np.repeat([5.0, 2.0, 1.0], 8) + np.tile(np.arange(8) * 1e-9, 3),
        "near": 1 + np.arange(d) * 1e-11,
        "low rank": np.append(np.zeros(d - 3), [1.0, 2.0, 3.0]),
    }[spectrum]
    q = np.linalg.qr(rng.normal(size=(d, d)))[0].astype(np.longdouble)
    for _ in range(3):  # orthonormal in the higher precision
        q = q + q @ (np.eye(d, dtype=np.longdouble) - q.T @ q) / 2
    a = (q * true.astype(np.longdouble)) @ q.T
    a = (a + a.T) / 2
    values, vectors = eigenvectors(a)
    assert np.allclose(values.astype(float), np.sort(true)[::-1], rtol=0, atol=1e-16 * 50 * true.max())
    assert residual(a, values, vectors) < 1e-17 * d
    if spectrum in ("apart", "clustered"):
        overlap = np.abs(q[:, np.argsort(-true)].T @ vectors).astype(float)
        assert np.abs(overlap - np.eye(d)).max() < (1e-15 if spectrum == "apart" else 1e-7)


def test_eigenvectors_beat_double_where_values_cluster():
    """A cluster 1e-9 wide: its vectors come out to 1e-10, where a double precision solver is off by about 1e-7."""
    rng = np.random.default_rng(9)
    d = 12
    true = 1 + np.arange(d) * 1e-9
    q = np.linalg.qr(rng.normal(size=(d, d)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q + q @ (np.eye(d, dtype=np.longdouble) - q.T @ q) / 2
    a = (q * true.astype(np.longdouble)) @ q.T
    values, vectors = eigenvectors((a + a.T) / 2)
    overlap = np.abs(q[:, ::-1].T @ vectors).astype(float)
    assert np.abs(overlap - np.eye(d)).max() < 1e-9


def test_copies_count_once(spark):
    rng = np.random.default_rng(4)
    rows = rng.integers(0, 90, (60, 4)).tolist()
    model, fit = fit_whitening(frame_of(spark, rows + [rows[0]] * 500))
    assert model.n == len(set(map(tuple, rows))) == fit.count()
    assert identity_error(fit, model) < 1e-12


def test_integer_vectors(spark):
    rows = [(1, [0.1, 1e30]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0]), (None, [-0.1, 0.0]), (7, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"x": F.lit(1), "place": F.lit("y")})
    found = {r.vec_id: list(r.x) for r in integer_vectors(frame).collect()}
    assert found == {1: [1_000_006, (1 << 45) + 1_000_000], None: [999_993, 1_000_000]}


def test_no_variance_and_empty(spark):
    one = frame_of(spark, [[1, 2, 3]] * 4)
    model, fit = fit_whitening(one)
    assert model.n == 1 and len(model.values) == 0 and identity_error(fit, model) == 0
    assert [(r.deviation, list(r.whitened)) for r in whiten(one, model).collect()] == [(0, [])] * 4
    none = one.where("false")
    model, fit = fit_whitening(none)
    assert model.n == 0 and whiten(none, model).isEmpty() and identity_error(fit, model) == 0


def test_low_rank_and_repeated_ids(spark):
    """Two dimensions of variance in five: two components, one row for each stored row."""
    rng = np.random.default_rng(6)
    rows = [[int(a), int(b), int(a), int(a + b), 9] for a, b in rng.integers(0, 1000, (80, 2))]
    x = frame_of(spark, rows).withColumn("vec_id", F.lit(None).cast("long"))
    model, fit = fit_whitening(x)
    assert len(model.values) == 2 and sum(model.explained) == pytest.approx(1)
    assert identity_error(fit, model) < 1e-10
    assert [len(r.whitened) for r in whiten(x, model).collect()] == [2] * 80
