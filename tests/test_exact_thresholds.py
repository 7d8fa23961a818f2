"""The exact threshold search against every choice of cuts."""

import itertools
import math
import random

import numpy as np
import pytest

from cohortspark.models.thresholds import optimize_thresholds, optimize_thresholds_exact


def kappa(actual, predicted, k):
    n = len(actual)
    observed = sum((a - p) ** 2 for a, p in zip(actual, predicted))
    expected = sum((a - p) ** 2 for a in actual for p in predicted) / n
    return 1 - observed / expected if expected else None


def brute(rows, k):
    actual, cuts = [a for a, _ in rows], sorted({s for _, s in rows}) + [math.inf]
    best = -math.inf
    for chosen in itertools.combinations_with_replacement(cuts, k - 1):
        value = kappa(actual, [sum(s >= t for t in chosen) for _, s in rows], k)
        best = best if value is None else max(best, value)
    return best


@pytest.mark.parametrize("seed", range(6))
def test_equals_every_choice(spark, seed):
    rng = random.Random(seed)
    k = 3 + seed % 2
    rows = [(a, round(a * rng.choice([0.3, 1.0]) + rng.gauss(0, 1.2), 1 if seed % 2 else 3)) for a in (rng.randrange(k) for _ in range(50))]
    found = optimize_thresholds_exact(spark.createDataFrame(rows, "a int, s double").repartition(5), "a", "s", k)
    assert found.kappa == pytest.approx(brute(rows, k), abs=1e-9)
    assert list(found.thresholds) == sorted(found.thresholds)
    again = kappa([a for a, _ in rows], [sum(s >= t for t in found.thresholds) for _, s in rows], k)
    assert again == pytest.approx(found.kappa, abs=1e-9)


def test_not_below_the_grid_and_all_distinct_scores(spark):
    rng = np.random.default_rng(1)
    actual = rng.integers(0, 5, 3000)
    rows = [(int(a), float(a * 0.8 + rng.normal())) for a in actual]
    frame = spark.createDataFrame(rows, "a int, s double").repartition(7)
    exact, grid = optimize_thresholds_exact(frame, "a", "s"), optimize_thresholds(frame, "a", "s")
    assert exact.kappa >= grid.kappa - 1e-12 and set(exact.thresholds) <= {s for _, s in rows} | {math.inf}


def test_missing_values_one_class_and_nothing(spark):
    schema = "a int, s double"
    one = optimize_thresholds_exact(spark.createDataFrame([(2, 0.5), (2, 0.5), (None, 1.0), (1, None), (0, math.nan)], schema), "a", "s")
    assert one.kappa is None or one.kappa <= 1
    assert optimize_thresholds_exact(spark.createDataFrame([], schema), "a", "s").kappa is None
    with pytest.raises(ValueError):
        optimize_thresholds_exact(spark.createDataFrame([(7, 1.0)], schema), "a", "s")
