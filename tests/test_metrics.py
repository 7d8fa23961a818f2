import itertools
import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cohortspark.functions.scalars import threshold_round
from cohortspark.models import metrics, thresholds

HYPOTHESIS = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "y int, p int")


def kappa_of(pairs):
    labels = sorted({v for pair in pairs for v in pair})
    place = {v: i for i, v in enumerate(labels)}
    table = np.zeros((len(labels), len(labels)))
    for y, p in pairs:
        table[place[y], place[p]] += 1
    gaps = (np.arange(len(labels))[:, None] - np.arange(len(labels))[None, :]) ** 2
    expected = np.outer(table.sum(1), table.sum(0)) / table.sum()
    bottom = (gaps * expected).sum()
    return None if bottom == 0 else 1 - (gaps * table).sum() / bottom


def kappa(spark, pairs, **options):
    return metrics.quadratic_kappa(frame(spark, pairs), "y", "p", **options).first()["kappa"]


def test_identical_reversed_and_constant_labels(spark):
    assert kappa(spark, [(i, i) for i in range(4)]) == 1.0
    assert kappa(spark, [(i, 3 - i) for i in range(4)]) < 0
    assert kappa(spark, [(2, 2), (2, 2)]) is None
    assert kappa(spark, [(None, 2), (1, None)]) is None


pairs = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 4)), min_size=1, max_size=30)


@HYPOTHESIS
@given(pairs)
def test_kappa_matches_the_definition(spark, data):
    got, expected = kappa(spark, data), kappa_of(data)
    assert (got is None) == (expected is None)
    if got is not None:
        assert math.isclose(got, expected, abs_tol=1e-9) and -1 - 1e-9 <= got <= 1 + 1e-9


def test_kappa_distances_between_absent_classes(spark):
    """Only occurring classes have places, unless the class list is given."""
    data = [(0, 0), (0, 3), (1, 1), (3, 3), (3, 1)]
    assert kappa(spark, data) == pytest.approx(kappa_of(data))
    given_labels = kappa(spark, data, labels=[0, 1, 2, 3])
    assert given_labels != pytest.approx(kappa_of(data))


def test_report_lines(spark):
    got = metrics.classification_report(frame(spark, [(0, 0), (0, 1), (1, 1), (2, 1)]), "y", "p").collect()
    lines = {r["label"]: r for r in got}
    assert [r["label"] for r in got] == ["0", "1", "2", "accuracy", "macro avg", "weighted avg"]
    assert lines["0"]["precision"] == 1.0 and lines["0"]["recall"] == 0.5
    assert lines["1"]["precision"] == pytest.approx(1 / 3) and lines["2"]["f1"] == 0.0
    assert lines["accuracy"]["f1"] == 0.5 and lines["accuracy"]["support"] == 4
    assert lines["macro avg"]["recall"] == pytest.approx(0.5)
    assert lines["weighted avg"]["precision"] == pytest.approx((2 * 1.0 + 1 / 3) / 4)


def test_metrics_of_counts_equal_metrics_of_rows(spark):
    rng = random.Random(3)
    df = frame(spark, [(rng.randrange(4), rng.randrange(4)) for _ in range(200)])
    counts = metrics.collected_confusion(df, "y", "p")
    names = {"actual": "actual", "predicted": "predicted", "count": "count"}
    assert metrics.accuracy(counts, **names).first() == metrics.accuracy(df, "y", "p").first()
    assert metrics.quadratic_kappa(counts, **names).first() == metrics.quadratic_kappa(df, "y", "p").first()
    assert (
        metrics.classification_report(counts, **names).collect()
        == metrics.classification_report(df, "y", "p").collect()
    )


def test_kappa_of_many_classes(spark):
    df = spark.range(5000).selectExpr("cast(id AS int) AS y", "cast((id + 1) % 5000 AS int) AS p")
    n = 5000
    observed = (n - 1) + (n - 1) ** 2
    expected = 2 * sum(i * i for i in range(n)) - 2 * sum(range(n)) ** 2 / n
    assert abs(metrics.quadratic_kappa(df, "y", "p").first()["kappa"] - (1 - observed / expected)) < 1e-12


def scored(spark, n=300, seed=5):
    rng = random.Random(seed)
    data = []
    for _ in range(n):
        y = rng.randrange(4)
        data.append((y, min(4.0, max(0.0, round(0.6 * y + 0.7 + rng.gauss(0, 0.6), 2)))))
    return spark.createDataFrame(data, "y int, s double"), data


def kappa_fixed(data, cuts, n_classes=5):
    """Kappa with distances between class numbers, computed pair by pair."""
    table = np.zeros((n_classes, n_classes))
    for y, s in data:
        table[y, sum(s >= c for c in cuts)] += 1
    gaps = (np.arange(n_classes)[:, None] - np.arange(n_classes)[None, :]) ** 2
    bottom = (gaps * np.outer(table.sum(1), table.sum(0)) / table.sum()).sum()
    return 1 - (gaps * table).sum() / bottom


def test_grid_lists_every_candidate(spark):
    df, data = scored(spark)
    cuts = [0.5, 1.0, 1.5, 2.0, 2.5, 3.0]
    got = {tuple(r[:4]): r["kappa"] for r in thresholds.threshold_grid(df, "y", "s", cuts).collect()}
    assert set(got) == set(itertools.combinations(cuts, 4))
    for candidate, value in got.items():
        assert value == pytest.approx(kappa_fixed(data, candidate))


def test_grid_with_uneven_cuts(spark):
    df, data = scored(spark)
    cuts = [0.3, 1.1, 1.2, 2.9]
    (row,) = thresholds.threshold_grid(df, "y", "s", cuts).collect()
    assert row["kappa"] == pytest.approx(kappa_fixed(data, cuts))


@pytest.mark.parametrize("seed", [5, 6, 7])
def test_optimum_is_the_best_of_all(spark, seed):
    df, data = scored(spark, seed=seed)
    best = thresholds.optimize_thresholds(df, "y", "s", low=0.0, high=4.0, bins=10)
    cuts = [4.0 * i / 10 for i in range(11)]
    everything = max(kappa_fixed(data, c) for c in itertools.combinations_with_replacement(cuts, 4))
    assert best.kappa == pytest.approx(everything)
    assert best.kappa == pytest.approx(kappa_fixed(data, best.thresholds))


def test_optimum_beats_the_start_and_agrees_with_rounding(spark):
    df, data = scored(spark)
    best = thresholds.optimize_thresholds(df, "y", "s")
    assert best.kappa >= kappa_fixed(data, [0.5, 1.5, 2.5, 3.5])
    rounded = df.withColumn("p", threshold_round("s", best.thresholds))
    again = metrics.quadratic_kappa(rounded, "y", "p", labels=range(5)).first()["kappa"]
    assert again == pytest.approx(best.kappa)


def test_labels_outside_the_classes_raise(spark):
    with pytest.raises(ValueError):
        thresholds.optimize_thresholds(spark.createDataFrame([(7, 1.0)], "y int, s double"), "y", "s")
