import math
import random
import statistics

import numpy as np
import pytest
from conftest import rows

from cohortspark.operators import aggregates, windows
from cohortspark.operators.stats import column_stats

SERIES = (
    "id string, X double, Y double, Z double, enmo double, anglez double, non_wear_flag double, light double,"
    " battery_voltage double, time_of_day bigint, weekday int, relative_date_PCIAT double"
)


def sample(id_, hour, weekday, enmo, light=1.0, non_wear=0.0, day=0.0, x=0.0):
    return (id_, x, 0.0, 0.0, enmo, 0.0, non_wear, light, None, hour * 3600, weekday, day)


def test_single_sample_has_no_deviation(spark):
    got = aggregates.series_summary(spark.createDataFrame([sample("a", 1, 1, 0.5)], SERIES)).first()
    assert got["enmo_mean"] == 0.5 and got["enmo_std"] is None and got["battery_voltage_mean"] is None


def test_sum_of_nulls_is_zero_and_null_keys_form_no_group(spark):
    df = spark.createDataFrame([sample("a", 1, 1, 0.5, non_wear=None), sample(None, 1, 1, 0.5)], SERIES)
    got = aggregates.series_summary_full(df).collect()
    assert [r["id"] for r in got] == ["a"] and got[0]["non_wear_flag_sum"] == 0.0


def test_period_profile_zero_or_null(spark):
    """Missing under one flag but present under the other is 0; never present is NULL; all-NULL stays NULL."""
    df = spark.createDataFrame(
        [
            sample("a", 1, 1, 2.0),
            sample("a", 7, 1, 4.0),
            sample("a", 7, 6, 6.0),
            sample("b", 13, 2, None),
            sample("b", 20, 6, 1.0),
        ],
        SERIES,
    )
    got = {(r["id"], r["weekday_flag"]): r for r in aggregates.period_profile(df).collect()}
    assert set(got) == {("a", "weekday"), ("a", "weekend"), ("b", "weekday"), ("b", "weekend")}
    assert got["a", "weekday"]["enmo_night"] == 2.0 and got["a", "weekend"]["enmo_night"] == 0.0
    assert got["a", "weekend"]["enmo_morning"] == 6.0
    assert got["a", "weekday"]["enmo_evening"] is None and got["a", "weekday"]["enmo_unknown"] is None
    assert got["b", "weekday"]["enmo_afternoon"] is None and got["b", "weekend"]["enmo_afternoon"] == 0.0
    assert got["b", "weekday"]["non_wear_flag_afternoon"] == 0.0


def test_unknown_times_are_kept(spark):
    df = spark.createDataFrame([("a", 0.0, 0.0, 0.0, 3.0, 0.0, 1.0, 1.0, None, None, None, 0.0)], SERIES)
    got = aggregates.period_profile(df).first()
    assert (got["weekday_flag"], got["enmo_unknown"], got["non_wear_flag_unknown"]) == ("weekend", 3.0, 1.0)


def test_participant_profile_equals_its_blocks(spark):
    rng = random.Random(1)
    data = [
        sample(
            rng.choice("abc"), rng.randrange(24), rng.randrange(1, 8),
            None if rng.random() < 0.2 else 1e6 + rng.gauss(0, 1e-2), rng.random(), rng.choice([0.0, 1.0, None]),
            x=rng.gauss(0, 1),
        )
        for _ in range(500)
    ] + [sample("single", 3, 3, None)]
    df = spark.createDataFrame(data, SERIES)
    profile = aggregates.participant_profile(df)
    summary = {r["id"]: r for r in aggregates.series_summary_full(df).collect()}
    period = {(r["id"], r["weekday_flag"]): r for r in aggregates.period_profile(df).collect()}
    ratio = {r["id"]: r["non_wear_ratio"] for r in aggregates.non_wear_ratio(df).collect()}
    got = profile.collect()
    assert len(got) == len(period)
    for row in got:
        expected = {**summary[row["id"]].asDict(), **period[row["id"], row["weekday_flag"]].asDict()}
        expected["non_wear_ratio"] = ratio[row["id"]]
        assert set(row.asDict()) == set(expected)
        for name, value in row.asDict().items():
            if isinstance(value, float):
                assert math.isclose(value, expected[name], rel_tol=1e-9, abs_tol=1e-9), name
            else:
                assert value == expected[name], name


def test_hot_participant(spark):
    """A participant with most of the samples is aggregated like any other."""
    df = spark.range(30_000).selectExpr(
        "if(id % 3 > 0, 'hot', cast(id % 50 AS string)) AS id", "cast(id AS double) AS enmo"
    )
    got = aggregates.summarise(df, ["id"], {"enmo": ("mean", "max")})
    assert got.where("id = 'hot'").first()["enmo_max"] == 29999.0 and got.count() == 51


def test_rolling_needs_three_values(spark):
    df = spark.createDataFrame(
        [("a", float(d), v) for d, v in enumerate([1.0, 2.0, None, 4.0, 5.0, 6.0])],
        "id string, relative_date_PCIAT double, enmo_mean double",
    )
    got = windows.add_rolling_mean(windows.add_lag(df, ["enmo_mean"]), ["enmo_mean"]).orderBy("relative_date_PCIAT")
    assert [r["enmo_mean_rolling3"] for r in got.collect()] == [None, None, None, None, None, 5.0]
    assert [r["enmo_mean_lag1"] for r in got.collect()] == [None, 1.0, 2.0, None, 4.0, 5.0]


def test_value_counts_with_and_without_null(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), (None,), ("b",)], "s string")
    assert [tuple(r) for r in aggregates.value_counts(df, "s").collect()] == [(None, 2), ("b", 2), ("a", 1)]
    assert [tuple(r) for r in aggregates.value_counts(df, "s", dropna=True).collect()] == [("b", 2), ("a", 1)]
    shares = aggregates.value_percentages(df, "s", dropna=True).collect()
    assert [round(r["percentage"], 6) for r in shares] == [66.666667, 33.333333]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 1.0, 5.0, 9.99, 10.0, None]], "v double")
    got = aggregates.histogram(df, "v", 10).orderBy("bin").collect()
    assert [r["count"] for r in got] == [1, 1, 0, 0, 0, 1, 0, 0, 0, 2]
    assert aggregates.histogram(df.where("v IS NULL"), "v").count() == 0
    single = aggregates.histogram(df.where("v = 5"), "v", 4).collect()
    assert sum(r["count"] for r in single) == 1 and len(single) == 4


def test_impute(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None)], "a double, b double")
    assert rows(aggregates.impute(df, aggregates.fit_means(df, ["a", "b"]))) == [(1.0, None), (2.0, None), (3.0, None)]


def test_mode_ties_take_the_smallest(spark):
    df = spark.createDataFrame(
        [("Spring", 10.0), ("Fall", 9.0), ("Fall", 10.0), ("Spring", 9.0), (None, None)], "s string, n double"
    )
    assert aggregates.fit_modes(df, ["s", "n"]).values == {"s": "Fall", "n": 9.0}
    assert aggregates.fit_modes(df.where("s IS NULL"), ["s", "n"]).values == {"s": None, "n": None}


@pytest.mark.parametrize("width", [3, 30])
def test_column_stats_narrow_and_wide(spark, width):
    data = [[None if (i + j) % 7 == 0 else float(i * j % 11) for j in range(width)] for i in range(60)]
    names = [f"c-{j}" for j in range(width)]
    got = column_stats(spark.createDataFrame(data, ", ".join(f"`{n}` double" for n in names)), names)
    for j, name in enumerate(names):
        present = [r[j] for r in data if r[j] is not None]
        assert (got[name].rows, got[name].count) == (60, len(present))
        assert math.isclose(got[name].mean, statistics.fmean(present))
        assert math.isclose(got[name].variance, statistics.pvariance(present), abs_tol=1e-12)


def test_constant_column_has_no_variance(spark):
    df = spark.range(1000).selectExpr("0.1D + 0.2D AS v", "cast(null AS double) AS w")
    got = column_stats(df, ["v", "w"])
    assert got["v"].variance == 0.0 and got["w"].variance is None and got["w"].mean is None


def test_count_classes_and_min_max(spark):
    df = spark.createDataFrame([(0.0, 5.0), (0.0, 7.0), (1.0, None), (None, 3.0)], "y double, t double")
    assert aggregates.count_classes(df, "y").first()[0] == 2
    assert rows(aggregates.class_min_max(df, "y", "t")) == [(0.0, 5.0, 7.0), (1.0, None, None)]


def test_correlations_skip_incomplete_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (None, 9.0)], "a double, b double")
    assert aggregates.correlations(df, ["a", "b"]).first()["correlation"] == pytest.approx(1.0)


def test_correlations_of_many_columns(spark):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(200, 70)) + 1e6
    df = spark.createDataFrame(data.tolist(), [f"c{i}" for i in range(70)])
    got = {(r["left"], r["right"]): r["correlation"] for r in aggregates.correlations(df, df.columns).collect()}
    expected = np.corrcoef(data.T)
    assert len(got) == 70 * 69 // 2
    assert all(abs(v - expected[int(a[1:]), int(b[1:])]) < 1e-9 for (a, b), v in got.items())


def test_correlation_without_variation(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (1.0, 4.0, None)], "a double, b double, c double")
    assert {r["correlation"] for r in aggregates.correlations(df, ["a", "b", "c"]).collect()} == {None}
