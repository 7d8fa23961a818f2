import math

import pytest
from pyspark.sql import functions as F

from cohortspark.functions import scalars


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def numbers(spark, items, name="v"):
    return spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, {name} double").orderBy("i")


def test_bins_are_right_closed(spark):
    df = numbers(spark, [0.0, 0.5, 12.0, 12.5, 17.0, 25.0, 26.0, None, math.nan])
    expected = [None, "Child", "Child", "Teen", "Teen", "Young Adult", None, None, None]
    assert values(df, scalars.age_group("v")) == expected


def test_open_ended_bins(spark):
    df = numbers(spark, [0.0, 1.0, 3.0, 6.0, 7.0, 1e300])
    assert values(df, scalars.internet_use_category("v")) == [None, "Low", "Moderate", "High", "Very High", "Very High"]
    df = numbers(spark, [18.5, 18.6, 25.0, 30.0, 30.1])
    assert values(df, scalars.bmi_category("v")) == ["Underweight", "Normal", "Normal", "Overweight", "Obese"]
    df = numbers(spark, [0.0, 20.0, 40.0, 60.0, 61.0])
    assert values(df, scalars.questionnaire_bin("v")) == [None, "Mild", "Moderate", "Severe", None]


def test_severity_index(spark):
    df = numbers(spark, [-1.0, 0.0, 30.0, 31.0, 49.0, 50.0, 79.0, 80.0, 100.0, 101.0, None])
    assert values(df, scalars.severity_index("v")) == [None, 0, 0, 1, 1, 2, 2, 3, 3, None, None]


def test_weekday_flag_counts_null_as_weekend(spark):
    df = numbers(spark, [1.0, 4.0, 5.0, 7.0, None])
    assert values(df, scalars.weekday_flag("v")) == ["weekday", "weekday", "weekend", "weekend", "weekend"]


def test_day_part_units(spark):
    df = numbers(spark, [0.0, 21599.0, 21600.0, 43200.0, 64800.0, None])
    expected = ["night", "night", "morning", "afternoon", "evening", "unknown"]
    assert values(df, scalars.day_part("v")) == expected
    in_ms = df.withColumn("v", F.col("v") * 1000)
    assert values(in_ms, scalars.day_part("v", "ms")) == expected
    with pytest.raises(KeyError):
        scalars.day_part("v", "minutes")


def test_division_by_zero_is_null(spark):
    df = spark.createDataFrame([(10.0, 2.0), (1.0, 0.0), (None, 3.0)], "score double, age double")
    assert values(df, scalars.age_adjusted_score("score", "age")) == [5.0, None, None]


def test_registered_multiplier(spark):
    name = scalars.register_multiplier(spark, "times_one_two", 1.2)
    df = numbers(spark, [10.0, None])
    assert values(df, F.expr(f"{name}(v)")) == [12.0, None]
    assert "PythonUDF" not in df.select(F.expr(f"{name}(v)"))._jdf.queryExecution().toString()


def test_epoch_seconds_and_milliseconds(spark):
    for factor in (1, 1000):
        df = spark.createDataFrame(
            [(1, str(1_700_000_000 * factor)), (2, "x"), (3, None), (4, "")], "i int, raw string"
        )
        got = scalars.epoch_to_timestamp(df, "raw", "at").orderBy("i").select(F.unix_seconds("at"))
        assert [r[0] for r in got.collect()] == [1_700_000_000, None, None, None]


def test_epoch_out_of_range_is_null(spark):
    df = spark.createDataFrame([("1e11",), ("5",)], "raw string")
    got = scalars.epoch_to_timestamp(df, "raw", "at").select(F.unix_seconds("at"))
    assert [r[0] for r in got.collect()] == [None, 5]


def test_id_from_path(spark):
    df = spark.createDataFrame([("s3:/data/id=00c0ffee/",), ("/data/id=a/b",), ("plain",)], "p string")
    assert values(df, scalars.id_from_path("p")) == ["00c0ffee", "a/b", "plain"]


def test_argmax_takes_the_first_of_a_tie(spark):
    df = spark.createDataFrame([([0.2, 0.4, 0.4],), ([0.9, 0.1, 0.0],), (None,)], "p array<double>")
    assert values(df, scalars.argmax_class("p")) == [1, 0, None]


def test_threshold_round(spark):
    df = numbers(spark, [0.49, 0.5, 1.5, 2.5, 3.49, 3.5, None])
    assert values(df, scalars.threshold_round("v")) == [0, 1, 2, 3, 3, 4, None]


def test_round_class_is_half_even(spark):
    df = numbers(spark, [0.5, 1.5, 2.5, 2.51])
    assert values(df, scalars.round_class("v")) == [0, 2, 2, 3]
