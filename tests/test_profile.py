"""Profiles are decided by the rows of a table."""

import datetime as dt

from pyspark.sql import functions as F

from cohortspark.operators.profile import fit_profile, profile_frame, profile_report, read_profile

SCHEMA = "n long, x double, s string, many string, b boolean, d date, a array<int>, `odd.name` int"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def base(spark):
    day = dt.date(2024, 1, 1)
    return frame(spark, [(i, i / 2, "uv"[i % 2], f"m{i}", True, day + dt.timedelta(i), [i], i) for i in range(300)]).repartition(3)


def report(df, profile):
    return {r.column_name: r for r in profile_report(df, profile).collect()}


def test_the_recorded_table_matches_itself(spark):
    df = base(spark)
    profile = fit_profile(df)
    by_name = {p.column_name: p for p in profile}
    assert by_name["n"].least == 0 and by_name["n"].greatest == 299 and by_name["s"].levels == ("u", "v")
    assert by_name["many"].levels is None and by_name["b"].levels == ("true",)
    assert all(r.matches and r.rows_checked == 300 and r.nulls == 0 for r in report(df, profile).values())
    assert read_profile(profile_frame(spark, profile)) == profile


def test_rows_decide(spark):
    profile = fit_profile(base(spark))
    other = frame(spark, [(-1, float("nan"), "w", "new", False, dt.date(2023, 1, 1), None, 5), (None, 7.0, None, None, None, None, [1], 900)])
    found = report(other, profile)
    assert {c: (r.nulls, r.outside) for c, r in found.items()} == {
        "n": (1, 1), "x": (1, 0), "s": (1, 1), "many": (1, 0), "b": (1, 1), "d": (1, 1), "a": (1, 0), "odd.name": (0, 1),
    }
    assert not any(r.matches for r in found.values())


def test_other_types_and_missing_columns(spark):
    df = base(spark)
    found = report(df.drop("s").withColumn("x", F.col("x").cast("string")), fit_profile(df))
    assert (found["s"].present, found["s"].matches, found["s"].nulls) == (None, False, None)
    assert (found["x"].present, found["x"].matches) == ("string", False)
    assert found["n"].matches


def test_empty_tables(spark):
    empty = base(spark).where("false")
    assert all(p.rows == 0 and p.least is None and p.levels is None for p in fit_profile(empty))
    assert all(r.matches and r.rows_checked == 0 for r in report(empty, fit_profile(base(spark))).values())


def test_levels_are_bounded_exactly(spark):
    df = spark.range(70).select((F.col("id") % 5).cast("string").alias("five"), (F.col("id") % 6).cast("string").alias("six"))
    levels = {p.column_name: p.levels for p in fit_profile(df, max_levels=5)}
    assert levels == {"five": tuple("01234"), "six": None}
