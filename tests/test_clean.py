import math

import pytest
from conftest import rows
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from cohortspark.operators import clean
from cohortspark.operators.numbering import ordered_row_id
from cohortspark.operators.sizing import fit_levels


def test_coerce_numeric(spark):
    df = spark.createDataFrame([("0",), ("",), ("abc",), ("1.5",), ("NaN",), (None,)], "v string")
    assert [r[0] for r in clean.coerce_numeric(df, ["v"]).collect()] == [0.0, None, None, 1.5, None, None]


def test_hyphenated_names(spark):
    df = spark.createDataFrame([(1.0, None)], "`Physical-BMI` double, `CGAS-Season` string")
    assert clean.fill_constant(df, "Missing", ["CGAS-Season"]).first()["CGAS-Season"] == "Missing"
    assert clean.select_by_regex(df, [r"^CGAS", r".*BMI"]).columns == ["CGAS-Season", "Physical-BMI"]


def test_mask_incomplete(spark):
    df = spark.createDataFrame([(1, 2, 9), (None, 2, 9)], "a int, b int, v int")
    assert [r["m"] for r in clean.mask_incomplete(df, "v", ["a", "b"], "m").collect()] == [9, None]


def test_map_codes_and_order(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (7.0,), (None,)], "c double")
    got = clean.map_codes(df, "c", {0.0: "Male", 1.0: "Female"}, "s")
    assert [r["s"] for r in got.collect()] == ["Female", "Male", None, None]
    ordered = clean.order_categories(got, "s", ["Female", "Male"])
    assert [r["s"] for r in ordered.collect()][:2] == ["Female", "Male"]


def test_drop_null_rows_treats_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (math.nan, "b"), (None, "c"), (2.0, None)], "v double, s string")
    assert rows(clean.drop_null_rows(df, ["v"])) == [(1.0, "a"), (2.0, None)]
    assert rows(clean.drop_null_rows(df)) == [(1.0, "a")]


def test_conform_schema_ignores_absent_columns(spark):
    target = StructType([StructField("a", IntegerType()), StructField("zz", StringType())])
    df = clean.conform_schema(spark.createDataFrame([(1.0, 2.0)], "a double, b double"), target)
    assert df.dtypes == [("a", "int"), ("b", "double")]


def test_add_missing_columns(spark):
    df = clean.add_missing_columns(spark.createDataFrame([(1,)], "a int"), ["a", "b"])
    assert df.schema["b"].dataType == DoubleType() and df.first()["b"] is None


def test_dedup_columns(spark):
    df = spark.createDataFrame([("x", 1, 2)], "id string, a int, b int")
    first, second = clean.dedup_columns([df.select("id", "a"), df], "id")
    assert first.columns == ["id", "a"] and second.columns == ["id", "b"]


def test_index_category(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("b",)], "s string")
    expected = [(None, -1), ("a", 0), ("b", 1), ("b", 1), ("c", 2)]
    assert rows(clean.index_category(df, "s", "code")) == expected
    assert rows(clean.index_category(df.where("s IS NULL"), "s", "code")) == [(None, -1)]


def test_row_ids_are_consecutive_in_key_order(spark):
    df = spark.range(1000).selectExpr("(id * 7919) % 1000 AS k").repartition(7)
    got = ordered_row_id(df, ["k"], "row", start=10, partitions=5)
    assert [(r["k"], r["row"]) for r in got.orderBy("k").collect()] == [(k, k + 10) for k in range(1000)]


def test_row_ids_of_an_empty_frame(spark):
    assert ordered_row_id(spark.range(0), ["id"], "row").collect() == []


def test_ensure_id_keeps_an_existing_id(spark):
    df = spark.createDataFrame([("p1",)], "id string")
    assert clean.ensure_id(df, ["id"]) is df


def test_any_number_of_levels(spark):
    df = spark.range(5000).selectExpr("lpad(cast(id AS string), 4, '0') AS s")
    assert fit_levels(df, ["s"])["s"] == [f"{i:04d}" for i in range(5000)]
    assert clean.index_category(df, "s", "code").where("cast(s AS int) <> code").isEmpty()


def test_schema_report(spark):
    got = clean.schema_report(spark.createDataFrame([(1, "a"), (2, "b")], "x int, `y-z` string"))
    assert rows(got) == [(0, "x", "int", 2, 2), (1, "y-z", "string", 2, 2)]
