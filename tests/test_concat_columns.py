"""Blocks side by side: one exchange whatever their number, and what keys mean."""

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cohortspark.operators.joins import concat_columns


def test_equals_full_joins_in_one_exchange(spark):
    base = spark.range(200).withColumnRenamed("id", "k")
    blocks = [
        base.where(F.col("k") % m != 1).select(F.col("k").alias("id"), (F.col("k") * m).alias(f"v{m}"), F.array("k").alias(f"a{m}"))
        for m in (2, 3, 5, 7)
    ]
    found = concat_columns(blocks)
    expected = blocks[0]
    for block in blocks[1:]:
        expected = expected.join(block, "id", "full")
    assert found.columns == expected.columns and rows(found) == rows(expected)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan
    assert found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0].count("Exchange hashpartitioning") == 1


def test_nulls_maps_and_equal_names(spark):
    left = spark.createDataFrame([("a", None), (None, 1)], "id string, x int")
    right = spark.createDataFrame([("b", {"m": 1}, 9), (None, None, 8)], "id string, y map<string,int>, x int")
    found = {r["id"]: (r.x, r.y) for r in concat_columns([left, right]).collect()}
    assert found == {"a": (None, None), "b": (None, {"m": 1}), None: (1, None)}
    assert concat_columns([left]).count() == 2 and concat_columns([left.where("false"), right.where("false")]).isEmpty()


def test_repeated_key_is_an_error(spark):
    block = spark.createDataFrame([("a", 1), ("a", 2)], "id string, x int")
    with pytest.raises(PySparkException, match="several rows for the key a"):
        concat_columns([block, block.select("id").distinct()]).collect()
