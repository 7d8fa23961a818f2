import hashlib
import math

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohortspark.operators import encode, split

HYPOTHESIS = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def test_one_hot_null_and_unseen_are_zero(spark):
    train = spark.createDataFrame([("Fall",), ("Spring",), (None,)], "s string")
    levels = encode.fit_levels(train, ["s"])
    test = spark.createDataFrame([("Fall",), ("Winter",), (None,)], "s string")
    assert rows(encode.one_hot(test, levels)) == [("Fall", 1, 0), (None, 0, 0), ("Winter", 0, 0)]
    assert encode.one_hot(test, levels, drop_first=True).columns == ["s", "s_Spring"]


@HYPOTHESIS
@given(st.lists(st.sampled_from(["a", "b", "c'\\", None]), min_size=1, max_size=20))
def test_one_hot_rows_sum_to_at_most_one(spark, data):
    df = spark.createDataFrame([(v,) for v in data], "s string")
    for row in encode.one_hot(df, encode.fit_levels(df, ["s"])).collect():
        assert sum(row[1:]) == (row["s"] is not None)


@HYPOTHESIS
@given(st.lists(st.integers(-50, 50), min_size=2, max_size=20))
def test_scaled_columns_have_mean_zero_and_deviation_one(spark, data):
    df = spark.createDataFrame([(float(v),) for v in data], "v double")
    scaled = [r["v"] for r in encode.scale(df, encode.fit_scaler(df, ["v"])).collect()]
    assert math.isclose(sum(scaled) / len(scaled), 0, abs_tol=1e-9)
    variance = sum(v * v for v in scaled) / len(scaled)
    assert math.isclose(variance, 0 if len(set(data)) == 1 else 1, abs_tol=1e-9)


def test_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(3.0, None), (3.0, None)], "c double, n double")
    assert rows(encode.scale(df, encode.fit_scaler(df, ["c", "n"]))) == [(0.0, None), (0.0, None)]


def test_assembled_vector(spark):
    df = spark.createDataFrame([(1.0, "it's", 5.0), (3.0, None, None)], "`a-b` double, s string, p double")
    encoder = encode.fit_encoder(df, ["a-b"], ["s"], ["p"])
    assert encoder.names == ["a-b", "s_it's", "p"]
    got = encoder.assemble(df).select(vector_to_array("features").alias("f"))
    assert sorted(r["f"] for r in got.collect()) == [[-1.0, 1.0, 5.0], [1.0, 0.0, 5.0]]


def reference_split(ids, share, seed=42):
    ranked = sorted(ids, key=lambda i: hashlib.md5(f"{i}|{seed}".encode()).hexdigest())
    return set(ranked[: math.ceil(len(ids) * share)])


@pytest.mark.parametrize("n, share", [(1, 0.2), (10, 0.2), (101, 0.25), (1000, 0.2), (7, 1.0), (5, 0.0)])
def test_random_split_is_exact(spark, n, share):
    df = spark.range(n).selectExpr("cast(id AS string) AS id")
    got = split.split_random(df, test_share=share)
    assert {r["id"] for r in split.take(got, "test").collect()} == reference_split([str(i) for i in range(n)], share)
    assert got.count() == n


@HYPOTHESIS
@given(st.lists(st.sampled_from(["x", "y", None]), min_size=1, max_size=40), st.integers(0, 5))
def test_stratified_split_per_class(spark, classes, seed):
    df = spark.createDataFrame([(str(i), c) for i, c in enumerate(classes)], "id string, c string")
    got = split.split_stratified(df, "c", seed=seed).collect()
    for c in set(classes):
        members = [str(i) for i, v in enumerate(classes) if v == c]
        tested = {r["id"] for r in got if r["c"] == c and r["split"] == "test"}
        assert tested == reference_split(members, 0.2, seed)


def test_three_way_split_is_nested_and_complete(spark):
    df = spark.range(200).selectExpr("cast(id AS string) AS id", "id % 2 AS c")
    counts = dict(rows(split.split_three_way(df, "c").groupBy("split").count()))
    assert counts == {"train": 140, "validation": 30, "test": 30}


def test_repeated_keys_stay_together(spark):
    """A key with a third of all rows falls on one side as a whole."""
    df = spark.range(900).selectExpr("if(id % 3 = 0, 'hot', cast(id AS string)) AS id")
    got = split.split_random(df)
    assert got.where("id = 'hot'").select("split").distinct().count() == 1 and got.count() == 900


def test_encoder_with_thousands_of_levels(spark):
    """Levels are places of a sparse vector; NULL and unseen values are zeros."""
    df = spark.range(5000).selectExpr("cast(id AS double) AS x", "concat('v', lpad(cast(id AS string), 4, '0')) AS s")
    fitted = encode.fit_encoder(df, ["x"], ["s"])
    other = spark.createDataFrame([(0.0, "v4999"), (1.0, None), (2.0, "new")], "x double, s string")
    got = [r["features"] for r in fitted.assemble(other).orderBy("x").collect()]
    assert len(fitted.names) == 5001 and all(v.size == 5001 for v in got)
    assert [list(v.toArray()[1:].nonzero()[0]) for v in got] == [[4999], [], []]


@pytest.mark.parametrize("edge_rows", [100_000, 3])
def test_split_by_further_digits_is_exact(spark, monkeypatch, edge_rows):
    """Cuts found below further digits of the hash are those of a full sort; one id holds a third of the rows."""
    monkeypatch.setattr(split, "EDGE_ROWS", edge_rows)
    keys = [str(7 if i % 3 == 0 else i) for i in range(3000)]
    rows = spark.createDataFrame([(k, i % 2) for i, k in enumerate(keys)], "id string, y int")
    got = split.split_three_way(rows, "y").collect()
    for y in (0, 1):
        own = [k for i, k in enumerate(keys) if i % 2 == y]
        hashes = sorted(hashlib.md5(f"{k}|42".encode()).hexdigest() for k in own)
        held = math.ceil(len(own) * 0.3)
        cuts = hashes[math.ceil(held * 0.5) - 1], hashes[held - 1]
        for r in (r for r in got if r["y"] == y):
            h = hashlib.md5(f"{r['id']}|42".encode()).hexdigest()
            assert r["split"] == ("test" if h <= cuts[0] else "validation" if h <= cuts[1] else "train")


def test_few_rows_are_ranked(spark, monkeypatch):
    """Of a million rows, no more than the bound are left below a cut's digits."""
    monkeypatch.setattr(split, "EDGE_ROWS", 5)
    rows = spark.range(1_000_000).select(F.lit("").alias("_stratum"), F.md5(F.col("id").cast("string")).alias("_hash"))
    edge, digits = split._edges(rows, [[0.2], [0.7]])
    left = split._below(rows, edge, digits).groupBy("_cut").count().collect()
    assert digits > split._PREFIX and len(left) == 2 and max(r["count"] for r in left) <= 5
