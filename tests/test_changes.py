from collections import Counter

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cohortspark.operators.changes import check_primary_key, snapshot_changes

SCHEMA = "k int, v double"


def test_each_kind_of_change(spark):
    old = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0), (4, None)], SCHEMA)
    new = spark.createDataFrame([(1, 1.0), (2, 2.5), (4, None), (5, 5.0)], SCHEMA)
    assert rows(snapshot_changes(old, new, ["k"])) == [
        (2, 2.0, "update_preimage"),
        (2, 2.5, "update_postimage"),
        (3, 3.0, "delete"),
        (5, 5.0, "insert"),
    ]


def test_null_keys_compare_equal(spark):
    old = spark.createDataFrame([(None, 1.0)], SCHEMA)
    new = spark.createDataFrame([(None, 2.0)], SCHEMA)
    assert [r[2] for r in rows(snapshot_changes(old, new, ["k"]))] == ["update_preimage", "update_postimage"]


def test_repeated_rows_do_not_pair_up(spark):
    """A hot key on both sides gives its difference, not every pair."""
    old = spark.range(3000).selectExpr("1 AS k", "0D AS v")
    new = spark.range(3002).selectExpr("1 AS k", "0D AS v")
    assert rows(snapshot_changes(old, new, ["k"])) == [(1, 0.0, "insert")] * 2


snapshot = st.lists(st.tuples(st.integers(0, 4), st.sampled_from([0.0, 1.0, None])), max_size=12)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(snapshot, snapshot)
def test_changes_applied_to_old_give_new(spark, before, after):
    old, new = spark.createDataFrame(before, SCHEMA), spark.createDataFrame(after, SCHEMA)
    state = Counter(before)
    for k, v, kind in snapshot_changes(old, new, ["k"]).collect():
        state[(k, v)] += 1 if kind in ("insert", "update_postimage") else -1
    assert +state == Counter(after) and not -state


def test_primary_key_report(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (None, 1.0), (2, 1.0)], SCHEMA)
    assert rows(check_primary_key(df, ["k"])) == [(1, 2, False), (None, 1, True)]
    assert check_primary_key(df, ["k", "v"]).count() == 1
