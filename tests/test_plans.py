"""Physical plans that must not appear in any query, and some that must."""

import pytest

from cohortspark.catalog.adapters import series
from cohortspark.catalog.registry import BUILDERS
from cohortspark.operators import aggregates, joins

SF_DIR = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "CollectLimit")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(BUILDERS))
def test_no_pairing_and_no_row_wise_python(spark, name):
    text = plan(BUILDERS[name](spark, SF_DIR))
    assert not [node for node in FORBIDDEN if node in text]
    lines = text.splitlines()
    for above, below in zip(lines, lines[1:]):
        assert not ("Sort" in above and "SinglePartition" in below), "a whole table in one task"


def test_participant_features_scan_once(spark):
    text = plan(aggregates.participant_profile(series(spark, SF_DIR)))
    assert text.count("FileScan") == 1 and "Join" not in text
    assert text.count("Exchange hashpartitioning") == 2


def test_blocks_share_the_partitioning_of_their_key(spark):
    frame = series(spark, SF_DIR)
    blocks = [aggregates.series_summary_full(frame), aggregates.non_wear_ratio(frame)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(joins.join_blocks(blocks))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange") == 2


def test_columns_are_pruned_and_filters_pushed(spark):
    text = plan(aggregates.summarise(series(spark, SF_DIR), ["step"], {"Y": ("mean",)}))
    assert "ReadSchema: struct<event_id:bigint>" in text and "IsNotNull(event_id)" in text


def test_the_run_reads_its_rows_from_files(spark, monkeypatch):
    """Training, testing and judging pass over stored rows, not over the split and the lookups each time."""
    from cohortspark.catalog import QUERIES
    from cohortspark.plans import training

    seen = []

    def stop(train, test, *_, **__):
        seen.extend([train, test])
        raise InterruptedError

    monkeypatch.setattr(training, "train_and_evaluate", stop)
    with pytest.raises(InterruptedError):
        QUERIES["train_and_evaluate"](spark, "/root/testdata/sf0.001")
    assert all("run-rows-" in path for frame in seen for path in frame.inputFiles())
