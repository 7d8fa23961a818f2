import math
import os
import uuid
from types import SimpleNamespace

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cohortspark.plans import runlog
from cohortspark.schemas import AGGREGATED_FEATURES_SCHEMA, SERIES_SCHEMA, CohortSpec
from cohortspark.session import scratch_path, shared_dir
from cohortspark.sources import readers, tables, writers

IDS = ["001", "1e5", "00012345"]


@pytest.fixture
def series_root(spark, tmp_path):
    base = spark.createDataFrame([(i, float(k)) for k, i in enumerate(IDS)], "id string, enmo double")
    full = base.select(
        *[
            (F.col(f.name) if f.name in base.columns else F.lit(1)).cast(f.dataType).alias(f.name)
            for f in SERIES_SCHEMA
        ]
    )
    return writers.write_series(full.withColumnRenamed("non_wear_flag", "non-wear_flag"), str(tmp_path / "series"))


def test_participant_ids_stay_text(spark, series_root):
    df = readers.read_series(spark, series_root)
    assert df.schema == SERIES_SCHEMA
    assert sorted(r["id"] for r in df.collect()) == sorted(IDS)
    assert {r["non_wear_flag"] for r in df.collect()} == {1.0}


def test_filter_on_participant_prunes_folders(spark, series_root):
    df = readers.read_participants(spark, series_root, ["001", "absent"])
    assert [r["id"] for r in df.collect()] == ["001"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "id#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_missing_roots(spark, series_root, tmp_path):
    absent = str(tmp_path / "absent")
    assert readers.read_series(spark, [series_root, absent], skip_unreadable=True).count() == 3
    empty = readers.read_series(spark, absent, skip_unreadable=True)
    assert empty.schema == SERIES_SCHEMA and empty.count() == 0
    with pytest.raises(AnalysisException):
        readers.read_series(spark, absent)


def test_corrupt_files_are_skipped_only_on_request(spark, series_root):
    folder = os.path.join(series_root, "id=broken")
    os.mkdir(folder)
    with open(os.path.join(folder, "part-0.parquet"), "w") as f:
        f.write("not parquet")
    assert readers.read_series(spark, series_root, skip_unreadable=True).count() == 3
    with pytest.raises(Exception):
        readers.read_series(spark, series_root).count()


def test_nan_becomes_null(spark):
    df = readers.nan_to_null(spark.createDataFrame([(math.nan, 1), (2.0, 2)], "v double, k int"))
    assert rows(df) == [(2.0, 2), (None, 1)]


def test_typed_csv_with_study_columns(spark, tmp_path):
    spec = CohortSpec()
    assert len(spec.numeric) == 68 and len(spec.categorical) == 11
    path = tmp_path / "cohort.csv"
    names = [f.name for f in spec.schema()]
    path.write_text(",".join(names) + "\n" + ",".join("7" if n != "Basic_Demos-Sex" else "" for n in names) + "\n")
    row = readers.read_csv(spark, str(path), spec.schema()).first()
    assert row["id"] == "7" and row["Physical-BMI"] == 7.0 and row["CGAS-Season"] == "7" and row["Basic_Demos-Sex"] is None


def test_table_round_trip_and_stamp(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    writers.save_table(spark.range(3), name, str(tmp_path / "t"))
    writers.save_table(spark.range(2), name, str(tmp_path / "t"))
    got = readers.read_table(spark, name)
    assert got.count() == 2 and got.where("timestamp > current_timestamp() - INTERVAL 1 HOUR").count() == 2


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    names = []
    for part in ("cohort", "features"):
        names.append(f"{part}_{uuid.uuid4().hex}")
        frame = spark.range(100).selectExpr("cast(id AS string) AS id", f"id AS {part}")
        writers.save_table(frame, names[-1], str(tmp_path / part), stamped=False, buckets=(4, "id"))
    # Bucketed reads matter where a broadcast is impossible.
    joined = spark.table(names[0]).join(spark.table(names[1]).hint("merge"), "id", "left")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.where("cohort = features").count() == 100


def test_insert_matches_columns_by_name(spark, tmp_path):
    name = tables.create_table(spark, f"t_{uuid.uuid4().hex}", AGGREGATED_FEATURES_SCHEMA, str(tmp_path / "t"))
    row = spark.createDataFrame(
        [tuple([float(i) for i in range(21)] + ["a"])],
        ", ".join(f"{f.name} double" for f in AGGREGATED_FEATURES_SCHEMA.fields[:0:-1]) + ", id string",
    )
    tables.insert_frame(row, name)
    tables.insert_from_view(row.withColumn("id", F.lit("b")), "v_rows", name)
    got = spark.table(name).orderBy("id").collect()
    assert [r["id"] for r in got] == ["a", "b"] and got[0]["battery_voltage_mean"] == 0.0 and got[1]["X_mean"] == 20.0


def test_append_with_new_columns(spark, tmp_path):
    path = str(tmp_path / "p")
    writers.append_parquet(spark.createDataFrame([(1,)], "a int"), path)
    writers.append_parquet(spark.createDataFrame([(2, "x")], "a int, b string"), path)
    assert rows(readers.read_parquet(spark, path, merge_schema=True)) == [(1, None), (2, "x")]


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "runs")
    runlog.log_run(spark, path, "r1", {"depth": 5}, {"accuracy": 0.5}, {"branch": "a"})
    runlog.log_run(spark, path, "r2", {"depth": 6}, {"accuracy": 0.6}, {"branch": "a"})
    runlog.log_run(spark, path, "r3", tags={"branch": "b"})
    runs = runlog.read_runs(spark, path)
    found = runlog.search_runs(runs, "branch", "a").collect()
    assert [r["run_id"] for r in found] == ["r2"] and found[0]["params"] == {"depth": "6"}
    assert runlog.search_runs(runs, "branch", "a", limit=None).count() == 2


class Session:
    """Just the settings a session offers."""

    def __init__(self, master, **settings):
        self.sparkContext = SimpleNamespace(master=master)
        self.conf = SimpleNamespace(get=lambda key, default: settings.get(key.replace(".", "_"), default))


def test_shared_folder_comes_from_the_session():
    configured = Session("spark://host:7077", spark_checkpoint_dir="/some/shared/folder")
    assert shared_dir(configured) == "/some/shared/folder"
    assert scratch_path(configured, "x").startswith("/some/shared/folder/x-")
    assert os.path.isdir(shared_dir(Session("local[2]")))
    with pytest.raises(RuntimeError):
        shared_dir(Session("spark://host:7077"))


def test_filters_on_floats_reach_the_scan(spark, tmp_path):
    """The comparison is pushed and row groups without a match are skipped; NaN and NULL meet no filter."""
    path = str(tmp_path / "t")
    rows = [(float(i), i) for i in range(1000)] + [(math.nan, -1), (None, -2)]
    spark.createDataFrame(rows, "v double, k int").repartitionByRange(4, "v").write.parquet(path)
    found = readers.read_parquet(spark, path, filters=[("v", ">", 990.5), ("k", "<>", 999)])
    assert "GreaterThan(v,990.5)" in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.k for r in found.collect()) == list(range(991, 999))
    assert sorted(r.k for r in readers.read_parquet(spark, path, filters=[("v", "in", [1.0, 2.0])]).collect()) == [1, 2]
    assert readers.read_parquet(spark, path, filters=[("v", ">=", 0.0)]).count() == 1000
    with pytest.raises(ValueError):
        readers.read_parquet(spark, path, filters=[("v", "like", 1)])


def test_series_filter_uses_the_stored_spelling(spark, tmp_path):
    frame = spark.createDataFrame([("a", 1.0, 5), ("a", math.nan, 6), ("b", 3.0, 7)], "id string, `non-wear_flag` float, step long")
    frame.write.partitionBy("id").parquet(str(tmp_path / "s"))
    found = readers.read_series(spark, str(tmp_path / "s"), filters=[("non_wear_flag", ">", 0.5)])
    assert "GreaterThan(" in found._jdf.queryExecution().executedPlan().toString().replace("`", "")
    assert sorted(r.step for r in found.collect()) == [5, 7]


def test_unreadable_files_are_listed_with_reasons(spark, tmp_path):
    root = tmp_path / "s"
    frame = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "id string, step long")
    frame.write.partitionBy("id").parquet(str(root))
    victim = next((root / "id=b").glob("*.parquet"))
    short = victim.read_bytes()[:-30]
    victim.write_bytes(short)  # beside a checksum that is wrong now
    (root / "id=f").mkdir()
    (root / "id=f" / "part-0.parquet").write_bytes(short)
    (root / "id=d").mkdir()
    (root / "id=d" / "part-0.parquet").write_bytes(b"")
    (root / "id=e").mkdir()
    (root / "id=e" / "part-0.parquet").write_bytes(b"PAR1 damaged footer PAR1")
    roots = [str(root), str(tmp_path / "gone")]
    found = {r.path.split("/")[-2 if "part" in r.path else -1]: (r.reason, r.bytes) for r in readers.unreadable_files(spark, roots).collect()}
    assert found == {
        "gone": ("missing root", None),
        "id=b": ("bytes cannot be read", len(short)),
        "id=f": ("no Parquet footer", len(short)),
        "id=e": ("no rows or damaged footer", 24),
    }
    assert sorted(r.step for r in readers.read_series(spark, roots, skip_unreadable=True).collect()) == [1, 3]
    assert readers.unreadable_files(spark, str(root / "id=a")).isEmpty()
    assert readers.unreadable_files(spark, [str(tmp_path / "gone")]).count() == 1


def test_folders_are_listed_once_by_few_tasks(spark, series_root, tmp_path):
    """Missing roots are told by the scan's error, one after another; sound roots are scanned once, and the session's setting stays."""
    (tmp_path / "b").mkdir()
    name, calls = "spark.sql.sources.parallelPartitionDiscovery.parallelism", []
    before = spark.conf.get(name)

    def scan(paths):
        calls.append(list(paths))
        return spark.read.schema("step long").parquet(*paths)

    roots = [str(tmp_path / "gone" / "b"), str(series_root), str(tmp_path / "b"), str(tmp_path / "gone too/")]
    with readers._few_listing_tasks(spark):
        assert int(spark.conf.get(name)) == 4 * spark.sparkContext.defaultParallelism
        frame, present = readers._scan_present(scan, roots)
    assert spark.conf.get(name) == before and present == roots[1:3] and frame.count() == 3
    assert sum(roots[1] in c for c in calls) == 3 and calls[-1] == present  # the first two fail before anything is listed
    assert readers._scan_present(scan, roots[:1]) == (None, [])
