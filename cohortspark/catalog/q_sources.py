"""Sources and sinks: write an adapted table to the scratch folder, read it back, compare with the table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from cohortspark.catalog.adapters import SUBJECT_COLUMNS, predictions, series, snapshots, subjects, table
from cohortspark.catalog.registry import query, rnd
from cohortspark.models.metrics import accuracy
from cohortspark.operators import aggregates, changes, clean, joins
from cohortspark.operators.aggregates import SUMMARY_STATS
from cohortspark.plans import feature_table, runlog
from cohortspark.schemas import AGGREGATED_FEATURES_SCHEMA, SERIES_SCHEMA, SERIES_TABLE_SCHEMA
from cohortspark.session import scratch_path
from cohortspark.sources import readers, tables, writers

_TEXT = {"id", "season"}
SUBJECT_SCHEMA = StructType(
    [StructField(c, StringType() if c in _TEXT else DoubleType()) for c in SUBJECT_COLUMNS]
)
_FLOATS = ("X", "Y", "Z", "enmo", "anglez", "non_wear_flag", "light", "battery_voltage", "relative_date_PCIAT")


def _name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex}"


def _subject_sql(id_expression: str = "id") -> str:
    doubles = ", ".join(rnd(c, c) for c in SUBJECT_COLUMNS if c not in _TEXT)
    return f"SELECT {id_expression} AS id, season, {doubles} FROM subjects"


@query("read_csv_inferred", _subject_sql("CAST(id AS INT)"))
def read_csv_inferred(spark, sf):
    path = writers.write_csv(subjects(spark, sf), scratch_path(spark, "csv"))
    return readers.read_csv(spark, path)


@query("read_csv_typed", _subject_sql())
def read_csv_typed(spark, sf):
    path = writers.write_csv(subjects(spark, sf), scratch_path(spark, "csv"))
    return readers.read_csv(spark, path, SUBJECT_SCHEMA)


@query(
    "read_parquet_table",
    f"SELECT l_orderkey, l_linenumber, {rnd('l_quantity', 'l_quantity')},"
    f" {rnd('l_extendedprice', 'l_extendedprice')} FROM lineitem",
)
def read_parquet_table(spark, sf):
    return readers.read_parquet(spark, f"{sf}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )


@query(
    "read_parquet_filtered",
    f"SELECT l_orderkey, l_linenumber, {rnd('l_quantity', 'l_quantity')}, {rnd('l_extendedprice', 'l_extendedprice')} FROM lineitem"
    " WHERE l_extendedprice > 30000 AND l_quantity <= 45 AND NOT isnan(l_extendedprice) AND NOT isnan(l_quantity)",
)
def read_parquet_filtered(spark, sf):
    """Filters on floating columns that the scan checks against its row groups."""
    filters = [("l_extendedprice", ">", 30000.0), ("l_quantity", "<=", 45.0)]
    found = readers.read_parquet(spark, f"{sf}/lineitem.parquet", filters=filters)
    return found.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


def _series_files(spark, sf) -> str:
    """Sensor files as stored by the devices: padded participant folders, hyphenated flag."""
    stored = clean.conform_schema(series(spark, sf), SERIES_SCHEMA).withColumn("id", F.lpad("id", 8, "0"))
    spelled = clean.rename_columns(stored, {"non_wear_flag": "non-wear_flag"})
    return writers.write_series(spelled, scratch_path(spark, "series"))


def _series_sql(id_expression: str) -> str:
    floats = ", ".join(rnd(f"CAST({c} AS FLOAT)", c) for c in _FLOATS)
    return f"SELECT {id_expression} AS id, step, time_of_day, weekday, quarter, {floats} FROM series"


@query("read_series", _series_sql("lpad(id, 8, '0')"))
def read_series(spark, sf):
    return readers.read_series(spark, _series_files(spark, sf))


@query("read_series_missing", _series_sql("lpad(id, 8, '0')"))
def read_series_missing(spark, sf):
    roots = [_series_files(spark, sf), scratch_path(spark, "absent")]
    return readers.read_series(spark, roots, skip_unreadable=True)


@query(
    "read_series_filtered",
    _series_sql("lpad(id, 8, '0')") + " WHERE CAST(enmo AS FLOAT) > 60 AND NOT isnan(enmo) AND light IS NOT NULL AND NOT isnan(light) AND light >= 2",
)
def read_series_filtered(spark, sf):
    return readers.read_series(spark, _series_files(spark, sf), filters=[("enmo", ">", 60.0), ("light", ">=", 2.0)])


@query(
    "unreadable_files",
    "SELECT 'missing root' AS reason, CAST(1 AS BIGINT) AS files, count(*) AS rows_read FROM series"
    " UNION ALL SELECT 'no Parquet footer', count(DISTINCT id), count(*) FROM series",
)
def unreadable_files(spark, sf):
    """Of a series with one spoilt file for each participant, and of a missing root: what is reported, and that no sound row is lost."""
    folder = _series_files(spark, sf)
    spoilt = series(spark, sf).select(F.lpad("id", 8, "0").alias("id")).distinct().withColumn("value", F.concat(F.lit("not Parquet "), "id"))
    writers.write_notes(spoilt, folder)
    roots = [folder, scratch_path(spark, "absent")]
    rows = readers.read_series(spark, roots, skip_unreadable=True).agg(F.count("*").alias("n"))
    found = readers.unreadable_files(spark, roots).groupBy("reason").agg(F.count("*").alias("files"))
    return found.withColumn("rows_read", rows.select("n").scalar())


@query("read_catalog_table", _subject_sql())
def read_catalog_table(spark, sf):
    name = writers.save_table(subjects(spark, sf), _name("subjects"), scratch_path(spark, "table"), stamped=False)
    return readers.read_table(spark, name)


@query("write_overwrite_stamped", _subject_sql())
def write_overwrite_stamped(spark, sf):
    name, path = _name("train_set"), scratch_path(spark, "table")
    writers.save_table(subjects(spark, sf).select("id"), name, path)
    writers.save_table(subjects(spark, sf), name, path)
    return clean.drop_columns(readers.read_table(spark, name), ["timestamp"])


@query(
    "append_merge_schema",
    f"SELECT id, {rnd('age', 'age')}, NULL::DOUBLE AS bmi FROM subjects"
    f" UNION ALL SELECT id, {rnd('age', 'age')}, {rnd('bmi', 'bmi')} FROM subjects",
)
def append_merge_schema(spark, sf):
    path = scratch_path(spark, "growing")
    writers.append_parquet(subjects(spark, sf).select("id", "age"), path)
    writers.append_parquet(subjects(spark, sf).select("id", "age", "bmi"), path)
    return readers.read_parquet(spark, path, merge_schema=True)


_SQL_STATS = {"mean": "avg({c})", "std": "stddev_samp({c})", "max": "max({c})", "min": "min({c})"}
SUMMARY_SQL = ", ".join(
    rnd(_SQL_STATS[s].format(c=c), f"{c}_{s}") for c, names in SUMMARY_STATS.items() for s in names
)


@query("create_typed_table", f"SELECT id, {SUMMARY_SQL} FROM series GROUP BY id")
def create_typed_table(spark, sf):
    path = scratch_path(spark, "table")
    name = tables.create_table(
        spark, _name("aggregated_features"), AGGREGATED_FEATURES_SCHEMA, path, {"change_feed": "true"}
    )
    tables.insert_frame(aggregates.series_summary(series(spark, sf)), name)
    return readers.read_table(spark, name)


@query(
    "insert_from_view",
    _series_sql("id")
    .replace("weekday,", "CAST(weekday AS TINYINT) AS weekday,")
    .replace("quarter,", "CAST(quarter AS TINYINT) AS quarter,"),
)
def insert_from_view(spark, sf):
    name = tables.create_table(spark, _name("series"), SERIES_TABLE_SCHEMA, scratch_path(spark, "table"))
    tables.insert_from_view(clean.conform_schema(series(spark, sf), SERIES_TABLE_SCHEMA), "_series_batch", name)
    return readers.read_table(spark, name)


@query(
    "snapshot_changes",
    f"""SELECT coalesce(o.o_custkey, n.o_custkey) AS o_custkey, 'insert' AS _change_type, n.n_orders,
      {rnd('n.largest', 'largest')}
      FROM new_snapshot n LEFT JOIN old_snapshot o ON o.o_custkey = n.o_custkey WHERE o.o_custkey IS NULL
    UNION ALL SELECT o.o_custkey, 'delete', o.n_orders, {rnd('o.largest', 'largest')}
      FROM old_snapshot o LEFT JOIN new_snapshot n ON o.o_custkey = n.o_custkey WHERE n.o_custkey IS NULL
    UNION ALL SELECT o.o_custkey, 'update_preimage', o.n_orders, {rnd('o.largest', 'largest')}
      FROM old_snapshot o JOIN new_snapshot n ON o.o_custkey = n.o_custkey
      WHERE (o.n_orders, o.largest) IS DISTINCT FROM (n.n_orders, n.largest)
    UNION ALL SELECT o.o_custkey, 'update_postimage', n.n_orders, {rnd('n.largest', 'largest')}
      FROM old_snapshot o JOIN new_snapshot n ON o.o_custkey = n.o_custkey
      WHERE (o.n_orders, o.largest) IS DISTINCT FROM (n.n_orders, n.largest)""",
)
def snapshot_changes(spark, sf):
    old, new = snapshots(spark, sf)
    return changes.snapshot_changes(old, new, ["o_custkey"])


@query("check_primary_key", "SELECT id, count(*) AS row_count, id IS NULL AS has_null FROM series GROUP BY id HAVING count(*) > 1")
def check_primary_key(spark, sf):
    return changes.check_primary_key(series(spark, sf), ["id"])


_FLOAT_SERIES = ", ".join(
    f"CAST(CAST({c} AS FLOAT) AS DOUBLE) AS {c}" for c in ("X", "Y", "Z", "enmo", "light", "battery_voltage")
)


@query(
    "feature_table_pipeline",
    f", stored AS (SELECT lpad(id, 8, '0') AS id, step, {_FLOAT_SERIES} FROM series)"
    f" SELECT id, {SUMMARY_SQL}, count(*) FILTER (step % 2 = 1) AS with_device FROM stored GROUP BY id",
)
def feature_table_pipeline(spark, sf):
    """Two batches of folders, the second with a new column and after an empty one, to a table of features."""
    stored = clean.conform_schema(series(spark, sf), SERIES_SCHEMA).withColumn("id", F.lpad("id", 8, "0"))
    stored = clean.rename_columns(stored, {"non_wear_flag": "non-wear_flag"})
    first = writers.write_series(stored.where("step % 2 = 0"), scratch_path(spark, "batch"))
    second = writers.write_series(stored.where("step % 2 = 1").withColumn("device", F.lit("wrist")), scratch_path(spark, "batch"))
    raw = tables.create_table(spark, _name("series"), SERIES_TABLE_SCHEMA, scratch_path(spark, "table"))
    features = tables.create_table(spark, _name("features"), AGGREGATED_FEATURES_SCHEMA, scratch_path(spark, "table"))
    feature_table.append_series(spark, first, raw)
    feature_table.append_series(spark, scratch_path(spark, "absent"), raw)
    feature_table.append_series(spark, second, raw, StructType([*SERIES_SCHEMA, StructField("device", StringType())]))
    feature_table.insert_features(spark, raw, features)
    devices = readers.read_table(spark, raw).groupBy("id").agg(F.count("device").alias("with_device"))
    return joins.left_join(readers.read_table(spark, features), devices, "id")


@query("write_parquet_features", f"SELECT id, {SUMMARY_SQL} FROM series GROUP BY id")
def write_parquet_features(spark, sf):
    path = writers.write_parquet(aggregates.series_summary(series(spark, sf)), scratch_path(spark, "features"))
    return readers.read_parquet(spark, path)


@query("write_json_records", f"SELECT id, {SUMMARY_SQL} FROM series GROUP BY id")
def write_json_records(spark, sf):
    path = writers.write_json(aggregates.series_summary(series(spark, sf)), scratch_path(spark, "json"))
    return spark.read.schema(AGGREGATED_FEATURES_SCHEMA).json(path)


@query(
    "log_run",
    "SELECT 'demo-run' AS run_id, 'threshold' AS model_type, 'main' AS branch, "
    + rnd("avg(CASE WHEN actual = predicted THEN 1.0e0 ELSE 0.0e0 END)", "accuracy")
    + " FROM predictions WHERE actual IS NOT NULL AND predicted IS NOT NULL",
)
def log_run(spark, sf):
    path = scratch_path(spark, "runs")
    measured = accuracy(predictions(spark, sf), "actual", "predicted").first()["accuracy"]
    runlog.log_run(
        spark, path, "demo-run", {"model_type": "threshold"}, {"accuracy": measured}, {"branch": "main"}
    )
    return runlog.read_runs(spark, path).select(
        "run_id",
        F.col("params")["model_type"].alias("model_type"),
        F.col("tags")["branch"].alias("branch"),
        F.col("metrics")["accuracy"].alias("accuracy"),
    )


@query(
    "search_runs",
    "SELECT o_orderkey AS run_id, o_orderpriority AS branch FROM orders WHERE o_orderpriority = '1-URGENT'"
    " ORDER BY o_orderdate DESC, o_orderkey LIMIT 1",
)
def search_runs(spark, sf):
    """Orders as run records: the priority is a tag and the order date the time of the run."""
    runs = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("run_id"),
        F.create_map(F.lit("branch"), "o_orderpriority").alias("tags"),
        F.col("o_orderdate").alias("logged_at"),
    )
    return runlog.search_runs(runs, "branch", "1-URGENT").select("run_id", F.col("tags")["branch"].alias("branch"))


@query(
    "union_positional",
    f"SELECT id, {rnd('age', 'value')} FROM subjects UNION ALL SELECT id, {rnd('enmo', 'value')} FROM series",
)
def union_positional(spark, sf):
    left = subjects(spark, sf).select("id", F.col("age").alias("value"))
    return joins.union_positional([left, series(spark, sf).select("id", "enmo")])


@query(
    "union_by_name",
    f"SELECT id, {rnd('age', 'age')}, NULL::DOUBLE AS enmo FROM subjects"
    f" UNION ALL SELECT id, NULL::DOUBLE AS age, {rnd('enmo', 'enmo')} FROM series",
)
def union_by_name(spark, sf):
    return joins.union_by_name([subjects(spark, sf).select("id", "age"), series(spark, sf).select("enmo", "id")])
