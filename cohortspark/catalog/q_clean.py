"""Projection, filtering and cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, IntegerType, StringType, StructField, StructType

from cohortspark.catalog.adapters import ITEMS, SUBJECT_SPEC, series, subjects, table
from cohortspark.catalog.registry import query, rnd
from cohortspark.operators import clean

_NUMERIC = SUBJECT_SPEC.numeric
_LEVELS = ["Spring", "Summer", "Fall", "Winter"]
# Severity labels by class.
SEVERITY = {0.0: "0 (None)", 1.0: "1 (Mild)", 2.0: "2 (Moderate)", 3.0: "3 (Severe)"}
_SEVERITY_SQL = "CASE " + " ".join(f"WHEN sii = {k}e0 THEN '{v}'" for k, v in SEVERITY.items()) + " END"


@query(
    "select_features",
    "SELECT id, season, " + ", ".join(rnd(c, c) for c in [*_NUMERIC, "sex", "sii"]) + " FROM subjects",
)
def select_features(spark, sf):
    return clean.select_features(subjects(spark, sf), SUBJECT_SPEC)


@query("select_by_regex", "SELECT " + ", ".join(rnd(c, c) for c in [*ITEMS, "pciat"]) + " FROM subjects")
def select_by_regex(spark, sf):
    return clean.select_by_regex(subjects(spark, sf), [r"^item_.*", r"^pciat"])


@query("drop_columns", f"SELECT id, time_of_day, {rnd('enmo', 'enmo')} FROM series")
def drop_columns(spark, sf):
    frame = series(spark, sf).select("id", "step", "time_of_day", "enmo", "non_wear_flag")
    return clean.drop_columns(frame, ["step", "non_wear_flag", "absent"])


@query("rename_columns", f"SELECT id, time_of_day AS ds, {rnd('enmo', 'y')} FROM series")
def rename_columns(spark, sf):
    return clean.rename_columns(series(spark, sf).select("id", "time_of_day", "enmo"), {"time_of_day": "ds", "enmo": "y"})


@query(
    "conform_schema",
    f"SELECT id, CAST(weekday AS VARCHAR) AS weekday, {rnd('CAST(X AS FLOAT)', 'X')},"
    " CAST(time_of_day AS INT) AS time_of_day FROM series",
)
def conform_schema(spark, sf):
    target = StructType(
        [
            StructField("weekday", StringType()),
            StructField("X", FloatType()),
            StructField("time_of_day", IntegerType()),
            StructField("not_present", IntegerType()),
        ]
    )
    return clean.conform_schema(series(spark, sf).select("id", "weekday", "X", "time_of_day"), target)


@query(
    "coerce_numeric",
    f"SELECT c_custkey, {rnd('CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END', 'reading')} FROM customer",
)
def coerce_numeric(spark, sf):
    text = F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).otherwise(F.col("c_acctbal").cast("string"))
    return clean.coerce_numeric(table(spark, sf, "customer").select("c_custkey", text.alias("reading")), ["reading"])


@query("tag_literal", "SELECT id, step, 'wave-1' AS cohort FROM series")
def tag_literal(spark, sf):
    return clean.tag_literal(series(spark, sf).select("id", "step"), "cohort", "wave-1")


@query("filter_equals", f"SELECT id, step, {rnd('enmo', 'enmo')} FROM series WHERE id = '7'")
def filter_equals(spark, sf):
    return clean.filter_equals(series(spark, sf).select("id", "step", "enmo"), "id", "7")


@query("filter_not_null", f"SELECT id, {rnd('sii', 'sii')} FROM subjects WHERE sii IS NOT NULL")
def filter_not_null(spark, sf):
    return clean.filter_not_null(subjects(spark, sf).select("id", "sii"), "sii")


@query(
    "drop_null_rows",
    f"SELECT id, step, {rnd('enmo', 'enmo')}, {rnd('battery_voltage', 'battery_voltage')} FROM series"
    " WHERE enmo IS NOT NULL AND battery_voltage IS NOT NULL",
)
def drop_null_rows(spark, sf):
    frame = series(spark, sf).select("id", "step", "enmo", "battery_voltage")
    return clean.drop_null_rows(frame, ["enmo", "battery_voltage"])


@query("head_rows", f"SELECT id, step, {rnd('enmo', 'enmo')} FROM series ORDER BY step LIMIT 5")
def head_rows(spark, sf):
    return clean.head_rows(series(spark, sf).select("id", "step", "enmo"), 5, ["step"])


@query(
    "distinct_pairs",
    f"SELECT DISTINCT time_of_day, {rnd('relative_date_PCIAT', 'relative_date_PCIAT')} FROM series",
)
def distinct_pairs(spark, sf):
    return clean.distinct_values(series(spark, sf), ["time_of_day", "relative_date_PCIAT"])


@query(
    "dedup_columns",
    f"SELECT s.id, {rnd('s.age', 'age')}, {rnd('s.bmi', 'bmi')}, {rnd('s.cgas', 'cgas')} FROM subjects s",
)
def dedup_columns(spark, sf):
    frame = subjects(spark, sf)
    blocks = clean.dedup_columns(
        [frame.select("id", "age", "bmi"), frame.select("id", "bmi", "cgas"), frame.select("id", "age")], "id"
    )
    first, second, third = blocks
    return first.join(second, "id", "left").join(third, "id", "left")


_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in ITEMS)
MASKED_SQL = f"CASE WHEN {_COMPLETE} THEN pciat END"


@query("mask_incomplete", f"SELECT id, {rnd(MASKED_SQL, 'complete_total')} FROM subjects")
def mask_incomplete(spark, sf):
    return clean.mask_incomplete(subjects(spark, sf), "pciat", ITEMS, "complete_total").select("id", "complete_total")


@query("fill_constant", f"SELECT id, coalesce(season, 'Missing') AS season, {rnd('coalesce(sii, 4)', 'sii')} FROM subjects")
def fill_constant(spark, sf):
    frame = clean.fill_constant(subjects(spark, sf).select("id", "season", "sii"), "Missing", ["season"])
    return clean.fill_constant(frame, 4.0, ["sii"])


@query("map_codes", f"SELECT id, {_SEVERITY_SQL} AS severity FROM subjects")
def map_codes(spark, sf):
    return clean.map_codes(subjects(spark, sf), "sii", SEVERITY, "severity").select("id", "severity")


@query(
    "order_categories",
    "SELECT id, season, CASE season WHEN 'Spring' THEN 0 WHEN 'Summer' THEN 1 WHEN 'Fall' THEN 2"
    " WHEN 'Winter' THEN 3 END AS place FROM subjects ORDER BY place NULLS LAST, id",
)
def order_categories(spark, sf):
    frame = subjects(spark, sf).select("id", "season").withColumn("place", clean.category_rank("season", _LEVELS))
    return clean.order_categories(frame, "season", _LEVELS, ["id"])


@query(
    "index_category",
    ", codes AS (SELECT season, CAST(row_number() OVER (ORDER BY season) - 1 AS INT) AS code"
    " FROM (SELECT DISTINCT season FROM subjects WHERE season IS NOT NULL))"
    " SELECT s.id, s.season, coalesce(c.code, -1) AS season_code FROM subjects s LEFT JOIN codes c USING (season)",
)
def index_category(spark, sf):
    return clean.index_category(subjects(spark, sf).select("id", "season"), "season", "season_code")


@query(
    "ensure_id",
    f"SELECT row_number() OVER (ORDER BY step) - 1 AS row_id, step, {rnd('enmo', 'enmo')} FROM series",
)
def ensure_id(spark, sf):
    return clean.ensure_id(series(spark, sf).select("step", "enmo"), ["step"], "row_id")


@query("add_missing_columns", f"SELECT id, {rnd('age', 'age')}, NULL::DOUBLE AS height FROM subjects")
def add_missing_columns(spark, sf):
    return clean.add_missing_columns(subjects(spark, sf).select("id", "age"), ["age", "height"])


@query(
    "key_schema_report",
    "SELECT position, column_name, data_type, (SELECT count(*) FROM series) AS row_count, 4 AS column_count"
    " FROM (VALUES (0, 'id', 'string'), (1, 'step', 'bigint'), (2, 'enmo', 'double'), (3, 'weekday', 'int'))"
    " t(position, column_name, data_type)",
)
def key_schema_report(spark, sf):
    return clean.schema_report(series(spark, sf).select("id", "step", "enmo", "weekday"))
