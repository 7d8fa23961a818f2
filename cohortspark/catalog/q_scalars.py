"""Scalar function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortspark.catalog.adapters import predictions, series, subjects, table
from cohortspark.catalog.registry import query, rnd
from cohortspark.functions import scalars


def _cut_sql(c: str, edges, labels) -> str:
    branches = " ".join(
        f"WHEN {c} > {low} AND {c} <= {high} THEN '{label}'"
        for low, high, label in zip(edges[:-1], edges[1:], labels, strict=True)
    )
    return f"CASE {branches} END"


INF = "1e308"
AGE_SQL = _cut_sql("age", [0, 12, 17, 25], ["Child", "Teen", "Young Adult"])
PCIAT_SQL = _cut_sql("pciat", [0, 20, 40, 60], ["Mild", "Moderate", "Severe"])
HOURS_SQL = _cut_sql("hours", [0, 1, 3, 6, INF], ["Low", "Moderate", "High", "Very High"])
BMI_SQL = _cut_sql("bmi", [0, 18.5, 25, 30, INF], ["Underweight", "Normal", "Overweight", "Obese"])
FLAG_SQL = "CASE WHEN weekday < 5 THEN 'weekday' ELSE 'weekend' END"
PART_SQL = (
    "CASE WHEN time_of_day < 21600 THEN 'night' WHEN time_of_day < 43200 THEN 'morning'"
    " WHEN time_of_day < 64800 THEN 'afternoon' WHEN time_of_day >= 64800 THEN 'evening' ELSE 'unknown' END"
)


def _over_subjects(name: str, column: str, function, alias: str, sql: str) -> None:
    @query(name, f"SELECT id, {rnd(column, column)}, {sql} AS {alias} FROM subjects")
    def build(spark, sf):
        return subjects(spark, sf).select("id", column, function(column).alias(alias))


_over_subjects("cut_age_group", "age", scalars.age_group, "age_group", AGE_SQL)
_over_subjects("cut_pciat", "pciat", scalars.questionnaire_bin, "pciat_bin", PCIAT_SQL)
_over_subjects("cut_internet_use", "hours", scalars.internet_use_category, "internet_use", HOURS_SQL)
_over_subjects("cut_bmi", "bmi", scalars.bmi_category, "bmi_category", BMI_SQL)


@query("severity_index", f"SELECT id, {rnd('sii', 'sii')} FROM subjects")
def severity_index(spark, sf):
    return subjects(spark, sf).select("id", scalars.severity_index("pciat").alias("sii"))


@query("weekday_flag", f"SELECT id, step, {FLAG_SQL} AS weekday_flag FROM series")
def weekday_flag(spark, sf):
    return series(spark, sf).select("id", "step", scalars.weekday_flag("weekday").alias("weekday_flag"))


@query("day_part", f"SELECT id, step, {PART_SQL} AS day_part FROM series")
def day_part(spark, sf):
    return series(spark, sf).select("id", "step", scalars.day_part("time_of_day").alias("day_part"))


@query("age_adjusted_score", f"SELECT id, {rnd('cgas / age', 'age_adjusted')} FROM subjects")
def age_adjusted_score(spark, sf):
    return subjects(spark, sf).select("id", scalars.age_adjusted_score("cgas", "age").alias("age_adjusted"))


@query("scale_prediction", f"SELECT id, {rnd('score * 1.3e0', 'adjusted')} FROM predictions")
def scale_prediction(spark, sf):
    return predictions(spark, sf).select("id", scalars.scale_prediction("score").alias("adjusted"))


@query("null_guarded_multiply", f"SELECT id, step, {rnd('battery_voltage * 1.2e0', 'scaled')} FROM series")
def null_guarded_multiply(spark, sf):
    function = scalars.register_multiplier(spark, "scale_voltage", 1.2)
    return series(spark, sf).select("id", "step", F.expr(f"{function}(battery_voltage)").alias("scaled"))


def _epoch(name: str, factor: int) -> None:
    """Epoch text with unreadable entries, in seconds or (factor 1000) milliseconds."""
    bad = "event_id % 19 = 0"

    @query(
        name,
        f"SELECT event_id, CASE WHEN {bad} THEN NULL ELSE epoch_us(date_trunc('second', ts)) END AS micros FROM events",
    )
    def build(spark, sf):
        whole = "datediff(CAST(ts AS DATE), DATE'1970-01-01') * 86400L + hour(ts) * 3600 + minute(ts) * 60 + second(ts)"
        text = f"CASE WHEN {bad} THEN 'unreadable' ELSE CAST(({whole}) * {factor}L AS STRING) END AS raw"
        frame = table(spark, sf, "events").selectExpr("event_id", text)
        stamped = scalars.epoch_to_timestamp(frame, "raw", "at")
        return stamped.select("event_id", F.unix_micros("at").alias("micros"))


_epoch("epoch_to_timestamp", 1)
_epoch("epoch_millis_to_timestamp", 1000)


@query("id_from_path", "SELECT event_id, CAST(user_id AS VARCHAR) AS id FROM events")
def id_from_path(spark, sf):
    folder = F.concat(F.lit("/data/series.parquet/id="), F.col("user_id").cast("string"), F.lit("/"))
    return table(spark, sf, "events").select("event_id", scalars.id_from_path(folder).alias("id"))


@query(
    "argmax_class",
    "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INT) AS predicted FROM embeddings",
)
def argmax_class(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", scalars.argmax_class("embedding").alias("predicted"))


@query(
    "threshold_round",
    "SELECT id, CAST(CASE WHEN score < 0.5e0 THEN 0 WHEN score < 1.5e0 THEN 1 WHEN score < 2.5e0 THEN 2"
    " WHEN score < 3.5e0 THEN 3 ELSE 4 END AS INT) AS class FROM predictions",
)
def threshold_round(spark, sf):
    return predictions(spark, sf).select("id", scalars.threshold_round("score").alias("class"))


@query("round_class", "SELECT id, CAST(round_even(score, 0) AS INT) AS class FROM predictions")
def round_class(spark, sf):
    return predictions(spark, sf).select("id", scalars.round_class("score").alias("class"))
