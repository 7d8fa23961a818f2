"""Composite plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortspark.catalog.adapters import ITEMS, SUBJECT_SPEC, series, subjects
from cohortspark.catalog.q_aggregates import DAILY_CTE, LAG_SQL, ROLLING_SQL, mode_sql
from cohortspark.catalog.q_encode import flags_sql, split_cte
from cohortspark.catalog.q_joins import BLOCKS_SQL
from cohortspark.catalog.q_models import beside
from cohortspark.catalog.q_scalars import AGE_SQL, BMI_SQL, HOURS_SQL, PCIAT_SQL
from cohortspark.catalog.registry import query, rnd
from cohortspark.functions.scalars import register_multiplier
from cohortspark.models import trees
from cohortspark.operators import aggregates, split
from cohortspark.operators.aggregates import DAILY_STATS
from cohortspark.plans import cohort, training
from cohortspark.plans import series as series_plans
from cohortspark.session import scratch_path
from cohortspark.sources import readers, writers

_NUMERIC = ["age", "cgas", "bmi", "hours", *ITEMS, "pciat"]
_FILLED = ", ".join(f"coalesce({c}, (SELECT avg({c}) FROM subjects)) AS {c}" for c in _NUMERIC)


def _scaled(c: str) -> str:
    deviation = f"stddev_pop({c}) OVER ()"
    return f"({c} - avg({c}) OVER ()) / (CASE WHEN {deviation} = 0 THEN 1 ELSE {deviation} END)"


@query(
    "prepare_cohort",
    f""", filled AS (SELECT id, sii, {_FILLED}, coalesce(season, {mode_sql('season')}) AS season,
        CASE coalesce(sex, {mode_sql('sex')}) WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' END AS sex FROM subjects)
    SELECT id, season, sex, {rnd('coalesce(sii, 4)', 'sii')},
      {', '.join(rnd(_scaled(c), c) for c in _NUMERIC)},
      {AGE_SQL} AS "Age_Group", {PCIAT_SQL} AS "PCIAT_Bin", {HOURS_SQL} AS "Internet_Use_Category",
      {rnd('cgas / age', 'Age_Adjusted_CGAS')}, {BMI_SQL} AS "BMI_Category",
      {flags_sql('season', ['Fall', 'Spring', 'Summer', 'Winter'])}
    FROM filled""",
)
def prepare_cohort(spark, sf):
    return cohort.prepare_cohort(subjects(spark, sf), SUBJECT_SPEC, keep_engineered=True)


@query("participant_features", BLOCKS_SQL)
def participant_features(spark, sf):
    return series_plans.participant_features(series(spark, sf))


_DAILY = ", ".join(rnd(f"{c}_{s}", f"{c}_{s}") for c, names in DAILY_STATS.items() for s in names)


@query(
    "daily_features",
    f", {DAILY_CTE} SELECT id, {rnd('relative_date_PCIAT', 'relative_date_PCIAT')}, {_DAILY}, {LAG_SQL}, {ROLLING_SQL} FROM daily",
)
def daily_features(spark, sf):
    return series_plans.daily_features(series(spark, sf), forecast=False)


@query("daily_features_forecast")
def daily_features_forecast(spark, sf):
    return series_plans.daily_features(series(spark, sf))


@query(
    "training_set",
    f", s AS (SELECT id, age, sii FROM subjects), {split_cte('cut', '0.2e0', 's')},"
    " f AS (SELECT id, avg(X) AS X_mean, avg(Y) AS Y_mean, avg(Z) AS Z_mean,"
    " avg(battery_voltage) AS battery_voltage_mean FROM series GROUP BY id)"
    f" SELECT id, {rnd('age', 'age')}, {rnd('sii', 'sii')}, split, "
    + ", ".join(rnd(c, c) for c in training.LOOKUP_FEATURES)
    + f", {rnd('battery_voltage_mean * 1.2e0', 'battery_voltage_mean_moving_avg')}"
    " FROM cut LEFT JOIN f USING (id)",
)
def training_set(spark, sf):
    """Training and testing rows, told apart by ``split``, with their looked-up features."""
    labelled = split.split_random(subjects(spark, sf).select("id", "age", "sii"))
    return _with_lookups(labelled, aggregates.series_summary(series(spark, sf)))


def _with_lookups(rows, features):
    function = register_multiplier(rows.sparkSession, "moving_average_battery_voltage")
    return training.create_training_set(
        rows,
        features,
        functions={"battery_voltage_mean_moving_avg": (function, {"x": "battery_voltage_mean"})},
    )


@query(
    "train_and_evaluate",
    f", s AS (SELECT id, sii FROM subjects), {split_cte('cut', '0.2e0', 's')},"
    " h AS (SELECT CAST(CAST(sii AS INT) AS VARCHAR) AS label FROM cut WHERE split = 'test' AND sii IS NOT NULL),"
    " trained AS (SELECT sii, count(*) AS n FROM cut WHERE split = 'train' AND sii IS NOT NULL GROUP BY sii),"
    f" r AS (SELECT label, count(*) AS support FROM h GROUP BY label"
    " UNION ALL SELECT unnest(['accuracy', 'macro avg', 'weighted avg']), (SELECT count(*) FROM h))"
    f" SELECT label, support, true AS accuracy_agrees, {rnd('(SELECT max(n) / sum(n) FROM trained)', 'majority')}, true AS beats_majority FROM r",
)
def train_and_evaluate(spark, sf):
    """Store the series features, split, look features up, train on one part and report on the other.

    The rows with their features are written once, as they are passed over for training, testing and judging, and spread by their
    number, or a file small in bytes would have one task score them with every tree.
    """
    stored = writers.write_parquet(aggregates.series_summary(series(spark, sf)), scratch_path(spark, "features"))
    features = readers.read_parquet(spark, stored)
    labelled = _with_lookups(split.split_random(subjects(spark, sf)), features)
    parts = trees.spread(subjects(spark, sf).count(), spark)
    rows = readers.read_parquet(spark, writers.write_parquet(labelled.repartition(parts, "id"), scratch_path(spark, "run-rows")))
    train = split.take(rows, "train")
    run = training.train_and_evaluate(
        train,
        split.take(rows, "test"),
        SUBJECT_SPEC,
        passthrough=["battery_voltage_mean_moving_avg"],
    )
    again = run.scored.agg(F.avg((F.col("actual") == F.col("predicted_class")).cast("double")).alias("a"))
    fitted = trees.fit_quality(run.model, train, "sii")
    quality = beside(fitted, again).select(
        (F.abs(F.col("a") - F.lit(run.accuracy)) < 1e-9).alias("accuracy_agrees"),
        "majority",
        trees.has_learnt(fitted).alias("beats_majority"),
    )
    return beside(run.report.where("section > 0 OR support > 0").select("label", "support"), quality)
