"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortspark.catalog.adapters import series, subjects, table
from cohortspark.catalog.q_aggregates import PERIOD_COLUMNS, PERIOD_CTES, RATIO_SQL, stats_sql
from cohortspark.catalog.q_sources import SUMMARY_SQL
from cohortspark.catalog.registry import query, rnd
from cohortspark.models.forecast import future_frame, sample_time
from cohortspark.operators import aggregates, joins
from cohortspark.operators.aggregates import FULL_SUMMARY_STATS, SUMMARY_STATS

_SUMMARY = [f"{c}_{s}" for c, names in SUMMARY_STATS.items() for s in names]
_FULL = [f"{c}_{s}" for c, names in FULL_SUMMARY_STATS.items() for s in names]
_AGE = rnd("age", "age")


@query(
    "join_subject_features",
    f", f AS (SELECT id, {SUMMARY_SQL} FROM series GROUP BY id)"
    f" SELECT id, season, {_AGE}, {', '.join(_SUMMARY)} FROM subjects LEFT JOIN f USING (id)",
)
def join_subject_features(spark, sf):
    features = aggregates.series_summary(series(spark, sf))
    return joins.left_join(subjects(spark, sf).select("id", "season", "age"), features, "id")


BLOCKS_SQL = (
    f", {PERIOD_CTES}, summary AS (SELECT id, {stats_sql(FULL_SUMMARY_STATS, rounded=False)} FROM series GROUP BY id),"
    f" ratio AS (SELECT id, {RATIO_SQL} AS non_wear_ratio FROM series GROUP BY id)"
    f" SELECT id, {', '.join(rnd(c, c) for c in _FULL)}, weekday_flag,"
    f" {', '.join(rnd(c, c) for c in PERIOD_COLUMNS)}, {rnd('non_wear_ratio', 'non_wear_ratio')}"
    " FROM summary LEFT JOIN period USING (id) LEFT JOIN ratio USING (id)"
)


@query("join_feature_blocks", BLOCKS_SQL)
def join_feature_blocks(spark, sf):
    frame = series(spark, sf)
    return joins.join_blocks(
        [aggregates.series_summary_full(frame), aggregates.period_profile(frame), aggregates.non_wear_ratio(frame)]
    )


@query(
    "join_daily_forecast",
    ", per_day AS (SELECT id, relative_date_PCIAT, avg(enmo) AS enmo_mean FROM series GROUP BY 1, 2),"
    " expected AS (SELECT CAST(o_custkey AS VARCHAR) AS id,"
    " CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 30 AS DOUBLE) AS relative_date_PCIAT,"
    " avg(o_totalprice) AS forecast FROM orders GROUP BY 1, 2)"
    f" SELECT id, {rnd('relative_date_PCIAT', 'relative_date_PCIAT')}, {rnd('enmo_mean', 'enmo_mean')},"
    f" {rnd('round(forecast, 4)', 'forecast')} FROM per_day LEFT JOIN expected USING (id, relative_date_PCIAT)",
)
def join_daily_forecast(spark, sf):
    """Daily rows with a second daily table joined on participant and relative day."""
    per_day = aggregates.summarise(series(spark, sf), ["id", "relative_date_PCIAT"], {"enmo": ("mean",)})
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date")) % 30
    expected = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").cast("string").alias("id"), day.cast("double").alias("relative_date_PCIAT"))
        .agg(F.round(F.avg("o_totalprice"), 4).alias("forecast"))
    )
    return joins.left_join(per_day, expected, ["id", "relative_date_PCIAT"])


_DS = "CAST(relative_date_PCIAT * 86400 + time_of_day AS BIGINT)"


@query(
    "join_on_timestamp",
    f", timed AS (SELECT id, {_DS} AS ds, relative_date_PCIAT FROM series),"
    " frames AS (SELECT DISTINCT id, ds, false AS is_future FROM timed UNION ALL"
    " SELECT id, last_ds + i * 86400, true FROM (SELECT id, max(ds) AS last_ds FROM timed GROUP BY id), range(1, 8) r(i))"
    f" SELECT id, ds, is_future, {rnd('relative_date_PCIAT', 'relative_date_PCIAT')}"
    " FROM frames LEFT JOIN (SELECT DISTINCT * FROM timed) USING (id, ds)",
)
def join_on_timestamp(spark, sf):
    timed = series(spark, sf).select("id", sample_time().alias("ds"), "relative_date_PCIAT")
    return joins.left_join(future_frame(timed), timed.distinct(), ["id", "ds"])


@query(
    "feature_lookup",
    ", f AS (SELECT id, avg(X) AS X_mean, avg(battery_voltage) AS battery_voltage_mean FROM series GROUP BY id)"
    f" SELECT id, {rnd('sii', 'sii')}, {rnd('X_mean', 'X_mean')}, {rnd('battery_voltage_mean', 'battery_voltage_mean')}"
    " FROM subjects LEFT JOIN f USING (id)",
)
def feature_lookup(spark, sf):
    rows = subjects(spark, sf).select("id", "sii", "season")
    features = aggregates.series_summary(series(spark, sf))
    return joins.feature_lookup(rows, features, ["X_mean", "battery_voltage_mean"], exclude=["season", "absent"])


@query(
    "concat_columns_by_key",
    ", samples AS (SELECT id, count(*) AS n_samples, sum(non_wear_flag) AS non_wear FROM series GROUP BY id),"
    " bought AS (SELECT CAST(o_custkey AS VARCHAR) AS id, count(*) AS n_orders FROM orders GROUP BY 1)"
    f" SELECT id, n_samples, {rnd('non_wear', 'non_wear')}, n_orders FROM samples FULL JOIN bought USING (id)",
)
def concat_columns_by_key(spark, sf):
    samples = series(spark, sf).groupBy("id").agg(
        F.count(F.lit(1)).alias("n_samples"), F.sum("non_wear_flag").alias("non_wear")
    )
    bought = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").cast("string").alias("id"))
        .agg(F.count(F.lit(1)).alias("n_orders"))
    )
    return joins.concat_columns([samples, bought])
