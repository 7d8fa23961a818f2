"""Aggregation and window queries."""

from __future__ import annotations

from cohortspark.catalog.adapters import ITEMS, series, subjects, table
from cohortspark.catalog.q_clean import MASKED_SQL
from cohortspark.catalog.q_scalars import FLAG_SQL, PART_SQL
from cohortspark.catalog.q_sources import SUMMARY_SQL
from cohortspark.catalog.registry import query, rnd
from cohortspark.functions.scalars import DAY_PARTS
from cohortspark.operators import aggregates, clean, joins, windows
from cohortspark.operators.aggregates import DAILY_STATS, FULL_SUMMARY_STATS
from cohortspark.operators.windows import TREND_COLUMNS
from pyspark.sql import functions as F

_SQL_STATS = {
    "mean": "avg({c})",
    "std": "stddev_samp({c})",
    "max": "max({c})",
    "min": "min({c})",
    "sum": "coalesce(sum({c}), 0)",
}


def stats_sql(stats, rounded: bool = True) -> str:
    cells = [(_SQL_STATS[s].format(c=c), f"{c}_{s}") for c, names in stats.items() for s in names]
    return ", ".join(rnd(e, a) if rounded else f"{e} AS {a}" for e, a in cells)


@query("series_summary", f"SELECT id, {SUMMARY_SQL} FROM series GROUP BY id")
def series_summary(spark, sf):
    return aggregates.series_summary(series(spark, sf))


@query("series_summary_full", f"SELECT id, {stats_sql(FULL_SUMMARY_STATS)} FROM series GROUP BY id")
def series_summary_full(spark, sf):
    return aggregates.series_summary_full(series(spark, sf))


@query(
    "daily_summary",
    f"SELECT id, {rnd('relative_date_PCIAT', 'relative_date_PCIAT')}, {stats_sql(DAILY_STATS)}"
    " FROM series GROUP BY id, relative_date_PCIAT",
)
def daily_summary(spark, sf):
    return aggregates.daily_summary(series(spark, sf))


_MEASURES = {"enmo": "avg(enmo)", "light": "avg(light)", "non_wear_flag": "coalesce(sum(non_wear_flag), 0)"}
PERIOD_COLUMNS = [f"{m}_{p}" for m in _MEASURES for p in DAY_PARTS]


def _period_ctes() -> str:
    """One filtered aggregate per measure and part, then the 0-or-NULL rule by the participant's row counts."""
    cells = ", ".join(
        [f"count(*) FILTER (WHERE part = '{p}') AS n_{p}" for p in DAY_PARTS]
        + [
            e.replace(")", f") FILTER (WHERE part = '{p}')", 1) + f" AS {m}_{p}"
            for m, e in _MEASURES.items()
            for p in DAY_PARTS
        ]
    )
    filled = ", ".join(
        f"CASE WHEN n_{p} > 0 THEN {m}_{p} WHEN max(n_{p}) OVER (PARTITION BY id) > 0 THEN 0 END AS {m}_{p}"
        for m in _MEASURES
        for p in DAY_PARTS
    )
    return f"""period_cells AS (SELECT id, weekday_flag, {cells}
        FROM (SELECT *, {FLAG_SQL} AS weekday_flag, {PART_SQL} AS part FROM series) GROUP BY id, weekday_flag),
      period AS (SELECT id, weekday_flag, {filled} FROM period_cells)"""


PERIOD_CTES = _period_ctes()
RATIO_SQL = "coalesce(sum(non_wear_flag), 0) / count(*)"


@query(
    "period_profile",
    f", {PERIOD_CTES} SELECT id, weekday_flag, {', '.join(rnd(c, c) for c in PERIOD_COLUMNS)} FROM period",
)
def period_profile(spark, sf):
    return aggregates.period_profile(series(spark, sf))


@query("non_wear_ratio", f"SELECT id, {rnd(RATIO_SQL, 'non_wear_ratio')} FROM series GROUP BY id")
def non_wear_ratio(spark, sf):
    return aggregates.non_wear_ratio(series(spark, sf))


@query(
    "class_min_max",
    f"SELECT {rnd('sii', 'sii')}, {rnd('min(pciat)', 'minimum')}, {rnd('max(pciat)', 'maximum')}"
    " FROM subjects WHERE sii IS NOT NULL GROUP BY sii",
)
def class_min_max(spark, sf):
    return aggregates.class_min_max(subjects(spark, sf), "sii", "pciat")


@query("value_counts", 'SELECT season AS "value", count(*) AS "count" FROM subjects GROUP BY season')
def value_counts(spark, sf):
    return aggregates.value_counts(subjects(spark, sf), "season")


@query(
    "value_percentages",
    'SELECT season AS "value", count(*) AS "count", '
    + rnd("count(*) * 100.0e0 / (SELECT count(*) FROM subjects)", "percentage")
    + " FROM subjects GROUP BY season",
)
def value_percentages(spark, sf):
    return aggregates.value_percentages(subjects(spark, sf), "season")


@query(
    "histogram",
    f""", masked AS (SELECT {MASKED_SQL} AS v FROM subjects),
      bounds AS (SELECT min(v) AS low, (max(v) - min(v)) / 20 AS width FROM masked),
      binned AS (SELECT CAST(least(floor((v - low) / width), 19) AS INT) AS bin, count(*) AS n
                 FROM masked, bounds WHERE v IS NOT NULL GROUP BY 1)
    SELECT CAST(i AS INT) AS bin, {rnd('low + i * width', 'low')}, {rnd('low + (i + 1) * width', 'high')},
      coalesce(n, 0) AS "count"
    FROM range(20) r(i) CROSS JOIN bounds LEFT JOIN binned ON bin = i""",
)
def histogram(spark, sf):
    masked = clean.mask_incomplete(subjects(spark, sf), "pciat", ITEMS, "complete_total")
    return aggregates.histogram(masked, "complete_total", 20)


@query("row_count_guard", "SELECT count(*) AS row_count FROM series")
def row_count_guard(spark, sf):
    frame = series(spark, sf)
    if aggregates.is_empty(frame):
        return spark.createDataFrame([], "row_count bigint")
    return aggregates.count_rows(frame)


_NUMERIC = ["age", "cgas", "bmi", "hours", "pciat", *ITEMS]


@query(
    "impute_mean",
    "SELECT id, " + ", ".join(rnd(f"coalesce({c}, (SELECT avg({c}) FROM subjects))", c) for c in _NUMERIC)
    + " FROM subjects",
)
def impute_mean(spark, sf):
    frame = subjects(spark, sf).select("id", *_NUMERIC)
    return aggregates.impute(frame, aggregates.fit_means(frame, _NUMERIC))


def mode_sql(c: str) -> str:
    return f"(SELECT {c} FROM subjects WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@query(
    "impute_mode",
    f"SELECT id, coalesce(season, {mode_sql('season')}) AS season,"
    f" {rnd('coalesce(hours, ' + mode_sql('hours') + ')', 'hours')} FROM subjects",
)
def impute_mode(spark, sf):
    frame = subjects(spark, sf).select("id", "season", "hours")
    return aggregates.impute(frame, aggregates.fit_modes(frame, ["season", "hours"]))


@query("count_classes", "SELECT count(DISTINCT sii) AS n_classes FROM subjects")
def count_classes(spark, sf):
    return aggregates.count_classes(subjects(spark, sf), "sii")


_CORRELATED = ["enmo", "hours", "bmi"]


@query(
    "correlations",
    ", joined AS (SELECT s.hours, s.bmi, f.enmo FROM subjects s LEFT JOIN"
    " (SELECT id, avg(enmo) AS enmo FROM series GROUP BY id) f USING (id)) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", {rnd(f'corr({a}, {b})', 'correlation')} FROM joined"
        for i, a in enumerate(_CORRELATED)
        for b in _CORRELATED[i + 1 :]
    ),
)
def correlations(spark, sf):
    """Activity, internet use and body mass: the pairwise correlations the study asks about."""
    activity = aggregates.series_summary(series(spark, sf)).select("id", F.col("enmo_mean").alias("enmo"))
    joined = joins.left_join(subjects(spark, sf).select("id", "hours", "bmi"), activity, "id")
    return aggregates.correlations(joined, _CORRELATED)


DAILY_CTE = (
    f"daily AS (SELECT id, relative_date_PCIAT, {stats_sql(DAILY_STATS, rounded=False)}"
    " FROM series GROUP BY id, relative_date_PCIAT)"
)
_W = "PARTITION BY id ORDER BY relative_date_PCIAT"
LAG_SQL = ", ".join(rnd(f"lag({c}) OVER ({_W})", f"{c}_lag1") for c in TREND_COLUMNS)
_FRAME = f"({_W} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"
ROLLING_SQL = ", ".join(
    rnd(f"CASE WHEN count({c}) OVER {_FRAME} = 3 THEN avg({c}) OVER {_FRAME} END", f"{c}_rolling3")
    for c in TREND_COLUMNS
)
_DAY = rnd("relative_date_PCIAT", "relative_date_PCIAT")


@query("daily_lag1", f", {DAILY_CTE} SELECT id, {_DAY}, {LAG_SQL} FROM daily")
def daily_lag1(spark, sf):
    lagged = windows.add_lag(aggregates.daily_summary(series(spark, sf)))
    return lagged.select("id", "relative_date_PCIAT", *[f"{c}_lag1" for c in TREND_COLUMNS])


@query("daily_rolling3", f", {DAILY_CTE} SELECT id, {_DAY}, {ROLLING_SQL} FROM daily")
def daily_rolling3(spark, sf):
    rolled = windows.add_rolling_mean(aggregates.daily_summary(series(spark, sf)))
    return rolled.select("id", "relative_date_PCIAT", *[f"{c}_rolling3" for c in TREND_COLUMNS])


@query("top_n", f"SELECT p_partkey, {rnd('p_retailprice', 'p_retailprice')} FROM part ORDER BY part.p_retailprice DESC, p_partkey LIMIT 10")
def top_n(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    return joins.top_n(parts, 10, "p_retailprice", ["p_partkey"])
