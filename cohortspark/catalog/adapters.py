"""The given tables seen as series, subjects, predictions and snapshots, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortspark.schemas import CohortSpec

ITEMS = tuple(f"item_{i:02d}" for i in range(1, 21))
SUBJECT_SPEC = CohortSpec(
    numeric=("age", "cgas", "bmi", "hours", *ITEMS, "pciat"),
    categorical=("season", "sex"),
    target="sii",
    age="age",
    sex="sex",
    function_score="cgas",
    bmi="bmi",
    total="pciat",
    hours="hours",
    items=ITEMS,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Columns written alike in both dialects.
_SERIES_COMMON = """
  event_id AS step,
  value - 50.0e0 AS X,
  CAST(event_id % 97 AS DOUBLE) AS Y,
  CAST(event_id % 13 AS DOUBLE) - 6.0e0 AS Z,
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS enmo,
  CAST(event_id % 181 AS DOUBLE) - 90.0e0 AS anglez,
  CASE WHEN event_type = 'error' THEN 1.0e0 ELSE 0.0e0 END AS non_wear_flag,
  CASE WHEN event_id % 23 = 0 THEN NULL ELSE 3000.0e0 + event_id % 1200 END AS battery_voltage,
  CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS BIGINT) AS time_of_day,
  CAST(quarter(ts) AS INT) AS quarter
"""
_SERIES_SPARK = """
  CAST(user_id AS STRING) AS id,
  CAST(datediff(CAST(ts AS DATE), DATE'2024-01-01') AS DOUBLE) AS relative_date_PCIAT,
  CAST(weekday(ts) + 1 AS INT) AS weekday,
  CAST(get_json_object(props, '$.k') AS DOUBLE) AS light
"""
_SERIES_DUCK = """
  CAST(user_id AS VARCHAR) AS id,
  CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS DOUBLE) AS relative_date_PCIAT,
  CAST(isodow(ts) AS INT) AS weekday,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) AS light
"""

_PCIAT = "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST((c_custkey * 37) % 101 AS DOUBLE) END"
_ITEM_COLUMNS = ",\n  ".join(
    f"CASE WHEN (c_custkey + {i}) % 29 = 0 THEN NULL ELSE CAST((c_custkey * {i}) % 6 AS DOUBLE) END AS {name}"
    for i, name in enumerate(ITEMS, 1)
)
_SUBJECTS_COMMON = f"""
  c_custkey,
  5.0e0 + c_custkey % 18 AS age,
  CAST(c_custkey % 2 AS DOUBLE) AS sex,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 25.0e0 + c_custkey % 75 END AS cgas,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE round(12.0e0 + abs(c_acctbal) / 400.0e0, 2) END AS bmi,
  {_PCIAT} AS pciat,
  CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE CAST(c_custkey % 4 AS DOUBLE) END AS hours,
  {_ITEM_COLUMNS},
  CASE WHEN c_custkey % 6 = 0 THEN NULL
       WHEN c_nationkey % 4 = 0 THEN 'Spring' WHEN c_nationkey % 4 = 1 THEN 'Summer'
       WHEN c_nationkey % 4 = 2 THEN 'Fall' ELSE 'Winter' END AS season
"""
_SII = """CASE WHEN pciat <= 30 THEN 0.0e0 WHEN pciat <= 49 THEN 1.0e0
       WHEN pciat <= 79 THEN 2.0e0 WHEN pciat <= 100 THEN 3.0e0 END AS sii"""
SUBJECT_COLUMNS = ["id", "age", "sex", "cgas", "bmi", "pciat", "hours", *ITEMS, "season", "sii"]


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(f"SELECT {_SERIES_SPARK}, {_SERIES_COMMON} FROM {{events}}", events=table(spark, sf_dir, "events"))


def _keyed_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        f"SELECT *, {_SII} FROM (SELECT CAST(c_custkey AS STRING) AS id, {_SUBJECTS_COMMON} FROM {{customer}})",
        customer=table(spark, sf_dir, "customer"),
    )


def subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed_subjects(spark, sf_dir).select(*SUBJECT_COLUMNS)


_PREDICTIONS = """SELECT id, CAST(floor(pciat / 26) AS INT) AS actual, CAST(hours AS INT) AS predicted,
    (c_custkey * 53) % 400 / 100.0e0 AS score FROM {source}"""


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actual and predicted class and a score; NULL classes stay and are skipped by the metrics."""
    return spark.sql(_PREDICTIONS.format(source="{keyed}"), keyed=_keyed_subjects(spark, sf_dir))


# Both snapshots together cover all orders; customers come, go and change between them.
_OLD, _NEW = "o_orderdate < TIMESTAMP '1996-01-01'", "o_orderdate >= TIMESTAMP '1994-01-01'"


def _snapshot_sql(dates: str, source: str) -> str:
    """Per-customer order summary of some dates."""
    return f"""SELECT o_custkey, count(*) AS n_orders, max(o_totalprice) AS largest FROM {source}
      WHERE {dates} GROUP BY o_custkey"""


def snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")

    def of(dates: str) -> DataFrame:
        return spark.sql(_snapshot_sql(dates, "{orders}").replace("TIMESTAMP '", "TIMESTAMP_NTZ '"), orders=orders)

    return of(_OLD), of(_NEW)


VIEWS_SQL = f"""series AS (SELECT {_SERIES_DUCK}, {_SERIES_COMMON} FROM events),
keyed AS (SELECT *, {_SII} FROM (SELECT CAST(c_custkey AS VARCHAR) AS id, {_SUBJECTS_COMMON} FROM customer)),
subjects AS (SELECT {", ".join(SUBJECT_COLUMNS)} FROM keyed),
predictions AS ({_PREDICTIONS.format(source="keyed")}),
old_snapshot AS ({_snapshot_sql(_OLD, "orders")}),
new_snapshot AS ({_snapshot_sql(_NEW, "orders")})"""
