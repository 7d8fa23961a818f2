"""Run records as a table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_SCHEMA = (
    "run_id string, params map<string,string>, metrics map<string,double>, tags map<string,string>, logged_at timestamp"
)


def log_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    params: Mapping[str, object] | None = None,
    metrics: Mapping[str, float] | None = None,
    tags: Mapping[str, str] | None = None,
) -> str:
    """Append one run to the run log."""
    record = (
        run_id,
        {k: str(v) for k, v in (params or {}).items()},
        {k: float(v) for k, v in (metrics or {}).items()},
        dict(tags or {}),
    )
    frame = spark.createDataFrame([record], RUN_SCHEMA.rsplit(",", 1)[0])
    frame.withColumn("logged_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(path)
    return path


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def search_runs(runs: DataFrame, tag: str, value: str, limit: int | None = 1, time: str = "logged_at") -> DataFrame:
    """Runs whose tag has the value, newest first; equal times by run id. ``limit=None`` returns all."""
    found = runs.where(F.col("tags")[tag] == value).orderBy(F.desc(time), "run_id")
    return found if limit is None else found.limit(limit)
