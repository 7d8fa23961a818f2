"""Registry of queries and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.catalog.adapters import VIEWS_SQL
from cohortspark.functions.scalars import quote

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
BUILDERS: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DIGITS = 9


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; doubles are rounded so that summation order cannot show."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(build(spark, sf_dir))

        QUERIES[name], BUILDERS[name] = run, build
        if sql is not None:
            ORACLES[name] = f"WITH {VIEWS_SQL}{sql if sql.lstrip().startswith(',') else ' ' + sql}"
        return build

    return register


def rounded(df: DataFrame) -> DataFrame:
    doubles = [c for c, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: F.round(F.col(quote(c)).cast("double"), DIGITS) for c in doubles}) if doubles else df


def rnd(expression: str, alias: str) -> str:
    """SQL counterpart of ``rounded``; adding zero turns -0.0 into 0.0."""
    return f'round(CAST({expression} AS DOUBLE), {DIGITS}) + 0e0 AS "{alias}"'
