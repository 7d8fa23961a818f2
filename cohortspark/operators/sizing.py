"""Columns in long form, and the levels of categorical columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from cohortspark.functions.scalars import quote

def long_form(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per (input row, column): the column's name, its value as text and, if numeric, as a number."""
    numeric = {f.name for f in df.schema if isinstance(f.dataType, NumericType)}
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(quote(c)).cast("string").alias("level"),
            (F.col(quote(c)) if c in numeric else F.lit(None)).cast("double").alias("number"),
        )
        for c in columns
    ]
    return df.select(F.inline(F.array(*cells)))


def fit_levels(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted distinct non-null values of several columns, found in one job.

    They become names of columns or places in a vector, so they have to be known before any row is encoded.
    """
    found = long_form(df, columns).select("column", "level").where("level IS NOT NULL").distinct()
    levels: dict[str, list[str]] = {c: [] for c in columns}
    for row in found.collect():
        levels[row["column"]].append(row["level"])
    return {c: sorted(values) for c, values in levels.items()}
