"""Measured profiles of tables: recorded with a model, compared with the rows that are to be scored."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, NumericType, StringType, TimestampType

from cohortspark.functions.scalars import quote
from cohortspark.operators.sizing import long_form

MAX_LEVELS = 64
PROFILE = "column_name string, type string, rows long, nulls long, least double, greatest double, levels array<string>"


@dataclass(frozen=True)
class ColumnProfile:
    """What one column held: ranges of numbers and times (as doubles), levels of texts and booleans if there were few."""

    column_name: str
    type: str
    rows: int
    nulls: int
    least: float | None
    greatest: float | None
    levels: tuple[str, ...] | None


def _as_number(name: str, kind: DataType) -> Column | None:
    """The value on the real line; longs beyond 2^53 are rounded, NaN counts as NULL."""
    column = F.col(quote(name))
    if isinstance(kind, NumericType):
        number = column.cast("double")
        return F.when(~F.isnan(number), number)
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("double")
    return column.cast("double") if isinstance(kind, TimestampType) else None


def _present(name: str, kind: DataType) -> Column:
    number = _as_number(name, kind)
    return F.col(quote(name)) if number is None else number


def fit_profile(df: DataFrame, max_levels: int = MAX_LEVELS) -> list[ColumnProfile]:
    """One pass for counts and ranges of all columns, and one grouping of the levels of columns that have few.

    A sketch in the first pass tells which texts may have at most ``max_levels`` levels; only those are grouped, and the
    exact number decides. The driver gets one row a column and never more than ``max_levels`` levels of it.
    An empty table gives profiles without rows, ranges and levels.
    """
    measures = [F.count(F.lit(1)).alias("rows")]
    for i, field in enumerate(df.schema):
        number = _as_number(field.name, field.dataType)
        measures.append(F.count(_present(field.name, field.dataType)).alias(f"n{i}"))
        if number is not None:
            measures += [F.min(number).alias(f"a{i}"), F.max(number).alias(f"b{i}")]
        elif isinstance(field.dataType, (StringType, BooleanType)):
            measures.append(F.approx_count_distinct(F.col(quote(field.name))).alias(f"d{i}"))
    found = df.agg(*measures).head().asDict()
    few = [f.name for i, f in enumerate(df.schema) if 0 < found.get(f"d{i}", 0) <= 2 * max_levels]
    levels: dict[str, tuple[str, ...]] = {}
    if few:
        distinct = long_form(df, few).where("level IS NOT NULL").select("column", "level").distinct()
        counted = distinct.groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("level")).alias("levels"))
        levels = {r["column"]: tuple(r["levels"]) for r in counted.where(F.col("n") <= max_levels).collect()}
    rows = found["rows"]
    return [
        ColumnProfile(
            f.name, f.dataType.simpleString(), rows, rows - found[f"n{i}"], found.get(f"a{i}"), found.get(f"b{i}"), levels.get(f.name)
        )
        for i, f in enumerate(df.schema)
    ]


def profile_frame(spark: SparkSession, profile: Sequence[ColumnProfile]) -> DataFrame:
    """The profile as rows, to be stored next to a model."""
    return spark.createDataFrame([tuple(asdict(p).values()) for p in profile], PROFILE)


def read_profile(stored: DataFrame) -> list[ColumnProfile]:
    rows = (r.asDict() for r in stored.select(*(field.split()[0] for field in PROFILE.split(", "))).collect())
    return [ColumnProfile(**{**r, "levels": None if r["levels"] is None else tuple(r["levels"])}) for r in rows]


def _outside(recorded: ColumnProfile, kind: DataType) -> Column:
    """Whether a value is one that the recorded column never had; NULL for NULL."""
    number = _as_number(recorded.column_name, kind)
    if number is not None and recorded.least is not None:
        return (number < recorded.least) | (number > recorded.greatest)
    if recorded.levels is not None:
        return ~F.col(quote(recorded.column_name)).cast("string").isin(list(recorded.levels))
    return F.lit(False)


def profile_report(df: DataFrame, recorded: Sequence[ColumnProfile]) -> DataFrame:
    """A row per recorded column: its types then and now, rows and nulls now, values outside the recorded range or levels.

    ``matches``: the type is the same, no value lies outside, and there are nulls only if there were some. A column that is
    gone or has another type has NULL counts and doesn't match. One aggregate over the table, without a shuffle of rows.
    """
    present = {f.name: f.dataType for f in df.schema}
    measures, cells = [F.count(F.lit(1)).alias("rows")], []
    for i, r in enumerate(recorded):
        kind = present.get(r.column_name)
        same = kind is not None and kind.simpleString() == r.type
        if same:
            measures.append(F.count(_present(r.column_name, kind)).alias(f"n{i}"))
            measures.append(F.count_if(_outside(r, kind)).alias(f"o{i}"))
        nulls = F.col("rows") - F.col(f"n{i}") if same else F.lit(None).cast("long")
        outside = F.col(f"o{i}") if same else F.lit(None).cast("long")
        matches = (outside == 0) & ((nulls == 0) | F.lit(r.nulls > 0)) if same else F.lit(False)
        cells.append(
            F.struct(
                F.lit(r.column_name).alias("column_name"),
                F.lit(r.type).alias("recorded"),
                F.lit(None if kind is None else kind.simpleString()).cast("string").alias("present"),
                F.col("rows").alias("rows_checked"),
                nulls.alias("nulls"),
                outside.alias("outside"),
                matches.alias("matches"),
            )
        )
    return df.agg(*measures).select(F.inline(F.array(*cells)))
