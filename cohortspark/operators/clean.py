"""Projection, filtering and cleaning."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortspark.functions.scalars import quote
from cohortspark.operators.numbering import ordered_row_id
from cohortspark.schemas import CohortSpec


def select_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[quote(c) for c in dict.fromkeys(names)])


def select_features(df: DataFrame, spec: CohortSpec, engineered: Sequence[str] = ()) -> DataFrame:
    """Key, numeric and categorical features and target, plus the engineered columns asked for."""
    return select_columns(df, [spec.key, *spec.numeric, *spec.categorical, spec.target, *engineered])


def select_by_regex(df: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """Columns whose start matches a pattern, in the order of the patterns."""
    return select_columns(df, [c for p in patterns for c in df.columns if re.match(p, c)])


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop the columns that are present; absent names are no error."""
    return df.drop(*names)


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def conform_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast the columns the schema names to its types; other columns stay."""
    targets = {f.name: f.dataType for f in schema if f.name in df.columns}
    return df.withColumns({c: F.col(quote(c)).cast(t) for c, t in targets.items()})


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text to double; text that is no number, and NaN, become NULL."""

    def number(c: str) -> Column:
        value = F.col(quote(c)).try_cast("double")
        return F.when(~F.isnan(value), value)

    return df.withColumns({c: number(c) for c in columns})


def tag_literal(df: DataFrame, column: str, value) -> DataFrame:
    return df.withColumn(column, F.lit(value))


def filter_equals(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(F.col(quote(column)) == F.lit(value))


def filter_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(quote(column)).isNotNull())


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows with a value in every listed column (all columns unless given); NaN is no value."""
    types = dict(df.dtypes)
    for c in subset or df.columns:
        df = df.where(F.col(quote(c)).isNotNull())
        if types[c] in ("double", "float"):
            df = df.where(~F.isnan(quote(c)))
    return df


def head_rows(df: DataFrame, n: int, keys: Sequence[str]) -> DataFrame:
    """First ``n`` rows by the keys: a top-k per partition merged at the end, not a full sort."""
    return df.orderBy(*[quote(k) for k in keys]).limit(n)


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return select_columns(df, columns).distinct()


def dedup_columns(blocks: Sequence[DataFrame], key: str) -> list[DataFrame]:
    """Drop from later blocks the columns an earlier block already has, except the join key."""
    seen: set[str] = set()
    unique = []
    for block in blocks:
        unique.append(block.drop(*[c for c in block.columns if c in seen and c != key]))
        seen.update(block.columns)
    return unique


def mask_incomplete(df: DataFrame, value: str, items: Sequence[str], target: str) -> DataFrame:
    """The value where every item is answered, otherwise NULL."""
    complete = reduce(and_, [F.col(quote(i)).isNotNull() for i in items])
    return df.withColumn(target, F.when(complete, F.col(quote(value))))


def fill_constant(df: DataFrame, value, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(quote(c)), F.lit(value)) for c in columns})


def map_codes(df: DataFrame, column: str, mapping: Mapping, target: str | None = None) -> DataFrame:
    """Code to label; a code outside the mapping becomes NULL."""
    c = F.col(quote(column))
    label = F.lit(None)
    for code, text in mapping.items():
        label = F.when(c == F.lit(code), F.lit(text)).otherwise(label)
    return df.withColumn(target or column, label)


def category_rank(column: str, levels: Sequence[str]) -> Column:
    """0-based place of a value in the declared level order; NULL for undeclared values."""
    place = F.array_position(F.array(*[F.lit(v) for v in levels]), F.col(quote(column)))
    return F.when(place > 0, place - 1).cast("int")


def order_categories(df: DataFrame, column: str, levels: Sequence[str], ties: Sequence[str] = ()) -> DataFrame:
    """Rows by declared level order; undeclared values last."""
    return df.orderBy(category_rank(column, levels).asc_nulls_last(), *[quote(t) for t in ties])


def index_category(df: DataFrame, column: str, target: str) -> DataFrame:
    """Alphabetical 0-based code of a string column; NULL gets -1.

    The levels are numbered without a global window and joined back; AQE broadcasts them when they turn out
    small, and otherwise splits hot levels.
    """
    levels = df.select(F.col(quote(column)).alias("_level")).where("_level IS NOT NULL").distinct()
    codes = ordered_row_id(levels, ["_level"], "_code")
    joined = df.join(codes, F.col(quote(column)) == F.col("_level"), "left")
    return joined.withColumn(target, F.coalesce("_code", F.lit(-1)).cast("int")).drop("_level", "_code")


def ensure_id(df: DataFrame, keys: Sequence[str], column: str = "id") -> DataFrame:
    """Add a 0-based row id in key order when the frame has none."""
    return df if column in df.columns else ordered_row_id(df, keys, column)


def add_missing_columns(df: DataFrame, columns: Sequence[str], data_type: str = "double") -> DataFrame:
    absent = [c for c in columns if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast(data_type) for c in absent}) if absent else df


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, and the frame's row and column counts."""
    described = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"), F.lit(t).alias("data_type"))
            for i, (c, t) in enumerate(df.dtypes)
        ]
    )
    counted = df.agg(F.count(F.lit(1)).alias("row_count"), F.lit(len(df.columns)).alias("column_count"))
    return counted.select(F.inline(described), "row_count", "column_count")
