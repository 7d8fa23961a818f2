"""Joins of cohort rows with features. Broadcast or shuffle is AQE's choice from measured sizes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.functions.scalars import quote
from cohortspark.operators.clean import dedup_columns, drop_columns, select_columns


def left_join(left: DataFrame, right: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    return left.join(right, [keys] if isinstance(keys, str) else list(keys), "left")


def join_blocks(blocks: Sequence[DataFrame], key: str = "id") -> DataFrame:
    """Left-join feature blocks on one key, so one partitioning serves every join.

    A block with several rows per key fans out its keys, as the period block does with its two flags.
    """
    return reduce(lambda a, b: left_join(a, b, key), dedup_columns(blocks, key))


def concat_columns(blocks: Sequence[DataFrame], key: str = "id") -> DataFrame:
    """Column-wise concatenation of blocks aligned by key; a key missing from a block gives NULLs there.

    The blocks' rows are united under their block's number and grouped once by key, so any number of blocks takes one exchange,
    and rows are combined before it. A key names one row in each block, as an index does: a repeated key is an error when the
    result is computed. A NULL key is a key like any other.
    """
    parts = dedup_columns(blocks, key)
    columns = [(i, c) for i, part in enumerate(parts) for c in part.columns if c != key]

    def tagged(i: int, part: DataFrame) -> DataFrame:
        slots = [
            (F.col(quote(c)) if at == i else F.lit(None).cast(parts[at].schema[c].dataType)).alias(f"_{n}") for n, (at, c) in enumerate(columns)
        ]
        return part.select(F.col(quote(key)).alias("_key"), F.lit(i).alias("_block"), *slots)

    united = reduce(DataFrame.union, [tagged(i, part) for i, part in enumerate(parts)])
    # Values and their row's count travel together, so that a NULL in the row isn't taken for a missing row.
    values = [F.first(F.when(F.col("_block") == i, F.struct(F.col(f"_{n}").alias("v"))), ignorenulls=True).alias(f"_{n}") for n, (i, _) in enumerate(columns)]
    counts = [F.count(F.when(F.col("_block") == i, 1)).alias(f"_rows{i}") for i in range(len(parts))]
    grouped = united.groupBy("_key").agg(*values, *counts)
    most = F.greatest(*[F.col(f"_rows{i}") for i in range(len(parts))], F.lit(0))
    text = F.concat(F.lit("a block has several rows for the key "), F.coalesce(F.col("_key").cast("string"), F.lit("NULL")))
    checked = F.when(most > 1, F.raise_error(text).cast(grouped.schema["_key"].dataType)).otherwise(F.col("_key"))
    return grouped.select(checked.alias(key), *[F.col(f"_{n}")["v"].alias(c) for n, (_, c) in enumerate(columns)])


def feature_lookup(
    df: DataFrame,
    features: DataFrame,
    names: Sequence[str],
    key: str = "id",
    exclude: Sequence[str] = (),
) -> DataFrame:
    """Add chosen feature columns by key, keep every row of ``df``, drop the excluded columns if present.

    The feature table must have one row per key, since a repeated key would multiply training rows. That
    is checked while the query runs: grouping by the key uses the partitioning the join needs anyway, so
    the features are not computed a second time for the check.
    """
    k = quote(key)
    message = F.concat(F.lit(f"repeated {key} in feature table: "), F.col(k).cast("string"))

    def single(name: str):
        return F.when(F.col("_n") > 1, F.raise_error(message)).otherwise(F.col(quote(name))).alias(name)

    looked_up = (
        select_columns(features, [key, *names])
        .where(F.col(k).isNotNull())
        .groupBy(k)
        .agg(F.count(F.lit(1)).alias("_n"), *[F.first(quote(n)).alias(n) for n in names])
        .select(k, *[single(n) for n in names])
    )
    return drop_columns(left_join(df, looked_up, key), exclude)


def union_positional(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, frames)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; a column absent from a frame is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def top_n(df: DataFrame, n: int, by: str, ties: Sequence[str] = ()) -> DataFrame:
    """The ``n`` largest rows: per-partition top-k, then a merge."""
    return df.orderBy(F.col(quote(by)).desc_nulls_last(), *[quote(t) for t in ties]).limit(n)


def sort_descending(df: DataFrame, by: str, ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.col(quote(by)).desc_nulls_last(), *[quote(t) for t in ties])
