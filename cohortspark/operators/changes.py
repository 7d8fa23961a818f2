"""Row-level differences between snapshots, and key checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.functions.scalars import quote


def snapshot_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows to take from ``old`` to ``new``, labelled in ``_change_type``.

    A key whose row differs gives ``update_preimage`` and ``update_postimage``; otherwise rows give
    ``insert`` or ``delete``. Both snapshots are counted by whole row in one shuffle, so unchanged rows
    cancel before any join and a repeated or NULL key never pairs with itself. Column types must be
    groupable (no maps).
    """
    columns = [quote(c) for c in old.columns]
    tagged = old.select(*columns, F.lit(-1).alias("_sign")).unionByName(new.select(*columns, F.lit(1).alias("_sign")))
    changed = tagged.groupBy(*columns).agg(F.sum("_sign").alias("_net")).where("_net <> 0")

    # One row per changed key; the join back is null-safe and only touches changed rows.
    sides = changed.groupBy(*[F.col(quote(k)).alias(f"_key{i}") for i, k in enumerate(keys)]).agg(
        (F.max("_net") > 0).alias("_in_new"), (F.min("_net") < 0).alias("_in_old")
    )
    same_key = [F.col(quote(k)).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    both = F.col("_in_new") & F.col("_in_old")
    kind = (
        F.when(both & (F.col("_net") > 0), "update_postimage")
        .when(both, "update_preimage")
        .when(F.col("_net") > 0, "insert")
        .otherwise("delete")
    )
    return (
        changed.join(sides, same_key)
        .withColumn("_change_type", kind)
        # A row repeated within a snapshot appears as often as it was added or removed.
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.abs("_net"))))
        .select(*columns, "_change_type")
    )


def check_primary_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that break a primary key: duplicates, and keys with a NULL part."""
    null_part = F.lit(False)
    for k in keys:
        null_part = null_part | F.col(quote(k)).isNull()
    counts = df.groupBy(*[quote(k) for k in keys]).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.withColumn("has_null", null_part).where("row_count > 1 OR has_null")
