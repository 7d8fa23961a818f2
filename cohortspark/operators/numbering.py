"""Consecutive row numbers without a global window."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.functions.scalars import quote
from cohortspark.session import ensure_checkpoint_dir

# monotonically_increasing_id keeps the partition number above this bit and the row's place below it.
_PLACE_BITS = 33


def ordered_row_id(
    df: DataFrame, keys: Sequence[str], target: str, start: int = 0, partitions: int | None = None
) -> DataFrame:
    """Number rows consecutively in key order; keys should identify a row.

    Rows are range-partitioned and sorted within partitions; a row's number is the count of rows in
    earlier partitions plus its place in its own. The sorted frame is checkpointed first: range
    boundaries come from a sample, so a recomputation could otherwise disagree with the counts.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    columns = [quote(k) for k in keys]
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(count, *columns).sortWithinPartitions(*columns).checkpoint()
    placed = ordered.withColumn("_slot", F.monotonically_increasing_id())
    partition = F.shiftright("_slot", _PLACE_BITS).cast("int")

    # One row per partition: bounded by the partition count whatever the data size.
    sizes = dict(placed.groupBy(partition.alias("p")).count().collect())
    present = sorted(sizes)
    before = accumulate((sizes[p] for p in present), initial=start)
    offsets = spark.createDataFrame(list(zip(present, before)) or [(0, start)], "_partition int, _offset bigint")

    place = F.col("_slot").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return (
        placed.withColumn("_partition", partition)
        .join(F.broadcast(offsets), "_partition")
        .withColumn(target, F.col("_offset") + place)
        .drop("_partition", "_slot", "_offset")
    )
