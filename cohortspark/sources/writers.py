"""Sinks: tables, parquet, CSV and JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.functions.scalars import quote
from cohortspark.sources import folders

__all__ = ["append_parquet", "save_table", "stamp", "write_csv", "write_json", "write_notes", "write_parquet", "write_series"]


def stamp(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Add the ingest time."""
    return df.withColumn(column, F.current_timestamp())


def save_table(
    df: DataFrame,
    name: str,
    path: str | None = None,
    stamped: bool = True,
    mode: str = "overwrite",
    buckets: tuple[int, str] | None = None,
) -> str:
    """Save as a parquet table, with the ingest time unless told otherwise; ``path`` makes it external.

    ``buckets=(n, key)`` stores rows hashed by the key: tables bucketed alike join on it without a shuffle.
    """
    out = stamp(df) if stamped else df
    if buckets:
        # Gather a bucket's rows before the write, or every task would write every bucket; AQE splits a
        # bucket that a hot key makes too large over several tasks and files.
        count, key = buckets
        out = out.hint("rebalance", count, F.col(quote(key)))
    writer = out.write.format("parquet").mode(mode)
    if buckets:
        writer = writer.bucketBy(*buckets).sortBy(buckets[1])
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return name


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path


def append_parquet(df: DataFrame, path: str) -> str:
    """Append a batch that may carry new columns; read back with ``merge_schema=True``."""
    return write_parquet(df, path, mode="append")


def write_series(df: DataFrame, root: str, key: str = "id", mode: str = "overwrite") -> str:
    """One folder per participant.

    The rebalance hint gathers each participant's rows into few files, while AQE splits a participant
    that holds much of the data over several tasks. On a local file system tasks write the files themselves (``folders``).
    """
    gathered, path = df.hint("rebalance", F.col(quote(key))), folders.local_root(df.sparkSession, root)
    if folders.can_write(df, key, mode, path):
        folders.write_parquet(gathered, path, key)
    else:
        gathered.write.mode(mode).partitionBy(key).parquet(root)
    return root


def write_notes(df: DataFrame, root: str, key: str = "id", mode: str = "append") -> str:
    """Lines of text, of the column beside the key, into the folder of each participant."""
    gathered, path = df.repartition(F.col(quote(key))), folders.local_root(df.sparkSession, root)
    if folders.can_write(df, key, mode, path):
        folders.write_text(gathered, path, key)
    else:
        gathered.write.mode(mode).partitionBy(key).text(root)
    return root


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", True).csv(path)
    return path


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).json(path)
    return path
