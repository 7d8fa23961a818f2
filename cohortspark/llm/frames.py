"""Small Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (BIGINT) and the text, whatever else the frame has."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def saved(df: DataFrame) -> DataFrame:
    """Computed once, in the shared checkpoint folder; a lost executor costs a read."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def free_names(df: DataFrame, words: str) -> tuple[str, ...]:
    """The words as column names that ``df`` has not, whatever its columns are called."""
    taken, lead = {c.lower() for c in df.columns}, "_"
    while any(c.startswith(lead) for c in taken):
        lead += "_"
    return tuple(lead + word for word in words.split())


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def runs(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[tuple[object, pa.Table]]:
    """Groups of equal ``key`` from batches that are sorted by it; one group at a time is held."""
    held: list[pa.RecordBatch] = []
    now: object = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_pylist()
        first = 0
        for i in range(1, len(keys) + 1):
            if i < len(keys) and keys[i] == keys[first]:
                continue
            if held and now != keys[first]:
                yield now, pa.Table.from_batches(held)
                held = []
            now = keys[first]
            held.append(batch.slice(first, i - first))
            first = i
    if held:
        yield now, pa.Table.from_batches(held)
