"""Exact token-length histogram and what its suffix sums answer (operator 3)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortspark.llm.frames import saved, table, texts
from cohortspark.llm.tokens import VOCABULARY, Encoder

STRIDE = 1024


def length_histogram(docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(n_tokens, n_docs) of all rows; null and empty texts have length 0, repeated rows count each time.

    Tasks send one row per length and batch, so hot lengths are summed before the shuffle.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, added=True)
        for batch in batches:
            counts = np.array([encoder.count(t.as_py()) for t in batch.column(0)], np.int64)
            lengths, times = np.unique(counts, return_counts=True)
            yield pa.RecordBatch.from_pydict({"n_tokens": lengths, "n_docs": times.astype(np.int64)})

    only = docs.select(F.col(text_col).cast("string"))
    return only.mapInArrow(work, "n_tokens long, n_docs long").groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def context_limits(histogram: DataFrame, stride: int = STRIDE) -> DataFrame:
    """For every length L that occurs: documents and tokens at or above it, and the total when texts are cut at L.

    ``docs_at_most / all`` is L's quantile. Limits between two lengths follow from the next longer row: with limit C,
    cut_tokens(C) = tokens below + C * docs_at_least. The suffix sums are sums within ranges of ``stride`` lengths plus sums
    of whole ranges, so no task sees all lengths.
    """
    tokens = F.col("n_tokens") * F.col("n_docs")
    held = saved(histogram.withColumn("_range", F.floor(F.col("n_tokens") / stride)))
    after = Window.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    ranges = held.groupBy("_range").agg(F.sum("n_docs").alias("_d"), F.sum(tokens).alias("_t"))
    ranges = ranges.select(
        "_range",
        F.coalesce(F.sum("_d").over(after), F.lit(0)).alias("_d"),
        F.coalesce(F.sum("_t").over(after), F.lit(0)).alias("_t"),
    )
    whole = held.agg(F.sum("n_docs").alias("docs"), F.sum(tokens).alias("tokens"))
    inside = Window.partitionBy("_range").orderBy(F.desc("n_tokens"))
    out = held.join(ranges, "_range").withColumns(
        {
            "docs_at_least": F.sum("n_docs").over(inside) + F.col("_d"),
            "tokens_at_least": F.sum(tokens).over(inside) + F.col("_t"),
        }
    )
    docs, total = whole.select("docs").scalar(), whole.select("tokens").scalar()
    return out.select(
        "n_tokens",
        "n_docs",
        "docs_at_least",
        "tokens_at_least",
        (docs - F.col("docs_at_least") + F.col("n_docs")).alias("docs_at_most"),
        (total - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).alias("cut_tokens"),
        docs.alias("docs"),
        total.alias("tokens"),
    )


def op3_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_limits(length_histogram(table(spark, sf_dir, "documents")))


QUERIES = {"op3_length_histogram": op3_length_histogram}
