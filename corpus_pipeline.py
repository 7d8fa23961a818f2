"""The corpus pipeline: toxicity, line dedup, near dedup, decontamination, packing. Each stage works on what its predecessor
left, written as Parquet in the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.llm.decontaminate import drop_contaminated
from cohortspark.llm.frames import table
from cohortspark.llm.lines import drop_duplicate_lines
from cohortspark.llm.packing import pack_documents
from cohortspark.llm.simhash import one_per_component
from cohortspark.llm.toxicity import drop_toxic, fit_toxicity
from cohortspark.session import scratch_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold."""
    return drop_toxic(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document or line has; those left without any line go."""
    return drop_duplicate_lines(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicate rows the one with the smallest id, and one of its rows without an id."""
    return one_per_component(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which benchmark windows cover less than the contaminated share of words."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in packed sequences."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]
ORACLE_SQL = None  # scores, edit distances, components and token ids have no SQL form; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that the whole pipeline makes of the documents."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
