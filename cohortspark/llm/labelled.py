"""Bounded samples of labelled documents for classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortspark.llm.frames import texts

PER_CLASS = 1500
CLASS_BYTES = 8 << 20
TEXT_BYTES = 1 << 18


def held_out(id_col: str = "doc_id"):
    """Rows kept away from training: crc32 of the id as text leaves 2 modulo 4; a null id isn't held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str,
    per_class: int = PER_CLASS,
    class_bytes: int = CLASS_BYTES,
    text_bytes: int = TEXT_BYTES,
) -> tuple[list[str], list[int], float]:
    """Whole texts, labels and the share of label 1 among all labels that may be learnt from.

    The bound on what a model is fitted on: of either label ``per_class`` documents, those with the smallest hash of their id,
    as far as their texts together have at most ``class_bytes``; a text of more than ``text_bytes`` isn't learnt from. Texts
    are taken whole. Rows with a null label or id are left out; of repeated labels the largest counts, of the rows of one id
    the smallest text (a null one is empty), so an id counts once however many rows it has. Scoring is not bounded.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out())
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    picked, share = [], known.agg(F.avg("label")).head()[0]
    for label in (0, 1):
        rows = known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).collect()
        picked += [(r.doc_id, label) for r in rows]
    if not picked:
        return [], [], 0.5
    ids = dict(picked)
    one = [i for i, label in ids.items() if label]
    text = F.coalesce("text", F.lit(""))
    found = texts(docs).where(F.col("doc_id").isin(list(ids)) & (F.octet_length(text) <= text_bytes))
    found = found.groupBy("doc_id").agg(F.min(text).alias("text")).withColumn("label", F.col("doc_id").isin(one).cast("int"))
    in_turn = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id")  # at most per_class rows
    found = found.withColumn("total", F.sum(F.octet_length("text")).over(in_turn)).where(F.col("total") <= class_bytes)
    rows = sorted(found.select("doc_id", "text").collect(), key=lambda r: r.doc_id)
    return [r.text for r in rows], [ids[r.doc_id] for r in rows], share
