"""The pipeline's stages in order, each judged on its own input."""

import corpus_pipeline
import numpy as np
from llm.helpers import alnum, by_id, windows

from cohortspark.llm.lines import duplicate_lines
from cohortspark.llm.simhash import near_duplicates
from cohortspark.session import scratch_path

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, folder, kept = docs.columns, scratch_path(spark, "stages"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        out.write.parquet(f"{folder}/{name}")
        kept[name] = (docs, spark.read.parquet(f"{folder}/{name}"))
        docs = kept[name][1]
        assert name == "packing" or docs.columns == columns
    before, after = kept["line_dedup"]
    assert duplicate_lines(after).isEmpty() or duplicate_lines(after).count() < duplicate_lines(before).count() / 10
    before, after = kept["near_dedup"]
    assert {r.doc_id for r in after.collect()} == {r.component_id for r in near_duplicates(before).collect()}
    before, after = kept["decontaminate"]
    items = {g for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect() for g in windows(alnum(r.text), 13)}

    def bad(text):
        w = alnum(text)
        hit = {i + j for i, g in enumerate(windows(w, 13)) if g in items for j in range(13)}
        return bool(hit) and 20 * len(hit) >= len(w)

    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect() if not bad(r.text)}
    before, after = kept["packing"]
    assert after.where("start = 0").count() == before.count()


def test_near_dedup_keeps_one_of_each_group(spark):
    text = "some words that make a text of which there are copies in the corpus"
    rows = [(1, text, "en", "s", 9), (1, text, "en", "s", 9), (2, text, "en", "s", 9), (None, text, "en", "s", 9), (5, "other words here", "en", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = [r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, SF_DIR).collect()]
    assert sorted(left, key=str) == [1, 5, None]


def test_run_equals_the_stages(spark):
    pieces = corpus_pipeline.run(spark, SF_DIR)
    assert pieces.groupBy("doc_id").sum("length").count() == pieces.where("start = 0").count()
    fill = np.array([r[0] for r in pieces.groupBy("sequence_id").sum("length").select("sum(length)").collect()])
    assert fill.max() <= 2048 and by_id(pieces)
