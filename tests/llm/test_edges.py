"""Nulls, empty and very long texts, repeated rows and ids, empty tables and clashing columns."""

import pytest
from llm.helpers import words
from pyspark.sql import functions as F

from cohortspark.llm.chats import as_events, digest, fold_events, render
from cohortspark.llm.decontaminate import contamination, drop_contaminated
from cohortspark.llm.lengths import context_limits, length_histogram
from cohortspark.llm.lines import drop_duplicate_lines, duplicate_lines
from cohortspark.llm.packing import pack_documents
from cohortspark.llm.quality import fit_quality, label_lines
from cohortspark.llm.repeats import remove_repeats
from cohortspark.llm.scoring import fit_models, score_documents
from cohortspark.llm.simhash import near_duplicates
from cohortspark.llm.toxicity import drop_toxic, fit_toxicity, score_toxicity

ROWS = 10


@pytest.fixture(scope="module", params=[False, True], ids=["edges", "empty"])
def docs(edges, request):
    return edges.where("false") if request.param else edges


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(0, 1, 0), (3, 1, 1), (3, 0, 1), (5, 0, 0), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "word"), (1, "word"), (None, "a"), (2, None), (3, "  ")], "item_id long, text string")


def size(docs):
    return docs.count()


def test_simhash(docs):
    rows = near_duplicates(docs).collect()
    assert len(rows) == size(docs)
    blank = {r.component_id for r in rows if r.fp == 0}
    assert len(blank) <= 1 and all(r.component_id == 3 for r in rows if r.doc_id == 3)


def test_chat(spark, docs):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, None, None, "x"), (None, 1, "assistant", "y" * 5000), (2, 1, "assistant", "")]
    stored = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    if docs.isEmpty():
        stored = stored.where("false")
    found = {r.conv_id: r for r in digest(render(fold_events(as_events(stored)))).collect()}
    if found:
        assert {i: (r.n_turns, r.loss_chars) for i, r in found.items()} == {1: (3, 0), None: (1, 5000), 2: (1, 0)}


def test_lengths(docs):
    rows = context_limits(length_histogram(docs)).collect()
    assert sum(r.n_docs for r in rows) == size(docs)


def test_scoring(docs):
    models = fit_models(docs, F.col("doc_id") == 3)
    rows = score_documents(docs, models).collect()
    assert len(rows) == size(docs) and all(r.score == 0 for r in rows if r.n_tokens == 0)


def test_lines(docs):
    rows = duplicate_lines(docs).collect()
    assert all(r.doc_id is not None for r in rows)
    if not docs.isEmpty():
        assert {(r.doc_id, r.line) for r in rows} == {(5, n) for n in range(1, 5)}
        left = {r.doc_id: r.text for r in drop_duplicate_lines(docs).collect()}
        assert left[5].split("\n") == ["same line of ten words that is long enough here", ""]
    assert drop_duplicate_lines(docs).columns == docs.columns


def test_quality(docs, labels):
    rows = label_lines(docs, fit_quality(docs, labels)).collect()
    assert len(rows) == size(docs) and all(r.base_failed and not r.kept for r in rows if r.n_words < 50)


def test_contamination(docs, benchmark):
    rows = contamination(docs, benchmark).collect()
    assert len(rows) == size(docs)
    assert [r.doc_id for r in rows if r.contaminated] == [3] * (2 if rows else 0)
    assert drop_contaminated(docs, benchmark).count() == max(0, size(docs) - 2)
    assert contamination(docs, benchmark.where("false")).where("contaminated").isEmpty()


def test_packing(docs):
    rows = pack_documents(docs).collect()
    assert sum(r.start == 0 for r in rows) == size(docs)


def test_toxicity(docs, labels):
    net = fit_toxicity(docs, labels)
    rows = score_toxicity(docs, net).collect()
    assert len(rows) == size(docs) and all(0 <= r.score <= 1 for r in rows)
    assert drop_toxic(docs, net).columns == docs.columns
    assert score_toxicity(docs, fit_toxicity(docs, labels.where("false"))).count() == size(docs)


def test_repeats(docs):
    rows = remove_repeats(docs).collect()
    assert len(rows) == size(docs)
    assert all(r.n_removed == 0 and r.kept == " ".join(words(r.kept)) for r in rows)
