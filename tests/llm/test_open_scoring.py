"""Cross-entropy differences under an open vocabulary."""

import math
from collections import Counter

import numpy as np
import pytest
from llm.helpers import by_id, lowered
from pyspark.sql import functions as F

from cohortspark.llm import QUERIES, scoring
from cohortspark.llm.scoring import PRIOR, score_corpus

SF_DIR = "/root/testdata/sf0.001"


def brute(docs):
    """docs: id -> (text, target)."""
    models = []
    every = {w for text, _ in docs.values() for w in lowered(text)}
    for kind in (True, False):
        word, history, pair = Counter(), Counter(), Counter()
        for text, target in docs.values():
            if target == kind:
                w = lowered(text)
                word.update(w)
                history.update([None, *w][: len(w)])
                pair.update(zip([None, *w], w))
        models.append((word, history, pair))
    out = {}
    for i, (text, _) in docs.items():
        w = lowered(text)
        losses = []
        for word, history, pair in models:
            total = 0.0
            for h, x in zip([None, *w], w):
                single = (word[x] + 1) / (word.total() + len(every) + 1)
                total -= math.log((pair[h, x] + PRIOR * single) / (history[h] + PRIOR))
            losses.append(total / max(1, len(w)))
        out[i] = (len(w), *losses, losses[1] - losses[0])
    return out


@pytest.mark.parametrize("chunk", [4 << 20, 30000])
def test_query_equals_brute_force(spark, small, chunk, monkeypatch):
    monkeypatch.setattr(scoring, "CHUNK", chunk)
    found = by_id(QUERIES["op4_scoring"](spark, SF_DIR))
    expected = brute({r.doc_id: (r.text, r.source == "src1") for r in small.collect()})
    assert len(found) == len(expected)
    for i, values in expected.items():
        assert tuple(found[i])[1:] == pytest.approx(values, abs=1e-9)


def test_rare_words_of_one_ending_differ(spark):
    """3,000 words are more frequent than these, and all of them end alike."""
    common = " ".join(f"word{i:04d} word{i:04d} word{i:04d}" for i in range(3000))
    rows = [(0, common, False), (1, "quasarly", True), (2, "pulsarly", False), (3, "quasarly", False), (4, "quasarly", True)]
    found = by_id(score_corpus(spark.createDataFrame(rows, "doc_id long, text string, own boolean"), F.col("own")))
    assert found[3].score == found[1].score > found[2].score


def test_edge_rows(edges):
    for docs in (edges, edges.where("false")):
        rows = score_corpus(docs, F.col("doc_id") == 3).collect()
        assert len(rows) == docs.count() and all(r.score == 0 for r in rows if r.n_tokens == 0)
        assert sum(r.doc_id is None for r in rows) == docs.where("doc_id IS NULL").count()


@pytest.mark.parametrize("most", [0, 1, 255, 256, 70_000, 1 << 40])
def test_packed_counts_come_back(most):
    counts = np.r_[np.random.default_rng(1).integers(0, most + 1, 1000), most]
    assert (scoring.unpack(scoring.pack(counts), len(counts)) == counts).all()
    assert len(scoring.unpack(scoring.pack(counts[:0]), 0)) == 0


@pytest.mark.parametrize("keys", [[], [0], [5], [7, 8, 300], [7, 1 << 50], [(1 << 60) - 1]])
@pytest.mark.parametrize("base", [0, 15 << 60])
def test_packed_keys_come_back(keys, base):
    keys = np.array(keys, np.uint64) + np.uint64(base)
    assert (scoring.unpack_keys(scoring.pack_keys(keys, base), len(keys), base) == keys).all()


def test_texts_are_not_shuffled(small, capsys):
    """Texts are scored where they were written: the exchanges are those of the counts."""
    score_corpus(small, F.col("source") == "src1").explain("formatted")
    exchanges = [part for part in capsys.readouterr().out.split("\n\n") if ") Exchange" in part]
    assert exchanges and not any("texts" in part for part in exchanges)
