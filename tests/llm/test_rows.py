"""Stages of the pipeline judge rows, not ids."""

import corpus_pipeline
import numpy as np
import pytest

from cohortspark.llm import lines
from cohortspark.llm.decontaminate import drop_contaminated
from cohortspark.llm.lines import drop_duplicate_lines
from cohortspark.llm.simhash import one_per_component

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_near_dedup_judges_rows(spark):
    text = "some words that make a text of which there are copies in the corpus"
    other = "an entirely different passage about rivers, mountains and the sea in winter"
    third = "numbers and figures of the last report on trade between the northern towns"
    rows = [(1, text), (7, text), (7, other), (7, third), (None, other), (None, third), (None, third)]
    docs = spark.createDataFrame([(i, t, "en", "s", 9) for i, t in rows], DOCS)
    left = corpus_pipeline.near_dedup(spark, docs, "")
    assert left.columns == docs.columns
    found = [(r.doc_id, r.text) for r in left.collect()]
    assert sorted(found, key=str) == sorted([(1, text), (7, other), (7, third), (None, other), (None, third)], key=str)


@pytest.mark.parametrize("bound", [1 << 25, 10])
def test_decontamination_judges_rows(spark, bound):
    bad = " ".join(f"w{i}" for i in range(13))
    benchmark = spark.createDataFrame([(i, f"{bad} {i}") for i in range(9)], "item_id long, text string")
    rows = [(None, bad), (None, "clean"), (1, bad), (1, "clean too"), (2, "clean as well")]
    docs = spark.createDataFrame([(i, t, "en", "s", 9) for i, t in rows], DOCS)
    left = drop_contaminated(docs, benchmark, bound=bound)
    assert left.schema == docs.schema
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted([rows[1], rows[3], rows[4]], key=str)


def test_stages_take_columns_of_any_name_and_type(spark):
    rows = [(1, "a b c d", 1, {"k": 1}, "x"), (2, "a b c d", 2, {"k": 2}, None), (2, "e f g", 3, None, "y"), (None, None, 4, {}, "z")]
    schema = "doc_id long, text string, _fp long, _lines map<string,int>, _line_id string"
    docs = spark.createDataFrame(rows, schema)
    for name in ("_fp", "row", "a.b"):
        frame = docs.withColumnRenamed("_fp", name)
        for stage in (one_per_component, drop_duplicate_lines):
            left = stage(frame)
            assert left.columns == frame.columns
            assert sorted(r[2] for r in left.collect()) == [1, 3, 4]


def test_near_dedup_keeps_one_of_equal_rows_and_the_least_of_ties(spark):
    text = "one text that several rows have"
    rows = [(4, text, "b")] * 3 + [(4, text, "a"), (9, text, "c"), (None, text, "d"), (None, text, "d"), (4, "", "e"), (5, None, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    left = [tuple(r) for n in (1, 5) for r in one_per_component(docs.repartition(n)).collect()]
    assert len(left) == 6 and len(set(left)) == 3
    assert {(i, t) for i, t, _ in left} == {(4, text), (None, text), (4, "")}
    assert one_per_component(docs.where("false")).collect() == []


def test_half_keys_travel_in_three_words(spark):
    """Four keys of 48 bits come back from the three words a line is stored with."""
    rng = np.random.default_rng(3)
    keys = [rng.integers(0, 1 << 64, 50, np.uint64, endpoint=False) for _ in range(4)]
    stored = [lines.packed(keys)[i].view(np.int64).tolist() for i in range(3)]
    found = spark.createDataFrame(list(zip(*stored, strict=True)), "k0 long, k1 long, k2 long").select(lines.unpacked().alias("k"))
    assert [r.k for r in found.collect()] == [[int(k[i]) >> 16 for k in keys] for i in range(50)]
    assert "k3" not in lines.LINES
