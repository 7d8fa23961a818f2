"""Equal hashes of different windows remove nothing."""

import pytest
from llm.helpers import by_id, windows, words

from cohortspark.llm import repeats


@pytest.mark.parametrize("chunk", [8 << 20, 200])
def test_false_equalities_are_found_out(spark, monkeypatch, chunk):
    exact = repeats.ngrams
    monkeypatch.setattr(repeats, "ngrams", lambda w, n: exact(w, n) % 97)
    monkeypatch.setattr(repeats, "CHUNK", chunk)
    shared = " ".join(f"s{i}" for i in range(30))
    rows = [(i, " ".join(f"d{i}w{j}" for j in range(40)) + (f" {shared} end{i}" if i % 2 else "")) for i in range(8)]
    rows += [(7, "x " * 50), (9, " ".join(f"d7w{j}" for j in range(20)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.n_words): r.kept for r in repeats.remove_repeats(docs, buckets=5).collect()}
    first = {}
    for i, text in rows:
        for g in windows(words(text), 13):
            first[g] = min(first.get(g, i), i)
    for i, text in rows:
        w = words(text)
        gone = {k + j for k, g in enumerate(windows(w, 13)) if first[g] < i for j in range(13)}
        assert got[i, len(w)] == " ".join(x for k, x in enumerate(w) if k not in gone)


@pytest.mark.parametrize("sent", [1 << 20, 0])
@pytest.mark.parametrize("modulus", [None, 97])
def test_rows_of_one_id_are_judged_by_themselves(spark, monkeypatch, sent, modulus):
    exact = repeats.ngrams
    if modulus:
        monkeypatch.setattr(repeats, "ngrams", lambda w, n: exact(w, n) % modulus)
    monkeypatch.setattr(repeats, "SENT_KEYS", sent)
    a, b = (" ".join(f"{c}{i}" for i in range(20)) for c in "ab")
    half = a.split()[5:] + b.split()[3:]
    rows = [(1, a), (5, a), (5, b), (5, b), (5, " ".join(half)), (6, b), (8, " ".join(half)), (None, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id or 0, r.kept, r.n_removed) for r in repeats.remove_repeats(docs, buckets=5).collect())
    first = {}
    for i, text in rows:
        for g in windows(words(text), 13):
            first[g] = min(first.get(g, 99), i or 99)
    want = []
    for i, text in rows:
        w = words(text)
        gone = {k + j for k, g in enumerate(windows(w, 13)) if i and first[g] < i for j in range(13)}
        want.append((i or 0, " ".join(x for k, x in enumerate(w) if k not in gone), len(gone)))
    assert got == sorted(want)
