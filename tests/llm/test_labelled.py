"""The bounded sample of labelled documents."""

from cohortspark.llm.labelled import held_out, labelled_sample

DOCS, LABELS = "doc_id long, text string", "doc_id long, toxic int"


def learnable(spark, n):
    ids = spark.range(1, 200).withColumnRenamed("id", "doc_id").where(~held_out())
    return [r.doc_id for r in ids.orderBy("doc_id").limit(n).collect()]


def test_an_id_counts_once_and_texts_are_whole(spark):
    a, b, c, d = learnable(spark, 4)
    long_text = "clean words " * 4000 + "the telling end"
    docs = spark.createDataFrame([(a, "same")] * 500 + [(b, long_text), (c, None), (d, "d"), (None, "x")], DOCS).repartition(4)
    labels = spark.createDataFrame([(a, 0), (b, 1), (c, 0), (d, None), (None, 1), (a, 0)], LABELS)
    found, y, share = labelled_sample(docs, labels, "toxic")
    assert sorted(zip(found, y)) == sorted([("same", 0), (long_text, 1), ("", 0)])
    assert abs(share - 1 / 3) < 1e-12


def test_bounds_leave_out_whole_texts(spark):
    ids = learnable(spark, 20)
    docs = spark.createDataFrame([(i, "w" * 100) for i in ids[:-1]] + [(ids[-1], "w" * 1000)], DOCS)
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)], LABELS)
    found, y, _ = labelled_sample(docs, labels, "toxic", class_bytes=450, text_bytes=900)
    assert {len(t) for t in found} == {100} and y.count(0) == y.count(1) == 4
    found, y, _ = labelled_sample(docs, labels, "toxic", per_class=3)
    assert y.count(0) == y.count(1) == 3


def test_nothing_labelled(spark):
    docs, labels = spark.createDataFrame([(1, "a")], DOCS), spark.createDataFrame([], LABELS)
    assert labelled_sample(docs, labels, "toxic") == ([], [], 0.5)
