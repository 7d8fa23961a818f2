"""Histogram sort against a plain sort of all rows."""

import zlib
from fractions import Fraction
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from cohortspark.llm.shards import locate, op11_shards, row_size, shard_documents, text_key, write_shards


def key(text):
    return int(md5((text or "").encode()).hexdigest()[:15], 16)


def size(text):
    return len((text or "").encode()) + 1


def plain(rows, shards, tolerance=Fraction(1, 100)):
    """(shard, ...) of every row of (id, text): by the middle byte of its group, or its own where the group is heavy."""
    rows = sorted(rows, key=lambda r: (key(r[1]), r[0] is not None, r[0] or 0))
    total, weight = sum(size(t) for _, t in rows), {}
    for _, text in rows:
        weight[key(text)] = weight.get(key(text), 0) + size(text)
    out, below, group, start = [], 0, None, 0
    for ident, text in rows:
        if key(text) != group:
            group, start = key(text), below
        light = weight[group] * shards <= tolerance * total
        twice = 2 * start + weight[group] if light else 2 * below + size(text)
        out.append((ident, size(text), twice * shards // (2 * total)))
        below += size(text)
    return out


def found(frame):
    return sorted(((r.doc_id, r["size"], r.shard) for r in frame.collect()), key=repr)


def check_slots(frame):
    slots = {}
    for r in frame.collect():
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("shards", [1, 2, 16, 37])
def test_equals_plain_sort(small, shards):
    frame = shard_documents(small, shards)
    expected = plain([(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()], shards)
    assert found(frame) == sorted(expected, key=repr)
    check_slots(frame)


def test_query_digests(spark, small):
    rows = {r.doc_id: r for r in op11_shards(spark, "/root/testdata/sf0.001").collect()}
    assert len(rows) == small.count()
    for r in small.collect():
        assert rows[r.doc_id].text_crc32 == zlib.crc32((r.text or "").encode()) and rows[r.doc_id].law == "bytes"


def test_hot_group_and_hot_id_are_cut_by_row(spark):
    """A third of the rows are copies, another third share id and text: sizes stay within a row of equal."""
    rows = [(i, "copy " * 20) for i in range(400)] + [(7, "same row " * 15)] * 400 + [(1000 + i, f"text {i} " * 12) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    frame = shard_documents(docs, 16)
    assert found(frame) == sorted(plain(rows, 16), key=repr)
    loads = [r.load for r in frame.groupBy("shard").agg(F.sum("size").alias("load")).collect()]
    assert len(loads) == 16 and max(loads) - min(loads) <= sum(size(t) for _, t in rows) / 16 * 0.01 + 200
    check_slots(frame)


def test_heavy_pieces_are_dealt_over_tasks(spark, small):
    """Pieces far smaller than a shard still give gapless slots, and every row once."""
    frame = shard_documents(small, 4, piece_bytes=2000)
    assert frame.count() == small.count() and frame.select("doc_id").distinct().count() == small.count()
    check_slots(frame)


def test_light_groups_stay_together(spark):
    rows = [(i, f"passage {i // 3} with a few words") for i in range(9000)]
    frame = shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 16)
    assert frame.groupBy("text").agg(F.countDistinct("shard").alias("n")).where("n > 1").isEmpty()


def test_locate_needs_few_rounds(spark):
    """Skewed and sparse keys, down to the value each goal falls on."""
    values = [0] * 50 + [1 << 40] + list(range(-5, 5)) + [(1 << 63) - 1] * 3 + [-(1 << 63)] * 2
    keys = spark.createDataFrame([(v, 2) for v in values], "k long, size long")
    places = locate(keys, "k", "size", {i: Fraction(i) for i in range(0, 2 * len(values), 5)}, 0)
    for i, place in places.items():
        below = 2 * sum(v < place.value for v in values)
        assert (place.below, place.rows) == (below, values.count(place.value)) and below <= i < below + place.bytes


def test_edges(spark, edges):
    """Null ids and texts, empty, blank and long texts, repeated rows, and columns named like those that are added."""
    docs = edges.withColumns({"size": F.lit("x"), "Shard": F.lit(1), "_sub": F.lit(2), "tags": F.create_map(F.lit("a"), "fp")})
    frame = shard_documents(docs, 3)
    assert frame.columns == ["doc_id", "text", "fp", "_sub", "tags", "size", "shard", "slot"]
    expected = plain([(r.doc_id, r.text) for r in edges.collect()], 3)
    assert found(frame) == sorted(expected, key=repr)
    check_slots(frame)
    assert shard_documents(edges.where("false")).isEmpty()
    one = shard_documents(edges.where("doc_id = 0"), 16).collect()
    assert [(r["size"], r.slot) for r in one] == [(1, 0)]


def test_written_shards(spark, small, tmp_path):
    path = write_shards(shard_documents(small, 4), str(tmp_path / "out"))
    back = spark.read.parquet(path)
    assert back.count() == small.count() and back.join(small, ["doc_id", "text"]).count() == small.count()


def test_keys(spark):
    row = spark.createDataFrame([("é",)], "text string").select(text_key().alias("k"), row_size().alias("s")).head()
    assert (row.k, row.s) == (key("é"), 3)
