"""Folders that tasks write themselves, next to those of Spark's writer."""

import json
import os

import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from cohortspark.sources import folders, writers

ODD = [None, "", "001", "1e5", "é ü", "x" * 100, *[f"a{chr(c)}b" for c in range(1, 128)]]


def frame(spark):
    out = [(i, k, float(k), f"s{k}" if k % 3 else None, bool(k % 2)) for k, i in enumerate(ODD * 2)]
    named = spark.createDataFrame(out, "id string, k long, v float, s string, `b-x` boolean")
    return named.withColumn("t", (F.col("k") % 100).cast("tinyint"))


def only_tasks(monkeypatch):
    def refuse(*_):
        raise AssertionError("written through Hadoop's local file system")

    monkeypatch.setattr(DataFrameWriter, "partitionBy", refuse)


def files_of(root, ending):
    return sorted(os.path.join(at, f) for at, _, names in os.walk(root) for f in names if f.endswith(ending) and not f.startswith("."))


def test_folders_equal_those_of_spark(spark, tmp_path, monkeypatch):
    new, old = str(tmp_path / "new"), str(tmp_path / "old")
    df = frame(spark)
    df.write.partitionBy("id").parquet(old)
    only_tasks(monkeypatch)
    writers.write_series(df, new)
    assert {f for f in os.listdir(new) if "=" in f} == {f for f in os.listdir(old) if "=" in f}
    assert sorted(f for f in os.listdir(new) if "=" not in f) == ["_SUCCESS"]
    a, b = (spark.read.parquet(p).select(*df.columns) for p in (new, old))
    assert a.schema == b.schema and rows(a) == rows(b)
    kept = [{k: v if k.endswith(b"version") else json.loads(v) for k, v in pq.read_schema(files_of(p, ".parquet")[0]).metadata.items()} for p in (new, old)]
    assert kept[0] == kept[1] and len(kept[0]) == 2


def test_a_damaged_byte_is_found_by_its_checksum(spark, tmp_path):
    root = writers.write_series(frame(spark).where("id = '001'"), str(tmp_path / "s"))
    (path,) = files_of(root, ".parquet")
    with open(path, "r+b") as f:
        f.seek(20)
        f.write(b"\0\1\2\3")
    with pytest.raises(Exception, match="(?i)checksum"):
        spark.read.parquet(root).collect()


def test_long_participants_come_in_row_groups(spark, tmp_path, monkeypatch):
    """A participant over several batches is one file, whose rows are written as they come."""
    monkeypatch.setattr(folders, "GROUP_BYTES", 100_000)
    df = spark.range(60_000).selectExpr("if(id < 50000, 'hot', cast(id % 7 AS string)) AS id", "id AS k", "id / 7 AS v")
    root = writers.write_series(df, str(tmp_path / "s"))
    (hot,) = files_of(os.path.join(root, "id=hot"), ".parquet")
    assert pq.ParquetFile(hot).num_row_groups > 2 and pq.ParquetFile(hot).metadata.num_rows == 50_000
    assert spark.read.schema("k long, v double, id string").parquet(root).select("id", "k", "v").exceptAll(df).count() == 0
    assert spark.read.parquet(root).count() == 60_000


def test_appended_folders_and_notes(spark, tmp_path, monkeypatch):
    df, root, old = frame(spark).select("id", F.col("s").alias("value")), str(tmp_path / "s"), str(tmp_path / "old")
    df.repartition("id").write.partitionBy("id").text(old)
    only_tasks(monkeypatch)
    for _ in range(2):
        writers.write_series(df, root, mode="append")
    assert spark.read.parquet(root).count() == 2 * df.count()
    writers.write_notes(df, root)
    texts = [{os.path.dirname(f)[len(p) :]: open(f, "rb").read() for f in files_of(p, ".txt")} for p in (root, old)]
    assert texts[0] == texts[1] and len(texts[0]) == len(set(ODD)) - 1


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    root = str(tmp_path / "s")
    broken = spark.range(100).selectExpr("cast(id AS string) AS id", "if(id = 77, cast(raise_error('no') AS bigint), id) AS k")
    with pytest.raises(Exception, match="no"):
        writers.write_series(broken, root)
    assert os.listdir(root) == []


def test_what_spark_has_to_write(spark, tmp_path):
    """Other systems, keys, types and what is there already are left to Spark's writer."""
    df, path = frame(spark), str(tmp_path / "s")
    assert folders.local_root(spark, path) == path == folders.local_root(spark, f"file:{path}")
    assert folders.can_write(df, "id", "overwrite", path) and folders.can_write(df, "id", "append", path)
    assert not folders.can_write(df, "id", "overwrite", None)
    assert not folders.can_write(df, "k", "overwrite", path)
    assert not folders.can_write(df.withColumn("at", F.current_timestamp()), "id", "overwrite", path)
    writers.write_series(df, path)
    assert not folders.can_write(df, "id", "overwrite", path)
    writers.write_series(df.where("id = '001'"), path)
    assert spark.read.parquet(path).count() == 2
