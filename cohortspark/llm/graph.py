"""Connected components of large graphs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.frames import saved


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge (a, b); root is the component's smallest node.

    Large-star and small-star rounds until nothing changes: a number of rounds logarithmic in the size. Minima are combined in
    the map tasks, and a hub's neighbours join one row, a join whose skew is split at run time. Loops and repeats are allowed.
    """
    now = saved(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    )
    mark = fingerprint(now)
    while mark[0]:
        both = now.union(now.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        now = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = now.groupBy("a").agg(F.min("b").alias("m"))
        other = now.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = saved(other.union(least.select("a", F.col("m").alias("b"))).distinct())
        before, mark = mark, fingerprint(now)
        if mark == before:
            break
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(now.select("b", "b").distinct())


def fingerprint(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).head()
    return row[0], row[1]


def unite(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels (each the smallest index of its set) after uniting the sets of i and j."""
    while True:
        a, b = label[i], label[j]
        open_ = a != b
        if not open_.any():
            return label
        i, j = i[open_], j[open_]
        np.minimum.at(label, np.maximum(a, b)[open_], np.minimum(a, b)[open_])
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
