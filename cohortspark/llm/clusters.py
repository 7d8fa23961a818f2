"""Exact centroid clustering with heap-ordered bounds (operator 12)."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.functions.scalars import quote
from cohortspark.llm.frames import saved, table
from cohortspark.session import scratch_path

CENTROIDS, ROUNDS, DIMS, SCALE = 8, 10, 64, 1024
ROWS_A_FILE = 1 << 18  # of a heap's run; one task then holds about 64 MB of 64 components
LARGEST = 1 << 27  # squared distances over 64 components of this size still fit a long
ENTRY = "vec_id long, x array<int>, was int, cluster int, gap double"
HEAP = "vec_id long, x array<int>, was int, gap double, round int, cluster int"


@dataclass(frozen=True)
class Clustering:
    """``members`` (vec_id, cluster, distance), the final centroids, and how many vectors each round had to rescan."""

    members: DataFrame
    centroids: list[list[int]]
    rescanned: list[int]


def integer_vectors(
    vectors: DataFrame, dims: int = DIMS, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(vec_id, x) of the vectors with exactly ``dims`` components, none null or non-finite; x is floor(scale * component).

    Integers beyond ±2**27 are set to that bound, so that squared distances fit a long.
    """
    v, bound = F.col(quote(vector_col)), float(LARGEST)
    good = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf)))
    whole = F.transform(
        v, lambda c: F.floor(F.greatest(F.lit(-bound), F.least(F.lit(bound), c.cast("double") * scale))).cast("int")
    )
    usable = v.isNotNull() & (F.size(v) == dims) & good
    return vectors.where(F.coalesce(usable, F.lit(False))).select(F.col(quote(id_col)).cast("long").alias("vec_id"), whole.alias("x"))


def first_centroids(x: DataFrame, count: int = CENTROIDS, seed: int = 3) -> list[list[int]]:
    """The vectors with the smallest SHA-256 of ``seed:vec_id``; ties go by components, vectors without an id come last."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return [list(r.x) for r in x.orderBy(order.asc_nulls_last(), "x").limit(count).select("x").collect()]


def matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(rows, -1)


def squares(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances (vector, centroid)."""
    out = np.empty((len(x), len(centroids)), np.int64)
    for j, centroid in enumerate(centroids):
        away = x - centroid
        out[:, j] = np.einsum("ij,ij->i", away, away)
    return out


def rescan(centroids: np.ndarray, offset: np.ndarray):
    """The nearest centroid of every vector, and when its place in that centroid's heap runs out.

    The gap between the upper bound (distance to the own centroid) and the lower bound (distance to the next one) is stored on
    top of the drift that the heap has accumulated so far, so entries needn't be touched when centroids move. It is rounded
    down by far more than the rounding of distances and drifts.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            far = squares(matrix(batch.column(1), batch.num_rows), centroids)
            nearest = far.argmin(axis=1)  # of equal distances the first
            upper = np.sqrt(far[np.arange(len(far)), nearest])
            if far.shape[1] > 1:
                far[np.arange(len(far)), nearest] = np.iinfo(np.int64).max
                lower = np.sqrt(far.min(axis=1))
            else:
                lower = np.full(len(far), np.inf)
            base = offset[nearest]
            gap = np.where(np.isinf(lower), np.inf, lower - upper + base - 1e-9 * (lower + upper + base + 1))
            gap = np.maximum(gap, np.nextafter(base, np.inf))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(nearest.astype(np.int32)), pa.array(gap)], ["vec_id", "x", "was", "cluster", "gap"]
            )

    return work


def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What vectors that changed their cluster add to and take from its component sums; place -1 counts vectors."""
    for batch in batches:
        if not batch.num_rows:
            continue
        was, now = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        x = matrix(batch.column(2), batch.num_rows)
        for sign, of in ((1, now), (-1, was)):
            for c in np.unique(of[of >= 0]):
                inside = of == c
                totals = np.append(sign * x[inside].sum(axis=0), sign * inside.sum())
                places = np.append(np.arange(x.shape[1]), -1)
                yield pa.RecordBatch.from_pydict(
                    {"cluster": np.full(len(totals), c, np.int32), "place": places.astype(np.int32), "total": totals}
                )


def drifts(before: list[list[int]], after: list[list[int]]) -> np.ndarray:
    """By how much the gap of each cluster's vectors can have shrunk: its own step and the longest of the others'."""
    steps = [math.sqrt(sum((a - b) ** 2 for a, b in zip(u, v))) * (1 + 1e-12) for u, v in zip(before, after)]
    return np.array([s + max(steps[:j] + steps[j + 1 :], default=0.0) for j, s in enumerate(steps)])


def cluster_vectors(x: DataFrame, starts: list[list[int]], rounds: int = ROUNDS) -> Clustering:
    """Lloyd's rounds over (vec_id, x), then one more assignment; exact, with ties to the smaller number.

    Each cluster's heap is kept as runs of Parquet sorted by gap, one run for each round, in the folder of the cluster. When
    centroids have moved, the top of a heap, all entries whose gap is at most the accumulated drift, is popped by a range filter
    that reaches the files' statistics; only these vectors are rescanned, and pushed as a new run. Entries aren't rewritten: the
    drift only grows, so what was popped is what lies at or below it. Sums change by the vectors that moved alone. Every round is
    one scan and one write; a lost executor repeats its tasks. The driver holds the centroids and their sums.

    Rows are taken as they are: equal ids and equal vectors are members each, and a centroid equal to an earlier one stays empty,
    as an empty one stays where it is. With fewer vectors than centroids there are as many centroids as vectors; with none, no
    members.
    """
    spark, folder = x.sparkSession, scratch_path(x.sparkSession, "heaps")
    centroids = [list(map(int, s)) for s in starts]
    if not centroids:
        return Clustering(spark.createDataFrame([], "vec_id long, cluster int, distance long"), [], [])
    dims, k = len(centroids[0]), len(centroids)
    sums, sizes = [[0] * dims for _ in range(k)], [0] * k
    offset, rescanned = np.zeros(k), []

    def heap(runs: int) -> DataFrame:
        paths = [f"{folder}/round={r}" for r in range(runs)]
        return spark.read.schema(HEAP).option("basePath", folder).parquet(*paths)

    for number in range(rounds + 1):
        if number == 0:
            popped = x.select("vec_id", "x", F.lit(-1).alias("was"))
        else:
            step = drifts(before, centroids)
            if not step.any():
                break
            reached, offset = offset, offset + step
            popped = heap(number).where(_between(reached, offset)).select("vec_id", "x", F.col("cluster").alias("was"))
            popped = popped.coalesce(max(spark.sparkContext.defaultParallelism, -(-rescanned[0] // ROWS_A_FILE)))
        pushed = popped.mapInArrow(rescan(np.array(centroids, np.int64), offset), ENTRY)
        pushed.sortWithinPartitions("cluster", "gap").write.partitionBy("cluster").parquet(f"{folder}/round={number}")
        run = heap(number + 1).where(F.col("round") == number)
        rescanned.append(run.count())
        if number == rounds:
            break
        changes = run.where("was <> cluster").select("was", "cluster", "x").mapInArrow(moved, "cluster int, place int, total long")
        for c, place, total in changes.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)"))).collect():
            if place < 0:
                sizes[c] += int(total)
            else:
                sums[c][place] += int(total)
        before = centroids
        centroids = [[s // n for s in total] if n else old for total, n, old in zip(sums, sizes, centroids)]

    final = np.array(centroids, np.int64)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(1).to_numpy(zero_copy_only=False)
            away = matrix(batch.column(2), batch.num_rows) - final[own] if batch.num_rows else np.zeros((0, dims), np.int64)
            distance = pa.array(np.einsum("ij,ij->i", away, away))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], distance], ["vec_id", "cluster", "distance"])

    live = heap(len(rescanned)).where(F.col("gap") > _of(offset)).select("vec_id", "cluster", "x")
    return Clustering(saved(live.mapInArrow(measure, "vec_id long, cluster int, distance long")), centroids, rescanned)


def _of(values: np.ndarray) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col("cluster") + 1)


def _between(reached: np.ndarray, offset: np.ndarray) -> Column:
    """Entries that the growth of their cluster's drift has reached; the outer bounds are for the files' statistics."""
    grown = [int(c) for c in np.flatnonzero(offset > reached)]
    outer = F.col("cluster").isin(grown) & (F.col("gap") > float(reached.min())) & (F.col("gap") <= float(offset.max()))
    return outer & (F.col("gap") > _of(reached)) & (F.col("gap") <= _of(offset))


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = integer_vectors(table(spark, sf_dir, "embeddings"))
    found = cluster_vectors(x, first_centroids(x))
    digests = [(j, sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(found.centroids)]
    named = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")  # one row for each centroid
    loads = found.members.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia"))
    inertia = found.members.agg(F.try_sum("distance").alias("inertia")).select("inertia").scalar()
    per_cluster = loads.join(F.broadcast(named), "cluster").withColumn("inertia", inertia)
    return found.members.join(F.broadcast(per_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _oracle() -> str:
    """Lloyd's rounds written out, every vector against every centroid."""
    parts = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id,
          list_transform(embedding, lambda c: CAST(floor(CAST(c AS DOUBLE) * {SCALE}) AS BIGINT)) AS x FROM embeddings
          WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = {DIMS})""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), x) - 1 AS j, x AS c FROM kept
          ORDER BY sha256('3:' || vec_id), x LIMIT {CENTROIDS})""",
    ]
    distance = "list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    for i in range(ROUNDS + 1):
        parts.append(
            f"""a{i} AS MATERIALIZED (SELECT r, vec_id, x, j, CAST(d AS BIGINT) AS d FROM (SELECT r, vec_id, x, j, {distance} AS d
              FROM kept CROSS JOIN c{i}) QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, j) = 1)"""
        )
        if i < ROUNDS:
            parts.append(
                f"""s{i} AS MATERIALIZED (SELECT j, p, CAST(sum(v) AS HUGEINT) AS s, count(*) AS n FROM (SELECT j,
                  unnest(x) AS v, unnest(range({DIMS})) AS p FROM a{i}) GROUP BY j, p),
                c{i + 1} AS MATERIALIZED (SELECT j, coalesce(m, c) AS c FROM c{i} LEFT JOIN
                  (SELECT j, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY p) AS m FROM s{i} GROUP BY j) USING (j))"""
            )
    return (
        "WITH "
        + ",\n".join(parts)
        + f""" SELECT vec_id, CAST(j AS INT) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY j) AS BIGINT) AS cluster_inertia,
      CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
      FROM a{ROUNDS} JOIN c{ROUNDS} USING (j)"""
    )


QUERIES = {"op12_clusters": op12_clusters}
ORACLES = {"op12_clusters": _oracle()}
