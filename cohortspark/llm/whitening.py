"""Embedding whitening by mixed-precision refinement (operator 13)."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.functions.scalars import quote
from cohortspark.llm.frames import saved, table

COMPONENTS, SCALE, SHIFT = 16, 64, 1_000_000
LARGEST = 1 << 45  # sums of a batch of such entries still fit a long
EXACT = 1 << 53
ROUNDS = 20
HIGH = np.longdouble
EPSILON = float(np.finfo(HIGH).eps)
NO_VARIANCE = 1e-13  # components below this share of the largest eigenvalue are left out


@dataclass(frozen=True)
class Whitening:
    """``components`` are columns, by falling ``values``; all statistics are over the n different vectors."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def explained(self) -> list[float]:
        return [float(v / self.trace) for v in self.values]


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(vec_id, x) of the vectors that are not null and hold no null or non-finite entry; x is floor(scale * entry) + shift.

    Vectors have one length, the commonest (of several the largest); rows of another length, which no common covariance can have,
    are left out. Integers beyond ±2**45 are set to that bound.
    """
    v, bound = F.col(quote(vector_col)), float(LARGEST)
    good = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf)))
    whole = F.transform(v, lambda c: F.floor(F.greatest(F.lit(-bound), F.least(F.lit(bound), c.cast("double") * scale))) + F.lit(shift))
    kept = vectors.where(F.coalesce(v.isNotNull() & good, F.lit(False)))
    lengths = kept.groupBy(F.size(v).alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    length = lengths[0].d if lengths else 0
    return kept.where(F.size(v) == length).select(F.col(quote(id_col)).cast("long").alias("vec_id"), whole.alias("x"))


def matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(rows, -1)


def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the entries in each batch; place -1 counts vectors."""
    for batch in batches:
        if batch.num_rows:
            x = matrix(batch.column(0), batch.num_rows)
            totals = np.append(batch.num_rows, x.sum(axis=0))
            yield pa.RecordBatch.from_pydict({"place": np.arange(-1, x.shape[1], dtype=np.int32), "total": totals})


def products(z: np.ndarray) -> np.ndarray:
    """The exact Gram matrix of an integer matrix as long numbers, or as Python integers where those are too small."""
    largest = int(np.abs(z).max())
    if largest * largest * len(z) < EXACT:
        floats = z.astype(np.float64)
        return (floats.T @ floats).astype(np.int64)
    wide = z.astype(object)
    return wide.T @ wide


def gram(centre: list[int]):
    """Per task, the sums of products of the entries less ``centre``, upper triangle."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centre), len(centre)), object)
        for batch in batches:
            if batch.num_rows:
                total = total + products(matrix(batch.column(0), batch.num_rows) - np.array(centre, np.int64))
        i, j = np.triu_indices(len(centre))
        text = pa.array([str(v) for v in total[i, j]], pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), text], ["i", "j", "total"])

    return work


def covariance(fit: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """n, the sums of x, and n * n times the covariance, all exact integers.

    The first pass adds up the entries; the second multiplies entries centred at the integer part of the mean, and the rest of the
    centring, less than 1 an entry, is taken off the sums exactly. The driver gets sums over dimensions and pairs of them.
    """
    added = fit.mapInArrow(add_up, "place int, total long").groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")))
    totals = {place: int(total) for place, total in added.collect()}
    n = totals.pop(-1, 0)
    sums = [totals[i] for i in range(len(totals))]
    if not n or not sums:
        return n, sums, np.zeros((0, 0), object)
    centre = [s // n for s in sums]
    rest = [s - n * m for s, m in zip(sums, centre)]
    scaled = np.zeros((len(sums), len(sums)), object)
    pairs = fit.mapInArrow(gram(centre), "i int, j int, total string")
    for i, j, total in pairs.groupBy("i", "j").agg(F.sum(F.col("total").cast("decimal(38,0)"))).collect():
        scaled[i, j] = scaled[j, i] = n * int(total) - rest[i] * rest[j]
    return n, sums, scaled


def high(values: np.ndarray, divisor: int) -> np.ndarray:
    """Integers over ``divisor`` in the higher precision."""
    flat = []
    for v in values.ravel():
        whole, part = divmod(int(v), divisor)
        upper = float(whole)
        flat.append(HIGH(upper) + HIGH(float(whole - int(upper))) + HIGH(part) / HIGH(divisor))
    return np.array(flat, HIGH).reshape(values.shape)


def improve(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One Ogita-Aishima step: eigenvalues, better eigenvectors and the error of the given ones, by matrix products alone.

    Eigenvalues no farther apart than the current error bound form a cluster; their vectors are only made orthonormal by the
    correction and then told apart within their span, by an eigenproblem of the cluster's size shifted by its middle.
    """
    r = np.eye(len(a), dtype=HIGH) - x.T @ x
    s = x.T @ a @ x
    s = (s + s.T) / 2  # rounding that isn't symmetric would be divided by small gaps and break the vectors' right angles
    values = np.diag(s) / (1 - np.diag(r))
    away = s - np.diag(values)
    bound = 2 * (np.sqrt((away**2).sum()) + np.sqrt((a**2).sum()) * np.sqrt((r**2).sum()))
    apart = values[None, :] - values[:, None]
    close = np.abs(apart) <= bound
    correction = np.where(close, r / 2, (s + values[None, :] * r) / np.where(close, 1, apart))
    better = x + x @ correction

    order = np.argsort(-values, kind="stable")
    better, ranked = better[:, order], values[order]
    error = float(max(np.abs(r).max(), np.abs(away).max() / np.abs(a).max()))
    first = 0
    for last in range(1, len(ranked) + 1):
        if last < len(ranked) and ranked[last - 1] - ranked[last] <= bound:
            continue
        if last - first > 1:
            span = better[:, first:last]
            shifted = span.T @ (a @ span - span * ranked[first:last].mean())
            shifted = (shifted + shifted.T) / 2
            width = np.abs(shifted).max()
            if width > 8 * len(a) * EPSILON * np.abs(a).max():  # otherwise equal within the precision: any basis will do
                turn = np.linalg.eigh((shifted / width).astype(np.float64))[1][:, ::-1].astype(HIGH)
                turn = turn + turn @ (np.eye(len(turn), dtype=HIGH) - turn.T @ turn) / 2
                better[:, first:last] = span @ turn
        first = last
    return ranked, better, error


def eigenvectors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns of a symmetric matrix in the higher precision.

    The start is a float32 decomposition; corrections square its error until they are below double precision.
    """
    scale = np.abs(a).max()
    if not scale:
        return np.zeros(len(a), HIGH), np.eye(len(a), dtype=HIGH)
    scaled = a / scale
    x = np.linalg.eigh(scaled.astype(np.float32))[1].astype(HIGH)
    for _ in range(ROUNDS):
        _, x, error = improve(scaled, x)
        if error <= 4 * len(a) * EPSILON:  # what went in was at the precision's own noise
            break
    x = x / np.sqrt((x**2).sum(axis=0))
    values = (x * (scaled @ x)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    return values[order] * scale, x[:, order]


def fit_whitening(x: DataFrame, components: int = COMPONENTS) -> tuple[Whitening, DataFrame]:
    """The whitening of (vec_id, x) rows and its fit list, each different x once.

    Copies meet in the map tasks before they are exchanged. Components without variance (eigenvalue below 1e-13 of the largest)
    can't be whitened and are left out; with no or one different vector there are none.
    """
    fit = saved(x.select("x").distinct())
    n, sums, scaled = covariance(fit)
    if not sums:
        return Whitening(n, sums, np.zeros(0), np.zeros((0, 0)), 0.0), fit
    a = high(scaled, n * n)
    values, vectors = eigenvectors(a)
    keep = min(components, int((values > NO_VARIANCE * max(values[0], 0)).sum()))
    trace = float(high(np.array([sum(scaled[i, i] for i in range(len(sums)))], object), n * n)[0])
    return Whitening(n, sums, values[:keep].astype(np.float64), vectors[:, :keep].astype(np.float64), trace), fit


def projector(model: Whitening):
    """Function from an integer matrix to whitened values: centred in integers, then by the rest of the mean."""
    centre = np.array([s // model.n for s in model.sums], np.int64)
    rest = np.array([(s % model.n) / model.n for s in model.sums])
    axes = model.components / np.sqrt(model.values)
    return lambda x: ((x - centre).astype(np.float64) - rest) @ axes


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sums of (n * x - sum) ** 2; None where a long can't hold one."""
    farthest = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    if farthest < 1 << 62:
        away = n * x - np.array(sums, np.int64)
        largest = int(np.abs(away).max(initial=0))
        if largest * largest * x.shape[1] < 1 << 63:
            return (away * away).sum(axis=1).tolist()
    exact = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(axis=1)
    return [int(v) if v < 1 << 63 else None for v in exact]


def whiten(x: DataFrame, model: Whitening) -> DataFrame:
    """(vec_id, deviation, whitened) of every (vec_id, x) row; ``whitened`` has one value for each component.

    Rows are maps of their own vector: repeated ids and vectors are repeated, a null id stays null. A deviation beyond a long is
    null.
    """
    if not model.sums:
        return x.select("vec_id", F.lit(None).cast("long").alias("deviation"), F.expr("CAST(array() AS ARRAY<DOUBLE>)").alias("whitened"))
    project = projector(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            entries = matrix(batch.column(1), batch.num_rows)
            found = pa.FixedSizeListArray.from_arrays(pa.array(project(entries).ravel()), len(model.values)) if len(model.values) else None
            found = found.cast(pa.list_(pa.float64())) if found is not None else pa.array([[]] * len(entries), pa.list_(pa.float64()))
            away = pa.array(deviations(entries, model.n, model.sums), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), away, found], ["vec_id", "deviation", "whitened"])

    return x.mapInArrow(work, "vec_id long, deviation long, whitened array<double>")


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity, measured on the whitened values."""
    m = len(model.values)
    if not m:
        return 0.0
    project = projector(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((m + 1, m))
        for batch in batches:
            if batch.num_rows:
                w = project(matrix(batch.column(0), batch.num_rows))
                total += np.vstack([w.sum(axis=0), w.T @ w])
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_pydict({"i": i.ravel().astype(np.int32), "j": j.ravel().astype(np.int32), "total": total.ravel()})

    sums = np.zeros((m + 1, m))
    for i, j, total in fit.mapInArrow(work, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total")).collect():
        sums[i, j] = total
    mean = sums[0] / model.n  # centred by the exact mean already; what rounding left of it
    return float(np.abs(sums[1:] / model.n - np.outer(mean, mean) - np.eye(m)).max())


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = integer_vectors(table(spark, sf_dir, "embeddings"))
    model, fit = fit_whitening(x)
    error, shares = identity_error(fit, model), model.explained
    rows = whiten(x, model).select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return rows.select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(F.array(*[F.lit(s) for s in shares]), F.col("place")).cast("double").alias("explained"),
        F.lit(error).alias("identity_error"),
    )


QUERIES = {"op13_whitening": op13_whitening}
