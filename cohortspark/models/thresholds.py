"""Cutpoints that turn a continuous score into ordered classes with the best quadratic kappa.

One pass over the data counts (score bin, class); everything after works on those counts, whose number
is the number of bins times the number of classes. For fixed counts, the observed and the expected
disagreement are both sums over the classes' score intervals, each taken from running totals at its two ends.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.functions.scalars import quote
from cohortspark.session import ensure_checkpoint_dir

COARSE_CUTS = tuple(0.25 * i for i in range(1, 16))


@dataclass(frozen=True)
class ThresholdFit:
    thresholds: tuple[float, ...]
    kappa: float | None


def _counts_by_bin(df: DataFrame, actual: str, score: str, cuts: Sequence[float], n_classes: int) -> np.ndarray:
    """counts[b, c]: rows of class c whose score has exactly b cuts at or below it."""
    s, values = F.col("s"), [float(c) for c in cuts]
    # array_size(filter) would test every cut per row; uniform cuts are found by arithmetic.
    step = values[1] - values[0] if len(values) > 1 else 1.0
    if all(abs(values[0] + i * step - v) < 1e-9 for i, v in enumerate(values)):
        guess = F.greatest(F.lit(0), F.least(F.lit(len(values)), F.floor((s - values[0]) / step) + 1)).cast("int")
        table = F.array(*[F.lit(v) for v in values])
        # Settle rounding at a bin edge by looking at the neighbouring cuts.
        up = F.when((guess < len(values)) & (F.get(table, guess) <= s), 1).otherwise(0)
        down = F.when((guess > 0) & (F.get(table, guess - 1) > s), 1).otherwise(0)
        bin_id: Column = guess + up - down
    else:
        bin_id = sum((F.when(s >= v, 1).otherwise(0) for v in values), F.lit(0))
    rows = (
        df.select(F.col(quote(actual)).cast("int").alias("c"), F.col(quote(score)).cast("double").alias("s"))
        .where("c IS NOT NULL AND s IS NOT NULL AND NOT isnan(s)")
        # Foreign classes count together, so the size is bounded whatever the column holds.
        .groupBy(bin_id.alias("b"), F.when(F.col("c").between(0, n_classes - 1), F.col("c")).otherwise(-1).alias("c"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    counts = np.zeros((len(values) + 1, n_classes))
    for b, c, n in rows:
        if not 0 <= c < n_classes:
            raise ValueError(f"a class is outside 0..{n_classes - 1}")
        counts[b, c] = n
    return counts


def _running_costs(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """observed[j, b], expected[j, b]: disagreement of the rows in the first b bins when all get class j."""
    n_classes = counts.shape[1]
    gaps = (np.arange(n_classes)[:, None] - np.arange(n_classes)[None, :]) ** 2.0
    below = np.vstack([np.zeros(n_classes), np.cumsum(counts, axis=0)])
    per_class = counts.sum(axis=0)
    observed = gaps @ below.T
    expected = np.outer(gaps @ per_class, below.sum(axis=1)) / max(per_class.sum(), 1.0)
    return observed, expected


def threshold_grid(
    df: DataFrame, actual: str, score: str, cuts: Sequence[float] = COARSE_CUTS, n_classes: int = 5
) -> DataFrame:
    """Kappa of every increasing choice of ``n_classes - 1`` cutpoints, as columns ``t1`` … and ``kappa``.

    The grid is enumerated on Spark; each candidate reads the running totals from constant arrays.
    """
    spark = df.sparkSession
    observed, expected = _running_costs(_counts_by_bin(df, actual, score, cuts, n_classes))
    m, k = len(cuts), n_classes - 1
    picks = spark.range(m).select(F.col("id").cast("int").alias("i0"))
    for i in range(1, k):  # only cuts above the last one, so nothing is made to be thrown away
        above = F.sequence(F.col(f"i{i - 1}") + 1, F.lit(m - 1))
        picks = picks.where(F.col(f"i{i - 1}") < m - 1).select("*", F.explode(above).alias(f"i{i}"))

    # Class j takes the bins from its lower cut (exclusive) through its upper cut: cut i closes i + 1 bins.
    edges = [F.lit(0), *[F.col(f"i{i}") + 1 for i in range(k)], F.lit(m + 1)]

    def total(costs: np.ndarray) -> Column:
        out = F.lit(0.0)
        for j in range(n_classes):
            table = F.array(*[F.lit(float(v)) for v in costs[j]])
            out = out + F.get(table, edges[j + 1]) - F.get(table, edges[j])
        return out

    cut_values = F.array(*[F.lit(float(c)) for c in cuts])
    return picks.select(
        *[F.get(cut_values, F.col(f"i{i}")).alias(f"t{i + 1}") for i in range(k)],
        (1 - F.try_divide(total(observed), total(expected))).alias("kappa"),
    )


def optimize_thresholds(
    df: DataFrame, actual: str, score: str, n_classes: int = 5, low: float = 0.0, high: float = 4.0, bins: int = 400
) -> ThresholdFit:
    """The cutpoints on a fine grid with the highest kappa: the exact optimum of the grid.

    Minimises observed / expected disagreement. For a trial ratio r, the best cuts for
    observed - r * expected follow from one running minimum per class, and the ratio they reach is the
    next trial; the ratio falls until it repeats (Dinkelbach's method).
    """
    cuts = [low + (high - low) * i / bins for i in range(bins + 1)]
    observed, expected = _running_costs(_counts_by_bin(df, actual, score, cuts, n_classes))
    ends = np.arange(len(cuts)) + 1
    ratio, chosen = np.inf, None
    trial = 1.0
    while True:
        cost = observed - trial * expected
        reach, origin = cost[0][ends], []
        for j in range(1, n_classes):
            entry = reach - cost[j][ends]
            lowest = np.minimum.accumulate(entry)
            source = np.maximum.accumulate(np.where(entry == lowest, np.arange(len(ends)), 0))
            origin.append(source)
            # The last class runs to the end of the score range.
            reach = lowest + (cost[j][-1] if j == n_classes - 1 else cost[j][ends])
        picks = [int(origin[-1][-1])]
        for source in reversed(origin[:-1]):
            picks.insert(0, int(source[picks[0]]))
        bounds = [0, *(int(ends[i]) for i in picks), observed.shape[1] - 1]
        num = sum(observed[j][bounds[j + 1]] - observed[j][bounds[j]] for j in range(n_classes))
        den = sum(expected[j][bounds[j + 1]] - expected[j][bounds[j]] for j in range(n_classes))
        if den <= 0:
            return ThresholdFit(tuple(cuts[i] for i in picks), None)
        if chosen is not None and num / den >= ratio - 1e-12:
            break
        ratio, chosen, trial = num / den, picks, num / den
    return ThresholdFit(tuple(cuts[i] for i in chosen), float(1.0 - ratio))


def optimize_thresholds_exact(df: DataFrame, actual: str, score: str, n_classes: int = 5) -> ThresholdFit:
    """The cutpoints with the highest kappa of all there are: every distinct score can be a cut, and infinity an empty class.

    Rows are counted by (score, class), range-partitioned by score and written once; running class counts start from the totals of
    the partitions before. For a trial ratio of observed to expected disagreement the cost of cut i depends on the counts below it
    alone, so a partition's best cuts i to j, for all i and j, are one small matrix, and partitions combine from left to right. The
    ratio of the best cuts is the next trial, until it repeats: a pass over the counts each time, a handful in all. The driver holds
    one such matrix for each partition. Rows without class or score are left out; scores in a tie for the best may be any of them.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    c, s = F.col(quote(actual)).cast("int"), F.col(quote(score)).cast("double")
    rows = df.select(c.alias("c"), (s + 0.0).alias("s")).where("c IS NOT NULL AND s IS NOT NULL AND NOT isnan(s)")
    counts = rows.groupBy("s").agg(*[F.count(F.when(F.col("c") == k, 1)).alias(f"n{k}") for k in range(n_classes)], F.count("*").alias("n"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = counts.repartitionByRange(parts, "s").sortWithinPartitions("s").withColumn("part", F.spark_partition_id()).checkpoint()
    totals = {r[0]: np.array(r[1:], float) for r in kept.groupBy("part").agg(*[F.sum(x) for x in kept.columns[1:-1]]).collect()}
    per_class = sum((t[:-1] for t in totals.values()), np.zeros(n_classes))
    if per_class.sum() != sum(t[-1] for t in totals.values()):
        raise ValueError(f"a class is outside 0..{n_classes - 1}")
    if not totals:
        return ThresholdFit((np.inf,) * (n_classes - 1), None)
    before, start = np.zeros(n_classes), {}
    for part in sorted(totals):
        start[part], before = before, before + totals[part][:-1]

    gaps = (np.arange(n_classes)[:, None] - np.arange(n_classes)[None, :]) ** 2.0
    expected = gaps @ per_class / per_class.sum()
    ratio, best, trial = np.inf, None, 1.0
    while True:
        found = kept.mapInArrow(_segment(start, gaps, expected, trial), "part int, cells array<double>")
        pieces = {r.part: np.array(r.cells) for r in found.collect()}
        end = _costs(per_class[None, :], gaps, expected, trial)  # a cut above all scores
        cuts = _join([*(pieces[p] for p in sorted(pieces)), _best_runs(np.array([np.inf]), end, per_class[None, :])], n_classes)
        below = np.vstack([np.zeros(n_classes), cuts[1], per_class])
        own = np.diff(below, axis=0)
        num, den = float((gaps * own).sum()), float((expected * own.sum(axis=1)).sum())
        if den <= 0:
            return ThresholdFit(tuple(cuts[0]), None)
        if best is not None and num / den >= ratio - 1e-12:
            return ThresholdFit(best, float(1 - ratio))
        ratio, best, trial = num / den, tuple(cuts[0]), num / den


def _costs(below: np.ndarray, gaps: np.ndarray, expected: np.ndarray, trial: float) -> np.ndarray:
    """cost[i, x]: what cut i at x, with the given class counts below, adds to observed - trial * expected disagreement."""
    each = gaps @ below.T - trial * np.outer(expected, below.sum(axis=1))
    return each[:-1] - each[1:]


def _best_runs(scores: np.ndarray, cost: np.ndarray, below: np.ndarray) -> np.ndarray:
    """For every i <= j the least cost of cuts i to j within a segment, with the cuts and the counts below them, as numbers in a row."""
    k, n = cost.shape[0], below.shape[1]
    out = []
    for i in range(k):
        reach, origins = cost[i], []
        for j in range(i, k):
            if j > i:
                lowest = np.minimum.accumulate(reach)
                origins.append(np.maximum.accumulate(np.where(reach == lowest, np.arange(len(reach)), 0)))
                reach = cost[j] + lowest
            picks = [int(reach.argmin())]
            for origin in reversed(origins):
                picks.insert(0, int(origin[picks[0]]))
            row = np.full((k, 1 + n), np.nan)
            row[i : j + 1, 0], row[i : j + 1, 1:] = scores[picks], below[picks]
            out.append(np.concatenate([[i, j, reach.min()], row.ravel()]))
    return np.concatenate(out)


def _segment(start: dict[int, np.ndarray], gaps: np.ndarray, expected: np.ndarray, trial: float):
    """Map task: the best runs of cuts of its partition, whose counts it holds."""

    def work(batches):
        import pyarrow as pa

        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        part = table.column("part")[0].as_py()
        own = np.array([table.column(f"n{k}").to_numpy() for k in range(len(expected))], float).T
        below = start[part] + np.cumsum(own, axis=0) - own  # strictly below each score
        cells = _best_runs(table.column("s").to_numpy(), _costs(below, gaps, expected, trial), below)
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "cells": pa.array([cells.tolist()], pa.list_(pa.float64()))})

    return work


def _join(pieces: list[np.ndarray], n_classes: int) -> tuple[np.ndarray, np.ndarray]:
    """The best cuts over segments in order: each takes a run of the cuts that those before have left."""
    k = n_classes - 1
    best: list[tuple[float, np.ndarray] | None] = [(0.0, np.full((k, 1 + n_classes), np.nan)), *[None] * k]
    for piece in pieces:
        now = list(best)
        for row in piece.reshape(-1, 3 + k * (1 + n_classes)):
            i, j, cost, cells = int(row[0]), int(row[1]), row[2], row[3:].reshape(k, -1)
            if best[i] is not None and (now[j + 1] is None or best[i][0] + cost < now[j + 1][0]):
                now[j + 1] = (best[i][0] + cost, np.where(np.isnan(cells), best[i][1], cells))
        best = now
    return best[k][1][:, 0], best[k][1][:, 1:]
