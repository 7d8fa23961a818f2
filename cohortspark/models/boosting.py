"""Histogram gradient boosting over Spark: all classes in one softmax pass, leaf-wise trees with L1 and L2 terms.

Features are cut into bins once. Rows travel as blocks of bin numbers with their running margins. One job a level sums gradients
per (class, node, feature, bin) in the map tasks, adds the sums up by (class, node) and finds the best cut there; the driver sees
one row per node. Nodes that one task can hold, up to the root, are grown to the end by one task each: there the larger of two
siblings costs no counting, and a tree of narrow cuts no job a level. Gradients are whole numbers of 2**-28, so sums, and with them
the trees, don't depend on how rows are partitioned.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortspark.functions.scalars import quote
from cohortspark.session import ensure_checkpoint_dir, scratch_path

UNIT = 1 << 28  # gradients are rounded to its inverse; 2**34 rows can be summed
BLOCK_ROWS = 4096
LOCAL_ROWS = 1 << 22  # of a node that one task grows to the end, in well under a second a million
LOCAL_CELLS = 1 << 26  # bins of such a node: wider rows are fewer
TASK_BLOCKS = 256  # that a task passes over at most; fewer where the cores have less to do
WAVES = 2
SORTED_ROWS = 1 << 21  # that a task sorts
FEW_ROWS = 1024
CELLS = 1 << 23  # gradient sums that a task holds at once; more nodes than that take another pass
CHECKPOINT_ROUNDS = 20
LEAST_HESSIAN, LEAST_GAIN = 1e-3, 1e-10

BLOCK = "held boolean, rows int, bins binary, label binary, pick binary, margin binary"


@dataclass(frozen=True)
class BoostingParams:
    """``classes`` of 0 asks for least squares on the label instead of a softmax over classes."""

    classes: int
    rounds: int = 100
    max_depth: int = 12
    leaves: int = 413
    learning_rate: float = 0.1
    min_leaf: int = 20
    feature_fraction: float = 1.0
    bagging_fraction: float = 1.0
    bagging_rounds: int = 1
    l1: float = 0.0
    l2: float = 0.0
    max_bins: int = 255
    seed: int = 42

    @property
    def margins(self) -> int:
        return self.classes or 1


@dataclass
class Tree:
    """Node arrays; ``feature`` is -1 at a leaf. A row goes left where its feature is at most ``cut``, its bin at most ``bin``."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    cut: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def walk(self, columns: np.ndarray, cuts: list) -> np.ndarray:
        """The node that every row (a column of ``columns``) ends in."""
        feature, left, right = (np.asarray(v, np.int32) for v in (self.feature, self.left, self.right))
        cut = np.asarray(cuts)
        node = np.zeros(columns.shape[1], np.int32)
        inner = np.arange(columns.shape[1]) if feature[0] >= 0 else np.zeros(0, np.intp)
        while len(inner):
            at = node[inner]
            node[inner] = np.where(columns[feature[at], inner] <= cut[at], left[at], right[at])
            inner = inner[feature[node[inner]] >= 0]
        return node


@dataclass
class _Node:
    number: int
    depth: int
    rows: int = 0
    g: int = 0
    h: int = 0
    best: tuple | None = None  # gain, feature, bin, then g, h and rows of the left child
    children: tuple | None = None


# ---------------------------------------------------------------------------------------------------------- bins


def bin_cuts(df: DataFrame, features: str = "features", max_bins: int = 255) -> list[list[float]]:
    """Upper bounds of all bins but the last, per feature, from one quantile sketch of all rows."""
    cells = df.select(F.posexplode(vector_to_array(quote(features))).alias("f", "v")).where("NOT isnan(v)")
    shares = F.array(*[F.lit(i / max_bins) for i in range(1, max_bins)])
    found = cells.groupBy("f").agg(F.array_sort(F.array_distinct(F.percentile_approx("v", shares, 20 * max_bins))).alias("q"), F.max("v").alias("m"))
    cuts: dict[int, list[float]] = {f: [c for c in q if c < m] for f, q, m in found.collect()}
    return [cuts.get(f, []) for f in range(max(cuts, default=-1) + 1)]


def block_count(rows: int) -> int:
    return max(1, -(-rows // BLOCK_ROWS))


def part_count(rows: int, cores: int) -> int:
    """Partitions of the blocks: every job of every round starts a task for each, so there are some waves of the cores at most,
    unless tasks would get more than ``TASK_BLOCKS``."""
    return min(block_count(rows), max(WAVES * cores, -(-block_count(rows) // TASK_BLOCKS)))


def _narrow(values: np.ndarray) -> bytes:
    """Whole numbers in four bytes each, where all fit, or eight; ``_wide`` tells by their length."""
    fits = not len(values) or (values.min() >= -(1 << 31) and values.max() < 1 << 31)
    return (values.astype(np.int32) if fits else values).tobytes()


def _wide(parts: Sequence[bytes], rows: Sequence[int]) -> np.ndarray:
    return np.concatenate([np.frombuffer(p, np.int32 if len(p) == 4 * n else np.int64) for p, n in zip(parts, rows)])


def _blocks(cuts: list[list[float]], start: list[float]):
    edges = [np.array(c) for c in cuts]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(first, BLOCK_ROWS)
                n = part.num_rows
                values = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
                bins = np.array([np.searchsorted(e, values[:, f]) for f, e in enumerate(edges)], np.uint8).reshape(len(edges), n)
                held = part.column(3).to_numpy(zero_copy_only=False)
                for side in np.unique(held):
                    inside = held == side
                    yield pa.RecordBatch.from_pylist(
                        [
                            {
                                "held": bool(side),
                                "rows": int(inside.sum()),
                                "bins": bins[:, inside].tobytes(),
                                "label": part.column(0).to_numpy(zero_copy_only=False)[inside].astype(np.float64).tobytes(),
                                "pick": part.column(2).to_numpy(zero_copy_only=False)[inside].astype(np.int64).tobytes(),
                                "margin": np.tile(np.array(start)[:, None], int(inside.sum())).tobytes(),
                            }
                        ],
                        pa.schema([("held", pa.bool_()), ("rows", pa.int32()), *((c, pa.binary()) for c in ("bins", "label", "pick", "margin"))]),
                    )

    return work


def _unpack(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(row of the batch, bins by feature, labels, picks, margins by class) of every block."""
    for i in range(batch.num_rows):
        n = batch.column(1)[i].as_py()
        raw = [np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in ((2, np.uint8), (3, np.float64), (4, np.int64), (5, np.float64))]
        yield i, raw[0].reshape(-1, n), raw[1], raw[2], raw[3].reshape(-1, n)


# ------------------------------------------------------------------------------------------------------ gradients


def softmax(margin: np.ndarray) -> np.ndarray:
    e = np.exp(margin - margin.max(axis=0))
    return e / e.sum(axis=0)


def gradients(margin: np.ndarray, label: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the loss by class, in units."""
    if not classes:
        return np.rint((margin - label) * UNIT).astype(np.int64), np.full(margin.shape, UNIT, np.int64)
    p = softmax(margin)
    g = p - (np.arange(classes)[:, None] == label)
    h = p * (1 - p) * (classes / (classes - 1) if classes > 1 else 1.0)
    return np.rint(g * UNIT).astype(np.int64), np.rint(h * UNIT).astype(np.int64)


def in_bag(pick: np.ndarray, epoch: int, fraction: float) -> np.ndarray:
    """Rows drawn for a bagging epoch, by a mix of the row's hash and the epoch: the same wherever the row lies."""
    with np.errstate(over="ignore"):
        z = pick.astype(np.uint64) + np.uint64(epoch + 1) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return z < np.uint64(min(int(fraction * 2**64), 2**64 - 1))


def _sums(bins: np.ndarray, g: np.ndarray, h: np.ndarray, offsets: np.ndarray, slot: np.ndarray | None = None, nodes: int = 1) -> np.ndarray:
    """(3, nodes, cells) sums of g, h and 1 by node and cell, of rows with a bin in every feature; exact, as sums of the rows that one
    block or small node has stay below 2 ** 53. Many rows are counted a feature at a time, whose cells stay in the cache."""
    width, weights = int(offsets[-1]), [g.astype(np.float64)]
    steady = len(h) > 0 and bool((h == h[0]).all())  # least squares: the second derivatives are the counts
    if not steady:
        weights.append(h.astype(np.float64))
    if len(g) < FEW_ROWS:
        cell = offsets[:-1, None] + bins
        cell = (cell if slot is None else cell + slot * width).ravel()
        parts = [np.bincount(cell, np.tile(v, len(bins)), nodes * width) for v in weights]
        out = np.array([parts[0], parts[-1], np.bincount(cell, minlength=nodes * width)]).astype(np.int64).reshape(3, nodes, width)
    else:
        out = np.empty((3, nodes, width), np.int64)
        for f, (first, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            cell = bins[f].astype(np.intp) if slot is None else slot * (end - first) + bins[f]
            for i, v in enumerate([*weights, None]):
                out[2 if v is None else i, :, first:end] = np.bincount(cell, v, nodes * (end - first)).reshape(nodes, -1)
    if steady:
        out[1] = out[2] * h[0]
    return out


def choose(sums: np.ndarray, offsets: np.ndarray, params: BoostingParams) -> list[tuple | None]:
    """The best cut of every node of ``sums`` (3, nodes, cells): (gain, place of the feature, bin, then g, h, rows on the left), or
    None where no cut is allowed or gains anything. Of equal gains the first feature and the lowest bin count."""
    if not offsets[-1]:
        return [None] * sums.shape[1]
    through = np.cumsum(sums, axis=2)
    starts = np.repeat(offsets[:-1], np.diff(offsets))
    left = through - (np.take(through, starts, axis=2) - np.take(sums, starts, axis=2))
    whole = np.repeat(np.take(left, offsets[1:] - 1, axis=2), np.diff(offsets), axis=2)
    right = whole - left

    def score(part: np.ndarray) -> np.ndarray:
        reach = np.maximum(np.abs(part[0]) / UNIT - params.l1, 0.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            return reach * reach / (part[1] / UNIT + params.l2)

    least = int(LEAST_HESSIAN * UNIT)
    allowed = (left[1:] >= np.array([least, params.min_leaf])[:, None, None]) & (right[1:] >= np.array([least, params.min_leaf])[:, None, None])
    gain = np.where(allowed.all(axis=0), score(left) + score(right) - score(whole), -np.inf)
    at = gain.argmax(axis=1)
    out: list[tuple | None] = []
    for node, cell in enumerate(at.tolist()):
        if not gain[node, cell] > LEAST_GAIN:
            out.append(None)
            continue
        place = int(np.searchsorted(offsets, cell, "right")) - 1
        out.append((float(gain[node, cell]), place, cell - int(offsets[place]), *(int(v) for v in left[:, node, cell])))
    return out


def _bag(pick: np.ndarray, number: int, params: BoostingParams) -> np.ndarray:
    if params.bagging_fraction >= 1:
        return np.ones(len(pick), bool)
    return in_bag(pick, number // params.bagging_rounds, params.bagging_fraction)


def _slots(trees: list[Tree], wanted: list[list[int]]) -> list[np.ndarray]:
    out = []
    for tree, nodes in zip(trees, wanted):
        slot = np.full(len(tree.feature), -1, np.int64)
        slot[nodes] = np.arange(len(nodes))
        out.append(slot)
    return out


def _histograms(trees: list[Tree], wanted: list[list[int]], drawn: list[list[int]], offsets: list[np.ndarray], params: BoostingParams, number: int):
    """Map task: the gradient sums of the wanted nodes of every class over the drawn features' bins, added up over its blocks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        widths = [int(o[-1]) for o in offsets]
        sums = [np.zeros((3, len(nodes), width), np.int64) for nodes, width in zip(wanted, widths)]
        slots = _slots(trees, wanted)
        for batch in batches:
            for _, bins, label, pick, margin in _unpack(batch):
                bag = _bag(pick, number, params)
                g, h = gradients(margin, label, params.classes)
                for k, tree in enumerate(trees):
                    if not wanted[k]:
                        continue
                    slot = slots[k][tree.walk(bins, tree.bin)]
                    rows = np.flatnonzero((slot >= 0) & bag)
                    sums[k] += _sums(bins[drawn[k]][:, rows], g[k][rows], h[k][rows], offsets[k], slot[rows], len(wanted[k]))
        for k, total in enumerate(sums):
            for i, node in enumerate(wanted[k]):
                part = total[:, i]
                if part[2].any():
                    yield pa.RecordBatch.from_pylist([{"c": k, "node": node, "sums": part.tobytes()}], _SUMS)

    return work


_SUMS = pa.schema([("c", pa.int32()), ("node", pa.int32()), ("sums", pa.binary())])
_FOUND = pa.schema([("c", pa.int32()), ("node", pa.int32()), ("found", pa.string())])


def _reduce(offsets: list[np.ndarray], params: BoostingParams):
    """The sums of every (class, node) of a partition over all map tasks, its totals and its best cut."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                key = (batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
                part = np.frombuffer(batch.column(2)[i].as_buffer(), np.int64).reshape(3, -1)
                totals[key] = totals[key] + part if key in totals else part
        for (c, node), sums in totals.items():
            whole = sums[:, : int(offsets[c][1])].sum(axis=1).tolist()  # every feature has all rows
            found = [*whole, choose(sums[:, None, :], offsets[c], params)[0]]
            yield pa.RecordBatch.from_pylist([{"c": c, "node": node, "found": json.dumps(found)}], _FOUND)

    return work


# ----------------------------------------------------------------------------------------------------- small nodes


def _rows_of_nodes(trees: list[Tree], wanted: list[list[int]], task: dict[tuple[int, int], int], drawn: list[list[int]], params: BoostingParams, number: int):
    """Map task: the bins and gradients of the rows that lie in small nodes, a row of bytes for each block and node."""
    schema = pa.schema([*((c, pa.int32()) for c in ("task", "c", "node")), *((c, pa.binary()) for c in ("bins", "g", "h"))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = _slots(trees, wanted)
        for batch in batches:
            for _, bins, label, pick, margin in _unpack(batch):
                bag = _bag(pick, number, params)
                g, h = gradients(margin, label, params.classes)
                out = []
                for k, tree in enumerate(trees):
                    if not wanted[k]:
                        continue
                    slot = np.where(bag, slots[k][tree.walk(bins, tree.bin)], -1)
                    order = np.argsort(slot, kind="stable")
                    ends = np.searchsorted(slot[order], np.arange(len(wanted[k]) + 1))
                    for i in np.flatnonzero(np.diff(ends)):
                        rows = order[ends[i] : ends[i + 1]]
                        parts = {"bins": bins[drawn[k]][:, rows].tobytes(), "g": _narrow(g[k][rows]), "h": _narrow(h[k][rows])}
                        out.append({"task": task[k, wanted[k][i]], "c": k, "node": wanted[k][i], **parts})
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema)

    return work


def subtree(bins: np.ndarray, g: np.ndarray, h: np.ndarray, offsets: np.ndarray, depth: int, params: BoostingParams) -> list[tuple]:
    """All nodes below and with a small node: (rows, g, h, best cut, number of the left child; the right one follows it).

    A level at a time; the larger of two siblings has its parent's sums less those of the smaller. Only cuts that leaf-wise growth
    of this subtree alone would make are made: beside the rest of the tree there are no more of them.
    """
    nodes: list[list] = [[len(g), int(g.sum()), int(h.sum()), None, 0]]
    level = [(0, np.arange(len(g)), _sums(bins, g, h, offsets)[:, 0])]
    while level:
        following = []
        for (number, *_), best in zip(level, choose(np.stack([s for *_, s in level], axis=1), offsets, params)):
            nodes[number][3] = best
        picked = set(_leaf_wise(params.leaves, lambda n: nodes[n][3], lambda n: (nodes[n][4], nodes[n][4] + 1) if nodes[n][4] else ()))
        for number, rows, sums in level:
            n, gs, hs, best, _ = nodes[number]
            if best is None or number not in picked:
                nodes[number][3] = None
                continue
            _, place, cut, gl, hl, nl = best
            nodes[number][4] = len(nodes)
            left = bins[place, rows] <= cut
            sides = [(nl, gl, hl, rows[left]), (n - nl, gs - gl, hs - hl, rows[~left])]
            nodes += [[*side[:3], None, 0] for side in sides]
            if depth + 1 < params.max_depth and max(nl, n - nl) >= 2 * params.min_leaf:
                small = 0 if nl <= n - nl else 1
                inside = sides[small][3]
                own = _sums(bins[:, inside], g[inside], h[inside], offsets)[:, 0]
                both = [own, sums - own] if small == 0 else [sums - own, own]
                for i in range(2):
                    if sides[i][0] >= 2 * params.min_leaf:
                        following.append((len(nodes) - 2 + i, sides[i][3], both[i]))
        level, depth = following, depth + 1
    return [tuple(n) for n in nodes]


def _dealt(rows: dict[tuple[int, int], int], tasks: int) -> dict[tuple[int, int], int]:
    """The task of every (class, node), so that tasks get about the same number of rows: the largest first, to the emptiest task."""
    held, out = [(0, t) for t in range(tasks)], {}
    for key in sorted(rows, key=lambda k: (-rows[k], k)):
        filled, out[key] = heapq.heappop(held)
        heapq.heappush(held, (filled + rows[key], out[key]))
    return out


def _finish(offsets: list[np.ndarray], depths: list[dict[int, int]], params: BoostingParams):
    """A small node's rows, at most ``LOCAL_ROWS``, to its whole subtree."""

    def grow_one(key: tuple[int, int], parts: list[list[bytes]]) -> pa.RecordBatch:
        blocks = [np.frombuffer(b, np.uint8).reshape(len(offsets[key[0]]) - 1, -1) for b, *_ in parts]
        rows = [b.shape[1] for b in blocks]
        g, h = (_wide([p[i] for p in parts], rows) for i in (1, 2))
        found = subtree(np.concatenate(blocks, axis=1), g, h, offsets[key[0]], depths[key[0]][key[1]], params)
        return pa.RecordBatch.from_pylist([{"c": key[0], "node": key[1], "found": json.dumps(found)}], _FOUND)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for batch in batches:
            for c, node, *part in zip(*(column.to_pylist() for column in batch.columns)):
                if now is not None and now != (c, node):
                    yield grow_one(now, parts)
                    parts = []
                now = (c, node)
                parts.append(part)
        if now is not None:
            yield grow_one(now, parts)

    return work


def _widest(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def _by_node(df: DataFrame, nodes: int, blocks: int) -> DataFrame:
    """The rows of each (class, node) in one partition; those of a single block are together as they are."""
    if blocks == 1:
        return df.coalesce(1)
    return df.repartition(min(nodes, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "c", "node")


# ---------------------------------------------------------------------------------------------------------- growth


def _leaf_wise(leaves: int, best: Callable[[int], tuple | None], children: Callable[[int], Sequence[int]]) -> list[int]:
    """The nodes that leaf-wise growth cuts, in order, as far as their best cuts are known: the largest gain first."""
    picked: list[int] = []
    heap = [(-best(0)[0], 0)] if best(0) else []
    while heap and len(picked) < leaves - 1:
        number = heapq.heappop(heap)[1]
        picked.append(number)
        for child in children(number):
            if best(child):
                heapq.heappush(heap, (-best(child)[0], child))
    return picked


def _chosen(nodes: list[_Node], leaves: int) -> list[_Node]:
    return [nodes[n] for n in _leaf_wise(leaves, lambda n: nodes[n].best, lambda n: nodes[n].children or ())]


def _routing(nodes: list[_Node]) -> Tree:
    tree = Tree(*([0] * len(nodes) for _ in range(7)))
    for node in nodes:
        tree.feature[node.number] = node.best[1] if node.children else -1
        if node.children:
            tree.bin[node.number] = node.best[2]
            tree.left[node.number], tree.right[node.number] = node.children
    return tree


def _leaf(g: int, h: int, params: BoostingParams) -> float:
    reach = max(abs(g) / UNIT - params.l1, 0.0)
    return -math.copysign(reach / (h / UNIT + params.l2), g) * params.learning_rate if reach else 0.0


def _final(nodes: list[_Node], cuts: list[list[float]], params: BoostingParams) -> Tree:
    """The chosen nodes alone, renumbered from the root; the others above them are leaves."""
    inner = {node.number for node in _chosen(nodes, params.leaves)}
    tree, queue = Tree(*([] for _ in range(7))), [0]
    for number in queue:
        node = nodes[number]
        split = number in inner
        tree.feature.append(node.best[1] if split else -1)
        tree.bin.append(node.best[2] if split else 0)
        tree.cut.append(cuts[node.best[1]][node.best[2]] if split else 0.0)
        tree.left.append(len(queue) if split else 0)
        tree.right.append(len(queue) + 1 if split else 0)
        tree.value.append(0.0 if split or not inner else _leaf(node.g, node.h, params))
        tree.gain.append(node.best[0] if split else 0.0)
        if split:
            queue.extend(node.children)
    return tree


def grow(
    state: DataFrame, cuts: list[list[float]], params: BoostingParams, number: int, rows: int, local_rows: int | None = None
) -> list[Tree]:
    """One tree for each class, of at most ``leaves`` leaves and ``max_depth`` levels; ``rows`` is at least the number of rows.

    Leaf-wise growth picks cuts by falling gain, and the best cut of a node doesn't depend on the order. So a level's open nodes
    are searched together, in one job for all classes, but only those that the growth so far would reach within its leaves; the
    final choice is the same as if leaves had been cut one by one. Nodes of at most ``local_rows`` rows (by default as many as
    ``LOCAL_ROWS`` and ``LOCAL_CELLS`` allow) are left for a last job, in which each is one task's group and is grown to the end there.
    """
    classes = params.margins
    usable = [f for f, c in enumerate(cuts) if c]
    if not usable:
        return [Tree() for _ in range(classes)]
    count = max(1, round(len(usable) * params.feature_fraction))
    if local_rows is None:
        local_rows = min(LOCAL_ROWS, LOCAL_CELLS // count)
    drawn = [sorted(np.random.default_rng([params.seed, number, k]).choice(usable, count, False).tolist()) for k in range(classes)]
    offsets = [np.concatenate([[0], np.cumsum([len(cuts[f]) + 1 for f in features])]).astype(np.int64) for features in drawn]
    grown: list[list[_Node]] = [[_Node(0, 0, rows)] for _ in range(classes)]
    training, blocks = state.where("NOT held"), block_count(rows)
    wanted = [[0] for _ in range(classes)]
    small: list[dict[int, int]] = [{} for _ in range(classes)]
    while any(wanted):
        large: list[list[int]] = [[] for _ in range(classes)]
        for k, numbers in enumerate(wanted):
            for n in numbers:
                if grown[k][n].rows > local_rows:
                    large[k].append(n)
                else:
                    small[k][n] = grown[k][n].depth
        trees = [_routing(nodes) for nodes in grown]
        for passed in _passes(large, max(1, CELLS // max(int(o[-1]) for o in offsets))):
            sums = training.mapInArrow(_histograms(trees, passed, drawn, offsets, params, number), "c int, node int, sums binary")
            met = _by_node(sums, sum(map(len, passed)), blocks).mapInArrow(_reduce(offsets, params), "c int, node int, found string")
            for c, at, found in met.collect():
                node = grown[c][at]
                node.g, node.h, node.rows, best = json.loads(found)
                node.best = None if best is None else (best[0], drawn[c][best[1]], *best[2:])
        wanted = []
        for nodes in grown:
            following = []
            for node in _chosen(nodes, params.leaves):
                if node.children:
                    continue
                _, _, _, gl, hl, nl = node.best
                left = _Node(len(nodes), node.depth + 1, nl, gl, hl)
                right = _Node(len(nodes) + 1, node.depth + 1, node.rows - nl, node.g - gl, node.h - hl)
                nodes += [left, right]
                node.children = (left.number, right.number)
                following += [n.number for n in (left, right) if n.depth < params.max_depth and n.rows >= 2 * params.min_leaf]
            wanted.append(following)
    if any(small):
        trees = [_routing(nodes) for nodes in grown]
        sizes = {(k, n): grown[k][n].rows for k, nodes in enumerate(small) for n in nodes}
        tasks = min(len(sizes), _widest(state.sparkSession)) if blocks > 1 else 1
        rows_of = training.mapInArrow(
            _rows_of_nodes(trees, [sorted(s) for s in small], _dealt(sizes, tasks), drawn, params, number),
            "task int, c int, node int, bins binary, g binary, h binary",
        )
        dealt = rows_of.repartitionById(tasks, "task") if blocks > 1 else rows_of.coalesce(1)
        together = dealt.drop("task").sortWithinPartitions("c", "node")
        for c, at, found in together.mapInArrow(_finish(offsets, small, params), "c int, node int, found string").collect():
            _attach(grown[c], at, json.loads(found), drawn[c])
    return [_final(nodes, cuts, params) for nodes in grown]


def _attach(nodes: list[_Node], at: int, found: list, drawn: list[int]) -> None:
    """Puts a subtree below a node; its own number 0 is the node itself."""
    base, top = len(nodes) - 1, nodes[at].depth
    for i, (rows, g, h, best, _) in enumerate(found):
        node = nodes[at] if i == 0 else _Node(base + i, 0)
        node.rows, node.g, node.h = rows, g, h
        node.best = None if best is None else (best[0], drawn[best[1]], *best[2:])
        if i:
            nodes.append(node)
    for i, (*_, best, left) in enumerate(found):
        if best is not None:
            node = nodes[at] if i == 0 else nodes[base + i]
            node.children = (base + left, base + left + 1)
            for child in node.children:
                nodes[child].depth = (top if i == 0 else node.depth) + 1


def _passes(wanted: list[list[int]], most: int) -> Iterator[list[list[int]]]:
    """The wanted nodes in parts of at most ``most`` over all classes."""
    flat = [(k, n) for k, nodes in enumerate(wanted) for n in nodes]
    for first in range(0, len(flat), most):
        yield [[n for c, n in flat[first : first + most] if c == k] for k in range(len(wanted))]


def _advance(trees: list[Tree]):
    """Adds a round's trees to the running margins."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = []
            for _, bins, _, _, margin in _unpack(batch):
                step = [np.asarray(t.value)[t.walk(bins, t.bin)] for t in trees]
                margins.append((margin + np.array(step)).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(margins, pa.binary())], batch.schema.names)

    return work


def _held_loss(classes: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = 0.0, 0
        for batch in batches:
            for _, _, label, _, margin in _unpack(batch):
                total, rows = total + losses(margin, label, classes).sum(), rows + len(label)
        yield pa.RecordBatch.from_pydict({"loss": [float(total)], "n": [rows]})

    return work


def losses(margin: np.ndarray, label: np.ndarray, classes: int) -> np.ndarray:
    """Negative log likelihood of every row, or its squared error."""
    if not classes:
        return (margin[0] - label) ** 2
    p = softmax(margin)
    known = (label >= 0) & (label < classes)
    return -np.log(np.maximum(p[np.where(known, label, 0).astype(int), np.arange(len(label))], 1e-15))


def train(
    df: DataFrame,
    label: str,
    params: BoostingParams,
    features: str = "features",
    validation: DataFrame | None = None,
    patience: int | None = None,
    local_rows: int | None = None,
) -> BoostedTreesModel:
    """Fit on the rows with a label; with ``validation`` and ``patience`` training stops when its loss hasn't fallen for so many
    rounds, and the trees of the best round are kept.

    Rows are binned and written once to the shared checkpoint folder. Margins are kept beside them, updated by each round's trees,
    and written there every few rounds, so a lost executor costs at most those rounds' maps. Blocks are dealt by the number of
    rows. Bags are drawn by a hash of the whole row: equal rows are drawn together.
    """
    ensure_checkpoint_dir(df.sparkSession)
    columns = [c for c in df.columns if c != features]

    def rows_of(frame: DataFrame, held: bool) -> DataFrame:
        values = vector_to_array(quote(features))
        known = frame.where(F.col(quote(label)).isNotNull())
        return known.select(
            F.col(quote(label)).cast("double").alias("label"),
            values.alias("features"),
            F.xxhash64(values, *[F.col(quote(c)) for c in columns if c in frame.columns]).alias("pick"),
            F.lit(held).alias("held"),
        )

    labelled = df.where(F.col(quote(label)).isNotNull())
    cuts = bin_cuts(labelled, features, params.max_bins)
    counts = labelled.groupBy(F.col(quote(label)).cast("double").alias("y")).agg(F.count("*").alias("n"))
    if params.classes:
        seen = dict(counts.where(F.col("y").between(0, params.classes - 1)).collect())
        total = sum(seen.values())
        start = [math.log(max(seen.get(float(k), 0) / total, 1e-15)) if total else 0.0 for k in range(params.classes)]
    else:
        total, mean = counts.agg(F.sum("n"), F.sum(F.col("y") * F.col("n")) / F.sum("n")).head()
        start = [mean or 0.0]
    rows = rows_of(df, False) if validation is None else rows_of(df, False).unionByName(rows_of(validation, True))
    parts = part_count(total or 0, df.sparkSession.sparkContext.defaultParallelism)
    state = rows.repartition(parts, "pick").sortWithinPartitions("held", "pick").mapInArrow(_blocks(cuts, start), BLOCK).checkpoint()
    rounds: list[list[Tree]] = []
    best, kept, older = math.inf, 0, None
    for number in range(params.rounds):
        trees = grow(state, cuts, params, number, total or 0, local_rows)
        rounds.append(trees)
        following = state.mapInArrow(_advance(trees), BLOCK)
        following = following.checkpoint() if (number + 1) % CHECKPOINT_ROUNDS == 0 else following.persist()
        if patience is not None and validation is not None:
            sums = following.where("held").mapInArrow(_held_loss(params.classes), "loss double, n long").agg(F.sum("loss"), F.sum("n")).head()
            loss = sums[0] / sums[1] if sums[1] else 0.0
            if loss < best:
                best, kept = loss, number + 1
            elif number + 1 - kept >= patience:
                break
        if older is not None:
            older.unpersist()
        older, state = state, following
    state.unpersist()
    if older is not None:
        older.unpersist()
    return BoostedTreesModel.of(rounds[: kept or len(rounds)], start, params.classes, len(cuts), features)


# ----------------------------------------------------------------------------------------------------------- model


class BoostedTreesModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted trees; adds ``probabilities`` for classes, ``prediction`` for least squares. Saved with its parameters."""

    trees = Param(Params._dummy(), "trees", "the trees of every round and class as JSON", typeConverter=TypeConverters.toString)
    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, trees: str = "", featuresCol: str = "features"):
        super().__init__()
        self._set(**self._input_kwargs)

    @classmethod
    def of(cls, rounds: Sequence[Sequence[Tree]], start: Sequence[float], classes: int, width: int, features: str) -> BoostedTreesModel:
        stored = {"start": list(start), "classes": classes, "width": width, "rounds": [[vars(t) for t in r] for r in rounds]}
        return cls(trees=json.dumps(stored), featuresCol=features)

    def _stored(self) -> dict:
        return json.loads(self.getOrDefault(self.trees))

    @property
    def classes(self) -> int:
        return self._stored()["classes"]

    @property
    def rounds(self) -> list[list[Tree]]:
        return [[Tree(**t) for t in r] for r in self._stored()["rounds"]]

    @property
    def start(self) -> list[float]:
        return self._stored()["start"]

    def first(self, rounds: int) -> BoostedTreesModel:
        """The model as it was after so many rounds."""
        stored = self._stored()
        return self.of(self.rounds[:rounds], stored["start"], stored["classes"], stored["width"], self.getOrDefault(self.featuresCol))

    def importances(self) -> list[float]:
        """Share of each feature in the gains of all cuts; zeros where nothing was cut."""
        gains = np.zeros(self._stored()["width"])
        for tree in (t for r in self.rounds for t in r):
            for f, gain in zip(tree.feature, tree.gain):
                if f >= 0:
                    gains[f] += gain
        return (gains / gains.sum() if gains.sum() else gains).tolist()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rounds, start, classes = self.rounds, np.array(self.start), self.classes

        @F.pandas_udf("array<double>" if classes else "double")
        def score(values):
            import pandas as pd

            if not len(values):
                return pd.Series([], dtype=object if classes else float)
            columns = np.vstack(values.to_numpy()).T
            margin = np.repeat(start[:, None], columns.shape[1], axis=1)
            for trees in rounds:
                margin += np.array([np.asarray(t.value)[t.walk(columns, t.cut)] for t in trees])
            return pd.Series(list(softmax(margin).T) if classes else margin[0])

        return dataset.withColumn("probabilities" if classes else "prediction", score(vector_to_array(self.getOrDefault(self.featuresCol))))

    def node_frame(self, df: DataFrame) -> DataFrame:
        """(round, class, node, feature, cut, left, right, value): every node of every tree; feature is NULL at leaves. ``place``,
        ``left_place`` and ``right_place`` number the nodes of all trees throughout."""
        trees = [(r + 1, c, t) for r, of_round in enumerate(self.rounds) for c, t in enumerate(of_round)]
        sizes = [len(t.feature) for *_, t in trees]
        feature = np.concatenate([np.asarray(t.feature, np.int32) for *_, t in trees])
        columns = {
            "round": pa.array(np.repeat([r for r, *_ in trees], sizes), pa.int32()),
            "class": pa.array(np.repeat([c for _, c, _ in trees], sizes), pa.int32()),
            "node": pa.array(np.concatenate([np.arange(n) for n in sizes]), pa.int32()),
            "feature": pa.array(feature, pa.int32(), mask=feature < 0),
        }
        for name, kind in (("cut", pa.float64()), ("left", pa.int32()), ("right", pa.int32()), ("value", pa.float64())):
            columns[name] = pa.array([v for *_, t in trees for v in getattr(t, name)], kind)
        first = np.repeat(np.cumsum([0, *sizes[:-1]]), sizes)  # the place of each tree's root
        columns["place"] = pa.array(np.arange(len(first)), pa.int64())
        for side in ("left", "right"):
            columns[f"{side}_place"] = pa.array(first + columns[side].to_numpy(), pa.int64())
        return df.sparkSession.createDataFrame(pa.table(columns))


def margins_by_join(model: BoostedTreesModel, df: DataFrame, keys: Sequence[str], last: bool = False) -> DataFrame:
    """(keys, round, class, margin) after every round, or after the last one only, by descending the node frame with joins: a scorer
    that shares nothing with the model's own. The keys identify a row.

    The nodes, whose number the rounds and leaves bound, are sent to the rows, numbered throughout, so that a step is one look into
    an array. Only the last margins' sums are exchanged. For all rounds, rows are dealt by their keys before they are repeated, and
    neither the running sums nor a later grouping by the keys moves them again.
    """
    path, spark = scratch_path(df.sparkSession, "nodes"), df.sparkSession
    model.node_frame(df).write.parquet(path)
    nodes, named = spark.read.parquet(path), [quote(k) for k in keys]
    steps = F.broadcast(nodes.select("place", "feature", "cut", "left_place", "right_place"))
    roots = F.broadcast(nodes.where("node = 0").select("round", "class", "place"))
    values = vector_to_array(model.getOrDefault(model.featuresCol))
    rounds = F.explode(F.sequence(F.lit(1), F.lit(len(model.rounds)))).alias("round")
    classes = F.explode(F.sequence(F.lit(0), F.lit(len(model.start) - 1))).alias("class")
    if not last:
        df = df.repartition(_tasks_of(df.count() * len(model.rounds) * len(model.start), spark), *named)
    at = df.select(*named, values.alias("_x"), rounds).select("*", classes).join(roots, ["round", "class"])
    for _ in range(max((_depth(t) for r in model.rounds for t in r), default=0)):
        to = F.when(F.col("feature").isNull(), F.col("place")).when(F.get("_x", F.col("feature")) <= F.col("cut"), F.col("left_place"))
        at = at.join(steps, "place").select(*named, "_x", "round", "class", to.otherwise(F.col("right_place")).alias("place"))
    done = at.join(F.broadcast(nodes.select("place", "value")), "place")
    begin = F.element_at(F.array(*[F.lit(s) for s in model.start]), F.col("class") + 1)
    if last:
        sums = done.groupBy(*named, "class").agg(F.sum("value").alias("_sum"))
        return sums.select(*named, F.lit(len(model.rounds)).alias("round"), "class", (begin + F.col("_sum")).alias("margin"))
    so_far = Window.partitionBy(*named, "class").orderBy("round").rowsBetween(Window.unboundedPreceding, 0)
    return done.select(*named, "round", "class", (begin + F.sum("value").over(so_far)).alias("margin"))


def _tasks_of(rows: int, spark: SparkSession) -> int:
    """Tasks for so many rows to sort: one for each ``SORTED_ROWS``, and the cores wherever that gives each of them some work."""
    return max(1, -(-rows // SORTED_ROWS), min(spark.sparkContext.defaultParallelism, rows >> 16))


def _depth(tree: Tree, node: int = 0) -> int:
    return 0 if tree.feature[node] < 0 else 1 + max(_depth(tree, tree.left[node]), _depth(tree, tree.right[node]))


def counts_by_round(model: BoostedTreesModel, df: DataFrame, label: str, thresholds: Sequence[float]) -> DataFrame:
    """(round, a, p, n, loss): rows per actual and predicted class and their loss, after every round, from one pass.

    Each batch keeps running margins, to which one round's trees are added at a time; a least-squares score is cut at the
    thresholds. Rows without a label are left out.
    """
    rounds, start, classes = model.rounds, np.array(model.start), model.classes
    limits = np.array(thresholds, float)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            actual = batch.column(0).to_numpy(zero_copy_only=False)
            columns = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).T
            margin = np.repeat(start[:, None], batch.num_rows, axis=1)
            for number, trees in enumerate(rounds, 1):
                margin = margin + np.array([np.asarray(t.value)[t.walk(columns, t.cut)] for t in trees])
                predicted = margin.argmax(axis=0) if classes else np.searchsorted(limits, margin[0], "right")
                pairs, at = np.unique(np.stack([actual, predicted.astype(float)]), axis=1, return_inverse=True)
                yield pa.RecordBatch.from_pydict(
                    {
                        "round": np.full(pairs.shape[1], number, np.int32),
                        "a": pairs[0],
                        "p": pairs[1],
                        "n": np.bincount(at.ravel()),
                        "loss": np.bincount(at.ravel(), losses(margin, actual, classes)),
                    }
                )

    rows = df.where(F.col(quote(label)).isNotNull()).select(F.col(quote(label)).cast("double"), vector_to_array(model.getOrDefault(model.featuresCol)))
    cells = rows.mapInArrow(work, "round int, a double, p double, n long, loss double")
    return cells.groupBy("round", "a", "p").agg(F.sum("n").alias("n"), F.sum("loss").alias("loss"))
