"""Line sequence labelling by a linear-chain conditional random field (operator 6)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from cohortspark.llm.arrays import (
    LINE,
    SPACE,
    chunks,
    covered,
    inside_texts,
    mix,
    ngrams,
    owners,
    span_hashes,
    spans,
    text_bytes,
)
from cohortspark.llm.frames import table, texts
from cohortspark.llm.labelled import PER_CLASS, labelled_sample

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
CONTENT_SHARE = 0.5
FEATURES = 11
CHUNK_LINES = 64


def byte_class(characters: bytes | range) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters)] = True
    return out


CLASSES = {
    "upper": byte_class(range(65, 91)),
    "digit": byte_class(range(48, 58)),
    "symbol": byte_class(SYMBOLS),
    "bar": byte_class(b"|"),
    "mark": byte_class(b"!?"),
    "point": byte_class(b".,;:"),
    "follow": byte_class(range(0x80, 0xC0)),  # bytes after the first of a code point
}


@dataclass
class Lines:
    """Lines with a word of a chunk of texts, and the per-text statistics."""

    features: np.ndarray
    words: np.ndarray
    bounds: np.ndarray  # where each text's lines begin
    stats: dict[str, np.ndarray]


def read_lines(data: np.ndarray, offsets: np.ndarray) -> Lines:
    sums = {name: np.r_[0, np.cumsum(table[data], dtype=np.int64)] for name, table in CLASSES.items()}
    starts, ends, word_bounds = spans(data, offsets, SPACE)
    hashes = span_hashes(data, starts, ends)
    n = len(hashes)

    def total(name: str, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return sums[name][b] - sums[name][a]

    grams = ngrams(hashes, 3)
    repeated = np.zeros(len(grams), bool)
    owner = owners(word_bounds)
    if len(grams):
        valid = np.flatnonzero(inside_texts(word_bounds, 3))
        keys = grams[valid] ^ mix(owner[valid].astype(np.uint64) + np.uint64(1))
        order = np.argsort(keys)
        same = keys[order][1:] == keys[order][:-1]
        repeated[valid[order[np.r_[same, False] | np.r_[False, same]]]] = True
    inside = np.r_[0, np.cumsum(covered(repeated, 3, n), dtype=np.int64)]
    chars = np.r_[0, np.cumsum((ends - starts) - total("follow", starts, ends))]

    first, last, line_bounds = spans(data, offsets, LINE)
    line_words = np.searchsorted(starts, last) - np.searchsorted(starts, first)
    keep = line_words > 0
    kept = np.r_[0, np.cumsum(keep)]
    line_bounds = kept[line_bounds]
    first, last, line_words = first[keep], last[keep], line_words[keep]
    line_hash = span_hashes(data, first, last)
    owner = owners(line_bounds)
    duplicate = np.ones(len(first), bool)
    duplicate[np.unique(line_hash ^ mix(owner.astype(np.uint64) + np.uint64(1)), return_index=True)[1]] = False
    dups = np.r_[0, np.cumsum(duplicate)]

    size = (last - first - total("follow", first, last)).astype(float)
    x = np.zeros((len(first), FEATURES), np.float32)
    x[:, 0] = 1
    x[:, 1] = np.log1p(line_words) / 4
    x[:, 2] = (line_words < 5) * 1.0
    for i, name in enumerate(("upper", "digit", "symbol", "bar", "mark", "point")):
        x[:, 3 + i] = np.minimum(1, 4 * total(name, first, last) / size)
    x[:, 9] = np.minimum(3, size / line_words / 8)
    x[:, 10] = duplicate
    stats = {
        "n_words": np.diff(word_bounds),
        "word_chars": np.diff(chars[word_bounds]),
        "n_symbols": total("symbol", offsets[:-1], offsets[1:]),
        "n_dup_lines": np.diff(dups[line_bounds]),
        "n_repeat_words": np.diff(inside[word_bounds]),
    }
    return Lines(x, line_words, line_bounds, stats)


def join_lines(parts: list[Lines]) -> Lines:
    if not parts:
        return read_lines(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    shifts = np.cumsum([0] + [p.bounds[-1] for p in parts])
    bounds = np.concatenate([p.bounds[:-1] + shift for p, shift in zip(parts, shifts)] + [shifts[-1:]])
    stats = {name: np.concatenate([p.stats[name] for p in parts]) for name in parts[0].stats}
    return Lines(np.concatenate([p.features for p in parts]), np.concatenate([p.words for p in parts]), bounds, stats)


def base_rule(stats: dict[str, np.ndarray]) -> np.ndarray:
    """Texts with too few words, or with too many in repeated passages."""
    return (stats["n_words"] < MIN_WORDS) | (100 * stats["n_repeat_words"] > MAX_REPEAT_PERCENT * stats["n_words"])


@dataclass
class Crf:
    """Labels 0 boilerplate and 1 content: weights of the line features, of label pairs in sequence, and of the first label."""

    emit: np.ndarray
    move: np.ndarray
    first: np.ndarray


def padded(values: np.ndarray, bounds: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequences as rows, cut into pieces of ``most``, and how many entries each row has."""
    pieces = [values[a : min(a + most, end)] for at, end in zip(bounds, bounds[1:]) for a in range(at, end, most)]
    out = np.zeros((len(pieces), most, *values.shape[1:]), values.dtype)
    for row, piece in zip(out, pieces):
        row[: len(piece)] = piece
    return out, np.array([len(p) for p in pieces], int)


def log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis, keepdims=True))).squeeze(axis)


def fit_crf(
    x: np.ndarray,
    y: np.ndarray,
    bounds: np.ndarray,
    weights: np.ndarray | None = None,
    rounds: int = 100,
    rate: float = 0.1,
    ridge: float = 1e-3,
) -> Crf:
    """Maximum likelihood of the weighted sequences with a ridge, by Adam on gradients of forward-backward; without lines everything is content."""
    crf = Crf(np.zeros((2, x.shape[1])), np.zeros((2, 2)), np.zeros(2))
    if not len(x):
        crf.emit[1, 0] = 1.0
        return crf
    xs, sizes = padded(x.astype(float), bounds, CHUNK_LINES)
    ys, _ = padded(y.astype(int), bounds, CHUNK_LINES)
    rows, steps = np.arange(len(xs)), xs.shape[1]
    there = np.arange(steps) < sizes[:, None]
    pieces = -(-np.diff(bounds) // CHUNK_LINES)
    weight = np.ones(len(xs)) if weights is None else np.repeat(weights, pieces)
    part = there * weight[:, None]
    one_hot = np.stack([ys == 0, ys == 1], -1) * part[..., None]
    seen_move = np.einsum("bti,btj->ij", one_hot[:, :-1], one_hot[:, 1:] > 0)
    parameters = [crf.emit, crf.move, crf.first]
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in parameters]
    for step in range(1, rounds + 1):
        e = xs @ crf.emit.T
        forward, back = np.zeros_like(e), np.zeros_like(e)
        forward[:, 0] = e[:, 0] + crf.first
        for t in range(1, steps):
            new = log_sum(forward[:, t - 1, :, None] + crf.move, 1) + e[:, t]
            forward[:, t] = np.where(there[:, t, None], new, forward[:, t - 1])
        for t in range(steps - 2, -1, -1):
            new = log_sum(crf.move + (e[:, t + 1] + back[:, t + 1])[:, None, :], 2)
            back[:, t] = np.where(there[:, t + 1, None], new, 0)
        z = log_sum(forward[rows, sizes - 1], 1)
        node = np.exp(forward + back - z[:, None, None]) * part[..., None]
        pair = forward[:, :-1, :, None] + crf.move + (e + back)[:, 1:, None, :] - z[:, None, None, None]
        pair = (np.exp(np.minimum(pair, 0)) * part[:, 1:, None, None]).sum((0, 1))
        scale = part.sum()
        grads = [
            np.einsum("btk,btf->kf", one_hot - node, xs) / scale,
            (seen_move - pair) / scale,
            (one_hot[:, 0] - node[:, 0]).sum(0) / weight.sum(),
        ]
        for p, g, (m, v) in zip(parameters, grads, state):
            g = g - ridge * p
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return crf


def viterbi(crf: Crf, x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The likeliest labels of all sequences, all of whose steps t are taken together; ties go to content."""
    e = x.astype(float) @ crf.emit.T
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = bounds[:-1][order], sizes[order]
    came = np.zeros((len(x), 2), np.int8)
    out = np.zeros(len(x), np.int8)
    best = np.zeros((len(sizes), 2))
    longest = int(sizes[0]) if len(sizes) else 0
    alive = [int(np.searchsorted(-sizes, -t, "left")) for t in range(longest + 1)]  # alive[t]: sequences longer than t
    for t in range(longest):
        n = alive[t]
        at = starts[:n] + t
        if t == 0:
            best[:n] = e[at] + crf.first
            continue
        ways = best[:n, :, None] + crf.move
        choice = (ways[:, 1] >= ways[:, 0]).astype(np.int8)
        came[at] = choice
        best[:n] = np.take_along_axis(ways, choice[:, None].astype(int), 1)[:, 0] + e[at]
    label = (best[:, 1] >= best[:, 0]).astype(np.int8)
    for t in range(longest - 1, -1, -1):
        n = alive[t]
        at = starts[:n] + t
        out[at] = label[:n]
        label[:n] = came[at, label[:n]]
    return out


def fit_quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Crf:
    """Fitted on a bounded labelled sample (see ``labelled_sample``), held-out rows excluded.

    Documents carry labels, lines don't: a line counts as boilerplate if its document is of low quality or if it repeats an
    earlier line of its document. Texts that fail the base rule are not learnt from, as the base rule decides about them. Weights restore the labels' shares among all rows.
    """
    sample, quality, share = labelled_sample(docs, labels, "quality", per_class)
    known = dict(zip(sample, quality))
    data, offsets = text_bytes(pa.array(list(known), pa.large_string()))
    lines = join_lines([read_lines(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in chunks(offsets)])
    owner = owners(lines.bounds)
    y = np.array(list(known.values()), int)[owner] * (lines.features[:, 10] == 0)
    judged = ~base_rule(lines.stats)
    kept = np.diff(lines.bounds)[judged]
    good = np.array(list(known.values()), int)[judged]
    weights = np.where(good, share / max(good.mean(), 1e-9), (1 - share) / max(1 - good.mean(), 1e-9)) if len(good) else good
    return fit_crf(lines.features[judged[owner]], y[judged[owner]], np.r_[0, np.cumsum(kept)], weights)


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, content_words long, line_labels array<byte>"
)


def label_lines(
    docs: DataFrame, crf: Crf, id_col: str = "doc_id", text_col: str = "text", share: float = CONTENT_SHARE
) -> DataFrame:
    """Per row: statistics, the labels of its lines with a word, and whether it is kept. Map only.

    Null and empty texts have no words and fail the base rule. Rows with equal or null ids are judged one by one. An empty
    table gives an empty result.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in chunks(offsets):
                lines = read_lines(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                label = viterbi(crf, lines.features, lines.bounds)
                content = np.r_[0, np.cumsum(label * lines.words)]
                content = np.diff(content[lines.bounds])
                words = lines.stats["n_words"]
                failed = base_rule(lines.stats)
                columns = [batch.column(0).slice(a, b - a), *(pa.array(v, pa.int64()) for v in lines.stats.values())]
                columns += [pa.array(failed), pa.array(~failed & (content >= share * words)), pa.array(content, pa.int64())]
                columns.append(pa.ListArray.from_arrays(pa.array(lines.bounds, pa.int32()), pa.array(label, pa.int8())))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = [field.split()[0] for field in SCHEMA.split(", ")]
    return texts(docs, id_col, text_col).mapInArrow(work, SCHEMA)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return label_lines(docs, fit_quality(docs, table(spark, sf_dir, "labels"))).drop("line_labels")


QUERIES = {"op6_quality": op6_quality}
