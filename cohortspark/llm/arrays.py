"""Vectorised text handling inside tasks: words, lines and n-grams as numpy hashes over the bytes of many texts.

A chunk is a run of whole texts of about ``CHUNK_BYTES``; a longer text is a chunk of its own. Hashes are 64-bit, equal
words hash equally in every task, and callers that need certainty compare the texts behind equal hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

SPACE = np.ones(256, bool)  # True: byte of a word [^\x20\x09-\x0D]+
SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)  # True: byte of a word [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LINE = np.ones(256, bool)
LINE[0x0A] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

STEP = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * STEP)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of STEP and of its inverse."""
    up, down = np.full(n, STEP, np.uint64), np.full(n, INVERSE, np.uint64)
    up[:1] = down[:1] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n + 1 offsets; a null is an empty text."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    _, offsets, data = column.buffers()
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES):
    """(first, last + 1) of runs of texts of about ``size`` bytes."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, last
        first = last


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of ``inside`` bytes that don't cross texts, and where each text's runs begin."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    mask = inside[data]
    edges = np.zeros(len(data) + 1, bool)  # a text begins here
    edges[offsets] = True
    starts = np.flatnonzero(mask & (np.r_[True, ~mask[:-1]] | edges[:-1]))
    ends = np.flatnonzero(mask & (np.r_[~mask[1:], True] | edges[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int = CHUNK_BYTES) -> np.ndarray:
    """A 64-bit hash of each span's bytes, by prefix sums over blocks of spans (spans must not overlap)."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + size, "right")))
        low, high = starts[first], ends[last - 1]
        out[first:last] = range_hashes(BYTE_CODE[data[low:high]], starts[first:last] - low, ends[first:last] - low)
        first = last
    return out


def range_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of codes[start:end] for each range, which may overlap."""
    up, down = powers(len(codes) + 1)
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place on; the last n - 1 places have none."""
    out = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for j in range(n if len(out) else 0):
        out = out * STEP + words[j : j + len(out)]
    return mix(out)


def inside_texts(bounds: np.ndarray, n: int) -> np.ndarray:
    """For each n-gram of the joined words: whether it lies in one text. bounds: where each text's words begin."""
    total = int(bounds[-1])
    keep = np.ones(max(0, total - n + 1), bool)
    for back in range(1, n):  # a gram that starts less than n before a boundary crosses it
        at = bounds[1:-1] - back
        keep[at[(at >= 0) & (at < len(keep))]] = False
    return keep


def owners(bounds: np.ndarray) -> np.ndarray:
    """The text of each word."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def covered(marked: np.ndarray, n: int, total: int) -> np.ndarray:
    """Words inside any marked n-gram."""
    change = np.zeros(total + 1, np.int32)
    at = np.flatnonzero(marked)
    np.add.at(change, at, 1)
    np.add.at(change, np.minimum(at + n, total), -1)
    return np.cumsum(change[:total]) > 0


def pack(values: list[np.ndarray]) -> pa.Array:
    """Arrays as a column of binaries."""
    return pa.array([np.ascontiguousarray(v).tobytes() for v in values], pa.binary())
