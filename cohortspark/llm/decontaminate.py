"""Benchmark decontamination by suffix arrays over the training words (operator 7)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.llm.arrays import ALNUM, LOWER, chunks, owners, span_hashes, spans, text_bytes
from cohortspark.llm.frames import saved, table, texts

WINDOW = 13
SHARE = 20  # contaminated: at least one word in SHARE is hit
BLOCK_BYTES = 32 << 20
CHUNK = 8 << 20


@dataclass
class TestWords:
    """The benchmark's words as numbers from 1 on (0: no such word), and its windows as suffixes of up to ``WINDOW`` words."""

    vocabulary: np.ndarray  # sorted hashes
    items: list[int]
    windows: np.ndarray  # different windows, WINDOW numbers each, 0 behind a short item
    sizes: np.ndarray
    item_bounds: np.ndarray  # of the items that have each window
    window_items: np.ndarray
    window_starts: np.ndarray  # the window's first word in the item
    pairs: np.ndarray  # sorted first * (n + 1) + second of the windows; 0 as second: windows of one word


def read_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = LOWER[data]
    starts, ends, bounds = spans(data, offsets, ALNUM)
    return span_hashes(data, starts, ends), bounds


def suffixes(numbers: np.ndarray, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The up to WINDOW numbers from each place on, 0 from the text's end on."""
    padded = np.r_[numbers, np.zeros(WINDOW, numbers.dtype)]
    place = at[:, None] + np.arange(WINDOW)
    return np.where(place < ends[:, None], padded[place], 0)


def sort_keys(rows: np.ndarray) -> np.ndarray:
    """Rows as strings of big-endian bytes, whose order is the order of the rows."""
    return np.ascontiguousarray(rows.astype(">u4")).view(f"S{4 * rows.shape[1]}").ravel()


def index_items(items: list[tuple[int, str]]) -> TestWords | None:
    """Windows of all items with words; of equal item ids each row is an item."""
    hashes, bounds = read_words(*text_bytes(pa.array([text for _, text in items], pa.large_string())))
    if not len(hashes):
        return None
    vocabulary, numbers = np.unique(hashes, return_inverse=True)
    numbers = numbers + 1
    sizes = np.diff(bounds)
    count = np.where(sizes > 0, np.maximum(1, sizes - WINDOW + 1), 0)
    owner = np.repeat(np.arange(len(items)), count)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    rows = suffixes(numbers, bounds[owner] + start, bounds[owner + 1])
    windows, inverse = np.unique(rows, axis=0, return_inverse=True)
    order = np.argsort(inverse.ravel(), kind="stable")
    pairs = np.unique(windows[:, 0] * np.int64(len(vocabulary) + 1) + windows[:, 1])
    return TestWords(
        vocabulary,
        [item for item, _ in items],
        windows,
        (windows > 0).sum(1),
        np.searchsorted(inverse.ravel()[order], np.arange(len(windows) + 1)),
        owner[order],
        start[order],
        pairs,
    )


def matches(test: TestWords, hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word place, window) of every occurrence of a window in these texts.

    The shard's suffix array holds the places whose first two words begin some window, sorted by their next WINDOW words;
    no other place can match. Every window is found in it by binary search.
    """
    at = np.minimum(np.searchsorted(test.vocabulary, hashes), len(test.vocabulary) - 1)
    numbers = np.where(test.vocabulary[at] == hashes, at + 1, 0)
    known = np.flatnonzero(numbers)
    ends = bounds[1:][owners(bounds)]
    after = np.where(known + 1 < ends[known], np.r_[numbers, 0][known + 1], 0)
    wide = np.int64(len(test.vocabulary) + 1)
    start = np.isin(numbers[known] * wide + after, test.pairs) | np.isin(numbers[known] * wide, test.pairs)
    places = known[start]
    keys = sort_keys(suffixes(numbers, places, ends[places]))
    order = np.argsort(keys, kind="stable")
    keys, places = keys[order], places[order]
    low = np.searchsorted(keys, sort_keys(test.windows), "left")
    top = np.where(np.arange(WINDOW) < test.sizes[:, None], test.windows, np.uint32(0xFFFFFFFF))
    count = np.searchsorted(keys, sort_keys(top), "right") - low
    window = np.repeat(np.arange(len(test.windows)), count)
    return places[np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)], window


def longest(
    test: TestWords, place: np.ndarray, window: np.ndarray, bounds: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Verbatim matches that can't be made longer: text, item, first word in the text and in the item, words."""
    many = np.diff(test.item_bounds)[window]
    entry = np.repeat(test.item_bounds[window], many)
    entry += np.arange(len(entry)) - np.repeat(np.cumsum(many) - many, many)
    place, size = np.repeat(place, many), np.repeat(test.sizes[window], many)
    text = np.searchsorted(bounds, place, "right") - 1
    item, start = test.window_items[entry], test.window_starts[entry]
    order = np.lexsort((place, place - start, item, text))
    text, item, place, start, size = text[order], item[order], place[order], start[order], size[order]
    same = (text[1:] == text[:-1]) & (item[1:] == item[:-1]) & (np.diff(place) == 1) & (np.diff(start) == 1)
    first = np.flatnonzero(np.r_[True, ~same]) if len(text) else np.zeros(0, int)
    last = np.r_[first[1:], len(text)][: len(first)] - 1
    return text[first], item[first], place[first] - bounds[text[first]], start[first], place[last] - place[first] + size[last]


MATCH = "array<struct<item_id: long, doc_start: long, item_start: long, n_words: long>>"


def list_matches(test: TestWords | None, column: pa.Array) -> Iterator[tuple[np.ndarray, pa.ListArray]]:
    """Numbers of words and longest matches, for runs of texts."""
    data, offsets = text_bytes(column)
    for a, b in chunks(offsets, CHUNK):
        hashes, bounds = read_words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        found = [np.zeros(0, np.int64)] * 5
        if test is not None and len(hashes):
            found = list(longest(test, *matches(test, hashes, bounds), bounds))
            found[1] = np.array(test.items, np.int64)[found[1]]
        names = ["item_id", "doc_start", "item_start", "n_words"]
        structs = pa.StructArray.from_arrays([pa.array(v, pa.int64()) for v in found[1:]], names)
        yield np.diff(bounds), pa.ListArray.from_arrays(pa.array(np.searchsorted(found[0], np.arange(b - a + 1)), pa.int32()), structs)


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, bound: int) -> Iterator[TestWords | None]:
    """The benchmark in blocks of about ``bound`` bytes; its size is measured first."""
    held = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    held = held.where(F.col("text").isNotNull() & F.col("item_id").isNotNull())
    count = 1 + (held.agg(F.sum(F.octet_length("text"))).head()[0] or 0) // bound
    for k in range(count):
        part = held.where(F.pmod(F.xxhash64("item_id"), F.lit(count)) == k)
        yield index_items([(r.item_id, r.text) for r in part.orderBy("item_id", "text").collect()])


def measure(found: list[dict]) -> tuple[int, int, str]:
    """Hit words, items, and the digest of the items."""
    hit, end = 0, 0
    for start, size in sorted((m["doc_start"], m["n_words"]) for m in found):
        hit += max(0, start + size - max(start, end))
        end = max(end, start + size)
    items = sorted({str(m["item_id"]) for m in found})
    return hit, len(items), hashlib.sha256(",".join(items).encode()).hexdigest()


def judge(n_words: int, n_hit: int) -> bool:
    return n_hit > 0 and SHARE * n_hit >= n_words


NAMES = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "matches"]
SCHEMA = (
    "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, matches " + MATCH
)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    bound: int = BLOCK_BYTES,
) -> DataFrame:
    """Per row: words, hit words, items with an occurring window, and whether it is contaminated; ``matches`` locates the
    longest verbatim matches. Map only: every batch of documents is a shard with its own suffix array.

    Null and empty texts have no words and are clean; items without words, with null text or null id match nothing. Rows
    with equal or null ids are judged one by one. A benchmark beyond ``bound`` bytes is searched block by block, each block by
    a pass over the documents that are written in between, so that a task holds one block.
    """
    tests = item_blocks(benchmark, item_col, item_text_col, bound)
    now = texts(docs, id_col, text_col).withColumn("matches", F.expr(f"CAST(array() AS {MATCH})"))
    test = next(tests)
    for following in tests:
        now = saved(now.mapInArrow(searcher(test), now.schema))
        test = following

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            earlier, at = batch.column(2).to_pylist(), 0
            for words, lists in list_matches(test, batch.column(1)):
                lists = [a + b for a, b in zip(earlier[at:], lists.to_pylist())]
                hit, items, digest = zip(*map(measure, lists))
                bad = [judge(n, h) for n, h in zip(words.tolist(), hit)]
                values = [batch.column(0).slice(at, len(words)), words, hit, items, digest, bad, lists]
                kinds = [pa.int64()] * 4 + [pa.string(), pa.bool_(), match_type()]
                at += len(words)
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], NAMES)

    return now.mapInArrow(work, SCHEMA)


def match_type() -> pa.DataType:
    return pa.list_(pa.struct([(n, pa.int64()) for n in ("item_id", "doc_start", "item_start", "n_words")]))


def searcher(test: TestWords | None, text_col: str = "text"):
    """A pass that appends the matches with one block of items to those in the last column."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts_ = batch.column(batch.schema.get_field_index(text_col))
            found = [m for _, lists in list_matches(test, texts_) for m in lists.to_pylist()]
            both = [a + b for a, b in zip(batch.columns[-1].to_pylist(), found)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(both, match_type())], batch.schema.names)

    return work


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", bound: int = BLOCK_BYTES) -> DataFrame:
    """The rows, all columns as they are, whose text isn't contaminated. Each row is judged by itself, whatever its id; with a
    benchmark beyond ``bound`` the rows carry their matches from block to block."""
    tests = item_blocks(benchmark, "item_id", "text", bound)
    test, held = next(tests), "_matches"
    while held in docs.columns:
        held += "_"
    now = docs.withColumn(held, F.expr(f"CAST(array() AS {MATCH})"))
    for following in tests:
        now = saved(now.mapInArrow(searcher(test, text_col), now.schema))
        test = following

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep: list[bool] = []
            earlier = batch.columns[-1].to_pylist()
            for words, lists in list_matches(test, batch.column(batch.schema.get_field_index(text_col))):
                for n, found in zip(words.tolist(), lists.to_pylist()):
                    keep.append(not judge(n, measure(earlier[len(keep)] + found)[0]))
            left = pa.RecordBatch.from_arrays(batch.columns[:-1], batch.schema.names[:-1])
            yield left.filter(pa.array(keep, pa.bool_()))

    return now.mapInArrow(work, docs.schema)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("matches")


QUERIES = {"op7_decontaminate": op7_decontaminate}
