"""Cross-entropy difference between a target and a background n-gram model (operator 4)."""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.llm.arrays import LOWER, SPACE, STEP, chunks, mix, owners, span_hashes, spans, text_bytes
from cohortspark.llm.frames import parts, runs, table
from cohortspark.session import scratch_path

SYMBOLS = 2048  # the closed vocabulary's size, which bounds the table of pairs at SYMBOLS * (SYMBOLS + 1) cells
ENDINGS = 64  # symbols for all other words, by their last two bytes
PRIOR = 64.0
CHUNK = 16 << 20
BUCKET_WORDS = 3_000_000  # words of all texts for each bucket of keys, which is counted as one group in a task
START = mix(np.array([0], np.uint64) + STEP)  # the history of a text's first word
SALTS = mix(np.arange(2, 4, dtype=np.uint64) * STEP)  # set word keys apart from pair keys
CHUNKS = "chunk long, own_words long, other_words long, own_texts long, other_texts long, ids array<long>, texts array<string>, flags array<boolean>"
COUNTS = "bucket int, chunk long, n int, keys binary, target binary, background binary, last_target binary, last_background binary"
TOTALS = COUNTS.replace("keys binary", "words int, different long")


def read_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the lower-cased (A-Z) words, their ending class, and where each text's words begin."""
    data = LOWER[data]
    starts, ends, bounds = spans(data, offsets, SPACE)
    last = data[ends - 1].astype(np.int64)
    before = np.where(ends - starts > 1, data[np.maximum(ends - 2, 0)], 0).astype(np.int64)
    return span_hashes(data, starts, ends), (before * 31 + last) % ENDINGS, bounds


@dataclass
class Models:
    """Log probabilities of (history, symbol) by both models; the last history is a text's start."""

    vocabulary: np.ndarray  # sorted hashes of the known words
    target: np.ndarray
    background: np.ndarray


def symbols(vocabulary: np.ndarray, hashes: np.ndarray, endings: np.ndarray) -> np.ndarray:
    if not len(vocabulary):
        return endings
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return np.where(vocabulary[at] == hashes, at + ENDINGS, endings)


def cells(vocabulary: np.ndarray, size: int, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """history * size + symbol of every word, and where each text's words begin."""
    hashes, endings, bounds = read_words(data, offsets)
    symbol = symbols(vocabulary, hashes, endings)
    history = np.r_[size, symbol[:-1]] if len(symbol) else symbol
    history[bounds[:-1][np.diff(bounds) > 0]] = size
    return history * size + symbol, bounds


def with_target(docs: DataFrame, target: Column, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        F.coalesce(target, F.lit(False)).alias("target"),
    )


def count_words(docs: DataFrame, by_target: bool = False) -> DataFrame:
    """(word, n) over all documents; with ``by_target`` also how often documents of the target have it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            flag = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for a, b in chunks(offsets, CHUNK):
                hashes, _, bounds = read_words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                word, inverse = np.unique(hashes, return_inverse=True)
                n = np.bincount(inverse, minlength=len(word))
                target = np.bincount(inverse[flag[a:b][owners(bounds)]], minlength=len(word))
                columns = [pa.array(v.astype(np.int64)) for v in (word.view(np.int64), n, target)]
                yield pa.RecordBatch.from_arrays(columns, ["word", "n", "target"])

    sums = [F.sum(name).alias(name) for name in ("n", "target")[: 1 + by_target]]
    return docs.mapInArrow(work, "word long, n long, target long").groupBy("word").agg(*sums)


def count_pairs(docs: DataFrame, vocabulary: np.ndarray, size: int) -> DataFrame:
    """(cell, target, background) over all documents; a task adds up its own before it sends them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, size * (size + 1)), np.int64)
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            flag = batch.column(2).to_numpy(zero_copy_only=False)
            for a, b in chunks(offsets, CHUNK):
                cell, bounds = cells(vocabulary, size, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                wanted = flag[a:b][owners(bounds)]
                for row, part in ((0, cell[wanted]), (1, cell[~wanted])):
                    found, n = np.unique(part, return_counts=True)
                    counts[row, found] += n
        found = np.flatnonzero(counts.any(0))
        for part in np.array_split(found, 1 + len(found) // 100_000):
            columns = [pa.array(part.astype(np.int32)), pa.array(counts[0, part]), pa.array(counts[1, part])]
            yield pa.RecordBatch.from_arrays(columns, ["cell", "target", "background"])

    rows = docs.mapInArrow(work, "cell int, target long, background long").groupBy("cell")
    return rows.agg(F.sum("target").alias("target"), F.sum("background").alias("background"))


def log_probabilities(counts: np.ndarray, prior: float) -> np.ndarray:
    """Pairs smoothed towards single symbols, those towards equality."""
    single = counts.sum(0) + 1.0
    single /= single.sum()
    return np.log((counts + prior * single) / (counts.sum(1, keepdims=True) + prior)).astype(np.float32)


def fit_models(
    docs: DataFrame,
    target: Column,
    size: int = SYMBOLS,
    prior: float = PRIOR,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Models:
    """Both models from all documents: those where ``target`` holds, and all others.

    They share one vocabulary, the most frequent words of both (ties by hash) and ``ENDINGS`` classes of endings, one order,
    two words, and one smoothing. Only the vocabulary and the table of pairs, both of a size fixed by ``size``, reach the driver.
    """
    held = with_target(docs, target, id_col, text_col)
    top = count_words(held).orderBy(F.desc("n"), "word").limit(size - ENDINGS).select("word").collect()
    vocabulary = np.sort(np.array([r.word for r in top], np.int64).view(np.uint64))
    found = count_pairs(held, vocabulary, size).toArrow()
    counts = np.zeros((2, size * (size + 1)))
    for row, name in enumerate(("target", "background")):
        counts[row, found["cell"].to_numpy()] = found[name].to_numpy()
    counts = counts.reshape(2, size + 1, size)
    return Models(vocabulary, log_probabilities(counts[0], prior), log_probabilities(counts[1], prior))


SCHEMA = "doc_id long, n_tokens long, ce_target double, ce_background double, score double"


def score_documents(docs: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row the mean loss per word under either model, in nats, and background less target: higher is more like the target.

    Null and empty texts have no words and 0 in all of them. Rows with equal or null ids are scored one by one; a null
    ``target`` counts as background in fitting. An empty table gives an empty result. Map only.
    """
    size = models.target.shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in chunks(offsets, CHUNK):
                part = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                cell, bounds = cells(models.vocabulary, size, *part)
                n = np.diff(bounds)
                losses = []
                for model in (models.target, models.background):
                    total = np.bincount(owners(bounds), -model.ravel()[cell].astype(float), len(n))
                    losses.append(total / np.maximum(n, 1))
                columns = [batch.column(0).slice(a, b - a), pa.array(n), *map(pa.array, (*losses, losses[1] - losses[0]))]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = [field.split()[0] for field in SCHEMA.split(", ")]
    return with_target(docs, F.lit(False), id_col, text_col).select("doc_id", "text").mapInArrow(work, SCHEMA)


def fields(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def cut_chunks(held: DataFrame) -> DataFrame:
    """Runs of whole rows of about ``CHUNK`` bytes, numbered, with their words and their texts that have words, of either kind.

    Saved in buckets by number: a number always means the same rows, and what comes back for a chunk is sent to its texts.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32

        def chunk(run: list[pa.RecordBatch]) -> pa.RecordBatch:
            nonlocal number
            rows = pa.Table.from_batches(run).combine_chunks()
            ids, texts, flags = (c.combine_chunks().cast(k) for c, k in zip(rows.columns, (pa.int64(), pa.string(), pa.bool_())))
            data, offsets = text_bytes(texts)
            n = np.diff(spans(data, offsets, SPACE)[2])
            flag = flags.to_numpy(zero_copy_only=False).astype(bool)
            sums = [v[f].sum() for v in (n, n > 0) for f in (flag, ~flag)]
            lists = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in (ids, texts, flags)]
            number += 1
            return pa.RecordBatch.from_arrays([*(pa.array([int(v)], pa.int64()) for v in (number - 1, *sums)), *lists], fields(CHUNKS))

        run, size = [], 0
        for batch in batches:
            _, offsets = text_bytes(batch.column(1))
            first = 0
            while first < batch.num_rows:
                last = int(np.searchsorted(offsets, offsets[first] + CHUNK - size, "right")) - 1
                if last <= first and run:
                    yield chunk(run)
                    run, size = [], 0
                    continue
                last = max(last, first + 1)
                run.append(batch.slice(first, last - first))
                size += int(offsets[last] - offsets[first])
                first = last
        if run:
            yield chunk(run)

    spark = held.sparkSession
    path = scratch_path(spark, "chunks")
    name = os.path.basename(path).replace("-", "_")
    rows = held.mapInArrow(work, CHUNKS)
    # More buckets than shuffle partitions, so that chunks spread evenly and the grouping by chunk takes over the buckets.
    rows.write.bucketBy(4 * parts(spark), "chunk").options(path=path, compression="zstd").saveAsTable(name)
    return spark.table(name)


def pack(counts: np.ndarray) -> bytes:
    """Counts in the least width that holds them, which comes first, their low bytes before their high ones, compressed; nothing
    where all are zero."""
    most = int(counts.max(initial=0))
    if not most:
        return b""
    width = next(w for w in (1, 2, 4, 8) if most < 1 << 8 * w)
    planes = counts.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()
    return bytes([width]) + pa.compress(planes, "zstd", asbytes=True)


def unpack(packed: bytes, n: int) -> np.ndarray:
    if not packed:
        return np.zeros(n, "<i8")
    width = packed[0]
    planes = np.frombuffer(pa.decompress(packed[1:], n * width, "zstd", asbytes=True), np.uint8)
    return planes.reshape(width, n).T.copy().view(f"<u{width}")[:, 0].astype("<i8")


def pack_keys(keys: np.ndarray, base: int) -> bytes:
    """Sorted keys from ``base`` on, by their gaps in the least number of bytes that holds the widest, which comes first."""
    gaps = np.diff(keys, prepend=np.uint64(base))
    width = (int(gaps.max(initial=0)).bit_length() + 7) // 8
    return bytes([width]) + gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack_keys(packed: bytes, n: int, base: int) -> np.ndarray:
    gaps = np.zeros((n, 8), np.uint8)
    gaps[:, : packed[0]] = np.frombuffer(packed, np.uint8, offset=1).reshape(n, packed[0])
    return np.cumsum(gaps.view("<u8")[:, 0], dtype=np.uint64) + np.uint64(base)


def gram_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of each word (odd) and of its pair with the word before it, or a text's start (even); where each text's words begin."""
    words, _, bounds = read_words(data, offsets)
    history = np.r_[START, words[:-1]] if len(words) else words
    history[bounds[:-1][np.diff(bounds) > 0]] = START[0]
    one = np.uint64(1)
    return mix(words ^ SALTS[0]) | one, mix(history * STEP + words) & ~one, bounds


def count_grams(cut: DataFrame, bits: int) -> DataFrame:
    """Each chunk's different keys and how often its rows of either kind have them, and how often a text ends with each of the
    words; a row for every bucket of keys, so that every chunk hears from all of them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                word, pair, bounds = gram_keys(*text_bytes(batch.column("texts")[i].values))
                if not len(word):
                    continue
                flag = batch.column("flags")[i].values.to_numpy(zero_copy_only=False).astype(bool)
                flags = flag[owners(bounds)]
                ends = bounds[1:][np.diff(bounds) > 0] - 1
                found, counts, lasts = [], [], []
                for keys in (word, pair):
                    different, inverse = np.unique(keys, return_inverse=True)
                    found.append(different)
                    counts.append([np.bincount(inverse[f], minlength=len(different)) for f in (flags, ~flags)])
                    if keys is word:
                        lasts = [np.bincount(inverse[ends[f[ends]]], minlength=len(different)) for f in (flags, ~flags)]
                order = np.argsort(np.concatenate(found))
                keys = np.concatenate(found)[order]
                target, background = (np.concatenate(v)[order] for v in zip(*counts))
                edges = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
                cuts, word_cuts = (np.r_[np.searchsorted(k, edges), len(k)] for k in (keys, found[0]))
                spans_, word_spans = (list(zip(c, c[1:])) for c in (cuts, word_cuts))
                columns = [
                    [pack_keys(keys[a:b], int(e)) for (a, b), e in zip(spans_, edges)],
                    *([pack(v[a:b]) for a, b in spans_] for v in (target, background)),
                    *([pack(v[a:b]) for a, b in word_spans] for v in lasts),
                ]
                heads = pa.array(np.arange(1 << bits, dtype=np.int32)), pa.array([batch.column("chunk")[i].as_py()] * (1 << bits), pa.int64())
                sizes = pa.array(np.diff(cuts).astype(np.int32))
                yield pa.RecordBatch.from_arrays([*heads, sizes, *(pa.array(c, pa.binary()) for c in columns)], fields(COUNTS))

    return cut.select("chunk", "texts", "flags").mapInArrow(work, COUNTS)


def total_grams(sent: DataFrame, bits: int) -> DataFrame:
    """Every row of ``sent`` with the counts over all chunks in place of the chunk's own, in the order of the chunk's keys, and the
    number of different words of the bucket in place of the keys."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, shard in runs(batches, "bucket"):
            each = shard.column("n").to_pylist()
            keys = [unpack_keys(x.as_py(), n, bucket << 64 - bits) for x, n in zip(shard.column("keys"), each)]
            bounds = np.cumsum([0, *each])
            words = [k & np.uint64(1) == 1 for k in keys]
            word_bounds = np.cumsum([0, *map(np.count_nonzero, words)])
            every, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            word_inverse = inverse[np.concatenate(words)]
            del keys
            columns = []
            for name in fields(COUNTS)[4:]:
                at, ends = (word_inverse, word_bounds) if name.startswith("last") else (inverse, bounds)
                sent_ = np.concatenate([unpack(x.as_py(), n) for x, n in zip(shard.column(name), np.diff(ends).tolist())])
                sums = np.zeros(len(every), "<i8")
                np.add.at(sums, at, sent_)
                sums = sums[at]
                columns.append(pa.array([pack(sums[a:b]) for a, b in zip(ends, ends[1:])], pa.binary()))
            different = np.count_nonzero(every & np.uint64(1))
            heads = shard.select(["bucket", "chunk", "n"]).combine_chunks().columns
            heads = [c.combine_chunks() for c in heads]
            lasts = pa.array(np.diff(word_bounds).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*heads, lasts, pa.array([different] * len(each), pa.int64()), *columns], fields(TOTALS))

    ordered = sent.repartition(parts(sent.sparkSession), "bucket").sortWithinPartitions("bucket")
    return ordered.mapInArrow(work, TOTALS)


def score_corpus(
    docs: DataFrame,
    target: Column,
    prior: float = PRIOR,
    id_col: str = "doc_id",
    text_col: str = "text",
    buckets: int | None = None,
) -> DataFrame:
    """Columns as ``score_documents``, by models of all words and pairs that occur: those of the rows where ``target`` holds,
    and those of all others.

    A pair's probability is its count smoothed by ``prior`` towards the word's, and that towards equality over the words of both
    models and one unknown word. Each chunk of rows sends its different words and pairs once, as 63-bit hashes in buckets, gets
    their counts over all documents back and scores its rows, so what is moved grows with the text, and a pair however frequent
    counts once per chunk. A word is the history of a pair as often as it occurs without ending a text. Only the numbers of words
    and texts reach the driver; the number of buckets follows from them. Very long texts are chunks of their own; equal rows, rows
    of equal or null ids and ties are scored one by one, null and empty texts get 0, an empty table gives no rows, and other
    columns don't matter.
    """
    spark = docs.sparkSession
    cut = cut_chunks(with_target(docs, target, id_col, text_col))
    row = cut.agg(*[F.sum(name) for name in fields(CHUNKS)[1:5]]).head()
    *sizes, own_texts, other_texts = (int(v or 0) for v in row)
    bits = (max(2, buckets or max(4 * parts(spark), sum(sizes) // BUCKET_WORDS + 1)) - 1).bit_length()

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = right.sort_by("bucket")
        each, words = (rows.column(name).to_pylist() for name in ("n", "words"))
        known = sum(rows.column("different").to_pylist())
        totals = {}
        for name in fields(COUNTS)[4:]:
            packed = zip(rows.column(name), words if name.startswith("last") else each)
            totals[name] = np.concatenate([unpack(x.as_py(), n) for x, n in packed] or [np.zeros(0, "<i8")])
        out = []
        for i in range(left.num_rows):
            ids, texts = (left.column(name).combine_chunks()[i].values for name in ("ids", "texts"))
            word, pair, bounds = gram_keys(*text_bytes(texts))
            keys, at = np.unique(word, return_inverse=True)
            odd = np.unique(pair)
            place = np.concatenate([keys, odd]).argsort().argsort()
            pair_at = place[len(keys) :][np.searchsorted(odd, pair)]
            word_at = place[: len(keys)][at]
            n = np.diff(bounds)
            starts = bounds[:-1][n > 0]
            losses = []
            for name, size, begun in (("target", sizes[0], own_texts), ("background", sizes[1], other_texts)):
                single = totals[name][word_at]
                history = np.r_[0, (single - totals[f"last_{name}"][at])[:-1]] if len(at) else single
                history[starts] = begun
                base = size + known + 1.0
                loss = -np.log((totals[name][pair_at] + prior * (single + 1.0) / base) / (history + prior))
                losses.append(np.bincount(owners(bounds), loss, len(n)) / np.maximum(n, 1))
            out.append(pa.table([ids, pa.array(n), *map(pa.array, (*losses, losses[1] - losses[0]))], fields(SCHEMA)))
        return pa.concat_tables(out)

    texts = cut.select("chunk", "ids", "texts").groupBy("chunk")
    return texts.cogroup(total_grams(count_grams(cut, bits), bits).groupBy("chunk")).applyInArrow(work, SCHEMA)


def op4_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_corpus(table(spark, sf_dir, "documents"), F.col("source") == "src1")


QUERIES = {"op4_scoring": op4_scoring}
