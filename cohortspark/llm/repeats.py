"""Repeated passages across documents by a compacted graph of word k-mers (operator 10)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.llm.arrays import SPACE, chunks, covered, inside_texts, mix, ngrams, owners, span_hashes, spans, text_bytes
from cohortspark.llm.frames import parts, runs, saved, table, texts

K = 13
PART = 4  # words of the part that decides an edge's bucket
BUCKETS = 1024
CHUNK = 8 << 20
LONGEST = 255
SENT_KEYS = 1 << 20  # ids or window hashes that may be sent to every task, 8 MB
EDGES = "bucket int, known boolean, docs binary, versions binary, starts binary, sizes binary, low binary, high binary"
PATHS = "doc_id long, version long, start int, n int, source_id long, source_version long, source_start int"
NAMES = [field.split()[0] for field in PATHS.split(", ")]
KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
ROW = ["doc_id", "version"]
SPAN = ["source_id", "source_version", "source_start", "n"]
WINDOWS = "doc_id long, version long, start int, key long, words binary"


def versions(held: DataFrame) -> DataFrame:
    """With ``version``, which tells apart the texts of one id: 0 for a text that has its id to itself, else its hash.

    Ids with several texts are found by one grouping, combined in the map tasks. Up to ``SENT_KEYS`` of them are broadcast;
    more are joined.
    """
    version = F.xxhash64("text")
    texts_of = held.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(version).alias("least"), F.max(version).alias("most"))
    shared = saved(texts_of.where("least <> most").select("doc_id", F.lit(True).alias("shared")))
    count = shared.count()
    if not count:
        return held.withColumn("version", F.lit(0).cast("long"))
    both = held.join(F.broadcast(shared) if count <= SENT_KEYS else shared, "doc_id", "left")
    return both.select("doc_id", "text", F.when(F.col("shared"), version).otherwise(0).alias("version"))


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` consecutive values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def pieces(breaks: np.ndarray, longest: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of runs; breaks[i]: a run begins at i. Runs over ``longest`` are cut."""
    first = np.flatnonzero(breaks)
    size = np.diff(np.r_[first, len(breaks)])
    if longest and len(size) and size.max() > longest:
        count = -(-size // longest)
        owner = np.repeat(np.arange(len(size)), count)
        at = (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)) * longest
        first, size = first[owner] + at, np.minimum(longest, size[owner] - at)
    return first, size


def word_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Equal only for equal words: of the words of one hash, those with other bytes than the first have a number of their own."""
    _, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    size, other = ends - starts, starts[first][number]
    same = size == size[first][number]
    order = np.argsort(size, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
        part = part[same[part] & (other[part] != starts[part])]
        for j in range(size[part[0]] if len(part) else 0):
            same[part] &= data[starts[part] + j] == data[other[part] + j]
    return np.where(same, number, -1 - np.arange(len(number)))


def edge_rows(ids: np.ndarray, versions: np.ndarray, data: np.ndarray, offsets: np.ndarray, k: int, buckets: int) -> Iterator[tuple]:
    """Edges of these texts, whose ids rise, as runs by bucket.

    An edge is a window of k words. Its bucket follows from its smallest ``PART`` words' hash, so neighbours mostly share one
    and travel as one run: document, first place, and a 48-bit hash of each edge. An edge that a smaller document of this chunk
    has as well, word by word, needs no more search: it is sent as ``known``, in runs without hashes.
    """
    starts, ends, bounds = spans(data, offsets, SPACE)
    words = span_hashes(data, starts, ends)
    at = np.flatnonzero(inside_texts(bounds, k)) if len(words) >= k else np.zeros(0, int)
    if not len(at):
        return
    edge = ngrams(words, k)[at]
    least = smallest(ngrams(words, min(PART, k)), k - min(PART, k) + 1)[at]
    doc = owners(bounds)[at]
    order = np.argsort(edge, kind="stable")
    group = np.flatnonzero(np.r_[True, edge[order][1:] != edge[order][:-1]])
    known = np.zeros(len(at), bool)
    source = np.empty(len(at), np.int64)
    source[order] = np.repeat(order[group], np.diff(np.r_[group, len(at)]))
    hit = np.flatnonzero(ids[doc] > ids[doc[source]])
    number, same = word_numbers(data, starts, ends, words), np.ones(len(hit), bool)
    for j in range(k):
        same &= number[at[hit] + j] == number[at[source[hit]] + j]
    known[hit[same]] = True
    place = at - bounds[doc]
    breaks = np.r_[True, (np.diff(at) > 1) | (np.diff(doc) > 0) | (np.diff(known.astype(np.int8)) != 0)]
    for flag in (True, False):
        chosen = np.flatnonzero(known == flag)
        if not len(chosen):
            continue
        cut = breaks[chosen].copy()
        if not flag:
            cut |= np.r_[True, np.diff(chosen) > 1] | np.r_[True, least[chosen][1:] != least[chosen][:-1]]
        first, size = pieces(cut, None if flag else LONGEST)
        head = chosen[first]
        bucket = (np.arange(len(head)) >> 12) % buckets if flag else (mix(least[head]) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.unique(bucket))
        for part in np.split(order, edges[1:]):
            n = size[part]
            index = chosen[np.repeat(first[part], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            low = high = b""
            if not flag:
                low, high = (edge[index] & np.uint64(0xFFFFFFFF)).astype("<u4"), (edge[index] >> np.uint64(48)).astype("<u2")
                low, high = low.tobytes(), high.tobytes()
            document = np.diff(ids[doc[head[part]]], prepend=0).astype("<i8").tobytes()
            version = versions[doc[head[part]]].astype("<i8").tobytes()
            yield int(bucket[part[0]]), flag, document, version, place[head[part]].astype("<i4").tobytes(), n.astype("<i4" if flag else "u1").tobytes(), low, high


def shared_paths(shard: pa.Table) -> tuple[np.ndarray, ...]:
    """Of one bucket: runs of edges that a document with a smaller id has as well, and the place in the smallest one.

    Edges that follow each other both in the document and in the smallest document are one path.
    """
    known = shard.column("known").to_pylist()
    rows = [[c.as_py() for c in shard.column(name)] for name in ("docs", "versions", "starts", "sizes", "low", "high")]
    out = [[] for _ in NAMES]
    parts_ = [[] for _ in rows]
    for flag, docs, versions_, starts, sizes, low, high in zip(known, *rows):
        doc, version = np.cumsum(np.frombuffer(docs, "<i8")), np.frombuffer(versions_, "<i8")
        start, size = np.frombuffer(starts, "<i4"), np.frombuffer(sizes, "<i4" if flag else "u1")
        if flag:
            none = np.full(len(doc), -1)
            for target, value in zip(out, (doc, version, start, size, none, none, none)):
                target.append(value)
        else:
            values = (doc, version, start, size, np.frombuffer(low, "<u4"), np.frombuffer(high, "<u2"))
            for target, value in zip(parts_, values):
                target.append(value)
    if parts_[0]:
        doc, version, start, size, low, high = (np.concatenate(p) for p in parts_)
        size = size.astype(np.int64)
        edge = low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32))
        run = np.repeat(np.arange(len(doc)), size)
        place = start[run] + np.arange(len(run)) - np.repeat(np.cumsum(size) - size, size)
        owner = doc[run]
        order = np.argsort(edge, kind="stable")
        group = np.flatnonzero(np.r_[True, edge[order][1:] != edge[order][:-1]])
        many = np.diff(np.r_[group, len(order)])
        first = np.repeat(np.minimum.reduceat(owner[order], group), many)
        own = np.where(owner[order] == first, place[order], np.iinfo(np.int32).max)
        source, source_at = np.empty(len(run), np.int64), np.empty(len(run), np.int64)
        least = np.repeat(np.minimum.reduceat(own, group), many)
        source[order], source_at[order] = first, least
        source_version = np.zeros(len(run), np.int64)
        if version.any():
            there = np.where(own == least, version[run[order]], np.iinfo(np.int64).max)
            source_version[order] = np.repeat(np.minimum.reduceat(there, group), many)
        hit = np.flatnonzero(owner > source)
        if len(hit):
            gap = (np.diff(hit) > 1) | (np.diff(run[hit]) > 0) | (np.diff(source[hit]) != 0) | (np.diff(source_at[hit]) != 1)
            gap |= np.diff(source_version[hit]) != 0
            at, n = pieces(np.r_[True, gap])
            head = hit[at]
            for target, value in zip(out, (owner[head], version[run[head]], place[head], n, source[head], source_version[head], source_at[head])):
                target.append(value)
    return tuple(np.concatenate(v) if v else np.zeros(0, np.int64) for v in out)


def repeated_paths(held: DataFrame, k: int = K, buckets: int | None = None) -> DataFrame:
    """PATHS of (doc_id, text, version): n edges from word ``start`` on that a smaller document has as well.

    ``source_*``: the first place in the smallest such document, -1 where a chunk's own documents decided. Only hashes are
    shuffled, about seven bytes a word; a bucket holds 1/buckets of the edges, and a passage however frequent is in it once
    per chunk of texts. Rows with a null id are not looked at.
    """
    spark = held.sparkSession
    buckets = buckets or max(BUCKETS, 8 * parts(spark))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid()).sort_by("doc_id")
            ids, version = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            data, offsets = text_bytes(batch.column(1))
            for a, b in chunks(offsets, CHUNK):
                rows = list(edge_rows(ids[a:b], version[a:b], data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], k, buckets))
                if rows:
                    kinds = [pa.int32(), pa.bool_()] + [pa.binary()] * 6
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], edges)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, shard in runs(batches, "bucket"):
            values = shared_paths(shard)
            if len(values[0]):
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, KINDS)], NAMES)

    edges = [field.split()[0] for field in EDGES.split(", ")]
    sent = held.select("doc_id", "text", "version").mapInArrow(cut, EDGES)
    return sent.repartition(parts(spark), "bucket").sortWithinPartitions("bucket").mapInArrow(find, PATHS)


def arrays(name: str, *columns: str) -> list:
    return [F.collect_list(F.struct(*columns)).alias(name)]


def whole_spans(paths: DataFrame) -> DataFrame:
    """Paths of one document and one source whose edges follow each other in both, joined to one: PATHS."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, version, source, other, held in zip(*(batch.column(i).to_pylist() for i in range(4)), batch.column(4)):
                start, n, at = (held.values.field(i).to_numpy().astype(np.int64) for i in range(3))
                shift = start - at
                order = np.lexsort((start, shift))
                start, n, at, shift = start[order], n[order], at[order], shift[order]
                first = np.flatnonzero(np.r_[True, (np.diff(shift) != 0) | (np.diff(start) > n[:-1])])
                end = np.maximum.reduceat(start + n, first)
                alike = ([value] * len(first) for value in (doc, version, source, other))
                columns = [next(alike), next(alike), start[first], end - start[first], next(alike), next(alike), at[first]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, KINDS)], NAMES)

    grouped = paths.groupBy(*ROW, "source_id", "source_version").agg(*arrays("held", "start", "n", "source_start"))
    return grouped.mapInArrow(work, PATHS)


def slices(held: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(source_id, source_version, source_start, n, words) of each wanted span, once however many rows have its text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, version, text, places in zip(*(c.to_pylist() for c in batch.columns)):
                words = (text or "").encode().split()
                rows = [(doc, version, p["source_start"], p["n"], b" ".join(words[p["source_start"] : p["source_start"] + p["n"] + k - 1])) for p in places]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], [*SPAN, "words"])

    places = wanted.groupBy(F.col("source_id").alias("doc_id"), F.col("source_version").alias("version"))
    both = held.join(places.agg(*arrays("places", "source_start", "n")), ROW).select(*ROW, "text", "places")
    found = both.mapInArrow(work, "source_id long, source_version long, source_start int, n int, words binary")
    return found.groupBy(*SPAN).agg(F.first("words").alias("words"))


def compared(held: DataFrame, spans_: DataFrame, k: int) -> DataFrame:
    """(doc_id, version, start, n, same) of each span: whether the text has the words of its source's text there."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, version, text, places in zip(*(c.to_pylist() for c in batch.columns)):
                words = (text or "").encode().split()
                rows = [(doc, version, p["start"], p["n"], b" ".join(words[p["start"] : p["start"] + p["n"] + k - 1]) == p["words"]) for p in places]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], [*ROW, "start", "n", "same"])

    source = slices(held, spans_.select(*SPAN).distinct(), k)
    asked = spans_.join(source, SPAN).groupBy(*ROW).agg(*arrays("places", "start", "n", "words"))
    both = held.join(asked, ROW).select(*ROW, "text", "places")
    both = both.mapInArrow(work, "doc_id long, version long, start int, n int, same boolean")
    return both.groupBy(*ROW, "start", "n").agg(F.max("same").alias("same"))


def chosen_windows(frame: DataFrame, k: int, keys: np.ndarray | None) -> DataFrame:
    """WINDOWS of (doc_id, version, text, places): those that begin at a place, if there are places, and have one of the keys, if given."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, version = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data, offsets = text_bytes(batch.column(2))
            places = batch.column(3)
            for a, b in chunks(offsets, CHUNK):
                part = data[offsets[a] : offsets[b]]
                starts, ends, bounds = spans(part, offsets[a : b + 1] - offsets[a], SPACE)
                inside = inside_texts(bounds, k) if len(starts) >= k else np.zeros(0, bool)
                wanted = np.ones(len(inside), bool)
                for i in range(a, b):
                    if places[i].is_valid:
                        own = wanted[bounds[i - a] : bounds[i - a + 1]]
                        own[:] = False
                        for p in places[i].as_py():
                            own[p["start"] : p["start"] + p["n"]] = True
                at = np.flatnonzero(inside & wanted)
                if not len(at):
                    continue
                edge = ngrams(span_hashes(part, starts, ends), k)[at].astype(np.uint64).view(np.int64)
                if keys is not None:
                    there = np.isin(edge, keys)
                    at, edge = at[there], edge[there]
                doc = owners(bounds)[at]
                for c in range(0, len(at), 10_000):
                    some = slice(c, c + 10_000)
                    words = [b" ".join(part[starts[i] : ends[i + k - 1]].tobytes().split()) for i in at[some].tolist()]
                    columns = [ids[a:b][doc[some]], version[a:b][doc[some]], at[some] - bounds[doc[some]], edge[some], words]
                    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c_, t) for c_, t in zip(columns, kinds)], names)

    names = [field.split()[0] for field in WINDOWS.split(", ")]
    return frame.select(*ROW, "text", "places").mapInArrow(work, WINDOWS)


def searched_words(held: DataFrame, failed: DataFrame, k: int) -> DataFrame:
    """(doc_id, version, start, n) of the windows of spans that were not the same, found by their words instead of hashes.

    Only windows with the hash of one of these are looked at, so a few false equalities cost one more pass over the texts
    and no more. The hashes are sent to the tasks up to ``SENT_KEYS``; with more of them all windows meet by their words.
    """
    asked = failed.groupBy(*ROW).agg(*arrays("places", "start", "n"))
    own = saved(chosen_windows(held.join(asked, ROW), k, None))
    keys = saved(own.select("key").distinct())
    sent = None
    if keys.count() <= SENT_KEYS:
        sent = np.sort(np.array([r.key for r in keys.collect()], np.int64))
    nowhere = F.lit(None).cast("array<struct<start:int,n:int>>").alias("places")
    every = chosen_windows(held.select(*ROW, "text", nowhere), k, sent)
    least = every.join(own.select("words").distinct(), "words", "left_semi").groupBy("words").agg(F.min("doc_id").alias("least"))
    return own.join(least, "words").where("least < doc_id").select(*ROW, "start", F.lit(1).alias("n"))


def verified_paths(held: DataFrame, k: int = K, buckets: int | None = None) -> DataFrame:
    """(doc_id, version, start, n) of (doc_id, text, version), ids not null: n windows from word ``start`` on whose words a smaller document has as well.

    Hashes only find candidates. Every span's words are compared with its source's; what a chunk decided was compared there.
    Windows of spans that differ are searched once more by their words, as another document may have them.
    """
    found = saved(repeated_paths(held, k, buckets))
    judged = saved(compared(held, whole_spans(found.where("source_start >= 0")), k))
    sure = found.where("source_start < 0").select(*ROW, "start", "n").union(judged.where("same").drop("same"))
    failed = judged.where("NOT same")
    return sure if failed.isEmpty() else sure.union(searched_words(held, failed, k))


SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def remove_repeats(
    docs: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None
) -> DataFrame:
    """Per row: words, words inside a window of k words that starts in a document with a smaller id too, and the words left.

    Windows are judged on the input. Null and empty texts have no words; texts of fewer than k words lose none; rows with a
    null id lose none and take none. Rows that share an id are judged each by its own words and take nothing from one another;
    repeated rows lose the same words. Texts of any length are searched whole. An empty table gives an empty result.
    """
    held = versions(texts(docs, id_col, text_col))
    found = verified_paths(held.where("doc_id IS NOT NULL"), k, buckets).groupBy(*ROW)
    found = found.agg(F.collect_list("start").alias("starts"), F.collect_list("n").alias("sizes"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, starts, sizes in zip(*(batch.column(i) for i in range(4))):
                words = (text.as_py() or "").encode().split()
                total, kept = len(words), words
                if starts.is_valid and total:
                    first, n = starts.values.to_numpy(), sizes.values.to_numpy()
                    index = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    marked = np.zeros(total, bool)
                    marked[index[index < total]] = True
                    gone = covered(marked, k, total)
                    kept = [w for w, out in zip(words, gone.tolist()) if not out]
                line = b" ".join(kept)
                rows.append((doc_id.as_py(), total, total - len(kept), hashlib.sha256(line).hexdigest(), line.decode()))
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds], names)

    names = [field.split()[0] for field in SCHEMA.split(", ")]
    both = held.join(found, ROW, "left").select("doc_id", "text", "starts", "sizes")
    return both.mapInArrow(work, SCHEMA)


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


QUERIES = {"op10_repeats": op10_repeats}
