"""Line deduplication within an edit bound by a deletion-neighbourhood join (operator 5)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortspark.llm.arrays import INVERSE, LINE, LOWER, SPACE, chunks, mix, owners, pack, powers, range_hashes, span_hashes, spans, text_bytes
from cohortspark.llm.frames import free_names, saved, table, texts

EDIT_FROM = 10  # lines of at least so many words may differ by one word; shorter ones must be equal
CHUNK = 4 << 20
KEY_BITS = 48  # of a half key; four keys are stored in three words
SIEVE_BITS = 1 << 26
TAG = np.uint64(0xD6E8FEB86659FD93)


def read_lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the lines with a word: text, number in the text, first and last + 1 word, hash; and all words' hashes. Lines are
    compared as sequences of lower-cased (A-Z) words."""
    data = LOWER[data]
    starts, ends, _ = spans(data, offsets, SPACE)
    words = span_hashes(data, starts, ends)
    first, last, bounds = spans(data, offsets, LINE)
    low, high = np.searchsorted(starts, first), np.searchsorted(starts, last)
    text = owners(bounds)
    breaks = np.r_[0, np.cumsum(data == 10)]
    number = breaks[first] - breaks[offsets[:-1]][text]
    keep = high > low
    return text[keep], number[keep], low[keep], high[keep], range_hashes(words, low[keep], high[keep]), words


def half_keys(words: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[np.ndarray]:
    """Two lines within one edit share one: of lengths n and n, or n and n + 1, either the first n // 2 words or the last
    n - n // 2 are equal. Each line has the keys for n and for n - 1 words."""
    out = []
    for less in (0, 1):
        n = high - low - less
        tag = n.astype(np.uint64) * TAG
        out.append(mix(range_hashes(words, low, low + n // 2) + tag))
        out.append(mix(range_hashes(words, high - (n - n // 2), high) ^ tag))
    return out


def variants(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All sequences with one word left out: keyed with the place and length, which lines that differ in that word share, and
    as lines of their own, which a line without that word shares."""
    n = len(words)
    up, _ = powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(words * up[:-1], out=total[1:])
    left = mix(total[:-1] + (total[-1] - total[1:]) * INVERSE + np.uint64(n - 1))  # the range hash of the n - 1 words
    return mix(left + (np.arange(n, dtype=np.uint64) + np.uint64(1)) * TAG), left


def packed(keys: list[np.ndarray]) -> list[np.ndarray]:
    """The four half keys cut to 48 bits, the last one in the upper bits of the other three. Keys only find lines that may have a
    partner: a false equality lets a line pass on, to be compared as any other, and loses none."""
    low, room = [k >> np.uint64(64 - KEY_BITS) for k in keys], np.uint64(64 - KEY_BITS)
    part = np.uint64((1 << 64 - KEY_BITS) - 1)
    return [low[i] | (low[3] >> np.uint64(i) * room & part) << np.uint64(KEY_BITS) for i in range(3)]


def unpacked() -> Column:
    """The array of the four half keys in k0, k1 and k2."""
    words = [F.col(f"k{i}") for i in range(3)]
    parts = [F.shiftleft(F.shiftrightunsigned(w, KEY_BITS), i * (64 - KEY_BITS)) for i, w in enumerate(words)]
    low = [w.bitwiseAND(F.lit((1 << KEY_BITS) - 1)) for w in words]
    return F.array(*low, parts[0].bitwiseOR(parts[1]).bitwiseOR(parts[2]))


LINES = "hash long, doc_id long, line int, k0 long, k1 long, k2 long"


def line_table(docs: DataFrame) -> DataFrame:
    """(hash, doc_id, line, k0..k2): a row per line with a word, and its half keys if it may differ by an edit."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            ids = batch.column(0).to_numpy()
            data, offsets = text_bytes(batch.column(1))
            for a, b in chunks(offsets, CHUNK):
                found = read_lines(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                text, number, low, high, hashes, words = found
                short = pa.array(high - low < EDIT_FROM)
                keys = [pa.array(k.view(np.int64)) for k in packed(half_keys(words, low, high))]
                nothing = pa.scalar(None, pa.int64())
                columns = [pa.array(hashes.view(np.int64)), pa.array(ids[a:b][text]), pa.array(number, pa.int32())]
                columns += [pa.compute.if_else(short, nothing, k) for k in keys]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = [field.split()[0] for field in LINES.split(", ")]
    return docs.mapInArrow(work, LINES)


def sieve(wanted: DataFrame, most_bits: int = SIEVE_BITS) -> np.ndarray:
    """A bit per slot of the wanted hashes, for about one in 16 other lines to pass; at most ``most_bits``, beyond which more
    lines pass. It only spares rows: who passes is joined with the wanted lines afterwards."""
    bits = min(most_bits, 1 << max(10, int(16 * wanted.count()).bit_length()))
    slot = F.col("hash").bitwiseAND(F.lit(bits - 1))
    words = wanted.select(F.shiftright(slot, 5).alias("word"), F.expr("shiftleft(1L, CAST(hash & 31 AS INT))").alias("bit"))
    rows = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits // 32, np.uint32)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy().astype(np.uint32)
    return np.unpackbits(out.view(np.uint8), bitorder="little")


def neighbourhood(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, kind, hash, doc_id, line, words) for every variant of the wanted lines (hash, doc_id, line)."""
    wanted = saved(wanted)
    slots = np.packbits(sieve(wanted))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = np.unpackbits(slots).astype(bool)
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            ids = batch.column(0).to_numpy()
            data, offsets = text_bytes(batch.column(1))
            for a, b in chunks(offsets, CHUNK):
                found = read_lines(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                text, number, low, high, hashes, words = found
                chosen = np.flatnonzero(passes[hashes & np.uint64(len(passes) - 1)] & (high - low >= EDIT_FROM))
                chosen = chosen[np.lexsort((number[chosen], ids[a:b][text[chosen]], hashes[chosen]))]
                chosen = chosen[np.r_[True, np.diff(hashes[chosen]) > 0]] if len(chosen) else chosen  # the earliest copy
                columns = [pa.array(hashes[chosen].view(np.int64)), pa.array(ids[a:b][text[chosen]])]
                columns += [pa.array(number[chosen], pa.int32()), pack([words[low[i] : high[i]] for i in chosen])]
                yield pa.RecordBatch.from_arrays(columns, ["hash", "doc_id", "line", "words"])

    def vary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                lists = [np.frombuffer(w, np.uint64) for w in part.column(3).to_pylist()]
                n = np.array([len(w) for w in lists])
                hashes = part.column(0).to_numpy().view(np.uint64)
                keys = [k for i, one in enumerate(lists) for k in (*variants(one), hashes[i : i + 1])]
                line = pa.array(np.repeat(np.arange(len(n)), 2 * n + 1))
                kind = np.concatenate([np.repeat([0, 1, 2], [m, m, 1]) for m in n.tolist()])
                own = np.full(len(kind), -1)
                own[kind == 2] = np.arange(len(n))
                columns = [pa.array(np.concatenate(keys).view(np.int64)), pa.array(kind.astype(np.int8))]
                columns += [part.column(i).take(line) for i in range(3)]
                columns.append(part.column(3).take(pa.array(own, mask=own < 0)))
                yield pa.RecordBatch.from_arrays(columns, ["key", "kind", "hash", "doc_id", "line", "words"])

    found = docs.mapInArrow(find, "hash long, doc_id long, line int, words binary")
    lines = found.join(wanted, ["hash", "doc_id", "line"], "left_semi").dropDuplicates(["hash"])
    return lines.mapInArrow(vary, "key long, kind byte, hash long, doc_id long, line int, words binary")


def within_one(a: bytes, b: bytes) -> bool:
    """Whether one word's change, insertion or removal turns a into b (sequences of 64-bit word hashes)."""
    x, y = sorted((np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")), key=len)
    if len(y) - len(x) > 1:
        return False
    differ = np.flatnonzero(x != y[: len(x)])
    first = int(differ[0]) if len(differ) else len(x)
    same = len(x) == len(y)
    return bool(np.array_equal(x[first + same :], y[first + 1 :]))


def near_pairs(rows: DataFrame) -> DataFrame:
    """(hash, other_hash, other_doc_id, other_line): lines with an earlier line within one edit.

    Lines that share a ``changed`` key differ in one and the same word, so each is paired with the earliest of them only, and
    no pair with an earlier line is lost. A removal pairs a line with the one line that its variant is.
    """
    place = F.struct("doc_id", "line", "hash")
    changed = rows.where("kind = 0").select("key", place.alias("me"))
    first = changed.groupBy("key").agg(F.min("me").alias("other"), F.count("*").alias("n")).where("n > 1")
    pairs = changed.join(first, "key").where("me <> other").select("me", "other")
    shorter = rows.where("kind = 2").select("key", place.alias("other"))
    longer = rows.where("kind = 1").select("key", place.alias("me"))
    drops = longer.join(shorter, "key").select(F.greatest("me", "other").alias("me"), F.least("me", "other").alias("other"))
    every = pairs.union(drops).where("me.hash <> other.hash").groupBy("me").agg(F.min("other").alias("other"))
    words = rows.where("kind = 2").select("hash", "words")
    mine = words.select(F.col("hash").alias("_a"), F.col("words").alias("a"))
    others = words.select(F.col("hash").alias("_b"), F.col("words").alias("b"))
    both = every.join(mine, F.col("me.hash") == F.col("_a")).join(others, F.col("other.hash") == F.col("_b"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())
            yield batch.filter(pa.array([within_one(a, b) for a, b in pairs], pa.bool_())).select(kept)

    kept = ["hash", "kept_doc_id", "kept_line"]
    both = both.select(
        F.col("me.hash").alias("hash"), F.col("other.doc_id").alias("kept_doc_id"), F.col("other.line").alias("kept_line"), "a", "b"
    )
    return both.mapInArrow(verify, "hash long, kept_doc_id long, kept_line int")


def duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, line, hash, kept_doc_id, kept_line, edits): every line that an earlier one makes superfluous.

    Earlier is a smaller doc_id, or the same and a smaller line number (0 for the first). Lines of at least ``EDIT_FROM`` words
    count as duplicates if they are equal or one word apart (changed, added or missing), shorter ones if they are equal; case of
    A-Z and white space don't count. Lines without a word, null texts and rows with a null id are left alone. Rows that
    share an id have the same places: of equal lines at one place none is earlier. An empty table gives an empty result.
    """
    held = texts(docs, id_col, text_col)
    lines = saved(line_table(held))
    place = F.struct("doc_id", "line")
    keys = [F.first(f"k{i}").alias(f"k{i}") for i in range(3)]
    distinct = saved(lines.groupBy("hash").agg(F.min(place).alias("at"), *keys))
    halves = distinct.select("hash", F.explode(unpacked()).alias("key")).where("key IS NOT NULL")
    shared = halves.groupBy("key").agg(F.min("hash").alias("a"), F.max("hash").alias("b")).where("a <> b").select("key")
    wanted = halves.join(shared, "key", "left_semi").select("hash").distinct()
    wanted = distinct.join(wanted, "hash").select("hash", "at.doc_id", "at.line")
    near = near_pairs(saved(neighbourhood(held, wanted)))
    exact = lines.join(distinct.select("hash", "at"), "hash").join(near, "hash", "left")
    exact = exact.where((place != F.col("at")) | F.col("kept_line").isNotNull())
    return exact.select(
        "doc_id",
        "line",
        "hash",
        F.coalesce("kept_doc_id", "at.doc_id").alias("kept_doc_id"),
        F.coalesce("kept_line", "at.line").alias("kept_line"),
        F.when(F.col("kept_line").isNull(), 0).otherwise(1).alias("edits"),
    )


def drop_duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, all columns as they are, without their superfluous lines; rows that lose every line with a word go.

    Rows with a null id or text and rows without any word stay as they are; extra columns may have any name and type.
    """
    key, held = free_names(docs, "line_id lines")
    gone = duplicate_lines(docs, id_col, text_col).groupBy(F.col("doc_id").alias(key))
    gone = gone.agg(F.collect_list(F.struct("line", "hash")).alias(held))
    both = docs.join(gone, F.col(id_col).cast("long") == F.col(key), "left").drop(key)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, lists = batch.column(at), batch.column(batch.num_columns - 1)
            data, offsets = text_bytes(column)
            kept = column.to_pylist()
            for a, b in chunks(offsets, CHUNK):
                text, number, _, _, hashes, _ = read_lines(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                bounds = np.searchsorted(text, np.arange(b - a + 1))
                for i in range(a, b):
                    asked = {(w["line"], w["hash"]) for w in lists[i].as_py() or ()}
                    part = slice(*bounds[i - a : i - a + 2])
                    there = list(zip(number[part].tolist(), hashes[part].view(np.int64).tolist()))
                    out = {n for n, h in there if (n, h) in asked}
                    if out and len(out) == len(there):
                        kept[i] = False
                    elif out:
                        kept[i] = "\n".join(line for n, line in enumerate(kept[i].split("\n")) if n not in out)
            keep = pa.array([k is not False for k in kept], pa.bool_())
            new = pa.array([None if k is False else k for k in kept], column.type)
            yield batch.set_column(at, batch.schema.field(at), new).select(list(range(batch.num_columns - 1))).filter(keep)

    at, numbered = docs.columns.index(text_col), [f"c{i}" for i in range(len(both.columns))]  # names may hold dots
    schema = T.StructType([T.StructField(name, field.dataType) for name, field in zip(numbered, docs.schema)])
    return both.toDF(*numbered).mapInArrow(work, schema).toDF(*docs.columns)


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_lines(table(spark, sf_dir, "documents")).drop("hash")


QUERIES = {"op5_lines": op5_lines}
