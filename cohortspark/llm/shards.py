"""Shards of nearly equal bytes by histogram sort (operator 11)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortspark.functions.scalars import quote
from cohortspark.llm.frames import free_names, table
from cohortspark.session import scratch_path

SHARDS = 16
TOLERANCE = 0.01  # share of a shard's bytes; a group of equal texts up to it isn't cut
PROBES = 64  # candidate boundaries for each splitter and round
PIECE_BYTES = 128 << 20  # about the most that one sorting task group holds
KEY_BITS, CELL_BITS = 60, 10
LEAST, MOST = -(1 << 63), (1 << 63) - 1


@dataclass(frozen=True)
class Place:
    """The value of a key that a goal falls on, with what lies below it and on it."""

    value: int
    below: int
    bytes: int
    rows: int


def row_size(text_col: str = "text") -> Column:
    """UTF-8 bytes of the text plus 1; a null text has none."""
    return F.coalesce(F.octet_length(F.col(quote(text_col)).cast("string")), F.lit(0)).cast("long") + 1


def text_key(text_col: str = "text") -> Column:
    """Sixty bits of the text's MD5, so that equal texts are neighbours; null counts as empty."""
    digest = F.md5(F.coalesce(F.col(quote(text_col)).cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def tally(edges: list[int]):
    """A map task's bytes, rows, least and largest key between consecutive edges, one row for each part that it meets."""
    starts = np.array(edges, np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = np.zeros(len(starts), np.int64)
        rows = np.zeros(len(starts), np.int64)
        low = np.full(len(starts), MOST, np.int64)
        high = np.full(len(starts), LEAST, np.int64)
        for batch in batches:
            keys, sizes = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            part = np.searchsorted(starts, keys, "right") - 1
            seen = part >= 0
            part, keys, sizes = part[seen], keys[seen], sizes[seen]
            np.add.at(size, part, sizes)
            np.add.at(rows, part, 1)
            np.minimum.at(low, part, keys)
            np.maximum.at(high, part, keys)
        met = np.flatnonzero(rows)
        columns = {"part": met, "bytes": size[met], "rows": rows[met], "low": low[met], "high": high[met]}
        yield pa.RecordBatch.from_pydict(columns)

    return work


def locate(keys: DataFrame, column: str, size: str, goals: dict[int, Fraction], below: int) -> dict[int, Place]:
    """For each goal (bytes, counted from ``below`` at the start of this frame) the value of ``column`` on which it falls.

    Every round counts the bytes between the candidate boundaries of all open goals exactly, in all partitions, and narrows each
    goal to the part that holds it, down to the least and largest key there. It ends when that part is a single value. The driver
    holds ``PROBES`` boundaries for each goal, whatever the size of the frame.
    """
    only = keys.select(column, size)
    first = only.agg(F.min(column), F.max(column)).head()
    bounds = {k: (first[0], first[1], below) for k in goals} if first[0] is not None else {}
    found: dict[int, Place] = {}
    while bounds:
        edges: set[int] = set()
        for low, high, _ in bounds.values():
            width = high - low + 1
            edges.update(low + i * width // PROBES for i in range(PROBES))
            edges.add(min(high + 1, MOST))
        starts = sorted(edges)
        counted = only.mapInArrow(tally(starts), "part long, bytes long, rows long, low long, high long")
        sums = counted.groupBy("part").agg(F.sum("bytes"), F.sum("rows"), F.min("low"), F.max("high")).orderBy("part").collect()
        following = {}
        for k, (low, high, before) in bounds.items():
            for part, weight, rows, least, largest in sums:
                if not low <= least <= high:
                    continue
                if before + weight > goals[k]:
                    if least == largest:
                        found[k] = Place(least, before, weight, rows)
                    else:
                        following[k] = (least, largest, before)
                    break
                before += weight
        bounds = following
    return found


def splitters(keys: DataFrame, names: tuple[str, str, str, str], shards: int, total: int, tolerance: float) -> list[tuple[int, int, int]]:
    """The least key (text key, id, row number) of each shard but the first.

    A group of equal text keys up to the tolerance goes, whole, to the shard that its middle byte falls in. A heavier one is
    refined by id and, where rows share an id, by row number: then each row goes where its own middle byte falls.
    """
    text, ident, number, size = names
    goals = {k: Fraction(k * total, shards) for k in range(1, shards)}
    limit = Fraction(tolerance).limit_denominator(10**6) * total / shards
    cuts: dict[int, tuple[int, int, int]] = {}

    def settle(k: int, place: Place, prefix: tuple[int, ...]) -> None:
        right = 2 * place.below + place.bytes >= 2 * goals[k]
        rest = (LEAST if right else MOST,) * (2 - len(prefix))
        cuts[k] = (*prefix, place.value, *rest) if len(prefix) < 2 else (*prefix, place.value + (not right))

    def descend(frame: DataFrame, level: int, wanted: dict[int, Fraction], below: int, prefix: tuple[int, ...]) -> None:
        heavy: dict[Place, dict[int, Fraction]] = {}
        column = (text, ident, number)[level]
        for k, place in locate(frame, column, size, wanted, below).items():
            if level == 2 or place.rows == 1 or (level == 0 and place.bytes <= limit):
                settle(k, place, prefix)
            else:
                heavy.setdefault(place, {})[k] = goals[k]
        for place, inside in heavy.items():
            descend(frame.where(F.col(column) == place.value), level + 1, inside, place.below, (*prefix, place.value))

    descend(keys, 0, goals, 0, ())
    return [cuts[k] for k in sorted(cuts)]


def shard_documents(
    docs: DataFrame,
    shards: int = SHARDS,
    tolerance: float = TOLERANCE,
    id_col: str = "doc_id",
    text_col: str = "text",
    piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """Every row with all its columns, and ``size``, ``shard`` and ``slot``; columns of these names are replaced.

    Rows are ordered by a hash of the text, then id, then a row number, so a shard is a range of that order. Shards differ from
    an equal share of bytes by no more than half the tolerance, or half of the row that lies on their boundary, at either end.
    Slots are gapless from 0 in each shard and follow the order, except that a piece of the order too heavy for one task is dealt
    over several by row number first.

    Null and empty texts have size 1 and are one group; null ids come first in their group; equal rows are told apart by their row
    number, so one group, id or row repeated in a third of the table is spread like any other rows; very long texts are never cut;
    an empty table gives an empty frame. The rows are written once to the shared folder with their keys: counting passes read the
    keys alone, and one exchange then moves whole rows.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c.lower() not in ("size", "shard", "slot") or c in (id_col, text_col)]
    text, ident, number, size, shard, cell, sub, pieces, first = names = free_names(docs, "text_key id_key number bytes_of shard_of cell sub pieces first")
    path = scratch_path(spark, "shards")
    docs.select(
        *[quote(c) for c in kept],
        text_key(text_col).alias(text),
        F.coalesce(F.col(quote(id_col)).cast("long"), F.lit(LEAST)).alias(ident),
        F.monotonically_increasing_id().alias(number),
        row_size(text_col).alias(size),
    ).write.option("compression", "zstd").parquet(path)
    rows = spark.read.parquet(path)
    total = rows.agg(F.sum(size)).head()[0] or 0
    cuts = splitters(rows, names[:4], shards, total, tolerance)

    key = F.struct(text, ident, number)
    after = [(key >= F.struct(*[F.lit(v).cast("long").alias(n) for v, n in zip(cut, names)])).cast("int") for cut in cuts]
    placed = rows.withColumns({shard: sum(after, F.lit(0)), cell: F.shiftright(F.col(text), KEY_BITS - CELL_BITS)})
    # At most 2 ** CELL_BITS + shards rows: the cells are fixed ranges of the hash, cut at the shard boundaries.
    loads = placed.groupBy(shard, cell).agg(F.ceil(F.sum(size) / piece_bytes).cast("long").alias(pieces))
    dealt = placed.join(F.broadcast(loads), [shard, cell]).withColumn(sub, F.pmod(F.xxhash64(number), pieces))

    group = [shard, cell, sub]
    earlier = Window.partitionBy(shard).orderBy(cell, sub).rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(*group).agg(F.count("*").alias("_n"))
    starts = starts.select(*group, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias(first))
    inside = Window.partitionBy(*group).orderBy(text, ident, number)
    numbered = dealt.withColumn(pieces, F.row_number().over(inside).cast("long") - 1).join(starts, group)
    return numbered.select(
        *[quote(c) for c in kept],
        F.col(size).alias("size"),
        F.col(shard).alias("shard"),
        (F.col(first) + F.col(pieces)).alias("slot"),
    )


def write_shards(sharded: DataFrame, path: str) -> str:
    """One folder ``shard=<n>`` of Parquet files for each shard; rows keep their slots."""
    sharded.write.partitionBy("shard").parquet(path)
    return path


def op11_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = shard_documents(table(spark, sf_dir, "documents"))
    return sharded.select(
        "doc_id",
        "size",
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def crc_table() -> list[int]:
    """The reflected CRC-32 table by its rule."""
    out = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        out.append(value)
    return out


_SQL = f"""
WITH sized AS (SELECT doc_id, coalesce(text, '') AS text, strlen(coalesce(text, '')) + 1 AS size,
    CAST('0x' || substr(md5(coalesce(text, '')), 1, 15) AS BIGINT) AS key FROM documents),
  whole AS (SELECT CAST(sum(size) AS BIGINT) AS total FROM sized),
  ordered AS (SELECT *, CAST(sum(size) OVER (PARTITION BY key) AS BIGINT) AS heavy,
    CAST(sum(size) OVER (ORDER BY key, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS BIGINT) AS through FROM sized),
  grouped AS (SELECT *, max(through) OVER (PARTITION BY key) AS group_through, heavy * {round(SHARDS / TOLERANCE)} <= total AS light
    FROM ordered CROSS JOIN whole),
  dealt AS (SELECT *, CAST((CASE WHEN light THEN 2 * group_through - heavy ELSE 2 * through - size END) * {SHARDS}
    // (2 * total) AS INT) AS shard FROM grouped),
  bytes AS (SELECT *, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: CAST('0x' || h AS BIGINT)) AS octets FROM dealt)
SELECT doc_id, CAST(size AS BIGINT) AS size,
  xor(list_reduce(list_prepend(4294967295::BIGINT, octets),
    lambda c, b: xor(c >> 8, ({crc_table()}::BIGINT[])[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) AS text_crc32,
  'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY key, doc_id NULLS FIRST) - 1 AS slot,
  CAST(NULL AS INT) AS grown_shard
FROM bytes
"""

QUERIES = {"op11_shards": op11_shards}
ORACLES = {"op11_shards": _SQL}
