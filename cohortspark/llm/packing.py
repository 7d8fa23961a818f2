"""Sum-of-squares online packing of token sequences (operator 8)."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from cohortspark.llm.frames import table, texts
from cohortspark.llm.tokens import VOCABULARY, Encoder

CAPACITY = 2048
END_ID = 1
MAX_OPEN = 4096
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
)


class Packer:
    """Windows of ``capacity`` tokens. ``levels[h]`` counts the windows filled up to h; 0 and ``capacity`` are not counted.

    Of a document of at least ``capacity`` tokens, full windows are cut off first. The rest goes whole into the level h for
    which the sum of the squared counts becomes smallest (the fuller level on a tie); h = 0 opens a window. When ``max_open``
    windows are open, and at the end, open windows are emptied into full ones, cutting pieces where needed, so one window at
    most stays partly filled and memory stays bounded.
    """

    def __init__(self, capacity: int = CAPACITY, max_open: int = MAX_OPEN):
        self.capacity, self.max_open = capacity, max_open
        self.levels = np.zeros(capacity + 1, np.int64)
        self.open: dict[int, list[list[tuple]]] = {}
        self.count = 0

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[list[tuple]]:
        """Windows that became full, each a list of (doc_id, start, doc_tokens, ids)."""
        total, size = len(ids) // 4, self.capacity
        start = total // size * size
        for at in range(0, start, size):
            yield [(doc_id, at, total, ids[4 * at : 4 * (at + size)])]
        if start < total:
            yield from self.place((doc_id, start, total, ids[4 * start :]))

    def place(self, piece: tuple) -> Iterator[list[tuple]]:
        size, length, levels = self.capacity, len(piece[3]) // 4, self.levels
        before = levels[: size - length + 1]
        opened = 2 * levels[length:] + 1  # growth of the sum of squares where the piece ends; a full window isn't counted
        opened[-1] = 0
        closed = 1 - 2 * before  # and where it begins; a new window isn't counted
        closed[1:][before[1:] == 0] = size * (self.count + 2)
        closed[0] = 0
        level = size - length - int(np.argmin((opened + closed)[::-1]))
        window: list[tuple] = []
        if level:
            window = self.open[level].pop()
            levels[level] -= 1
            self.count -= 1
        window.append(piece)
        if level + length == size:
            yield window
            return
        levels[level + length] += 1
        self.count += 1
        self.open.setdefault(level + length, []).append(window)
        if self.count > self.max_open:
            *full, rest = self.drain()
            yield from full
            filled = sum(len(p[3]) for p in rest) // 4
            if filled == size:
                yield rest
            elif filled:
                self.levels[filled], self.count, self.open = 1, 1, {filled: [rest]}

    def drain(self) -> Iterator[list[tuple]]:
        """All open windows as full ones and a last one that may be partly filled."""
        window, room = [], self.capacity
        for level in sorted(self.open, reverse=True):
            for doc_id, start, total, ids in (piece for held in self.open[level] for piece in held):
                while ids:
                    part = ids[: 4 * room]
                    window.append((doc_id, start, total, part))
                    start, ids, room = start + len(part) // 4, ids[len(part) :], room - len(part) // 4
                    if not room:
                        yield window
                        window, room = [], self.capacity
        yield window
        self.levels[:], self.open, self.count = 0, {}, 0


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    vocabulary: str = VOCABULARY,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents, packed by every task for itself: no shuffle, one partly filled window per task.

    A document is its ids and the end id; a null or empty text is the end id alone. Rows with equal or null ids are documents
    of their own. An empty table gives no pieces. ``ids`` holds a piece's tokens (little-endian 32-bit) if ``with_ids``.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer, end = Encoder(vocabulary, added=True), Packer(capacity), np.array([END_ID], "<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []
        schema = pa.schema([(n, pa.int64()) for n in names] + [("ids", pa.binary())])

        def emit(window: list[tuple]) -> None:
            nonlocal sequence
            offset = 0
            for doc_id, start, total, ids in window:
                length = len(ids) // 4
                rows.append((doc_id, start, length, zlib.crc32(ids), total, sequence, offset, ids if with_ids else None))
                offset += length
            sequence += 1

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for window in packer.add(doc_id, encoder.ids(text.as_py()) + end):
                    emit(window)
                if len(rows) > 5000:
                    yield flush()
        for window in packer.drain():
            if window:
                emit(window)
        if rows:
            yield flush()

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    out = texts(docs, id_col, text_col).mapInArrow(work, SCHEMA)
    return out if with_ids else out.drop("ids")


def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op8_pack": op8_pack}
