"""SimHash near duplicates by vantage-point trees over Hamming distance (operator 1)."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.llm.frames import parts, runs, saved, table, texts
from cohortspark.llm.graph import components, unite

SHINGLE = 3
SEED = 42
BITS = 64
DISTANCE = 3
LANES = 2
SAMPLE = 256
CANDIDATES = 4096
BLOCK = 1 << 22
LEAF = 1 << 13


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit i is 1 if it is set in over half of the hashes of all shingles, repeats included; no words, zero."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = (ends - np.array([len(w) + 1 for w in words]))[: len(words) - shingle + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist())]
    every = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    counts = np.zeros(BITS, np.int64)
    for a in range(0, len(every), 1 << 16):
        counts += np.unpackbits(every[a : a + (1 << 16)], axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes), bitorder="little").tobytes(), "little", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) per row. Map only."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], ["doc_id", "fp"])

    return texts(docs, id_col, text_col).mapInArrow(work, "doc_id long, fp long")


def lane(column, number: int, lanes: int):
    """One of the equal bit ranges of a fingerprint."""
    width = BITS // lanes
    return F.shiftrightunsigned(column, number * width).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1))


def depth(count: int, reach: int, width: int, most: int = CANDIDATES) -> int:
    """Levels at which a fingerprint meets about ``most`` others at random: the smallest number that suffices.

    A random pair meets if all its differences of distances are at most ``reach`` and of one parity, see ``overlaps``.
    """
    rng = np.random.default_rng(1)
    x, y, v = rng.integers(0, 1 << width, (3, 20_000), dtype=np.uint64)
    gap = np.abs(np.bitwise_count(x ^ v).astype(int) - np.bitwise_count(y ^ v).astype(int))
    even, odd = (float(np.mean((gap <= reach) & (gap % 2 == parity))) for parity in (0, 1))
    levels = 1
    while levels < 8 and count * (even**levels + odd**levels) > most:
        levels += 1
    return levels


def overlaps(levels: int, reach: int) -> list[tuple[int, ...]]:
    """Differences of distances that a partner within ``reach`` can have, one of each pair of opposite ones.

    By the triangle inequality every difference is at most ``reach``; as Hamming distances to one point differ by the parity
    of the distance between the two, all differences of a pair are even or all are odd.
    """
    steps = [d for d in product(range(-reach, reach + 1), repeat=levels) if len({v % 2 for v in d}) == 1]
    return [d for d in steps if d >= tuple([0] * levels)]


def vantage_points(distinct: DataFrame, number: int, lanes: int, levels: int) -> list[int]:
    """The points of a bounded sample whose distances to the sample spread most."""
    sample = [r[0] for r in distinct.select(lane(F.col("fp"), number, lanes)).orderBy(F.xxhash64("fp")).limit(SAMPLE).collect()]
    points = np.unique(np.array(sample, np.int64)).view(np.uint64)
    apart = np.bitwise_count(points[:, None] ^ points[None, :]).astype(float)
    spread = (apart**2).sum(1) * max(1, len(points)) - apart.sum(1) ** 2
    chosen = points[np.argsort(-spread, kind="stable")[:levels]]
    more = np.random.default_rng(number).integers(0, 1 << (BITS // lanes), levels - len(chosen), dtype=np.uint64)
    return np.r_[chosen, more].astype(np.uint64).view(np.int64).tolist()  # random ones if there are too few fingerprints


def shard_rows(distinct: DataFrame, count: int, distance: int, lanes: int) -> DataFrame:
    """(shard, home, fp): every fingerprint in its own shard, and as a visitor in those where a partner can be at home.

    Fingerprints within ``distance`` are within distance // lanes in one of the lanes, so each lane has a tree of its own with
    that reach. A shard is a leaf: the distances to the levels' vantage points.
    """
    reach, out = distance // lanes, None
    levels = depth(count, reach, BITS // lanes)
    for number in range(lanes):
        value = lane(F.col("fp"), number, lanes)
        rings = [F.bit_count(value.bitwiseXOR(F.lit(p))) + F.lit(reach) for p in vantage_points(distinct, number, lanes, levels)]
        base = BITS + 2 * reach + 2
        shard = F.lit(number).cast("long")
        for ring in rings:
            shard = shard * base + ring
        shifts = [sum(d * base ** (levels - 1 - i) for i, d in enumerate(step)) for step in overlaps(levels, reach)]
        rows = distinct.select("fp", shard.alias("shard"), F.explode(F.array([F.lit(s).cast("long") for s in shifts])).alias("shift"))
        rows = rows.select((F.col("shard") + F.col("shift")).alias("shard"), (F.col("shift") == 0).alias("home"), "fp")
        out = rows if out is None else out.union(rows)
    return out


def split_shards(rows: DataFrame, leaf: int) -> DataFrame:
    """(cell, side, home, fp): shards of at most ``leaf`` rows are cells; larger ones are cut into blocks by the fingerprint's
    hash, and every pair of blocks is a cell, whose rows are told apart by ``side``.

    So a dense group of near copies costs many tasks of bounded size; only the sizes of large shards are joined.
    """
    sizes = rows.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > leaf)
    sizes = sizes.select("shard", F.ceil(F.col("n") / leaf).cast("int").alias("blocks"))
    found = rows.join(sizes, "shard", "left")
    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    pairs = F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    found = found.select("shard", "home", "fp", "blocks", block.alias("block"), F.explode(pairs).alias("other"))
    cell = F.xxhash64("shard", F.least("block", "other"), F.greatest("block", "other"))
    return found.select(
        F.when(F.col("blocks").isNull(), F.xxhash64("shard")).otherwise(cell).alias("cell"),
        F.coalesce(F.col("block") > F.col("other"), F.lit(False)).alias("side"),
        "home",
        "fp",
    )


def near(fp: np.ndarray, homes: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all pairs within the distance, in blocks."""
    step = max(1, BLOCK // max(1, len(homes)))
    for a in range(0, len(fp), step):
        i, j = np.nonzero(np.bitwise_count(fp[a : a + step, None] ^ homes[None, :]) <= distance)
        yield i + a, j


def forest(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Links that connect what is connected within each cell, at most one per fingerprint in it."""
    for _, cell in runs(batches, "cell"):
        fp = cell.column("fp").to_numpy().view(np.uint64)
        home, side = (cell.column(name).to_numpy() for name in ("home", "side"))
        label = np.arange(len(fp))
        whole = not side.any()
        for rows, others in [(~side, ~side & home)] if whole else [(~side, side & home), (side, ~side & home)]:
            rows, others = np.flatnonzero(rows), np.flatnonzero(others)
            for i, j in near(fp[rows], fp[others], distance):
                label = unite(label, rows[i], others[j])
        at = np.flatnonzero(label != np.arange(len(fp)))
        if len(at):
            columns = [pa.array(fp[at].view(np.int64)), pa.array(fp[label[at]].view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b"])


def linked_roots(nodes: DataFrame, distance: int = DISTANCE, lanes: int = LANES, leaf: int = LEAF) -> DataFrame:
    """(node, root) of the different fingerprints (saved, in ``fp``) that have a link to another."""
    rows = split_shards(shard_rows(nodes.select("fp"), nodes.count(), distance, lanes), leaf)
    rows = rows.repartition(parts(nodes.sparkSession), "cell").sortWithinPartitions("cell")
    return components(rows.mapInArrow(lambda batches: forest(batches, distance), "a long, b long"))


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of every component, over rows: the row with the smallest (id, hash of the text, hash of the rest), and likewise one of
    those without an id. Rows that share an id are rows of their own; of wholly equal rows one stays.

    Null, empty and blank texts have fingerprint 0 and are linked like others. Extra columns may have any name and type. Each
    text of any length is fingerprinted once, and its row's key decides; only the survivors' rows are joined back. Minima are
    combined in the map tasks, so copies meet in no task. An empty table gives an empty result.
    """
    columns = {c: F.col("`" + c.replace("`", "``") + "`") for c in docs.columns}
    rest = [column for c, column in columns.items() if c not in (id_col, text_col)]
    keys = [
        F.col(id_col).isNull().alias("missing"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"),
        F.xxhash64(F.col(text_col).cast("string")).alias("hash"),
        (F.xxhash64(F.to_json(F.struct(*rest))) if rest else F.lit(0).cast("long")).alias("rest"),
    ]
    names = ["missing", "id", "hash", "rest"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t.as_py()) for t in batch.column(4)], np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(values)], [*names, "fp"])

    keyed = docs.select(*keys, F.col(text_col).cast("string").alias("text"))
    marked = saved(keyed.mapInArrow(work, "missing boolean, id long, hash long, rest long, fp long"))
    order = F.struct(*names)
    kinds = [F.min(F.when(kind, order)).alias(name) for kind, name in ((~F.col("missing"), "a"), (F.col("missing"), "b"))]
    nodes = saved(marked.groupBy("fp").agg(*kinds))
    best = nodes.join(linked_roots(nodes).withColumnRenamed("node", "fp"), "fp", "left")
    best = best.groupBy(F.coalesce("root", "fp")).agg(F.min("a").alias("a"), F.min("b").alias("b"))
    best = best.select(F.explode(F.array("a", "b")).alias("it")).where("it IS NOT NULL").select("it.*")
    rows = docs.select(*keys, F.struct(*columns.values()).alias("row")).groupBy(*names).agg(F.first("row").alias("row"))
    return rows.join(best, names).select("row.*")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    distance: int = DISTANCE,
    shingle: int = SHINGLE,
    lanes: int = LANES,
    leaf: int = LEAF,
) -> DataFrame:
    """(doc_id, fp, component_id) per row: the smallest doc_id reachable by links of at most ``distance`` differing bits.

    Null, empty and blank texts have fingerprint 0 and are linked like others. Rows with equal ids are rows of their own; a
    null id gets a component, and gives none its name unless all its ids are null. Rows of equal fingerprints are one node
    before anything is compared. An empty table gives an empty result.
    """
    marked = saved(fingerprints(docs, id_col, text_col, shingle))
    nodes = saved(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = linked_roots(nodes, distance, lanes, leaf)
    linked = nodes.join(roots.withColumnRenamed("node", "fp"), "fp")
    least = linked.groupBy("root").agg(F.min("first").alias("least"))
    linked = linked.join(least, "root").select("fp", "least")
    named = nodes.join(linked, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op1_simhash": op1_simhash}
