"""Reproducible train/test splits.

A row's place is the rank of ``md5(key|seed)``, which any engine can reproduce. The exact cut is found
like a radix selection: count rows per hash prefix, pick the prefix the cut falls in, and go on with the
next digits of the hashes below it, until few enough are left to rank. Afterwards a row is placed by
comparing its own hash with the cut. There is no global sort and no row number over a whole stratum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortspark.functions.scalars import quote
from cohortspark.session import ensure_checkpoint_dir

# Four hex digits a step: at most 65,536 counters per stratum and cut, and 1/65,536 of the rows left.
_PREFIX = 4
_HASH_DIGITS = 32
# Rows of one cut that are ranked in one window.
EDGE_ROWS = 100_000


def hash_key(key: str, seed: int) -> Column:
    text = F.coalesce(F.col(quote(key)).cast("string"), F.lit(""))
    return F.md5(F.concat(text, F.lit(f"|{seed}")))


def _running(frame: DataFrame, groups: Sequence[str], order: str) -> DataFrame:
    """Add the running count before and through each row of a group."""
    w = Window.partitionBy(*groups).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return frame.withColumn("_through", F.sum("_n").over(w)).withColumn("_before", F.col("_through") - F.col("_n"))


def _holds_cut() -> Column:
    return (F.col("_before") < F.col("_k")) & (F.col("_k") <= F.col("_through"))


def _counted(hashed: DataFrame, groups: Sequence[str], digits: int) -> DataFrame:
    """Rows per hash prefix; ``_size`` is 1 where they share one hash, as a hot key is one row to rank."""
    size = F.when(F.min("_hash") == F.max("_hash"), F.lit(1)).otherwise(F.count(F.lit(1)))
    prefix = F.substring("_hash", 1, digits).alias("_p")
    return hashed.groupBy(*groups, prefix).agg(F.count(F.lit(1)).alias("_n"), size.alias("_size"))


def _below(hashed: DataFrame, edge: DataFrame, digits: int) -> DataFrame:
    """The rows whose first digits hold a cut, once for each of the cuts."""
    same = F.col("_stratum").eqNullSafe(F.col("_s")) & (F.substring("_hash", 1, digits) == F.col("_p"))
    return hashed.join(edge, same).select("_s", "_cut", "_k", "_hash")


def _edges(hashed: DataFrame, shares: Sequence[Sequence[float]]) -> tuple[DataFrame, int]:
    """(stratum, prefix, cut, rank below the prefix) of every cut, and the prefixes' length, beyond which few rows are left."""
    counts = _counted(hashed, ["_stratum"], _PREFIX)
    total = F.sum("_n").over(Window.partitionBy("_stratum"))
    wanted = []
    for i, chain in enumerate(shares):
        size: Column = F.col("_total")
        for share in chain:
            size = F.ceil(size * F.lit(float(share)))
        wanted.append(F.struct(F.lit(i).alias("_cut"), size.cast("bigint").alias("_k")))
    found = (
        _running(counts.withColumn("_total", total), ["_stratum"], "_p")
        .withColumn("_want", F.explode(F.array(*wanted)))
        .select(F.col("_stratum").alias("_s"), "_p", "_size", "_before", "_through", "_want.*")
    )
    digits = _PREFIX
    ensure_checkpoint_dir(hashed.sparkSession)
    while True:
        left = (F.col("_k") - F.col("_before")).alias("_k")
        edge = found.where(_holds_cut()).select("_s", "_p", "_cut", left, "_size").checkpoint()
        most = edge.agg(F.max("_size")).first()[0] or 0
        if most <= EDGE_ROWS or digits >= _HASH_DIGITS:
            return edge.drop("_size"), digits
        below = _below(hashed, edge, digits)
        digits += _PREFIX
        found = _running(_counted(below, ["_s", "_cut", "_k"], digits), ["_s", "_cut"], "_p")


def _cut_hashes(hashed: DataFrame, shares: Sequence[Sequence[float]]) -> DataFrame:
    """One row per stratum: ``_cut0``, ``_cut1``, … the last hash inside each cut.

    Cut i holds ceil(share * size) rows, applied share after share (so [0.3, 0.5] is half of 30 %).
    """
    near = _below(hashed, *_edges(hashed, shares))
    # Equal hashes (a repeated key) count together, so a hot key is one row here.
    ranked = near.groupBy("_s", "_cut", "_k", "_hash").agg(F.count(F.lit(1)).alias("_n"))
    last = _running(ranked, ["_s", "_cut"], "_hash").where(_holds_cut())
    return last.groupBy("_s").agg(
        *[F.max(F.when(F.col("_cut") == i, F.col("_hash"))).alias(f"_cut{i}") for i in range(len(shares))]
    )


def split_labels(
    df: DataFrame,
    key: str,
    parts: Sequence[tuple[str, Sequence[float]]],
    rest: str,
    stratify: str | None = None,
    seed: int = 42,
    target: str = "split",
) -> DataFrame:
    """Label rows with nested parts, smallest first; rows outside all of them are ``rest``.

    Rows with the same key always get the same label.
    """
    stratum = F.col(quote(stratify)).cast("string") if stratify else F.lit("")
    hashed = df.select(stratum.alias("_stratum"), hash_key(key, seed).alias("_hash"))
    cuts = _cut_hashes(hashed, [chain for _, chain in parts])
    names = [f"_cut{i}" for i in range(len(parts))]
    placed = df.withColumns({"_stratum": stratum, "_hash": hash_key(key, seed)})
    if stratify is None:
        # One stratum: its cuts are constants.
        found = cuts.first()
        placed = placed.withColumns({n: F.lit(found[n] if found else None).cast("string") for n in names})
    else:
        placed = placed.join(cuts, F.col("_stratum").eqNullSafe(F.col("_s")), "left")
    label = F.lit(rest)
    for (part, _), cut in reversed(list(zip(parts, names, strict=True))):
        label = F.when(F.col("_hash") <= F.col(cut), F.lit(part)).otherwise(label)
    return placed.withColumn(target, label).drop("_stratum", "_hash", "_s", *names)


def split_random(df: DataFrame, key: str = "id", test_share: float = 0.2, seed: int = 42) -> DataFrame:
    return split_labels(df, key, [("test", [test_share])], "train", seed=seed)


def split_stratified(
    df: DataFrame, stratify: str, key: str = "id", test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    return split_labels(df, key, [("test", [test_share])], "train", stratify, seed)


def split_three_way(
    df: DataFrame, stratify: str, key: str = "id", held_out: float = 0.3, test_of_held_out: float = 0.5, seed: int = 42
) -> DataFrame:
    """Train, validation and test: the held-out part is split once more."""
    parts = [("test", [held_out, test_of_held_out]), ("validation", [held_out])]
    return split_labels(df, key, parts, "train", stratify, seed)


def take(df: DataFrame, part: str, column: str = "split") -> DataFrame:
    return df.where(F.col(column) == part).drop(column)
