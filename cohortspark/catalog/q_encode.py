"""Encoding, scaling and splitting queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohortspark.catalog.adapters import subjects
from cohortspark.catalog.registry import query, rnd
from cohortspark.operators import encode, split

_LEVELS = ["Fall", "Spring", "Summer", "Winter"]
_SCALED = ["age", "cgas", "bmi", "hours", "pciat"]


def flags_sql(c: str, levels) -> str:
    return ", ".join(f"CAST(coalesce({c} = '{v}', false) AS INT) AS \"{c}_{v}\"" for v in levels)


@query("one_hot_all", f"SELECT id, season, {flags_sql('season', _LEVELS)} FROM subjects")
def one_hot_all(spark, sf):
    frame = subjects(spark, sf).select("id", "season")
    return encode.one_hot(frame, encode.fit_levels(frame, ["season"]))


@query("one_hot_drop_first", f"SELECT id, season, {flags_sql('season', _LEVELS[1:])} FROM subjects")
def one_hot_drop_first(spark, sf):
    frame = subjects(spark, sf).select("id", "season")
    return encode.one_hot(frame, encode.fit_levels(frame, ["season"]), drop_first=True)


@query(
    "one_hot_ignore_unknown",
    "SELECT id, season, CAST(coalesce(season = 'Fall', false) AS INT) AS \"season_Fall\","
    " CAST(coalesce(season = 'Spring', false) AS INT) AS \"season_Spring\" FROM subjects",
)
def one_hot_ignore_unknown(spark, sf):
    """Levels learned where only fall and spring occur; the other seasons of the whole table get zeros."""
    frame = subjects(spark, sf).select("id", "season")
    levels = encode.fit_levels(frame.where(F.col("season").isin("Fall", "Spring")), ["season"])
    return encode.one_hot(frame, levels)


def _z(c: str) -> str:
    return f"({c} - (SELECT avg({c}) FROM subjects)) / (SELECT stddev_pop({c}) FROM subjects)"


@query("standard_scale", f"SELECT id, {', '.join(rnd(_z(c), c) for c in _SCALED)} FROM subjects")
def standard_scale(spark, sf):
    frame = subjects(spark, sf).select("id", *_SCALED)
    return encode.scale(frame, encode.fit_scaler(frame, _SCALED))


@query(
    "assemble_features",
    "SELECT id, "
    + ", ".join(rnd(f"coalesce({_z(c)}, 0)", f"f_{c}") for c in _SCALED)
    + ", "
    + ", ".join(rnd(f"CASE WHEN season = '{v}' THEN 1 ELSE 0 END", f"f_season_{v}") for v in _LEVELS)
    + f", {rnd('sex', 'f_sex')} FROM subjects",
)
def assemble_features(spark, sf):
    frame = subjects(spark, sf)
    encoder = encode.fit_encoder(frame, _SCALED, ["season"], ["sex"])
    slots = vector_to_array("features")
    return encoder.assemble(frame).select("id", *[slots[i].alias(f"f_{n}") for i, n in enumerate(encoder.names)])


RANKED_SQL = "row_number() OVER ({partition} ORDER BY md5(id || '|42'), id)"


def split_cte(name: str, share: str, source: str = "subjects", by: str | None = None) -> str:
    """Each row with its rank by hash and its stratum's size; split by the share."""
    partition = f"PARTITION BY {by}" if by else ""
    rank = RANKED_SQL.format(partition=partition)
    return (
        f"{name} AS (SELECT *, CASE WHEN {rank} <= ceil(count(*) OVER ({partition}) * {share})"
        f" THEN 'test' ELSE 'train' END AS split FROM {source})"
    )


@query("split_random", f", s AS (SELECT id FROM subjects), {split_cte('cut', '0.2e0', 's')} SELECT id, split FROM cut")
def split_random(spark, sf):
    return split.split_random(subjects(spark, sf).select("id"))


@query(
    "split_stratified",
    f", s AS (SELECT id, sii FROM subjects), {split_cte('cut', '0.2e0', 's', 'sii')}"
    f" SELECT id, {rnd('sii', 'sii')}, split FROM cut",
)
def split_stratified(spark, sf):
    return split.split_stratified(subjects(spark, sf).select("id", "sii"), "sii")


@query(
    "split_three_way",
    f", s AS (SELECT id, sii, {RANKED_SQL.format(partition='PARTITION BY sii')} AS place,"
    " ceil(count(*) OVER (PARTITION BY sii) * 0.3e0) AS held FROM subjects)"
    f" SELECT id, {rnd('sii', 'sii')}, CASE WHEN place <= ceil(held * 0.5e0) THEN 'test'"
    " WHEN place <= held THEN 'validation' ELSE 'train' END AS split FROM s",
)
def split_three_way(spark, sf):
    return split.split_three_way(subjects(spark, sf).select("id", "sii"), "sii")
