"""Aggregations. All group by keys with partial aggregation before the shuffle, so a hot key costs one
partial row per map task rather than all its samples."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.functions.scalars import DAY_PARTS, WEEKDAY_FLAGS, day_part, quote, weekday_flag
from cohortspark.operators.sizing import long_form
from cohortspark.operators.stats import column_stats

_FULL = ("mean", "std", "max", "min")
AXES = ("X", "Y", "Z")
# Fixed values.
SUMMARY_STATS: dict[str, tuple[str, ...]] = {
    **dict.fromkeys((*AXES, "enmo", "light"), _FULL),
    "battery_voltage": ("mean",),
}
# Fixed values.
FULL_SUMMARY_STATS: dict[str, tuple[str, ...]] = {
    **dict.fromkeys((*AXES, "enmo"), _FULL),
    "anglez": ("mean",),
    "non_wear_flag": ("sum",),
    "light": _FULL,
    "battery_voltage": ("mean",),
}
# Fixed values.
DAILY_STATS: dict[str, tuple[str, ...]] = {
    **dict.fromkeys(AXES, ("mean", "max", "min", "std")),
    "enmo": ("mean", "max", "std"),
    "anglez": ("mean",),
    "non_wear_flag": ("sum",),
    "light": ("mean", "max", "min"),
    "battery_voltage": ("mean",),
}


def _stat(column: str, stat: str) -> str:
    c = quote(column)
    measure = {
        "mean": f"avg({c})",
        "std": f"stddev_samp({c})",
        "max": f"max({c})",
        "min": f"min({c})",
        "sum": f"coalesce(sum(cast({c} AS double)), 0D)",  # the sum of nothing is 0 here, not NULL
    }[stat]
    return f"{measure} AS {quote(f'{column}_{stat}')}"


def summarise(df: DataFrame, keys: Sequence[str], stats: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row per key, columns named ``<column>_<stat>``; rows with a NULL key belong to no group."""
    measures = [_stat(c, s) for c, names in stats.items() for s in names]
    return _aggregate(_keyed(df, keys), [quote(k) for k in keys], measures)


def _keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with every key present, as IS NOT NULL filters, which reach the parquet scan."""
    for k in keys:
        df = df.where(F.col(quote(k)).isNotNull())
    return df


def series_summary(df: DataFrame) -> DataFrame:
    return summarise(df, ["id"], SUMMARY_STATS)


def series_summary_full(df: DataFrame) -> DataFrame:
    return summarise(df, ["id"], FULL_SUMMARY_STATS)


def daily_summary(df: DataFrame) -> DataFrame:
    return summarise(df, ["id", "relative_date_PCIAT"], DAILY_STATS)


_N_PARTS = len(DAY_PARTS)


def _period_code(unit: str) -> Column:
    """Weekday flag and day part as one small number, which groups faster than two strings."""
    return weekday_flag("weekday", (0, _N_PARTS)) + day_part("time_of_day", unit, range(_N_PARTS))


# The expressions of this section are SQL text: one call to the JVM each instead of one per operator.
_NON_WEAR_TOTAL = "coalesce(sum(cast(non_wear_flag AS double)), 0D)"
_PERIOD_MEASURES = {"enmo": "_enmo", "light": "_light", "non_wear_flag": "_non_wear"}


def _aggregate(df: DataFrame, keys: Sequence[Column | str], measures: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.expr(m) for m in measures])


def _period_cells(df: DataFrame, unit: str, *extra: str) -> DataFrame:
    """One row per (id, weekday flag, day part): at most ten per participant."""
    cells = [
        "count(1) AS _n",
        "avg(enmo) AS _enmo",
        "avg(light) AS _light",
        f"{_NON_WEAR_TOTAL} AS _non_wear",
    ]
    return _aggregate(_keyed(df, ["id"]), ["id", _period_code(unit).alias("_period")], [*cells, *extra])


def _flag_cells() -> list[str]:
    """Spread the period cells of a participant over columns, together with their row counts."""
    return [
        f"max({value}) FILTER (WHERE _period = {i * _N_PARTS + j}) AS {value}_{flag}_{part}"
        for i, flag in enumerate(WEEKDAY_FLAGS)
        for j, part in enumerate(DAY_PARTS)
        for value in ("_n", *_PERIOD_MEASURES.values())
    ]


def _flag_rows() -> str:
    """One row per weekday flag that occurs.

    A part seen under the other flag only counts as 0; a part the participant never has is NULL; a
    part whose values are all NULL keeps its NULL mean.
    """
    rows = []
    for flag, other in (WEEKDAY_FLAGS, WEEKDAY_FLAGS[::-1]):
        fields = ", ".join(
            f"'{measure}_{p}', CASE WHEN _n_{flag}_{p} IS NOT NULL THEN {cell}_{flag}_{p}"
            f" WHEN _n_{other}_{p} IS NOT NULL THEN 0D END"
            for measure, cell in _PERIOD_MEASURES.items()
            for p in DAY_PARTS
        )
        seen = ", ".join(f"_n_{flag}_{p}" for p in DAY_PARTS)
        rows.append(
            f"CASE WHEN coalesce({seen}) IS NOT NULL THEN named_struct('weekday_flag', '{flag}', {fields}) END"
        )
    return f"inline(array_compact(array({', '.join(rows)})))"


def period_profile(df: DataFrame, unit: str = "s") -> DataFrame:
    """Mean activity, mean light and non-wear total by day part, one row per (id, weekday flag)."""
    return _aggregate(_period_cells(df, unit), ["id"], _flag_cells()).selectExpr("id", _flag_rows())


def non_wear_ratio(df: DataFrame) -> DataFrame:
    """Non-wear total over the number of samples, those with a NULL flag included."""
    return _aggregate(_keyed(df, ["id"]), ["id"], [f"{_NON_WEAR_TOTAL} / count(1) AS non_wear_ratio"])


def participant_profile(df: DataFrame, unit: str = "s") -> DataFrame:
    """Full summary, period profile and non-wear ratio together, from one scan and no join.

    The samples are aggregated once to the ten period cells of a participant, with mergeable
    statistics (count, sum, squared deviations). The second step combines those few cells: their
    deviations add up with the spread of the cell means around the participant's mean.
    """
    spread = [c for c, s in FULL_SUMMARY_STATS.items() if "std" in s]
    means = [c for c, s in FULL_SUMMARY_STATS.items() if "mean" in s]
    extra, combined = [], ["sum(_n) AS _rows", "sum(_non_wear) AS non_wear_flag_sum"]
    for c in means:
        extra += [f"count({c}) AS _count_{c}", f"sum(cast({c} AS double)) AS _sum_{c}"]
        combined += [f"sum(_count_{c}) AS _count_{c}", f"sum(_sum_{c}) AS _sum_{c}"]
    for c in spread:
        extra += [f"var_pop({c}) * count({c}) AS _m2_{c}", f"max({c}) AS _max_{c}", f"min({c}) AS _min_{c}"]
        cell = f"named_struct('n', _count_{c}, 's', _sum_{c}, 'm2', _m2_{c})"
        combined += [
            f"collect_list({cell}) FILTER (WHERE _count_{c} > 0) AS _cells_{c}",
            f"max(_max_{c}) AS {c}_max",
            f"min(_min_{c}) AS {c}_min",
        ]
    merged = _aggregate(_period_cells(df, unit, *extra), ["id"], [*combined, *_flag_cells()])

    def value(c: str, stat: str) -> str:
        mean = f"try_divide(_sum_{c}, _count_{c})"
        if stat == "mean":
            return f"{mean} AS {c}_mean"
        if stat == "std":
            gap = f"(cell.s / cell.n - {mean})"
            squares = f"aggregate(_cells_{c}, 0D, (total, cell) -> total + cell.m2 + cell.n * {gap} * {gap})"
            return f"CASE WHEN _count_{c} > 1 THEN sqrt({squares} / (_count_{c} - 1)) END AS {c}_std"
        return f"{c}_{stat}"

    summary = [value(c, s) for c, names in FULL_SUMMARY_STATS.items() for s in names]
    return merged.selectExpr("id", *summary, _flag_rows(), "non_wear_flag_sum / _rows AS non_wear_ratio")


def class_min_max(df: DataFrame, by: str, value: str) -> DataFrame:
    v = quote(value)
    return _keyed(df, [by]).groupBy(quote(by)).agg(F.min(v).alias("minimum"), F.max(v).alias("maximum"))


def value_counts(df: DataFrame, column: str, dropna: bool = False) -> DataFrame:
    """Count per value, largest first; NULL is a value of its own unless dropped."""
    frame = _keyed(df, [column]) if dropna else df
    counts = frame.groupBy(F.col(quote(column)).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), F.asc_nulls_first("value"))


def value_percentages(df: DataFrame, column: str, dropna: bool = False) -> DataFrame:
    """Value counts with their share of all counted rows in percent; the total is a scalar subquery."""
    counts = value_counts(df, column, dropna)
    counted = (_keyed(df, [column]) if dropna else df).select(F.count(F.lit(1)).alias("n"))
    share = F.col("count") / counted.scalar() * 100
    return counts.withColumn("percentage", share).orderBy(F.desc("count"), F.asc_nulls_first("value"))


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equal-width bins between minimum and maximum of the finite values; the last bin is closed.

    Empty bins are listed with count 0. Minimum and maximum are one small row.
    """
    spark = df.sparkSession
    values = df.select(F.col(quote(column)).cast("double").alias("v"))
    values = values.where("v IS NOT NULL AND NOT isnan(v) AND abs(v) < double('infinity')")
    low, high = values.agg(F.min("v"), F.max("v")).first()
    if low is None:
        return spark.createDataFrame([], "bin int, low double, high double, count bigint")
    if low == high:  # a single value gets a unit-wide range around it
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    bin_id = F.least(F.floor((F.col("v") - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = values.groupBy(bin_id.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return edges.join(counts, "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("low"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("high"),
        F.coalesce("n", F.lit(0)).alias("count"),
    )


def is_empty(df: DataFrame) -> bool:
    """Guard before a write: stops at the first row found."""
    return df.isEmpty()


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def count_classes(df: DataFrame, target: str) -> DataFrame:
    """Number of distinct non-null target values.

    The distinct values are grouped before they are counted, which pre-aggregates hot classes.
    """
    return _keyed(df, [target]).select(quote(target)).distinct().agg(F.count(F.lit(1)).alias("n_classes"))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair over rows where both are present; NULL without variation.

    A task reduces its rows to the sums of all pairs, by matrix products on values less their column's mean, and sends one row
    per pair; so wide tables cost matrix products instead of an aggregate per pair.
    """
    names, stats = list(columns), column_stats(df, columns)
    mean = np.array([stats[c].mean or 0.0 for c in names])
    rows, cols = np.triu_indices(len(names), 1)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((6, len(names), len(names)))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float) - mean
            there = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x, posinf=np.inf, neginf=-np.inf)
            square = x * x
            parts = (there.T @ there, x.T @ there, there.T @ x, square.T @ there, there.T @ square, x.T @ x)
            sums += np.stack(parts)
        values = [pa.array(part[rows, cols]) for part in sums]
        pairs = [pa.array(rows.astype(np.int32)), pa.array(cols.astype(np.int32))]
        yield pa.RecordBatch.from_arrays([*pairs, *values], ["i", "j", "n", "x", "y", "xx", "yy", "xy"])

    numbers = df.select(*[F.col(quote(c)).cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    schema = "i int, j int, n double, x double, y double, xx double, yy double, xy double"
    sums = [F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")]
    found = numbers.mapInArrow(reduce, schema).groupBy("i", "j").agg(*sums).withColumn("n", F.nullif("n", F.lit(0.0)))
    spread = F.expr("sqrt(greatest(xx - x * x / n, 0D)) * sqrt(greatest(yy - y * y / n, 0D))")
    labels = F.array(*[F.lit(c) for c in names])
    return found.select(
        F.get(labels, F.col("i")).alias("left"),
        F.get(labels, F.col("j")).alias("right"),
        F.when(spread > 0, F.expr("xy - x * y / n") / spread).alias("correlation"),
    )


@dataclass(frozen=True)
class FillValues:
    """Learned replacement per column; None where the column held no value at all."""

    values: dict[str, float | str | None]


def fit_means(df: DataFrame, columns: Sequence[str]) -> FillValues:
    """Column means of all columns in one pass."""
    return FillValues({c: s.mean for c, s in column_stats(df, columns).items()})


def fit_modes(df: DataFrame, columns: Sequence[str]) -> FillValues:
    """Most frequent value of all columns in one job, the smallest on a tie.

    Values are counted in a shuffled group-by before the best is taken, so no task has to hold
    a column's whole value table.
    """
    types = dict(df.dtypes)
    counts = (
        long_form(df, columns)
        .where("level IS NOT NULL")
        .groupBy("column", "level", "number")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = counts.groupBy("column").agg(F.min(F.struct(-F.col("n"), "number", "level")).alias("best"))
    found = {r["column"]: r["best"] for r in best.collect()}
    modes: dict[str, float | str | None] = {}
    for c in columns:
        value = found.get(c)
        modes[c] = None if value is None else value["number" if types[c] in ("double", "float") else "level"]
    return FillValues(modes)


def impute(df: DataFrame, fill: FillValues) -> DataFrame:
    """Replace NULLs by the learned values; a column without one stays as it is, and text stands for its column's type."""
    known = {c: v for c, v in fill.values.items() if v is not None}
    types = dict(df.dtypes)
    literals = {c: F.lit(v).cast(types[c]) if isinstance(v, str) else F.lit(v) for c, v in known.items()}
    return df.withColumns({c: F.coalesce(F.col(quote(c)), v) for c, v in literals.items()}) if known else df
