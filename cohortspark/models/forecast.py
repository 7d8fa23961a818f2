"""Seasonal forecasts per participant and feature.

The model is a trend plus daily and weekly harmonics, fitted by least squares. Samples are brought together by participant,
and each task reduces its own, in Arrow batches, to the sums of the normal equations; Spark adds those up per series and
segment of time, so a participant with much of the data need not fit one task. Only the finished 16 x 17 sums are solved.

The trend may change its slope where segments meet: within a segment such a bend is a straight line, so the sums of
any bend follow from those of the segments, and one scan is enough. Changes of slope are shrunken by a penalty on
their absolute values, in proportion to the series' noise, which leaves those that aren't needed at zero.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from math import pi

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.functions.scalars import quote

# Fixed values.
FORECAST_FEATURES = ("enmo", "light", "battery_voltage")
DAY = 86_400
DAILY_HARMONICS = 4
WEEKLY_HARMONICS = 3
N_TERMS = 2 + 2 * (DAILY_HARMONICS + WEEKLY_HARMONICS)
RIDGE = 1e-6
BEND_RIDGE = 1e-9  # with bends, whose columns are much alike
MAX_BENDS = 25
BEND_SPAN = 0.8  # bends lie in this first part of a series
BEND_SCALE = 0.05  # expected change of slope, in the series' size per span
SWEEPS = 500


# Period in days and number of harmonics of each seasonality.
_SEASONS = ((1.0, DAILY_HARMONICS), (7.0, WEEKLY_HARMONICS))
_CYCLES = [k / period for period, harmonics in _SEASONS for k in range(1, harmonics + 1)]
# Partial sums a task keeps before it hands them on.
_MAX_OPEN_SERIES = 2048
# Series whose equations, and all that solving them takes, a task holds at once.
SOLVED_AT_ONCE = 256


def sample_time(day: Column | str = "relative_date_PCIAT", time_of_day: Column | str = "time_of_day") -> Column:
    """Seconds on one continuous axis from the relative day and the seconds within it."""
    d = F.col(quote(day)) if isinstance(day, str) else day
    t = F.col(quote(time_of_day)) if isinstance(time_of_day, str) else time_of_day
    return (d * DAY + t).cast("bigint")


def _design(ds: str) -> list[str]:
    """Model terms of a timestamp, as SQL: 1, days, and sine and cosine of every harmonic."""
    days = f"({ds} / {float(DAY)!r}D)"
    waves = [f"{wave}({days} * {2 * pi * c!r}D)" for c in _CYCLES for wave in ("sin", "cos")]
    return ["1D", days, *waves]


def _design_matrix(ds: np.ndarray) -> np.ndarray:
    """The same terms for a batch of timestamps, one row each."""
    days = ds / float(DAY)
    waves = [wave(days * (2 * pi * c)) for c in _CYCLES for wave in (np.sin, np.cos)]
    return np.column_stack([np.ones(len(days)), days, *waves])


def _with_design(df: DataFrame) -> DataFrame:
    """Add the model terms of ``ds`` as columns x0, x1, …"""
    return df.selectExpr("*", *[f"{term} AS x{i}" for i, term in enumerate(_design("ds"))])


_UPPER = np.triu_indices(N_TERMS)
_N_SUMS = len(_UPPER[0]) + N_TERMS + 1  # X'X, X'y and y'y


def _partial_sums(features: Sequence[str], width: int | None) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Reduce a task's batches to one row per (id, segment, feature): count, and X'X, X'y and y'y as one flat array.

    A segment is ``width`` seconds, and its days count from its start. Samples of an id are multiplied out once per set of
    present features; a feature's sums are those of the sets it belongs to. The number of open series is bounded, so a
    task's memory is too.
    """
    k = len(features)
    bits = 1 << np.arange(k)

    def rows(open_sums: dict[tuple[str, int, int], tuple[int, np.ndarray]]) -> pd.DataFrame:
        series: dict[tuple[str, int, int], tuple[int, np.ndarray]] = {}
        for (id_, segment, members), (n, z) in open_sums.items():
            for f in range(k):
                if members & bits[f]:
                    flat = np.concatenate([z[:N_TERMS, :N_TERMS][_UPPER], z[:N_TERMS, N_TERMS + f], z[N_TERMS, f : f + 1]])
                    before = series.get((id_, segment, f), (0, 0.0))
                    series[(id_, segment, f)] = (before[0] + n, before[1] + flat)
        return pd.DataFrame(
            [(id_, segment, features[f], n, sums) for (id_, segment, f), (n, sums) in series.items()],
            columns=["id", "segment", "feature", "n", "g"],
        )

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_sums: dict[tuple[str, int, int], tuple[int, np.ndarray]] = {}
        for batch in batches:
            codes, ids = pd.factorize(batch["id"])
            y = batch[[f"y{f}" for f in range(k)]].to_numpy(dtype=float)
            ds = batch["ds"].to_numpy(dtype=float)
            segment = np.floor(ds / width).astype(np.int64) if width else np.zeros(len(ds), np.int64)
            members = (~np.isnan(y)) @ bits
            order = np.lexsort((members, segment, codes))
            kind = np.column_stack([codes, segment, members])[order]
            starts = np.flatnonzero(np.r_[True, (kind[1:] != kind[:-1]).any(1)]) if len(order) else order
            x = _design_matrix(ds[order])
            x[:, 1] -= segment[order] * ((width or 0) / DAY)
            y = np.nan_to_num(y[order])
            both = np.hstack([x, y])
            for start, end in zip(starts, [*starts[1:], len(order)]):
                code, part, present = kind[start].tolist()
                if not present:
                    continue
                key = (ids[code], part, present)
                n, z = open_sums.get(key, (0, 0.0))
                squares = np.zeros((1, N_TERMS + k))
                squares[0, :k] = (y[start:end] ** 2).sum(0)
                sums = np.vstack([x[start:end].T @ both[start:end], squares])
                open_sums[key] = (n + int(end - start), z + sums)
            if len(open_sums) > _MAX_OPEN_SERIES:
                yield rows(open_sums)
                open_sums = {}
        if open_sums:
            yield rows(open_sums)

    return reduce


_FITTED = "struct<coef: array<double>, bends: array<double>, changes: array<double>>"


def fit_seasonal(
    df: DataFrame,
    features: Sequence[str] = FORECAST_FEATURES,
    key: str = "id",
    ds: str = "ds",
    bend_days: int | None = None,
) -> DataFrame:
    """Coefficients per (id, feature): ``coef`` array, NULL when there are fewer samples than terms.

    With ``bend_days`` the trend may bend at every so many days of the time axis, within the first ``BEND_SPAN`` of the series
    and at most at ``MAX_BENDS`` evenly chosen places: ``bends`` are their days, ``changes`` those of the slope per day. Both
    are empty without it, and for series with fewer samples than terms and bends.
    """
    samples = df.select(
        F.col(quote(key)).alias("id"),
        F.col(quote(ds)).alias("ds"),
        *[F.col(quote(f)).cast("double").alias(f"y{k}") for k, f in enumerate(features)],
    ).where("id IS NOT NULL AND ds IS NOT NULL")
    work = _partial_sums(list(features), bend_days and bend_days * DAY)
    # Sums are far wider than samples, so an id's samples are brought together first; AQE splits an id that holds much of the data,
    # whose sums then still meet below.
    together = samples.hint("rebalance", F.col("id")).sortWithinPartitions("id", "ds")
    partial = together.mapInPandas(work, "id string, segment bigint, feature string, n bigint, g array<double>")
    totals = [F.expr(f"sum(get(g, {i}))").alias(f"g{i}") for i in range(_N_SUMS)]
    normal = partial.groupBy("id", "feature", "segment").agg(F.expr("sum(n)").alias("n"), *totals)
    packed = normal.selectExpr("id", "feature", "n", "segment", f"array({', '.join(f'g{i}' for i in range(_N_SUMS))}) AS g")
    series = packed.groupBy("id", "feature").agg(F.expr("sum(n)").alias("n"), F.sort_array(F.collect_list(F.struct("segment", "n", "g"))).alias("s"))

    @F.pandas_udf(_FITTED)
    def solve(segments: pd.Series) -> pd.DataFrame:
        parts = (segments.iloc[i : i + SOLVED_AT_ONCE] for i in range(0, max(len(segments), 1), SOLVED_AT_ONCE))
        return pd.concat(
            [_solve([[(s["segment"], s["n"], s["g"]) for s in one] for one in part], float(bend_days or 0)) for part in parts], ignore_index=True
        )

    enough = F.when(F.col("n") >= N_TERMS, solve("s"))
    return series.select("id", "feature", "n", enough.alias("m")).select("id", "feature", "n", "m.coef", "m.bends", "m.changes")


def _bend_segments(first: int, last: int) -> np.ndarray:
    """Segments, counted from the first, at whose starts the trend may bend."""
    places = np.arange(1, int(np.ceil(BEND_SPAN * (last - first + 1))))
    if len(places) <= MAX_BENDS:
        return places
    return places[np.linspace(0, len(places) - 1, MAX_BENDS).round().astype(int)]


def _joined_sums(segments: list[tuple], days: float, bends: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """X'X, X'y and y'y of a series from its segments', with a column per bend; days count from the first segment's start."""
    at = np.array([s[0] - segments[0][0] for s in segments])
    sums = np.array([s[2] for s in segments], float)
    gram = np.zeros((len(at), N_TERMS, N_TERMS))
    gram[:, _UPPER[0], _UPPER[1]] = gram[:, _UPPER[1], _UPPER[0]] = sums[:, : len(_UPPER[0])]
    moment = sums[:, len(_UPPER[0]) : -1]
    turn = np.zeros((len(at), N_TERMS + len(bends), N_TERMS))
    turn[:, np.arange(N_TERMS), np.arange(N_TERMS)] = 1.0
    turn[:, 1, 0] = at * days
    since = at[:, None] - bends
    turn[:, N_TERMS:, 0] = np.where(since >= 0, since * days, 0.0)
    turn[:, N_TERMS:, 1] = since >= 0
    return (turn @ gram @ turn.transpose(0, 2, 1)).sum(0), (turn @ moment[:, :, None])[:, :, 0].sum(0), float(sums[:, -1].sum())


def _solve(series: list[list[tuple]], days: float) -> pd.DataFrame:
    """Solve a batch of normal equations, scaled to a unit diagonal, with a small ridge.

    Time is first measured from the series' own mean and in its own spread: far from the origin the level and the trend
    would be one and the same column. Both are exact linear changes of the sums, undone in the coefficients. Bends are
    shrunken on what the other terms leave over, all series of the batch at once.
    """
    count = np.array([sum(s[1] for s in one) for one in series], float)
    bends = [_bend_segments(one[0][0], one[-1][0]) if days else np.zeros(0, int) for one in series]
    bends = [b if n >= N_TERMS + len(b) else b[:0] for b, n in zip(bends, count)]
    most = max(map(len, bends), default=0)
    size = N_TERMS + most
    gram, moment, square = np.zeros((len(series), size, size)), np.zeros((len(series), size)), np.zeros(len(series))
    for i, (one, b) in enumerate(zip(series, bends)):
        own = N_TERMS + len(b)
        gram[i, :own, :own], moment[i, :own], square[i] = _joined_sums(one, days, b)
    n = np.maximum(gram[:, 0, 0], 1.0)
    mean = gram[:, 0, 1] / n
    spread = np.sqrt(np.maximum(gram[:, 1, 1] / n - mean**2, 0.0))
    spread[spread < 1e-9] = 1.0
    change = np.tile(np.eye(size), (len(series), 1, 1))
    change[:, 1, 0], change[:, 1, 1] = -mean / spread, 1 / spread
    turned = np.swapaxes(change, 1, 2)
    gram, moment = change @ gram @ turned, (change @ moment[:, :, None])[:, :, 0]
    scale = np.sqrt(np.einsum("nii->ni", gram))
    scale[scale == 0] = 1.0
    scaled = gram / scale[:, :, None] / scale[:, None, :] + (BEND_RIDGE if days else RIDGE) * np.eye(size)
    moment = moment / scale
    solution = np.linalg.solve(scaled, moment[:, :, None])[:, :, 0]
    if most:
        noise = np.maximum(square - (solution * moment).sum(1), 0.0) / n
        span = np.array([(one[-1][0] - one[0][0] + 1) * days for one in series])
        penalty = noise * span / (BEND_SCALE * np.sqrt(np.maximum(square / n, 1e-300)))
        solution = _shrunken(scaled, moment, solution, penalty[:, None] / scale[:, N_TERMS:])
    solution = (turned @ (solution / scale)[:, :, None])[:, :, 0]
    start = np.array([one[0][0] * days for one in series])
    solution[:, 0] -= solution[:, 1] * start
    rows = [
        (x[:N_TERMS].tolist(), ((one[0][0] + b) * days).tolist(), x[N_TERMS : N_TERMS + len(b)].tolist())
        for one, x, b in zip(series, solution, bends)
    ]
    return pd.DataFrame(rows, columns=["coef", "bends", "changes"])


def _shrunken(gram: np.ndarray, moment: np.ndarray, start: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    """Least squares with a penalty on the absolute values of the bends, by coordinate descent on the sums."""
    plain, mixed = gram[:, :N_TERMS, :N_TERMS], gram[:, :N_TERMS, N_TERMS:]
    taken = np.linalg.solve(plain, np.concatenate([mixed, moment[:, :N_TERMS, None]], axis=2))
    left = gram[:, N_TERMS:, N_TERMS:] - np.swapaxes(mixed, 1, 2) @ taken[:, :, :-1]
    target = moment[:, N_TERMS:] - (np.swapaxes(mixed, 1, 2) @ taken[:, :, -1:])[:, :, 0]
    own = np.maximum(np.einsum("nii->ni", left), BEND_RIDGE / 2)
    bend = start[:, N_TERMS:].copy()
    for _ in range(SWEEPS):
        before = bend.copy()
        for j in range(bend.shape[1]):
            pull = target[:, j] - (left[:, j] * bend).sum(1) + left[:, j, j] * bend[:, j]
            bend[:, j] = np.sign(pull) * np.maximum(np.abs(pull) - penalty[:, j], 0.0) / own[:, j]
        if np.abs(bend - before).max() <= 1e-10 * np.abs(bend).max(initial=1e-300):
            break
    rest = taken[:, :, -1] - (taken[:, :, :-1] @ bend[:, :, None])[:, :, 0]
    return np.concatenate([rest, bend], axis=1)


def future_frame(df: DataFrame, periods: int = 7, key: str = "id", ds: str = "ds") -> DataFrame:
    """Distinct (id, ds) of the history, followed by ``periods`` daily steps after the last one."""
    history = df.select(F.col(quote(key)).alias("id"), F.col(quote(ds)).alias("ds")).where(
        "id IS NOT NULL AND ds IS NOT NULL"
    )
    steps = F.transform(F.sequence(F.lit(1), F.lit(periods)), lambda i: F.col("last") + i * F.lit(DAY))
    ahead = history.groupBy("id").agg(F.max("ds").alias("last")).select("id", F.explode(steps).alias("ds"))
    return history.distinct().withColumn("is_future", F.lit(False)).unionByName(
        ahead.withColumn("is_future", F.lit(True))
    )


def forecast_by_group(
    df: DataFrame,
    features: Sequence[str] = FORECAST_FEATURES,
    periods: int = 7,
    key: str = "id",
    ds: str = "ds",
    bend_days: int | None = 7,
) -> DataFrame:
    """Fitted values at every distinct timestamp and ``periods`` daily steps ahead.

    One row per (id, ds) with a ``<feature>_forecast`` column per feature. The trend may bend every ``bend_days`` days (None: it
    is straight); the last slope goes on into the future.
    """
    fitted = fit_seasonal(df, features, key, ds, bend_days).withColumn("m", F.when(F.col("coef").isNotNull(), F.struct("coef", "bends", "changes")))
    coef = fitted.groupBy("id").agg(*[F.max(F.when(F.col("feature") == f, F.col("m"))).alias(f"_m{k}") for k, f in enumerate(features)])
    # One coefficient row per id; AQE splits an id with many timestamps when the join has to shuffle.
    joined = _with_design(future_frame(df, periods, key, ds).join(coef, "id", "left"))

    def value(k: int) -> Column:
        terms = " + ".join(f"x{i} * get(_m{k}.coef, {i})" for i in range(N_TERMS))
        bent = f"zip_with(_m{k}.bends, _m{k}.changes, (b, c) -> c * greatest(x1 - b, 0D))"
        return F.expr(f"{terms} + aggregate({bent}, 0D, (a, v) -> a + v)")

    return joined.select("id", "ds", "is_future", *[value(k).alias(f"{f}_forecast") for k, f in enumerate(features)])


def daily_forecast(forecast: DataFrame, features: Sequence[str] = FORECAST_FEATURES) -> DataFrame:
    """Forecasts averaged per participant and relative day, ready to join to daily rows."""
    day = F.floor(F.col("ds") / F.lit(DAY)).cast("double").alias("relative_date_PCIAT")
    return forecast.groupBy("id", day).agg(*[F.avg(f"{f}_forecast").alias(f"{f}_forecast") for f in features])
