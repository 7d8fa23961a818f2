"""Lag and rolling means over daily rows. The window groups are a participant's days, not samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortspark.functions.scalars import quote

TREND_COLUMNS = ("enmo_mean", "light_mean", "battery_voltage_mean")


def _by_day(key: str, order: str):
    return Window.partitionBy(quote(key)).orderBy(quote(order))


def add_lag(
    df: DataFrame,
    columns: Sequence[str] = TREND_COLUMNS,
    key: str = "id",
    order: str = "relative_date_PCIAT",
    offset: int = 1,
) -> DataFrame:
    w = _by_day(key, order)
    return df.withColumns({f"{c}_lag{offset}": F.lag(quote(c), offset).over(w) for c in columns})


def add_rolling_mean(
    df: DataFrame,
    columns: Sequence[str] = TREND_COLUMNS,
    key: str = "id",
    order: str = "relative_date_PCIAT",
    size: int = 3,
) -> DataFrame:
    """Mean of the current and preceding rows; NULL unless the frame holds ``size`` non-null values."""
    w = _by_day(key, order).rowsBetween(1 - size, 0)
    means = {
        f"{c}_rolling{size}": F.when(F.count(quote(c)).over(w) == size, F.avg(quote(c)).over(w)) for c in columns
    }
    return df.withColumns(means)
