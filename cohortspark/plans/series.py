"""Series features per participant and per day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.models.forecast import FORECAST_FEATURES, daily_forecast, forecast_by_group, sample_time
from cohortspark.operators.aggregates import daily_summary, participant_profile
from cohortspark.operators.joins import left_join
from cohortspark.operators.windows import add_lag, add_rolling_mean


def participant_features(series: DataFrame, unit: str = "s") -> DataFrame:
    """Summary, period profile and non-wear ratio: one row per (id, weekday flag) that occurs."""
    return participant_profile(series, unit)


def daily_features(series: DataFrame, forecast: bool = True, periods: int = 7) -> DataFrame:
    """Daily summary with lag and rolling columns, and the daily means of the seasonal forecasts."""
    daily = add_rolling_mean(add_lag(daily_summary(series)))
    if not forecast:
        return daily
    timed = series.select("id", sample_time().alias("ds"), *FORECAST_FEATURES)
    per_day = daily_forecast(forecast_by_group(timed, periods=periods))
    typed = daily.withColumn("relative_date_PCIAT", F.col("relative_date_PCIAT").cast("double"))
    return left_join(typed, per_day, ["id", "relative_date_PCIAT"])
