"""Column functions. All are built-in expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values.
DAY_PARTS = ("night", "morning", "afternoon", "evening", "unknown")
WEEKDAY_FLAGS = ("weekday", "weekend")
# Fixed values.
DEFAULT_THRESHOLDS = (0.5, 1.5, 2.5, 3.5)

_INF = float("inf")
# Timestamps outside the nanosecond range of a 64-bit epoch count as bad values.
_MAX_EPOCH_SECONDS = 9223372036.0
_MILLISECOND_CUTOFF = 1e12


def _col(c: Column | str) -> Column:
    return F.col(quote(c)) if isinstance(c, str) else c


def quote(name: str) -> str:
    """Backtick a column name: cohort names contain hyphens."""
    return "`" + name.replace("`", "``") + "`"


def cut(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label right-closed intervals ``(edge, next edge]``; values outside all of them become NULL."""
    c = _col(c)
    out = F.lit(None).cast("string")
    for low, high, label in reversed(list(zip(edges[:-1], edges[1:], labels, strict=True))):
        out = F.when((c > F.lit(float(low))) & (c <= F.lit(float(high))), F.lit(label)).otherwise(out)
    return out


# Interval edges and their labels.
def age_group(age: Column | str) -> Column:
    return cut(age, [0, 12, 17, 25], ["Child", "Teen", "Young Adult"])


def questionnaire_bin(total: Column | str) -> Column:
    return cut(total, [0, 20, 40, 60], ["Mild", "Moderate", "Severe"])


def internet_use_category(hours: Column | str) -> Column:
    return cut(hours, [0, 1, 3, 6, _INF], ["Low", "Moderate", "High", "Very High"])


def bmi_category(bmi: Column | str) -> Column:
    return cut(bmi, [0, 18.5, 25, 30, _INF], ["Underweight", "Normal", "Overweight", "Obese"])


def severity_index(total: Column | str) -> Column:
    """Documented target derivation: 0-30, 31-49, 50-79 and 80-100 give 0, 1, 2 and 3."""
    t = _col(total)
    return (
        F.when((t >= 0) & (t < 31), 0.0)
        .when((t >= 31) & (t < 50), 1.0)
        .when((t >= 50) & (t < 80), 2.0)
        .when((t >= 80) & (t <= 100), 3.0)
    )


def weekday_flag(weekday: Column | str, labels: Sequence = WEEKDAY_FLAGS) -> Column:
    """``weekday`` below 5, otherwise ``weekend`` (also for NULL)."""
    return F.when(_col(weekday) < 5, F.lit(labels[0])).otherwise(F.lit(labels[1]))


def day_part(time_of_day: Column | str, unit: str = "s", labels: Sequence = DAY_PARTS) -> Column:
    """Six-hour part of the day; ``unit`` is ``s`` or ``ms``; NULL gives ``unknown``."""
    hour = 3600 * {"s": 1, "ms": 1000}[unit]
    t = _col(time_of_day)
    night, morning, afternoon, evening, unknown = (F.lit(label) for label in labels)
    return (
        F.when(t < 6 * hour, night)
        .when(t < 12 * hour, morning)
        .when(t < 18 * hour, afternoon)
        .when(t >= 18 * hour, evening)
        .otherwise(unknown)
    )


def age_adjusted_score(score: Column | str, age: Column | str) -> Column:
    """score / age; NULL rather than an error when age is zero."""
    return F.try_divide(_col(score), _col(age))


def scale_prediction(prediction: Column | str, factor: float = 1.3) -> Column:
    return _col(prediction) * F.lit(float(factor))


def register_multiplier(spark: SparkSession, name: str, factor: float = 1.2) -> str:
    """Register a SQL function ``name(x DOUBLE)`` that is NULL-safe and inlined by the optimizer."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x DOUBLE) RETURNS DOUBLE RETURN x * {float(factor)!r}D")
    return name


def epoch_to_timestamp(df: DataFrame, source: str, target: str) -> DataFrame:
    """Epoch seconds to timestamp, or milliseconds when the column's maximum exceeds 1e12; bad values become NULL.

    The maximum is an uncorrelated scalar subquery: one partial-aggregated number, no join.
    """
    number = F.col(quote(source)).try_cast("double")
    # A leading scan for one max; parquet column pruning keeps it to a single column.
    is_millis = df.select(F.max(number).alias("m")).scalar() > F.lit(_MILLISECOND_CUTOFF)
    seconds = F.when(is_millis, number / F.lit(1000.0)).otherwise(number)
    valid = F.abs(seconds) <= F.lit(_MAX_EPOCH_SECONDS)
    return df.withColumn(target, F.timestamp_micros(F.when(valid, F.round(seconds * F.lit(1e6))).cast("bigint")))


def id_from_path(path: Column | str) -> Column:
    """Text after the last ``=`` of a path, without slashes at its ends."""
    return F.trim(F.substring_index(_col(path), "=", -1), F.lit("/"))


def argmax_class(probabilities: Column | str) -> Column:
    """Index of the largest array element, the first one on a tie."""
    p = _col(probabilities)
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def threshold_round(score: Column | str, thresholds: Sequence[float] = DEFAULT_THRESHOLDS) -> Column:
    """Number of the first threshold the score lies strictly below; the last class beyond them all."""
    s = _col(score)
    out = F.lit(len(thresholds))
    for k in reversed(range(len(thresholds))):
        out = F.when(s < F.lit(float(thresholds[k])), F.lit(k)).otherwise(out)
    return F.when(s.isNotNull(), out).cast("int")


def round_class(score: Column | str) -> Column:
    """Nearest class, halves to the even one."""
    return F.bround(_col(score), 0).cast("int")
