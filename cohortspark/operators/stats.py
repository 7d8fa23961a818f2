"""Statistics of many columns in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.functions.scalars import quote

# Spark compiles an aggregate into one loop only up to this many fields; eight are used per column.
_MAX_CODEGEN_FIELDS = 100
_FIELDS_PER_COLUMN = 8


@dataclass(frozen=True)
class ColumnStats:
    """Population statistics of the non-null values; ``mean`` and ``variance`` are None without any."""

    rows: int
    count: int
    mean: float | None
    variance: float | None

    @property
    def deviation(self) -> float | None:
        return None if self.variance is None else self.variance**0.5

    @property
    def filled_deviation(self) -> float | None:
        """Deviation once NULLs are filled with the mean, which adds rows but no squared deviation."""
        return None if self.variance is None else (self.variance * self.count / self.rows) ** 0.5


def column_stats(df: DataFrame, columns: Sequence[str]) -> dict[str, ColumnStats]:
    """Count, mean and population variance per column, from one scan and one shuffle of partial results.

    A constant column gets variance 0 by its minimum and maximum: its computed variance may miss zero by
    a rounding error. Few columns become one wide aggregate. Many are unpivoted inside the map tasks and
    grouped by column number, because an aggregate beyond the field limit is no longer compiled.
    """

    def measures(c: str) -> list:
        v = F.col(c).cast("double")
        constant = F.min(v) == F.max(v)
        return [F.count(F.lit(1)), F.count(v), F.avg(v), F.when(constant, 0.0).otherwise(F.var_pop(v))]

    if len(columns) * _FIELDS_PER_COLUMN < _MAX_CODEGEN_FIELDS:
        flat = df.agg(*[m.alias(f"s{i}_{j}") for i, c in enumerate(columns) for j, m in enumerate(measures(quote(c)))])
        values = list(flat.first())
        return {c: ColumnStats(*values[4 * i : 4 * i + 4]) for i, c in enumerate(columns)}
    cells = ", ".join(f"{i}, cast({quote(c)} as double)" for i, c in enumerate(columns))
    long = df.selectExpr(f"stack({len(columns)}, {cells}) AS (i, v)")
    named = [m.alias(f"s{j}") for j, m in enumerate(measures("v"))]
    found = {row["i"]: ColumnStats(*row[1:]) for row in long.groupBy("i").agg(*named).collect()}
    empty = ColumnStats(0, 0, None, None)
    return {c: found.get(i, empty) for i, c in enumerate(columns)}
