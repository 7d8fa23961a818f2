"""One-hot encoding, scaling and feature assembly."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.functions.scalars import quote
from cohortspark.operators.sizing import fit_levels
from cohortspark.operators.stats import column_stats

__all__ = ["FeatureEncoder", "Scaler", "fit_encoder", "fit_levels", "fit_scaler", "one_hot", "scale"]


def one_hot(df: DataFrame, levels: Mapping[str, Sequence[str]], drop_first: bool = False) -> DataFrame:
    """A 0/1 column ``<column>_<level>`` per level; NULL and values outside the levels give all zeros."""
    flags = {
        f"{c}_{level}": F.when(F.col(quote(c)).cast("string") == level, 1).otherwise(0)
        for c, values in levels.items()
        for level in values[1 if drop_first else 0 :]
    }
    return df.withColumns(flags) if flags else df


@dataclass(frozen=True)
class Scaler:
    """Column means and population standard deviations; 1 where the deviation is zero."""

    mean: dict[str, float | None]
    std: dict[str, float | None]


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> Scaler:
    """Means and population deviations of all columns in one pass."""
    stats = column_stats(df, columns)
    return Scaler({c: s.mean for c, s in stats.items()}, {c: _divisor(s.deviation) for c, s in stats.items()})


def _divisor(deviation: float | None) -> float | None:
    return 1.0 if deviation == 0 else deviation


def _standardised(c: str, scaler: Scaler) -> Column:
    if scaler.mean[c] is None:  # nothing but NULLs
        return F.lit(None).cast("double")
    return (F.col(quote(c)) - F.lit(scaler.mean[c])) / F.lit(scaler.std[c])


def scale(df: DataFrame, scaler: Scaler) -> DataFrame:
    """(value - mean) / deviation, in place."""
    return df.withColumns({c: _standardised(c, scaler) for c in scaler.mean})


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class FeatureEncoder:
    """Fitted preprocessing: scaled numerics, one-hot categoricals, other columns passed through.

    A NULL numeric is taken at its column mean (0 after scaling); NULL or unseen categories give zeros.
    """

    scaler: Scaler
    levels: dict[str, list[str]]
    passthrough: tuple[str, ...]
    passthrough_mean: dict[str, float | None]
    drop_first: bool = False

    def _numbers(self) -> dict[str, str]:
        """SQL of every slot that is one number: scaled columns, then those passed through."""
        slots = {}
        for c in self.scaler.mean:
            mean, std = self.scaler.mean[c], self.scaler.std[c]
            slots[c] = "0D" if mean is None else f"coalesce(({quote(c)} - ({mean!r}D)) / {std!r}D, 0D)"
        for c in self.passthrough:
            slots[c] = f"coalesce(cast({quote(c)} as double), {self.passthrough_mean[c] or 0.0!r}D)"
        return slots

    def _encoded(self) -> dict[str, list[str]]:
        """Levels with a place in the vector."""
        kept = {c: values[1 if self.drop_first else 0 :] for c, values in self.levels.items()}
        return {c: values for c, values in kept.items() if values}

    @property
    def names(self) -> list[str]:
        levels = [f"{c}_{level}" for c, values in self._encoded().items() for level in values]
        return [*self.scaler.mean, *levels, *self.passthrough]

    def _helpers(self) -> list[str]:
        numbers = len(self._numbers())
        coded = len(self._encoded())
        return [*(f"_f{i}" for i in range(numbers)), *(f"_{k}{i}" for i in range(coded) for k in "cv")]

    def stages(self, output: str = "features") -> list:
        """Transformers for an ML pipeline; plain SQL text, so a saved pipeline carries the statistics.

        A level is one lookup and one place of a sparse vector, so the number of levels doesn't matter. Codes beyond the
        levels stand for NULL and unseen values, which the encoder turns into zeros.
        """
        numbers, encoded = self._numbers(), self._encoded()
        select = [f"{sql} AS _f{i}" for i, sql in enumerate(numbers.values())]
        for i, (c, values) in enumerate(encoded.items()):
            place = f"array_position(array({', '.join(map(_text, values))}), cast({quote(c)} as string))"
            select.append(f"cast(coalesce(nullif({place}, 0) - 1, {len(values)}) as double) AS _c{i}")
        stages: list = [SQLTransformer(statement=f"SELECT {', '.join(['*', *select])} FROM __THIS__")]
        if encoded:
            codes, vectors = [f"_c{i}" for i in range(len(encoded))], [f"_v{i}" for i in range(len(encoded))]
            spark = SparkSession.active()
            largest = spark.createDataFrame(
                [tuple(float(len(v) - 1) for v in encoded.values())], ", ".join(f"{c} double" for c in codes)
            )
            stages.append(OneHotEncoder(inputCols=codes, outputCols=vectors, handleInvalid="keep", dropLast=True).fit(largest))
        scaled = len(self.scaler.mean)
        inputs = [f"_f{i}" for i in range(scaled)] + [f"_v{i}" for i in range(len(encoded))]
        inputs += [f"_f{i}" for i in range(scaled, len(numbers))]
        return [*stages, VectorAssembler(inputCols=inputs, outputCol=output)]

    def assemble(self, df: DataFrame, output: str = "features") -> DataFrame:
        """Add the feature vector and drop the per-slot helper columns."""
        return PipelineModel(stages=self.stages(output)).transform(df).drop(*self._helpers())


def fit_encoder(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    passthrough: Sequence[str] = (),
    drop_first: bool = False,
) -> FeatureEncoder:
    """Learn scaling and levels on ``df``: one aggregate and one distinct job."""
    measured = fit_scaler(df, [*numeric, *passthrough])
    scaler = Scaler({c: measured.mean[c] for c in numeric}, {c: measured.std[c] for c in numeric})
    levels = fit_levels(df, categorical) if categorical else {}
    return FeatureEncoder(
        scaler, levels, tuple(passthrough), {c: measured.mean[c] for c in passthrough}, drop_first
    )
