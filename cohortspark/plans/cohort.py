"""Cohort preparation: raw wide table to model-ready rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from cohortspark.functions import scalars
from cohortspark.operators import clean
from cohortspark.operators.aggregates import FillValues, fit_modes, impute
from cohortspark.operators.encode import Scaler, fit_levels, one_hot, scale
from cohortspark.operators.stats import column_stats
from cohortspark.schemas import CohortSpec

DERIVED = ("Age_Group", "PCIAT_Bin", "Internet_Use_Category", "Age_Adjusted_CGAS", "BMI_Category")
MISSING_TARGET = 4.0


@dataclass(frozen=True)
class CohortStats:
    """What preparation learns: column means, deviations after filling, modes and season levels."""

    means: FillValues
    modes: FillValues
    scaler: Scaler
    levels: dict[str, list[str]]


def clean_types(df: DataFrame, spec: CohortSpec) -> DataFrame:
    """Add listed columns the table lacks, and turn text in numeric columns into numbers or NULL."""
    with_all = clean.add_missing_columns(df, [*spec.numeric, spec.target])
    with_all = clean.add_missing_columns(with_all, spec.categorical, "string")
    return clean.coerce_numeric(with_all, spec.numeric)


def fit_cohort(df: DataFrame, spec: CohortSpec) -> CohortStats:
    """Learn all statistics: one pass for the numerics, one counting job for the modes, one for levels."""
    typed = clean_types(df, spec)
    stats = column_stats(typed, spec.numeric)
    means: dict[str, float | str | None] = {c: s.mean for c, s in stats.items()}
    return CohortStats(
        FillValues(means),
        fit_modes(typed, spec.categorical),
        Scaler(dict(means), {c: 1.0 if s.filled_deviation == 0 else s.filled_deviation for c, s in stats.items()}),
        fit_levels(typed, spec.seasons) if spec.seasons else {},
    )


def add_features(df: DataFrame, spec: CohortSpec, levels: dict[str, list[str]]) -> DataFrame:
    """Bins, one-hot seasons, age-adjusted score and BMI class; each only if its inputs are features."""
    have = set(spec.numeric)
    derived = {
        "Age_Group": ([spec.age], scalars.age_group(spec.age)),
        "PCIAT_Bin": ([spec.total], scalars.questionnaire_bin(spec.total)),
        "Internet_Use_Category": ([spec.hours], scalars.internet_use_category(spec.hours)),
        "Age_Adjusted_CGAS": (
            [spec.function_score, spec.age],
            scalars.age_adjusted_score(spec.function_score, spec.age),
        ),
        "BMI_Category": ([spec.bmi], scalars.bmi_category(spec.bmi)),
    }
    usable = {name: column for name, (inputs, column) in derived.items() if have.issuperset(inputs)}
    return one_hot(df.withColumns(usable) if usable else df, levels)


def apply_cohort(
    df: DataFrame,
    spec: CohortSpec,
    stats: CohortStats,
    scaled: bool = True,
    keep_engineered: bool = False,
    missing_target: float | None = MISSING_TARGET,
) -> DataFrame:
    """Fill, label the sex, derive features, scale, fill the target and select. Map-only: no shuffle.

    Without ``keep_engineered`` only key, features and target remain. ``missing_target=None`` leaves
    unlabelled rows NULL.
    """
    filled = impute(impute(clean_types(df, spec), stats.means), stats.modes)
    if spec.sex in spec.categorical:
        filled = clean.map_codes(filled, spec.sex, spec.sex_labels)
    out = add_features(filled, spec, stats.levels)
    engineered = [c for c in out.columns if c not in filled.columns] if keep_engineered else []
    if scaled:
        out = scale(out, stats.scaler)
    if missing_target is not None:
        out = clean.fill_constant(out, missing_target, [spec.target])
    return clean.select_features(out, spec, engineered)


def prepare_cohort(df: DataFrame, spec: CohortSpec, fit_on: DataFrame | None = None, **options) -> DataFrame:
    """Fit on ``fit_on`` (all rows unless given, e.g. the training part) and apply to ``df``."""
    return apply_cohort(df, spec, fit_cohort(df if fit_on is None else fit_on, spec), **options)


def relevant_numeric(spec: CohortSpec, include_leaky: bool = False) -> Sequence[str]:
    """Numeric model inputs; the columns the target is computed from are left out unless asked for."""
    return [c for c in spec.numeric if include_leaky or c not in spec.leaky]
