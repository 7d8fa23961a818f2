"""Training sets by feature lookup, and the train-and-evaluate run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.functions.scalars import quote
from cohortspark.models import metrics
from cohortspark.models.trees import FOREST_PARAMS, score_batch, train_random_forest
from cohortspark.operators.clean import filter_not_null
from cohortspark.operators.encode import fit_encoder
from cohortspark.operators.joins import feature_lookup
from cohortspark.plans.cohort import relevant_numeric
from cohortspark.schemas import CohortSpec

# Fixed values.
LOOKUP_FEATURES = ("X_mean", "Y_mean", "Z_mean", "battery_voltage_mean")
# Fixed values.
EXCLUDED = ("update_timestamp_utc", "timestamp")


def create_training_set(
    df: DataFrame,
    features: DataFrame,
    names: Sequence[str] = LOOKUP_FEATURES,
    functions: Mapping[str, tuple[str, Mapping[str, str]]] | None = None,
    key: str = "id",
    exclude: Sequence[str] = EXCLUDED,
) -> DataFrame:
    """Look features up by key, then add ``output: (function, {argument: column})`` function columns.

    Functions are registered SQL functions; they are inlined into the plan.
    """
    out = feature_lookup(df, features, names, key, exclude)
    for output, (function, bindings) in (functions or {}).items():
        arguments = ", ".join(f"{arg} => {quote(column)}" for arg, column in bindings.items())
        out = out.withColumn(output, F.expr(f"{function}({arguments})"))
    return out


@dataclass(frozen=True)
class TrainedRun:
    model: PipelineModel
    scored: DataFrame
    report: DataFrame
    accuracy: float | None
    kappa: float | None
    feature_names: list[str]


def train_and_evaluate(
    train: DataFrame,
    test: DataFrame,
    spec: CohortSpec,
    passthrough: Sequence[str] = (),
    include_leaky: bool = False,
    **forest: int,
) -> TrainedRun:
    """Encode, train a balanced random forest on the labelled training rows, and score the test rows.

    Fitting passes over the training rows several times, so they are kept (in memory, spilling to disk)
    until the forest is built.
    """
    held_out = filter_not_null(test, spec.target)
    labelled = filter_not_null(train, spec.target).persist()
    try:
        encoder = fit_encoder(labelled, relevant_numeric(spec, include_leaky), spec.categorical, passthrough)
        features = encoder.assemble(labelled).select(spec.target, "features")
        classifier = train_random_forest(features, spec.target, **{**FOREST_PARAMS, **forest})
    finally:
        labelled.unpersist()
    model = PipelineModel(stages=[*encoder.stages(), classifier])
    scored = score_batch(model, held_out).select(
        spec.key, F.col(quote(spec.target)).cast("int").alias("actual"), "predicted_class", "probabilities"
    )
    # The test rows are scored once; every metric works on the class counts.
    counts = metrics.collected_confusion(scored, "actual", "predicted_class")
    columns = {"actual": "actual", "predicted": "predicted", "count": "count"}
    return TrainedRun(
        model,
        scored,
        metrics.classification_report(counts, **columns),
        metrics.accuracy(counts, **columns).first()["accuracy"],
        metrics.quadratic_kappa(counts, **columns).first()["kappa"],
        encoder.names,
    )
