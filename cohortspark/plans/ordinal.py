"""The ordinal run: score, cutpoints tuned on held-out rows, and metrics on the rows after that."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.functions.scalars import quote, threshold_round
from cohortspark.models import metrics
from cohortspark.models.thresholds import ThresholdFit, optimize_thresholds
from cohortspark.models.trees import eval_by_iteration, score_batch, train_ordinal_score
from cohortspark.operators.clean import filter_not_null
from cohortspark.operators.encode import fit_encoder
from cohortspark.operators.split import split_three_way, take
from cohortspark.plans.cohort import relevant_numeric
from cohortspark.schemas import CohortSpec


@dataclass(frozen=True)
class OrdinalRun:
    model: PipelineModel
    thresholds: ThresholdFit
    by_round: DataFrame
    scored: DataFrame
    report: DataFrame
    accuracy: DataFrame
    kappa: DataFrame


def train_ordinal(
    df: DataFrame, spec: CohortSpec, passthrough: Sequence[str] = (), n_classes: int = 4, seed: int = 42, **boosting
) -> OrdinalRun:
    """Train on 70 % of the labelled rows, tune cutpoints and watch the rounds on 15 %, and report on the last 15 %.

    The encoded rows are kept until the run is done, as boosting passes over them many times; nothing is learnt from rows
    outside the training part.
    """
    labelled = split_three_way(filter_not_null(df, spec.target), spec.target, spec.key, seed=seed)
    encoder = fit_encoder(take(labelled, "train"), relevant_numeric(spec), spec.categorical, passthrough)
    rows = encoder.assemble(labelled).select(spec.key, spec.target, "split", "features").persist()
    try:
        booster = train_ordinal_score(take(rows, "train"), spec.target, **boosting)
        tuned = score_batch(booster, take(rows, "validation"))
        fit = optimize_thresholds(tuned, spec.target, "prediction", n_classes=n_classes, high=float(n_classes - 1))
        by_round = eval_by_iteration(booster, take(rows, "validation"), spec.target, fit.thresholds)
        scored = score_batch(booster, take(rows, "test")).select(
            spec.key,
            F.col(quote(spec.target)).cast("int").alias("actual"),
            threshold_round("prediction", fit.thresholds).alias("predicted"),
        )
        counts = metrics.collected_confusion(scored, "actual", "predicted")
    finally:
        rows.unpersist()
    columns = {"actual": "actual", "predicted": "predicted", "count": "count"}
    return OrdinalRun(
        PipelineModel(stages=[*encoder.stages(), booster]),
        fit,
        by_round,
        scored,
        metrics.classification_report(counts, **columns),
        metrics.accuracy(counts, **columns),
        metrics.quadratic_kappa(counts, **columns),
    )
