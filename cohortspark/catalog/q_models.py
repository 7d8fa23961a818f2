"""Metric, threshold, training and forecast queries.

All models are trained with the tuned parameters, the functions' defaults. A model has no SQL counterpart, so its query returns
what a right one must show: its scores are those of its exported trees, descended by joins that share no code with the model, and
on the rows it learnt from it is right clearly more often than a guess (a score: its squared error is below the label's variance;
``trees.has_learnt``). A stump or a model of other labels fails that.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.catalog.adapters import SUBJECT_SPEC, predictions, series, subjects
from cohortspark.catalog.q_encode import RANKED_SQL, split_cte
from cohortspark.catalog.registry import query, rnd
from cohortspark.functions import scalars
from cohortspark.models import boosting, forecast, metrics, thresholds, trees
from cohortspark.models.trees import spread
from cohortspark.operators import aggregates, encode, joins, profile, split
from cohortspark.operators.clean import filter_not_null
from cohortspark.operators.numbering import ordered_row_id
from cohortspark.plans import ordinal
from cohortspark.plans.cohort import relevant_numeric
from cohortspark.session import scratch_path
from cohortspark.sources import readers, writers

_BOTH = "actual IS NOT NULL AND predicted IS NOT NULL"


@query("accuracy", f"SELECT {rnd('avg(CASE WHEN actual = predicted THEN 1.0e0 ELSE 0.0e0 END)', 'accuracy')} FROM predictions WHERE {_BOTH}")
def accuracy(spark, sf):
    return metrics.accuracy(predictions(spark, sf), "actual", "predicted")


@query("confusion_matrix", f'SELECT actual, predicted, count(*) AS "count" FROM predictions WHERE {_BOTH} GROUP BY 1, 2')
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(predictions(spark, sf), "actual", "predicted")


_REPORT_SQL = f""", rated AS (SELECT actual, predicted FROM predictions WHERE {_BOTH}),
  names AS (SELECT actual AS c FROM rated UNION SELECT predicted FROM rated),
  counts AS (SELECT c, (SELECT count(*) FROM rated WHERE actual = c) AS support,
      (SELECT count(*) FROM rated WHERE predicted = c) AS assigned,
      (SELECT count(*) FROM rated WHERE actual = c AND predicted = c) AS hits FROM names),
  rates AS (SELECT *, CASE WHEN assigned = 0 THEN 0 ELSE hits / assigned END AS p,
      CASE WHEN support = 0 THEN 0 ELSE hits / support END AS r FROM counts),
  scores AS (SELECT *, CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END AS f FROM rates),
  report AS (
    SELECT 0 AS section, CAST(c AS VARCHAR) AS label, p, r, f, support FROM scores
    UNION ALL SELECT 1, 'accuracy', NULL, NULL, sum(hits) / sum(support), sum(support) FROM scores
    UNION ALL SELECT 2, 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM scores
    UNION ALL SELECT 3, 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
      sum(f * support) / sum(support), sum(support) FROM scores)
  SELECT CAST(section AS INT) AS section, label, {rnd('p', 'precision')}, {rnd('r', 'recall')}, {rnd('f', 'f1')},
    CAST(support AS BIGINT) AS support FROM report"""


@query("classification_report", _REPORT_SQL)
def classification_report(spark, sf):
    return metrics.classification_report(predictions(spark, sf), "actual", "predicted")


_KAPPA = (
    "1 - sum(n * (a - p) * (a - p)) / (sum(n * (a * a + p * p)) - 2 * sum(n * a) * sum(n * p) / CAST(sum(n) AS DOUBLE))"
)


@query(
    "quadratic_kappa",
    f""", rated AS (SELECT actual, predicted FROM predictions WHERE {_BOTH}),
      names AS (SELECT c, row_number() OVER (ORDER BY c) - 1 AS place
                FROM (SELECT actual AS c FROM rated UNION SELECT predicted FROM rated)),
      n AS (SELECT count(*) AS total FROM rated),
      rows_of AS (SELECT c, count(*) AS k FROM rated JOIN names ON actual = c GROUP BY c),
      columns_of AS (SELECT c, count(*) AS k FROM rated JOIN names ON predicted = c GROUP BY c)
    SELECT round(1 - (SELECT sum((a.place - p.place) ** 2) FROM rated
        JOIN names a ON actual = a.c JOIN names p ON predicted = p.c)
      / (SELECT sum(r.k * s.k * (a.place - p.place) ** 2) / (SELECT CAST(total AS DOUBLE) FROM n)
        FROM rows_of r JOIN names a ON r.c = a.c CROSS JOIN columns_of s JOIN names p ON s.c = p.c), 9) AS kappa""",
)
def quadratic_kappa(spark, sf):
    return metrics.quadratic_kappa(predictions(spark, sf), "actual", "predicted")


def _grid_sql(comparison: str) -> str:
    """Kappa of every candidate, straight from the scored rows."""
    order = " AND ".join(f"c{i}.t {comparison} c{i + 1}.t" for i in range(1, 4))
    return f""", cuts AS (SELECT i * 0.25e0 AS t FROM range(1, 16) r(i)),
      grid AS (SELECT c1.t AS t1, c2.t AS t2, c3.t AS t3, c4.t AS t4
               FROM cuts c1, cuts c2, cuts c3, cuts c4 WHERE {order}),
      counted AS (SELECT actual AS a, floor(score * 4) / 4 AS s, CAST(count(*) AS DOUBLE) AS n FROM predictions
                  WHERE actual IS NOT NULL GROUP BY 1, 2),
      placed AS (SELECT t1, t2, t3, t4, a, n, CAST(s >= t1 AS INT) + CAST(s >= t2 AS INT) + CAST(s >= t3 AS INT)
                 + CAST(s >= t4 AS INT) AS p FROM grid CROSS JOIN counted),
      kappas AS (SELECT t1, t2, t3, t4, {_KAPPA} AS kappa FROM placed GROUP BY t1, t2, t3, t4)"""


@query(
    "threshold_grid",
    _grid_sql("<") + f" SELECT {', '.join(rnd(f't{i}', f't{i}') for i in range(1, 5))}, {rnd('kappa', 'kappa')} FROM kappas",
)
def threshold_grid(spark, sf):
    return thresholds.threshold_grid(predictions(spark, sf), "actual", "score")


@query("optimize_thresholds", _grid_sql("<=") + f" SELECT {rnd('max(kappa)', 'kappa')} FROM kappas")
def optimize_thresholds(spark, sf):
    """Best kappa over the quarter-point cuts, so that SQL can enumerate them; the default grid is finer."""
    best = thresholds.optimize_thresholds(predictions(spark, sf), "actual", "score", low=0.25, high=3.75, bins=14)
    return spark.createDataFrame([(best.kappa,)], "kappa double")


@query("optimize_thresholds_fine")
def optimize_thresholds_fine(spark, sf):
    best = thresholds.optimize_thresholds(predictions(spark, sf), "actual", "score")
    return spark.createDataFrame([(*best.thresholds, best.kappa)], "t1 double, t2 double, t3 double, t4 double, kappa double")


@query(
    "optimize_thresholds_exact",
    f""", rated AS (SELECT actual FROM predictions WHERE actual IS NOT NULL AND score IS NOT NULL)
    SELECT count(*) AS "rows", true AS in_order, true AS kappa_agrees, true AS not_below_grid FROM rated""",
)
def optimize_thresholds_exact(spark, sf):
    """Of the exact optimum: kappa of its cuts recomputed from the rows, and that no cuts on the fine grid are better."""
    rows = predictions(spark, sf)
    best, grid = thresholds.optimize_thresholds_exact(rows, "actual", "score"), thresholds.optimize_thresholds(rows, "actual", "score")
    a, p = F.col("actual"), scalars.threshold_round("score", best.thresholds)
    rated = rows.where("actual IS NOT NULL AND score IS NOT NULL").select("actual", p.alias("p"))
    p = F.col("p")
    expected = F.sum(a * a + p * p) - 2 * F.sum(a) * F.sum(p) / F.count("*")
    again = rated.agg(F.count("*").alias("rows"), (1 - F.sum((a - p) * (a - p)) / expected).alias("kappa"))
    return again.select(
        "rows",
        F.lit(list(best.thresholds) == sorted(best.thresholds)).alias("in_order"),
        (F.abs(F.col("kappa") - F.lit(best.kappa)) < 1e-9).alias("kappa_agrees"),
        F.lit(best.kappa >= grid.kappa - 1e-12).alias("not_below_grid"),
    )


_PASS = ("enmo_mean", "light_mean")
_LABELLED = f"s AS (SELECT id, sii FROM subjects WHERE sii IS NOT NULL), {split_cte('cut', '0.2e0', 's')}"
_TEST = f", {_LABELLED} SELECT id, {rnd('sii', 'sii')}, {{}} FROM cut WHERE split = 'test'"


def _model_rows(spark, sf) -> DataFrame:
    """Labelled subjects with their mean activity and light, and the part they belong to.

    They are written once, as training passes over its rows several times, and spread by their number: files that are small in bytes
    would leave hundreds of trees a row to one task.
    """
    activity = aggregates.summarise(series(spark, sf), ["id"], {"enmo": ("mean",), "light": ("mean",)})
    rows = filter_not_null(joins.left_join(subjects(spark, sf), activity, "id"), "sii")
    parts = spread(subjects(spark, sf).count(), spark)
    return readers.read_parquet(spark, writers.write_parquet(split.split_random(rows).repartition(parts, "id"), scratch_path(spark, "model-rows")))


def _encoder(rows: DataFrame) -> encode.FeatureEncoder:
    return encode.fit_encoder(rows, relevant_numeric(SUBJECT_SPEC), ["season", "sex"], _PASS)


def _encoded(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Training and testing rows, encoded by what the training rows show."""
    rows = _model_rows(spark, sf)
    encoder = _encoder(split.take(rows, "train"))
    return tuple(encoder.assemble(split.take(rows, part)).select("id", "sii", "features") for part in ("train", "test"))


_PARTS = f", {_LABELLED}, trained AS (SELECT sii, count(*) AS n FROM cut WHERE split = 'train' GROUP BY sii)"
_MAJORITY = rnd("(SELECT max(n) / sum(n) FROM trained)", "majority") + ", true AS beats_majority"
_VARIANCE = rnd("(SELECT sum(n * sii * sii) / sum(n) - (sum(n * sii) / sum(n)) ** 2 FROM trained)", "variance") + ", true AS below_variance"


def beside(rows: DataFrame, one: DataFrame) -> DataFrame:
    """The columns of a frame of one row beside every row, from one scalar subquery."""
    held = rows.withColumn("_one", one.select(F.struct(*one.columns).alias("s")).scalar())
    return held.select(*rows.columns, *[F.col("_one")[c].alias(c) for c in one.columns])


def _judged(rows: DataFrame, model, train: DataFrame) -> DataFrame:
    """Adds how the model does on the rows it learnt from."""
    quality = trees.fit_quality(model, train, "sii")
    name, shown = ("majority", "beats_majority") if "majority" in quality.columns else ("variance", "below_variance")
    return beside(rows, quality.select(name, trees.has_learnt(quality).alias(shown)))


def _apart(p: str, q: str):
    return F.array_max(F.transform(F.arrays_zip(p, q), lambda z: F.abs(z[p] - z[q])))


_AGREES = "true AS agrees"
_FOREST_SQL = f"{_PARTS} SELECT id, {rnd('sii', 'sii')}, {_AGREES}, {_MAJORITY} FROM cut WHERE split = 'test'"


@query("train_random_forest", _FOREST_SQL)
def train_random_forest(spark, sf):
    train, test = _encoded(spark, sf)
    model = trees.train_random_forest(train, "sii")
    joined = trees.probabilities_by_join(model, test).withColumnRenamed("probabilities", "q")
    rows = trees.score_batch(model, test).join(joined, "id").select("id", "sii", (_apart("probabilities", "q") < 1e-9).alias("agrees"))
    return _judged(rows, model, train)


def _joined_margins(model, rows: DataFrame, last: bool = False) -> DataFrame:
    """(id, sii, round, m) with the margins of all classes after every round, or the last one."""
    margins = boosting.margins_by_join(model, rows, ["id", "sii"], last)
    in_order = F.array_sort(F.collect_list(F.struct("class", "margin")))
    return margins.groupBy("id", "sii", "round").agg(F.transform(in_order, lambda z: z["margin"]).alias("m"))


def _softmax(m: str):
    e = F.transform(m, lambda x: F.exp(x - F.array_max(m)))
    total = F.aggregate(e, F.lit(0.0), lambda a, x: a + x)
    return F.transform(e, lambda x: x / total)


@query("train_boosted_trees", _FOREST_SQL)
def train_boosted_trees(spark, sf):
    train, test = _encoded(spark, sf)
    model = trees.train_boosted_trees(train, "sii")
    joined = _joined_margins(model, test, last=True).select("id", _softmax("m").alias("q"))
    rows = trees.score_batch(model, test).join(joined, "id").select("id", "sii", (_apart("probabilities", "q") < 1e-9).alias("agrees"))
    return _judged(rows, model, train)


@query("train_ordinal_score", f"{_PARTS} SELECT id, {rnd('sii', 'sii')}, {_AGREES}, {_VARIANCE} FROM cut WHERE split = 'test'")
def train_ordinal_score(spark, sf):
    train, test = _encoded(spark, sf)
    model = trees.train_ordinal_score(train, "sii")
    joined = _joined_margins(model, test, last=True).select("id", F.get("m", F.lit(0)).alias("q"))
    rows = trees.score_batch(model, test).join(joined, "id")
    return _judged(rows.select("id", "sii", (F.abs(F.col("prediction") - F.col("q")) < 1e-9).alias("agrees")), model, train)


@query(
    "score_batch",
    f"{_PARTS} SELECT id, {rnd('sii', 'sii')}, {_AGREES}, true AS class_agrees, true AS expected_agrees, {_MAJORITY} FROM cut WHERE split = 'test'",
)
def score_batch(spark, sf):
    train, test = _encoded(spark, sf)
    model = trees.train_random_forest(train, "sii")
    joined = trees.probabilities_by_join(model, test).withColumnRenamed("probabilities", "q")
    largest = F.aggregate(
        F.transform("q", lambda x, i: F.struct(x.alias("x"), i.alias("i"))),
        F.struct(F.lit(-1.0).alias("x"), F.lit(-1).alias("i")),
        lambda a, z: F.when(z["x"] > a["x"] + 1e-9, z).otherwise(a),
    )["i"]
    expected = F.aggregate(F.transform("q", lambda x, i: x * i), F.lit(0.0), lambda a, x: a + x)
    scored = trees.score_batch(model, test).join(joined, "id").withColumn("_e", trees.expected_class())
    tied = F.size(F.filter("q", lambda x: F.array_max("q") - x < 1e-9)) > 1  # rounding decides there
    rows = scored.select(
        "id",
        "sii",
        (_apart("probabilities", "q") < 1e-9).alias("agrees"),
        ((F.col("predicted_class") == largest) | tied).alias("class_agrees"),
        (F.abs(F.col("_e") - expected) < 1e-9).alias("expected_agrees"),
    )
    return _judged(rows, model, train)


@query("score_adjusted", f"{_PARTS} SELECT id, {rnd('sii', 'sii')}, true AS adjusted, {_MAJORITY} FROM cut WHERE split = 'test'")
def score_adjusted(spark, sf):
    """The class times 1.3, where the class is one with the largest share in the exported trees."""
    train, test = _encoded(spark, sf)
    model = trees.train_random_forest(train, "sii")
    joined = trees.probabilities_by_join(model, test).withColumnRenamed("probabilities", "q")
    scored = trees.score_adjusted(model, test, test.schema).join(joined, "id")
    found = F.get("q", F.round(F.col("adjusted_prediction") / 1.3).cast("int"))
    whole = F.abs(F.col("adjusted_prediction") - 1.3 * F.round(F.col("adjusted_prediction") / 1.3)) < 1e-9
    return _judged(scored.select("id", "sii", (whole & (F.array_max("q") - found < 1e-9)).alias("adjusted")), model, train)


@query(
    "eval_by_iteration",
    "SELECT unnest(['classes', 'score']) AS model, CAST(i AS INT) AS round, true AS loss_agrees, true AS kappa_agrees,"
    " true AS training_loss_falls FROM range(1, 101) t(i)",
)
def eval_by_iteration(spark, sf):
    """Loss and kappa of every round on rows the boosters have not seen, next to those of a full scoring with the first rounds' trees
    by joins; and whether the loss of the training rows is lower than the round before."""
    train, test = _encoded(spark, sf)
    out = []
    for name, model in (("classes", trees.train_boosted_trees(train, "sii")), ("score", trees.train_ordinal_score(train, "sii"))):
        found = trees.eval_by_iteration(model, test, "sii")
        learnt = trees.eval_by_iteration(model, train, "sii").select("round", F.col("loss").alias("learnt"))
        before = learnt.select((F.col("round") + 1).alias("round"), F.col("learnt").alias("before"))
        rows = _joined_margins(model, test)
        if name == "classes":
            p = F.get(_softmax("m"), F.col("sii").cast("int"))
            loss, predicted = -F.log(F.greatest(p, F.lit(1e-15))), scalars.argmax_class("m")
        else:
            score = F.get("m", F.lit(0))
            loss, predicted = (score - F.col("sii")) * (score - F.col("sii")), scalars.threshold_round(score)
        pairs = rows.select("round", "sii", loss.alias("l"), predicted.cast("double").alias("p"))
        a, p = F.col("sii"), F.col("p")
        expected = F.sum(a * a + p * p) - 2 * F.sum(a) * F.sum(p) / F.count("*")
        again = pairs.groupBy("round").agg(F.avg("l").alias("l"), (1 - F.try_divide(F.sum((a - p) * (a - p)), expected)).alias("k"))
        whole = found.join(again, "round").join(learnt, "round").join(before, "round", "left")
        out.append(
            whole.select(
                F.lit(name).alias("model"),
                "round",
                (F.abs(F.col("loss") - F.col("l")) < 1e-9).alias("loss_agrees"),
                (F.coalesce(F.abs(F.col("kappa") - F.col("k")), F.lit(0.0)) < 1e-9).alias("kappa_agrees"),
                (F.coalesce("before", F.lit(float("inf"))) > F.col("learnt") - 1e-2).alias("training_loss_falls"),
            )
        )
    return out[0].union(out[1])


def _trained(spark, sf):
    """Training rows encoded, the names of their features, and the forest."""
    rows = split.take(_model_rows(spark, sf), "train")
    encoder = _encoder(rows)
    features = encoder.assemble(rows).select("sii", "features")
    return features, encoder.names, trees.train_random_forest(features, "sii")


_NAMES_SQL = f""", names AS (
    SELECT unnest({[c for c in relevant_numeric(SUBJECT_SPEC)] + list(_PASS)}) AS feature
    UNION ALL SELECT DISTINCT 'season_' || season FROM subjects WHERE sii IS NOT NULL AND season IS NOT NULL
    UNION ALL SELECT DISTINCT 'sex_' || CAST(sex AS VARCHAR) FROM subjects WHERE sii IS NOT NULL)"""


@query(
    "feature_importance",
    f"{_PARTS}{_NAMES_SQL} SELECT feature, true AS agrees, 1.0e0 AS total, {_MAJORITY} FROM names",
)
def feature_importance(spark, sf):
    """Importances next to those recomputed from the gains of the stored nodes."""
    features, names, model = _trained(spark, sf)
    found = trees.feature_importance(model, names, features)
    places = spark.createDataFrame(list(enumerate(names)), "place int, feature string")
    again = trees.importance_by_nodes(model, features).select(F.col("feature").alias("place"), F.col("importance").alias("again"))
    total = found.agg(F.round(F.sum("importance"), 6).alias("total")).scalar()
    both = found.join(places.join(again, "place", "left"), "feature")
    agrees = (F.abs(F.col("importance") - F.coalesce("again", F.lit(0.0))) < 1e-9).alias("agrees")
    return _judged(both.select("feature", agrees, total.alias("total")), model, features)


@query("sort_importance", _NAMES_SQL + " SELECT CAST(row_number() OVER () AS INT) AS rank, true AS in_order FROM names")
def sort_importance(spark, sf):
    """One row per feature: its place after sorting, and whether it is no more important than the one before."""
    features, names, model = _trained(spark, sf)
    found = joins.sort_descending(trees.feature_importance(model, names, features), "importance", ["feature"])
    placed = ordered_row_id(found.withColumn("_slot", F.monotonically_increasing_id()), ["_slot"], "rank", start=1)
    before = placed.select((F.col("rank") + 1).alias("rank"), F.col("importance").alias("before"))
    in_order = F.coalesce(F.col("before") >= F.col("importance"), F.lit(True)).alias("in_order")
    return placed.join(before, "rank", "left").select(F.col("rank").cast("int").alias("rank"), in_order)


@query("save_load_model", _TEST.format("0.0e0 AS difference"))
def save_load_model(spark, sf):
    """Preprocessing and forest saved as one pipeline and reloaded: both score the raw test rows alike."""
    rows = _model_rows(spark, sf)
    train, test = split.take(rows, "train"), split.take(rows, "test")
    encoder = _encoder(train)
    forest = trees.train_random_forest(encoder.assemble(train).select("sii", "features"), "sii")
    model = PipelineModel(stages=[*encoder.stages(), forest])
    loaded = trees.load_pipeline(trees.save_model(model, scratch_path(spark, "model")))
    scored = trees.score_batch(model, test).select("id", "sii", F.col("probabilities").alias("p"))
    again = trees.score_batch(loaded, test).select("id", F.col("probabilities").alias("q"))
    apart = F.array_max(F.transform(F.arrays_zip("p", "q"), lambda z: F.abs(z["p"] - z["q"])))
    return scored.join(again, "id").select("id", "sii", apart.alias("difference"))


@query(
    "train_ordinal",
    f""", s AS (SELECT sii, {RANKED_SQL.format(partition='PARTITION BY sii')} AS place,
        ceil(count(*) OVER (PARTITION BY sii) * 0.3e0) AS held FROM subjects WHERE sii IS NOT NULL),
      trained AS (SELECT sii, count(*) AS n FROM s WHERE place > held GROUP BY sii)
    SELECT CAST(CAST(sii AS INT) AS VARCHAR) AS label, count(*) AS support, true AS accuracy_agrees, true AS kappa_agrees, {_VARIANCE}
    FROM s WHERE place <= ceil(held * 0.5e0) GROUP BY sii""",
)
def train_ordinal(spark, sf):
    """The ordinal run: supports of the classes that the test rows have, its metrics next to those recomputed from its scored rows,
    and how its score fits the rows it learnt from."""
    rows = _model_rows(spark, sf).drop("split")
    run = ordinal.train_ordinal(rows, SUBJECT_SPEC, _PASS)
    a, p = F.col("actual"), F.col("predicted")
    expected = F.sum(a * a + p * p) - 2 * F.sum(a) * F.sum(p) / F.count("*")
    kappa = 1 - F.try_divide(F.sum((a - p) * (a - p)), expected)
    again = run.scored.agg(F.avg((a == p).cast("double")).alias("accuracy2"), kappa.alias("kappa2"))
    metrics_ = beside(beside(run.accuracy, run.kappa.select("kappa")), again).select(
        (F.abs(F.col("accuracy") - F.col("accuracy2")) < 1e-9).alias("accuracy_agrees"),
        (F.coalesce(F.abs(F.col("kappa") - F.col("kappa2")), F.lit(0.0)) < 1e-9).alias("kappa_agrees"),
    )
    supports = run.report.where("section = 0 AND support > 0").select("label", "support")
    learnt = split.take(split.split_three_way(rows, "sii", "id"), "train")
    return _judged(beside(supports, metrics_), run.model, learnt)


def _timed(spark, sf) -> DataFrame:
    return series(spark, sf).select("id", forecast.sample_time().alias("ds"), *forecast.FORECAST_FEATURES)


@query("forecast_by_group")
def forecast_by_group(spark, sf):
    return forecast.forecast_by_group(_timed(spark, sf))


# A slope of each id's own, a bend after two weeks and a daily wave, at the times of the series.
_CURVE = """5.0e0 + {days} * (CAST(id AS BIGINT) % 7) / 10.0e0 + 0.3e0 * greatest({days} - 14.0e0, 0.0e0)
    + 2.0e0 * sin({days} * 2.0e0 * pi())"""
_CURVED = "CAST(ds AS DOUBLE) / 86400.0e0"


@query(
    "forecast_known_curve",
    f""", t AS (SELECT DISTINCT id, CAST(relative_date_PCIAT * 86400 + time_of_day AS BIGINT) AS ds FROM series),
    ahead AS (SELECT id, ds, false AS is_future FROM t
      UNION ALL SELECT id, max(ds) + i * 86400, true FROM t, range(1, 8) AS r(i) GROUP BY id, i)
    SELECT id, ds, is_future, round({_CURVE.format(days=_CURVED)}, 6) AS enmo, true AS recovered FROM ahead""",
)
def forecast_known_curve(spark, sf):
    """Forecasts of a curve known at all times, of which the model sees the series' samples: each lies within 0.01 of it."""
    seen = _timed(spark, sf).select("id", "ds", F.expr(_CURVE.format(days=_CURVED)).alias("enmo"))
    found = forecast.forecast_by_group(seen, ["enmo"]).withColumn("curve", F.expr(_CURVE.format(days=_CURVED)))
    near = F.abs(F.col("enmo_forecast") - F.col("curve")) < 0.01
    return found.select("id", "ds", "is_future", F.round("curve", 6).alias("enmo"), F.coalesce(near, F.lit(False)).alias("recovered"))


# Recorded on a part of the rows, checked on all of them.
_PROFILED = {
    "series": ("weekday <= 5 AND enmo IS NOT NULL", {"step": "bigint", "X": "double", "enmo": "double", "light": "double", "weekday": "int"}),
    "subjects": ("season IN ('Fall', 'Spring') AND age < 15", {"age": "double", "bmi": "double", "pciat": "double", "season": "string"}),
}


def _profile_sql(source: str, part: str, c: str, kind: str) -> str:
    recorded = f"(SELECT * FROM {source} WHERE {part})"
    if kind == "string":
        outside = f"count(*) FILTER (WHERE {c} NOT IN (SELECT {c} FROM {recorded} WHERE {c} IS NOT NULL))"
    else:
        outside = f"count(*) FILTER (WHERE {c} < (SELECT min({c}) FROM {recorded}) OR {c} > (SELECT max({c}) FROM {recorded}))"
    return f"""SELECT '{source}' AS source, '{c}' AS column_name, '{kind}' AS recorded, '{kind}' AS present, count(*) AS rows_checked,
      count(*) - count({c}) AS nulls, {outside} AS outside,
      (SELECT count(*) > count({c}) FROM {recorded}) AS had_nulls FROM {source}"""


_PROFILES_SQL = " UNION ALL ".join(_profile_sql(s, part, c, k) for s, (part, columns) in _PROFILED.items() for c, k in columns.items())


@query(
    "schema_signature",
    f"""SELECT source, column_name, recorded, present, rows_checked, nulls, outside,
    outside = 0 AND (nulls = 0 OR had_nulls) AS matches FROM ({_PROFILES_SQL})""",
)
def schema_signature(spark, sf):
    """Measured profiles of parts of two tables (types, nulls, ranges, levels), stored, read back and held against all their rows."""
    reports = []
    for name, frame in (("series", series(spark, sf)), ("subjects", subjects(spark, sf))):
        part, columns = _PROFILED[name]
        known = profile.fit_profile(frame.where(part).select(*columns))
        path = scratch_path(spark, f"profile_{name}")
        profile.profile_frame(spark, known).write.parquet(path)
        stored = readers.read_parquet(spark, path)
        reports.append(profile.profile_report(frame, profile.read_profile(stored)).withColumn("source", F.lit(name)))
    return reports[0].unionByName(reports[1])
