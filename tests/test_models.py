import math
import random

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from cohortspark.catalog import q_models
from cohortspark.functions.scalars import register_multiplier
from cohortspark.models import forecast, metrics, trees
from cohortspark.operators import aggregates, encode, joins, signature
from cohortspark.operators.split import split_random, take
from cohortspark.plans import cohort, training
from cohortspark.schemas import CohortSpec

SPEC = CohortSpec(
    numeric=("age", "signal", "total"), categorical=("season",), target="y", age="age", sex="sex",
    function_score="signal", bmi="bmi", total="total", hours="hours", items=(),
)
SMALL = {"num_trees": 5, "max_depth": 4}
PLAIN = {"l1": 0.0, "bagging_fraction": 1.0, "feature_fraction": 1.0}
BOOST = {"classes": 3, "rounds": 3, "max_depth": 3, "learning_rate": 0.3, "min_leaf": 1, "l1": 0.0}


@pytest.fixture(scope="module")
def separable(spark):
    """The class follows from the signal; ``total`` gives the class away."""
    rng = random.Random(2)
    data = []
    for i in range(300):
        y = rng.randrange(3)
        signal = None if i % 50 == 0 else y * 10 + rng.random()
        data.append((f"p{i}", float(rng.randrange(5, 20)), signal, float(y), rng.choice(["Fall", "Spring", None]), float(y)))
    return spark.createDataFrame(data, "id string, age double, signal double, total double, season string, y double").cache()


@pytest.fixture(scope="module")
def encoded(separable):
    return encode.fit_encoder(separable, ["age", "signal"], ["season"]).assemble(separable).select("id", "y", "features").cache()


def accuracy(scored):
    hit = (F.col("y") == F.col("predicted_class")).cast("double")
    return scored.select(F.avg(hit)).first()[0]


def test_forest_learns_and_probabilities_sum_to_one(encoded):
    scored = trees.score_batch(trees.train_random_forest(encoded, "y", **SMALL), encoded)
    assert accuracy(scored) > 0.9
    assert all(math.isclose(sum(r["probabilities"]), 1) for r in scored.collect())


def test_boosting_learns_every_class(encoded):
    model = trees.train_boosted_trees(encoded, "y", **BOOST)
    scored = trees.score_batch(model, encoded)
    assert accuracy(scored) > 0.9
    assert all(math.isclose(sum(r["probabilities"]), 1) for r in scored.collect())
    by_round = trees.eval_by_iteration(model, encoded, "y").orderBy("round").collect()
    assert len(by_round) == 3 and by_round[2]["loss"] < by_round[0]["loss"] and by_round[2]["kappa"] > 0.9


def test_ordinal_score_and_adjustment(encoded):
    model = trees.train_ordinal_score(encoded, "y", rounds=5, max_depth=3, learning_rate=0.5, min_leaf=1, **PLAIN)
    scored = trees.score_adjusted(model, encoded, encoded.schema)
    row = scored.first()
    assert row["adjusted_prediction"] == pytest.approx(1.3 * row["prediction"])
    error = scored.select(F.avg(F.abs(F.col("prediction") - F.col("y")))).first()[0]
    assert error < 0.2
    assert trees.eval_by_iteration(model, encoded, "y").count() == 5


def test_labels_that_the_inputs_hardly_tell_are_still_seen_to_be_learnt(spark):
    """A balanced forest on 20,000 rows of random labels is right less often than their commonest class, yet it has fitted them;
    a stump, or a forest of other labels, has not."""
    rng = random.Random(8)
    data = [(rng.random(), rng.random(), float(rng.random() < 0.35), float(rng.random() < 0.35)) for _ in range(20_000)]
    frame = spark.createDataFrame(data, "a double, b double, sii double, other double")
    frame = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(frame).cache()
    models = [
        trees.train_random_forest(frame, "sii", num_trees=10, max_depth=10),
        trees.train_random_forest(frame, "sii", num_trees=1, max_depth=1),
        trees.train_random_forest(frame, "other", num_trees=10, max_depth=10),
    ]
    one = spark.range(1)
    assert trees.fit_quality(models[0], frame, "sii").selectExpr("accuracy < 1.1 * majority").head()[0]
    assert [q_models._judged(one, m, frame).head().beats_majority for m in models] == [True, False, False]


def test_a_forest_keeps_the_nodes_of_its_rows(encoded):
    assert trees.train_random_forest(encoded, "y", **SMALL).getCacheNodeIds()


def test_scoring_checks_the_signature(encoded):
    model = trees.train_random_forest(encoded, "y", **SMALL)
    with pytest.raises(TypeError):
        trees.score_adjusted(model, encoded.withColumn("id", F.lit(1)), encoded.schema)
    report = signature.signature_report(encoded.drop("id"), signature.signature(encoded))
    assert [r["column_name"] for r in report.where("NOT matches").collect()] == ["id"]


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0.0,), (0.0,), (0.0,), (1.0,)], "y double")
    assert {r["c"]: r["w"] for r in trees.class_weights(df, "y").collect()} == {0.0: 4 / 6, 1.0: 2.0}


def test_importance_names(separable, encoded):
    encoder = encode.fit_encoder(separable, ["age", "signal"], ["season"])
    model = trees.train_random_forest(encoded, "y", **SMALL)
    ranked = joins.sort_descending(trees.feature_importance(model, encoder.names, encoded), "importance").collect()
    assert ranked[0]["feature"] == "signal" and {r["feature"] for r in ranked} == set(encoder.names)


def test_run_reload_and_leak_free_inputs(spark, separable, tmp_path):
    labelled = split_random(separable)
    run = training.train_and_evaluate(take(labelled, "train"), take(labelled, "test"), SPEC, **SMALL)
    assert "total" not in run.feature_names and run.accuracy > 0.9 and run.kappa > 0.9
    assert run.report.where("label = 'accuracy'").first()["f1"] == pytest.approx(run.accuracy)
    path = trees.save_model(run.model, str(tmp_path / "model"))
    again = trees.score_batch(trees.load_pipeline(path), take(labelled, "test"))
    before = {r["id"]: r["probabilities"] for r in run.scored.collect()}
    assert {r["id"]: r["probabilities"] for r in again.collect()} == before


def test_lookup_keeps_rows_and_rejects_repeated_keys(spark):
    rows = spark.createDataFrame([("a", 1.0), ("b", 2.0), (None, 3.0)], "id string, y double")
    table = spark.createDataFrame([("a", 10.0), (None, 99.0)], "id string, battery_voltage_mean double")
    function = register_multiplier(spark, "lookup_scale")
    got = training.create_training_set(
        rows, table, ["battery_voltage_mean"], {"scaled": (function, {"x": "battery_voltage_mean"})}
    )
    assert {r["id"]: r["scaled"] for r in got.collect()} == {"a": 12.0, "b": None, None: None}
    twice = table.union(table)
    with pytest.raises(SparkRuntimeException, match="repeated id"):
        training.create_training_set(rows, twice, ["battery_voltage_mean"]).collect()


def test_cohort_fit_on_training_part(spark):
    train = spark.createDataFrame([("a", 10.0, "x", "Fall"), ("b", 20.0, None, "Fall")], "id string, age double, signal string, season string")
    test = spark.createDataFrame([("c", None, "4", "Winter")], "id string, age double, signal string, season string")
    got = cohort.prepare_cohort(test, SPEC, fit_on=train, scaled=False, keep_engineered=True).first().asDict()
    assert got["age"] == 15.0 and got["Age_Group"] == "Teen" and got["season_Fall"] == 0
    assert got["signal"] == 4.0 and got["total"] is None and got["y"] == 4.0
    assert got["Age_Adjusted_CGAS"] == pytest.approx(4 / 15)


def sinusoid(spark, ids, days=14, extra=""):
    return spark.range(days * 24).selectExpr(
        f"explode(array({ids})) AS id", "id * 3600 AS ds",
        f"5 + 0.1 * id / 24 + 2 * sin(2 * pi() * id / 24) AS enmo{extra}",
    )


def test_forecast_recovers_trend_and_cycle(spark):
    df = sinusoid(spark, "'a', 'b'").withColumns({"light": F.col("enmo") * 2, "battery_voltage": F.lit(None).cast("double")})
    got = forecast.forecast_by_group(df).collect()
    assert len(got) == 2 * (14 * 24 + 7) and sum(r["is_future"] for r in got) == 14
    for r in got:
        d = r["ds"] / 86400
        expected = 5 + 0.1 * d + 2 * math.sin(2 * math.pi * d)
        assert r["enmo_forecast"] == pytest.approx(expected, abs=1e-2)
        assert r["light_forecast"] == pytest.approx(2 * expected, abs=2e-2)
        assert r["battery_voltage_forecast"] is None


def test_forecast_matches_least_squares_with_gaps(spark):
    """Features with different gaps are fitted on their own rows, whatever the partitioning."""
    import numpy as np

    df = sinusoid(spark, "'a'").withColumns(
        {"enmo": F.when(F.col("ds") % 7 > 2, F.col("enmo")), "light": F.when(F.col("ds") / 3600 % 5 > 1, F.sqrt("ds"))}
    ).withColumn("battery_voltage", F.lit(1.0))
    fitted = {r["feature"]: r for r in forecast.fit_seasonal(df.repartition(7)).collect()}
    local = df.toPandas()
    for feature in ("enmo", "light"):
        part = local[local[feature].notna()]
        x = forecast._design_matrix(part["ds"].to_numpy(float))
        y = part[feature].to_numpy(float)
        exact = x @ np.linalg.lstsq(x, y, rcond=None)[0]
        assert fitted[feature]["n"] == len(part)
        assert np.allclose(x @ np.array(fitted[feature]["coef"]), exact, atol=2e-2 * np.ptp(y))


def test_many_open_series_are_flushed(spark, monkeypatch):
    df = spark.range(4000).selectExpr("cast(id % 40 AS string) AS id", "id * 977 AS ds", "cast(id % 13 AS double) AS enmo")
    whole = {r["id"]: r["n"] for r in forecast.fit_seasonal(df, ["enmo"]).collect()}
    monkeypatch.setattr(forecast, "_MAX_OPEN_SERIES", 3)
    assert {r["id"]: r["n"] for r in forecast.fit_seasonal(df, ["enmo"]).collect()} == whole == {str(i): 100 for i in range(40)}


def test_short_series_has_no_forecast(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 3600, 2.0), ("a", 7200, 3.0)], "id string, ds bigint, enmo double")
    got = forecast.forecast_by_group(df, ["enmo"]).collect()
    assert len(got) == 10 and all(r["enmo_forecast"] is None for r in got)


def bent(spark, noise="0D"):
    """Hourly samples of six weeks: a level, a slope, a bend after three weeks and a daily wave."""
    curve = "3 + 0.2D * t + 0.5D * greatest(t - 21, 0) + sin(2 * pi() * t)"
    return spark.range(42 * 24).selectExpr("'a' AS id", "id * 3600 AS ds", "id / 24 AS t").selectExpr("*", f"{curve} AS curve", f"{curve} + {noise} AS enmo")


def test_bent_trend_is_recovered(spark):
    rows = bent(spark)
    got = {r["ds"]: r["enmo_forecast"] for r in forecast.forecast_by_group(rows.repartition(5), ["enmo"], 0).collect()}
    assert max(abs(got[r["ds"]] - r["curve"]) for r in rows.collect()) < 1e-2
    fitted = forecast.fit_seasonal(rows, ["enmo"], bend_days=7).first()
    assert fitted["bends"] == [7.0, 14.0, 21.0, 28.0]
    assert fitted["changes"] == pytest.approx([0, 0, 0.5, 0], abs=1e-3)
    straight = {r["ds"]: r["enmo_forecast"] for r in forecast.forecast_by_group(rows, ["enmo"], 0, bend_days=None).collect()}
    assert max(abs(straight[r["ds"]] - r["curve"]) for r in rows.collect()) > 0.3


def test_shrunken_bends_are_the_optimum(spark):
    """No other bends have a smaller penalised error than those found, and noise alone bends little."""
    import numpy as np

    rows = bent(spark, "3D * (pmod(xxhash64(ds), 1000) / 500 - 1)")
    fitted = forecast.fit_seasonal(rows, ["enmo"], bend_days=7).first()
    local = rows.toPandas()
    y, days = local["enmo"].to_numpy(), local["ds"].to_numpy(float) / 86400
    x = np.hstack([forecast._design_matrix(local["ds"].to_numpy(float)), np.maximum(days[:, None] - np.array(fitted["bends"]), 0)])
    exact = x @ np.linalg.lstsq(x, y, rcond=None)[0]
    penalty = ((y - exact) ** 2).mean() * 42 / (forecast.BEND_SCALE * np.sqrt((y**2).mean()))

    def cost(b):
        return ((y - x @ b) ** 2).sum() / 2 + penalty * np.abs(b[forecast.N_TERMS :]).sum()

    found = np.array([*fitted["coef"], *fitted["changes"]])
    least = cost(found)
    rng = np.random.default_rng(3)
    for step in (1e-1, 1e-2, 1e-3):
        for _ in range(200):
            assert cost(found + step * rng.normal(size=len(found)) * (rng.random(len(found)) < 0.2)) > least - 1e-6 * abs(least)
    # The smooth part has no slope left, a bend that is not zero has the penalty's, a zero one less.
    pull = x.T @ (y - x @ found)
    size = np.sqrt((x**2).sum(0))
    assert np.allclose(pull[: forecast.N_TERMS] / size[: forecast.N_TERMS], 0, atol=1e-3)
    for b, p in zip(found[forecast.N_TERMS :], pull[forecast.N_TERMS :]):
        assert abs(p) <= penalty * 1.001 if b == 0 else p == pytest.approx(np.sign(b) * penalty, rel=1e-3)


def test_bends_of_long_and_short_series(spark):
    """Two years have at most 25 bends; a series too short for its bends has a straight trend; null ids and times are left out."""
    rows = spark.range(730 * 4).selectExpr("'long' AS id", "id * 21600 + 5 AS ds", "cast(id % 11 AS double) AS enmo")
    rows = rows.union(spark.range(17).selectExpr("'short'", "id * 200000", "cast(id AS double)"))
    rows = rows.union(spark.range(3).selectExpr("cast(NULL AS string)", "cast(NULL AS bigint)", "1D"))
    fitted = {r["id"]: r for r in forecast.fit_seasonal(rows, ["enmo"], bend_days=7).collect()}
    assert set(fitted) == {"long", "short"}
    assert len(fitted["long"]["bends"]) == len(fitted["long"]["changes"]) == forecast.MAX_BENDS and max(fitted["long"]["bends"]) < 0.8 * 735
    assert fitted["short"]["bends"] == [] and len(fitted["short"]["coef"]) == forecast.N_TERMS
    assert forecast.forecast_by_group(rows.where("false"), ["enmo"]).count() == 0


def test_metrics_of_a_perfect_model(spark):
    df = spark.createDataFrame([(0, 0), (1, 1), (2, 2)], "y int, p int")
    assert metrics.accuracy(df, "y", "p").first()[0] == 1.0


@pytest.mark.parametrize("day", [0, 1_000, 19_700])
def test_forecast_wherever_time_starts(spark, day):
    """A trend of half a unit a day and a daily sine are found again, also in ordinary epoch seconds."""
    rows = spark.range(14 * 24).selectExpr("'a' AS id", f"(id * 3600 + {day} * 86400L) AS ds", "0.5D * (id / 24) + sin(2 * pi() * id / 24) AS enmo")
    got = forecast.forecast_by_group(rows, ["enmo"]).orderBy("ds").collect()
    for r in got:
        t = r["ds"] / 86400 - day
        assert abs(r["enmo_forecast"] - (0.5 * t + math.sin(2 * math.pi * t))) < 1e-2


def test_modes_keep_types(spark):
    rows = [(9007199254740993, True, "2024-01-02"), (9007199254740993, True, "2024-01-02"), (None, None, None), (1, False, "2024-01-01")]
    df = spark.createDataFrame(rows, "n long, b boolean, d string").withColumn("d", F.col("d").cast("date"))
    filled = aggregates.impute(df, aggregates.fit_modes(df, ["n", "b", "d"]))
    assert filled.dtypes == df.dtypes
    assert filled.where("n = 9007199254740993 AND b AND d = DATE'2024-01-02'").count() == 3


def test_histogram_of_finite_values(spark):
    values = [0.0, 1.0, float("nan"), float("inf"), float("-inf"), None]
    got = aggregates.histogram(spark.createDataFrame([(v,) for v in values], "v double"), "v", 2).orderBy("bin").collect()
    assert [tuple(r) for r in got] == [(0, 0.0, 0.5, 1), (1, 0.5, 1.0, 1)]


def test_ordinal_run(spark, separable):
    from cohortspark.plans.ordinal import train_ordinal

    run = train_ordinal(separable, SPEC, n_classes=3, rounds=3, max_depth=2, learning_rate=1.0, **PLAIN)  # the first tree at full weight
    assert run.accuracy.first()["accuracy"] > 0.8 and len(run.thresholds.thresholds) == 2
    rounds = run.by_round.orderBy("round").collect()
    assert [r["round"] for r in rounds] == [1, 2, 3]
    assert all(r["loss"] < 0.3 and 0.5 < r["kappa"] <= 1 for r in rounds)


def test_forecasts_of_many_series_meet_by_id_and_are_solved_in_parts(spark):
    """Samples, not their much wider sums, are exchanged first; series beyond one part are solved like those of the first."""
    ids = forecast.SOLVED_AT_ONCE + 40
    rows = spark.range(ids * 40).selectExpr(
        f"cast(id % {ids} AS string) AS id", f"cast(id / {ids} AS bigint) * 30000 AS ds", f"cast(id / {ids} AS bigint) * 0.5D + id % {ids} AS enmo"
    ).coalesce(1)
    fitted = forecast.fit_seasonal(rows, ["enmo"], bend_days=7)
    assert "REBALANCE_PARTITIONS_BY_COL" in fitted._jdf.queryExecution().executedPlan().toString()
    got = forecast.forecast_by_group(rows, ["enmo"]).where("NOT is_future").collect()
    assert len(got) == ids * 40
    assert all(abs(r["enmo_forecast"] - (r["ds"] / 30000 * 0.5 + int(r["id"]))) < 1e-2 * (1 + int(r["id"])) for r in got)
