"""Distributed boosting against a booster in plain Python that cuts one leaf at a time."""

import math
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from cohortspark.models import boosting, trees
from cohortspark.models.boosting import UNIT, BoostingParams, Tree, bin_cuts, train


def data(spark, rows=240, classes=3, seed=0, ties=True):
    rng = random.Random(seed)
    out = []
    for i in range(rows):
        y = rng.randrange(classes)
        noise = rng.randrange(4) if ties else rng.random() * 4
        out.append((i, float(y), [float(noise), float(rng.randrange(6)) + y * 1.5, float(y == 1 and rng.random() < 0.6), 7.0, round(rng.random(), 1)]))
    frame = spark.createDataFrame(out, "id long, y double, x array<double>")
    return frame.select("id", "y", array_to_vector("x").alias("features")).repartition(5), out


def gradients(margins, y, classes):
    if not classes:
        return [[round((margins[0] - y) * UNIT)], [UNIT]]
    top = max(margins)
    e = [math.exp(m - top) for m in margins]
    p = [v / sum(e) for v in e]
    scale = classes / (classes - 1)
    return [[round((p[k] - (k == y)) * UNIT) for k in range(classes)], [round(p[k] * (1 - p[k]) * scale * UNIT) for k in range(classes)]]


def score(g, h, params):
    reach = max(abs(g) / UNIT - params.l1, 0.0)
    return reach * reach / (h / UNIT + params.l2) if reach else 0.0


def best_cut(rows, bins, g, h, widths, params):
    total_g, total_h = sum(g[i] for i in rows), sum(h[i] for i in rows)
    best = None
    for f, width in enumerate(widths):
        for cut in range(width - 1):
            left = [i for i in rows if bins[i][f] <= cut]
            gl, hl = sum(g[i] for i in left), sum(h[i] for i in left)
            if min(len(left), len(rows) - len(left)) < params.min_leaf or min(hl, total_h - hl) < 1e-3 * UNIT - 1:
                continue
            gain = score(gl, hl, params) + score(total_g - gl, total_h - hl, params) - score(total_g, total_h, params)
            if gain > 1e-10 and (best is None or gain > best[0] + 1e-9 * abs(best[0])):
                best = (gain, f, cut, left)
    return best


def plain(rows, cuts, params):
    """Leaves of every tree as (rows, value), for every round and class."""
    classes, widths = params.classes, [len(c) + 1 for c in cuts]
    bins = [[sum(c < v for c in cuts[f]) for f, v in enumerate(x)] for _, _, x in rows]
    if classes:
        start = [math.log(sum(y == k for _, y, _ in rows) / len(rows)) for k in range(classes)]
    else:
        start = [sum(y for _, y, _ in rows) / len(rows)]
    margins = [list(start) for _ in rows]
    out = []
    for _ in range(params.rounds):
        parts = [gradients(m, y, classes) for m, (_, y, _) in zip(margins, rows)]
        steps, found = [], []
        for k in range(params.margins):
            g, h = [p[0][k] for p in parts], [p[1][k] for p in parts]
            leaves = [(list(range(len(rows))), 0)]
            cut_of = {0: best_cut(leaves[0][0], bins, g, h, widths, params)}
            while sum(x is not None for x in leaves) < params.leaves:
                open_ = [(cut_of[i][0], -i) for i in range(len(leaves)) if leaves[i] and cut_of.get(i)]
                if not open_:
                    break
                at = -max(open_)[1]
                inside, depth = leaves[at]
                _, _, _, left = cut_of[at]
                right = sorted(set(inside) - set(left))
                leaves[at] = None
                for part in (left, right):
                    leaves.append((part, depth + 1))
                    deep = depth + 1 >= params.max_depth or len(part) < 2 * params.min_leaf
                    cut_of[len(leaves) - 1] = None if deep else best_cut(part, bins, g, h, widths, params)
            done = [x for x in leaves if x]
            values = []
            for part, _ in done:
                total = sum(g[i] for i in part)
                reach = max(abs(total) / UNIT - params.l1, 0.0)
                values.append(0.0 if len(done) == 1 or not reach else -math.copysign(reach / (sum(h[i] for i in part) / UNIT + params.l2), total) * params.learning_rate)
            found.append(sorted((sorted(part), v) for (part, _), v in zip(done, values)))
            steps.append({i: v for (part, _), v in zip(done, values) for i in part})
        for i, m in enumerate(margins):
            for k in range(params.margins):
                m[k] += steps[k][i]
        out.append(found)
    return out


def leaves_of(model, rows):
    columns = np.array([x for *_, x in rows]).T
    out = []
    for trees_ in model.rounds:
        found = []
        for tree in trees_:
            ends = tree.walk(columns, tree.cut)
            found.append(sorted((np.flatnonzero(ends == n).tolist(), tree.value[n]) for n in np.unique(ends)))
        out.append(found)
    return out


CASES = {
    "softmax": BoostingParams(3, rounds=3, max_depth=5, leaves=31, min_leaf=5, learning_rate=0.3, l2=1e-6),
    "few leaves": BoostingParams(3, rounds=2, max_depth=6, leaves=5, min_leaf=4, learning_rate=0.3, l2=0.5),
    "l1 and l2": BoostingParams(3, rounds=3, max_depth=4, leaves=16, min_leaf=5, learning_rate=0.2, l1=3.0, l2=1.5),
    "shallow": BoostingParams(3, rounds=2, max_depth=1, leaves=99, min_leaf=1, learning_rate=0.5, l2=1e-6),
    "least squares": BoostingParams(0, rounds=3, max_depth=4, leaves=12, min_leaf=8, learning_rate=0.3, l1=0.5, l2=1e-6),
}


@pytest.mark.parametrize("local_rows", [0, 60, 4096])
@pytest.mark.parametrize("case", CASES)
def test_equals_plain_booster(spark, case, local_rows):
    """Counted level by level, grown to the end in one task, or both: the same leaves and values as one leaf at a time."""
    frame, rows = data(spark)
    params = CASES[case]
    model = train(frame, "y", params, local_rows=local_rows)
    expected = plain(rows, bin_cuts(frame), params)
    found = leaves_of(model, rows)
    for e, f in zip(expected, found):
        for a, b in zip(e, f):
            assert [x for x, _ in a] == [x for x, _ in b]
            assert [v for _, v in a] == pytest.approx([v for _, v in b], abs=1e-6)


def test_partitions_do_not_matter(spark, monkeypatch):
    """Bags and feature draws included, in blocks of 50 rows over many partitions."""
    frame, _ = data(spark, 400, ties=False)
    params = BoostingParams(3, rounds=4, max_depth=6, leaves=20, min_leaf=3, feature_fraction=0.6, bagging_fraction=0.7, bagging_rounds=2, l2=1e-6)
    one = train(frame, "y", params)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 50)
    assert train(frame.repartition(11), "y", params, local_rows=40).rounds == one.rounds


def test_bins_of_many_values(spark):
    frame = spark.range(5000).select((F.col("id") * 7 % 5000).cast("double").alias("v")).select(array_to_vector(F.array("v", F.lit(1.0))).alias("features"))
    cuts = bin_cuts(frame)
    assert len(cuts) == 2 and cuts[1] == [] and 200 <= len(cuts[0]) <= 254
    gaps = np.diff([-1, *cuts[0], 4999])
    assert gaps.max() <= 3 * 5000 / 255


def test_early_stopping_keeps_the_best_round(spark):
    frame, _ = data(spark, 200)
    other, _ = data(spark, 150, seed=5)
    params = {"classes": 3, "rounds": 40, "learning_rate": 0.6, "min_leaf": 3, "l1": 0.0, "max_depth": 6}
    model = trees.train_boosted_trees(frame, "y", validation=other, patience=3, **params)
    full = trees.train_boosted_trees(frame, "y", **params)
    by_round = {r["round"]: r.loss for r in trees.eval_by_iteration(full, other, "y").collect()}
    kept = len(model.rounds)
    assert kept < 40 and model.rounds == full.rounds[:kept]
    assert by_round[kept] == min(by_round[r] for r in range(1, kept + 4))


@pytest.mark.parametrize("classes", [3, 0])
def test_rounds_equal_full_scoring_and_joins(spark, classes):
    frame, _ = data(spark, 150)
    model = train(frame, "y", BoostingParams(classes, rounds=4, max_depth=4, leaves=8, min_leaf=4, l2=1e-6))
    by_round = {r["round"]: r for r in trees.eval_by_iteration(model, frame, "y", (0.5, 1.5, 2.5)).collect()}
    joined = {}
    for r in boosting.margins_by_join(model, frame, ["id"]).collect():
        joined.setdefault((r["round"], r["id"]), {})[r["class"]] = r.margin
    for number in range(1, 5):
        scored = trees.score_batch(model.first(number), frame).collect()
        if classes:
            loss = -sum(math.log(r.probabilities[int(r.y)]) for r in scored) / len(scored)
            for r in scored:
                m = joined[number, r["id"]]
                e = [math.exp(m[k]) for k in range(3)]
                assert [v / sum(e) for v in e] == pytest.approx(list(r.probabilities))
        else:
            loss = sum((r.prediction - r.y) ** 2 for r in scored) / len(scored)
            assert all(joined[number, r["id"]][0] == pytest.approx(r.prediction) for r in scored)
        assert by_round[number].loss == pytest.approx(loss)


def test_model_is_saved_in_a_pipeline(spark, tmp_path):
    frame, _ = data(spark, 120)
    model = train(frame, "y", BoostingParams(3, rounds=2, max_depth=3, leaves=6, min_leaf=4, l2=1e-6))
    PipelineModel(stages=[model]).write().overwrite().save(str(tmp_path / "m"))
    again = trees.load_pipeline(str(tmp_path / "m"))
    p, q = (sorted((r["id"], tuple(r.probabilities)) for r in trees.score_batch(m, frame).collect()) for m in (model, again))
    assert p == q
    ranked = trees.feature_importance(again, list("abcde"), frame).collect()
    assert sum(r.importance for r in ranked) == pytest.approx(1) and max(ranked, key=lambda r: r.importance).feature == "b"


def test_labels_rows_and_features_that_are_missing(spark):
    frame, _ = data(spark, 90)
    params = BoostingParams(5, rounds=2, max_depth=3, leaves=6, min_leaf=4, l2=1e-6)
    unlabelled = frame.withColumn("y", F.when(F.col("id") % 3 > 0, F.col("y")))
    model = train(unlabelled, "y", params)
    probabilities = trees.score_batch(model, unlabelled).head().probabilities
    assert len(probabilities) == 5 and sum(probabilities) == pytest.approx(1) and max(probabilities[3:]) < 1e-9
    assert trees.eval_by_iteration(model, unlabelled, "y").count() == 2
    flat = frame.withColumn("features", array_to_vector(F.array(F.lit(2.0))))
    assert all(t.feature == [-1] for r in train(flat, "y", params).rounds for t in r)
    empty = train(frame.where("false"), "y", params)
    assert trees.score_batch(empty, frame).count() == 90
    gone = frame.withColumn("features", array_to_vector(F.transform(vector_to_array("features"), lambda x: F.when(x == 3, F.lit(float("nan"))).otherwise(x))))
    assert accuracy(train(gone, "y", params), gone) > 0.5


def accuracy(model, frame):
    return trees.fit_quality(model, frame, "y").head().accuracy


def stump(classes):
    """A tree that has learnt nothing."""
    tree = Tree([0, -1, -1], [0, 0, 0], [0.1, 0.0, 0.0], [1, 0, 0], [2, 0, 0], [0.0, 0.3, -0.3], [1.0, 0.0, 0.0])
    return boosting.BoostedTreesModel.of([[tree] * max(classes, 1)], [0.0] * max(classes, 1), classes, 40, "features")


@pytest.mark.parametrize("name", ["train_boosted_trees", "train_ordinal_score", "eval_by_iteration", "train_ordinal"])
def test_a_stump_fails_the_query(spark, monkeypatch, name):
    from check_oracles import compare, connect

    from cohortspark.catalog import ORACLES, QUERIES
    from cohortspark.plans import ordinal

    monkeypatch.setattr(trees, "train_boosted_trees", lambda *_, **__: stump(5))
    for module in (trees, ordinal):
        monkeypatch.setattr(module, "train_ordinal_score", lambda *_, **__: stump(0))
    sf = "/root/testdata/sf0.001"
    assert compare(QUERIES[name](spark, sf), connect(sf), ORACLES[name])


@pytest.mark.parametrize("name", ["train_random_forest", "score_batch", "score_adjusted", "feature_importance", "train_and_evaluate"])
def test_a_forest_of_random_labels_fails_the_query(spark, monkeypatch, name):
    from check_oracles import compare, connect

    from cohortspark.catalog import ORACLES, QUERIES
    from cohortspark.plans import training

    def shuffled(df, label, **_):
        other = df.withColumn(label, F.pmod(F.xxhash64(vector_to_array("features")), F.lit(4)).cast("double"))
        return forest(other, label, num_trees=1, max_depth=1)

    forest = trees.train_random_forest
    for module in (trees, training):
        monkeypatch.setattr(module, "train_random_forest", shuffled)
    sf = "/root/testdata/sf0.001"
    assert compare(QUERIES[name](spark, sf), connect(sf), ORACLES[name])


def test_subtrees_stop_where_leaf_wise_growth_would():
    """A small node's subtree makes no more cuts than the tree has leaves for, and the best of them; sums are the same counted a
    feature at a time."""
    rng = np.random.default_rng(5)
    bins = rng.integers(0, 40, (6, 4000)).astype(np.uint8)
    offsets = np.arange(0, 241, 40)
    g = np.rint(rng.normal(size=4000) * boosting.UNIT).astype(np.int64)
    h = np.rint(rng.random(4000) * boosting.UNIT).astype(np.int64)
    grown = [boosting.subtree(bins, g, h, offsets, 0, boosting.BoostingParams(2, max_depth=8, min_leaf=5, leaves=n)) for n in (12, 4000)]
    assert len(grown[0]) < 2 * 16 < 200 < len(grown[1])

    def first(found):
        best = lambda n: found[n][3]
        return [best(n) for n in boosting._leaf_wise(12, best, lambda n: (found[n][4], found[n][4] + 1) if best(n) else ())]

    assert len(first(grown[0])) == 11 and first(grown[0]) == first(grown[1])
    whole = boosting._sums(bins, g, h, offsets)
    assert all((whole[:, 0] == sum(boosting._sums(bins[:, i : i + 500], g[i : i + 500], h[i : i + 500], offsets)[:, 0] for i in range(0, 4000, 500))).ravel())


def _below_exchange(frame):
    """The lines of a plan that lie below an exchange, with the kinds of the exchanges above them."""
    above = []
    for line in frame._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
        above = [(d, kind) for d, kind in above if d < depth]
        yield line, [kind for _, kind in above]
        if "Exchange" in line:
            above.append((depth, "broadcast" if "BroadcastExchange" in line else "shuffle"))


def test_scoring_by_joins_sends_the_nodes_to_the_rows(spark):
    """Rows times trees are neither broadcast nor shuffled before they are added up, however small the rows' files are."""
    frame = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        spark.range(200).selectExpr("cast(id AS string) AS id", "id % 7D AS a", "id % 5D AS b", "cast(id % 3 AS double) AS y")
    )
    forest = trees.train_random_forest(frame, "y", num_trees=4, max_depth=3)
    booster = trees.train_boosted_trees(frame, "y", classes=3, rounds=2, max_depth=3, min_leaf=1)
    margins = boosting.margins_by_join(booster, frame, ["id"], last=True)
    for scored in (trees.probabilities_by_join(forest, frame), margins):
        found = [kinds for line, kinds in _below_exchange(scored) if "Generate explode" in line]
        assert found and all(kinds == ["shuffle"] for kinds in found)  # the one that adds up a row's trees
    rounds = boosting.margins_by_join(booster, frame, ["id"]).where("round = 2")
    whole = {(r["id"], r["class"]): r["margin"] for r in rounds.collect()}
    assert {(r["id"], r["class"]): r["margin"] for r in margins.collect()} == pytest.approx(whole)
    counts = dict(trees.score_batch(forest, frame).select("id", "probabilities").collect())
    for r in trees.probabilities_by_join(forest, frame).collect():
        assert r["probabilities"] == pytest.approx(counts[r["id"]])


def test_a_tree_is_grown_by_few_tasks(spark, monkeypatch):
    """Nodes that a task can hold, up to a root of more than 65,536 rows, are grown without a job a level, and rows lie in some
    waves of partitions, however many blocks they are; the trees are those counted level by level."""
    frame = spark.range(70_000).select(
        (F.col("id") % 3).cast("double").alias("y"),
        array_to_vector(F.array((F.col("id") * 7 % 50).cast("double"), (F.col("id") * F.col("id") % 41).cast("double"))).alias("features"),
    )
    params = BoostingParams(3, rounds=1, max_depth=6, leaves=12, min_leaf=20, l2=1e-6)
    by_level = train(frame, "y", params, local_rows=0)
    parts = []

    def no_level(*_):
        raise AssertionError("a job for a level")

    def grown(state, *rest):
        parts.append(state.rdd.getNumPartitions())
        return grow(state, *rest)

    grow = boosting.grow
    monkeypatch.setattr(boosting, "_histograms", no_level)
    monkeypatch.setattr(boosting, "grow", grown)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 500)
    assert train(frame, "y", params).rounds == by_level.rounds
    assert parts == [boosting.WAVES * spark.sparkContext.defaultParallelism]


def test_nodes_are_dealt_evenly():
    """A task has no second node while another has none."""
    rows = {(k, 0): 1000 + k for k in range(5)}
    assert sorted(boosting._dealt(rows, 5).values()) == list(range(5))
    assert sorted(boosting._dealt(rows | {(5, 0): 6000}, 2).values()) == [0, 1, 1, 1, 1, 1]
    wide = [np.array([5, -(1 << 28)]), np.array([1 << 40, 2, 3])]
    assert boosting._wide([boosting._narrow(w) for w in wide], [2, 3]).tolist() == [5, -(1 << 28), 1 << 40, 2, 3]


def test_margins_of_all_rounds_are_not_exchanged(spark):
    """Rows are dealt by their keys before they are repeated for rounds and classes; running sums and a row's classes stay there."""
    frame, _ = data(spark, 120)
    model = train(frame, "y", BoostingParams(3, rounds=3, max_depth=3, leaves=6, min_leaf=4, l2=1e-6))
    margins = boosting.margins_by_join(model, frame, ["id"]).groupBy("id", "round").agg(F.collect_list("margin"))
    found = [kinds for line, kinds in _below_exchange(margins) if "Generate explode" in line]
    assert found and all(kinds == [] for kinds in found)
