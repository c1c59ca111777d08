import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoremill.operators import attribution, models
from scoremill.operators.evaluation import score_metrics
from scoremill.plans.comparison import compare_models

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 3)) * [1, 10, 0.1] + [0, 50, 2]
    z = 1.2 * x[:, 0] - 0.08 * (x[:, 1] - 50) + (x[:, 0] > 0.5) * (x[:, 2] > 2) - 0.4
    y = (rng.random(3000) < 1 / (1 + np.exp(-z))).astype(int)
    rows = [(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id int, a double, b double, c double, y int").repartition(4).cache()


def newton(x, y, inverse_penalty):
    x = np.column_stack([np.ones(len(x)), x])
    beta, ridge = np.zeros(x.shape[1]), np.diag([0] + [1 / inverse_penalty] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        beta -= np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge, x.T @ (p - y) + ridge @ beta)
    return beta


@pytest.mark.parametrize("inverse_penalty", [1.0, 0.1])
def test_logistic_regression_equals_newton(frame, inverse_penalty):
    scales = models.scaling(frame, FEATURES)
    scaled = models.standardise(frame, scales)
    model = models.fit_logistic(scaled, FEATURES, "y", inverse_penalty)
    pdf = scaled.toPandas()
    beta = newton(pdf[FEATURES].to_numpy(), pdf["y"].to_numpy(), inverse_penalty)
    assert [model.intercept, *(c for _, c in model.coefficients)] == pytest.approx(list(beta), abs=1e-5)
    raw = models.unscaled(model, scales)
    scored = scaled.select("id", model.probability().alias("p")).join(
        frame.select("id", raw.probability().alias("q")), "id")
    assert scored.where(F.abs(F.col("p") - F.col("q")) > 1e-9).count() == 0


def test_standardise_uses_the_population_deviation_and_survives_a_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, k double")
    rows = models.standardise(df, models.scaling(df, ["x", "k"])).collect()
    assert sorted(r["x"] for r in rows) == [-1.0, 1.0] and [r["k"] for r in rows] == [0.0, 0.0]


def test_feature_matrix_leaves_out_identifiers_and_outcomes(spark):
    df = spark.createDataFrame([(1, 2, 3, 4.0, "x", 1, None), (2, 3, 4, 5.0, "x", 0, 7.0)],
                               "key int, id int, member_id int, total_pymnt double, grade string, y int, dti double")
    names = models.model_features(df, "key", "y")
    assert names == ["dti"]
    assert [r["dti"] for r in models.feature_matrix(df, names, ["key"]).orderBy("key").collect()] == [7.0, 7.0]


@pytest.fixture(scope="module")
def boosted(frame):
    return models.fit_boosted_trees(frame, FEATURES, "y", "id", trees=6, learning_rate=0.3, depth=3)


def test_boosted_trees_score_probabilities_that_rank(frame, boosted):
    scored = models.score_trees(boosted, frame, FEATURES).select(F.col("y").alias("default_status"), "score")
    row = scored.agg(F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    assert 0 <= row["lo"] <= row["hi"] <= 1
    assert score_metrics(scored).first()["auc"] > 0.75


def test_best_prefix_waits_for_patience():
    assert models.best_prefix([5, 4, 3, 4, 4, 2], 10) == (6, False)
    assert models.best_prefix([5, 4, 3, 4, 4, 2], 2) == (3, True)
    assert models.best_prefix([1.0], 3) == (1, False)


def test_small_steps_keep_boosting(frame):
    model = models.fit_boosted_trees(frame, FEATURES, "y", "id", trees=40, learning_rate=0.05, depth=2, patience=5)
    assert model.getNumTrees > 10


def test_the_first_rounds_are_the_same_trees(frame, boosted):
    part = models.first_rounds(boosted, 4)
    assert part.getNumTrees == 4 and part.treeWeights == boosted.treeWeights[:4]
    grown = models.fit_boosted_trees(frame, FEATURES, "y", "id", trees=4, learning_rate=0.3, depth=3)
    scores = lambda m: [r["score"] for r in models.score_trees(m, frame, FEATURES).orderBy("id").collect()]
    assert scores(part) == pytest.approx(scores(grown), abs=1e-12)


def test_no_round_is_grown_more_than_twice(frame, monkeypatch):
    """An early stop grows once; without one, all rounds are grown after the first try."""
    asked = []
    fit = models.GBTClassifier.fit
    monkeypatch.setattr(models.GBTClassifier, "fit", lambda self, data: asked.append(self.getMaxIter()) or fit(self, data))
    monkeypatch.setattr(models, "best_prefix", lambda losses, patience: (3, len(losses) < 20))
    assert models.fit_boosted_trees(frame, FEATURES, "y", "id", trees=40, depth=2, patience=2).getNumTrees == 3
    assert asked == [8]
    monkeypatch.setattr(models, "best_prefix", lambda losses, patience: (len(losses), len(losses) > 8))
    assert models.fit_boosted_trees(frame, FEATURES, "y", "id", trees=10, depth=2, patience=2).getNumTrees == 10
    assert asked == [8, 8, 10]


def stored_trees(spark, model, tmp_path):
    model.write().overwrite().save(str(tmp_path / "trees"))
    trees = {}
    for r in spark.read.parquet(str(tmp_path / "trees" / "data")).select("treeID", "nodeData.*").collect():
        trees.setdefault(r["treeID"], {})[r["id"]] = r
    return trees


def conditional(nodes, node, x, known):
    if node["leftChild"] < 0:
        return node["prediction"]
    left, right = nodes[node["leftChild"]], nodes[node["rightChild"]]
    f, cut = node["split"]["featureIndex"], node["split"]["leftCategoriesOrThreshold"][0]
    if f in known:
        return conditional(nodes, left if x[f] <= cut else right, x, known)
    return (left["rawCount"] * conditional(nodes, left, x, known)
            + right["rawCount"] * conditional(nodes, right, x, known)) / node["rawCount"]


@pytest.mark.parametrize("kept", [0, 200, 8_000_000])
def test_tree_attribution_equals_shapley_by_enumeration(spark, frame, boosted, tmp_path, monkeypatch, kept):
    """With the values of all leaves kept in a task, of some, and of none."""
    monkeypatch.setattr(attribution, "TABLE_NUMBERS", kept)
    trees = stored_trees(spark, boosted, tmp_path)
    sample = frame.orderBy("id").limit(25)
    found = {r["id"]: r for r in attribution.tree_attribution(sample, boosted, FEATURES, "id").collect()}

    def value(x, known):
        return 2 * sum(boosted.treeWeights[t] * conditional(n, n[0], x, known) for t, n in trees.items())

    for r in sample.collect():
        x = [r[f] for f in FEATURES]
        for i, f in enumerate(FEATURES):
            others, phi = [j for j in range(3) if j != i], 0.0
            for size in range(3):
                for s in itertools.combinations(others, size):
                    w = math.factorial(size) * math.factorial(2 - size) / 6
                    phi += w * (value(x, {*s, i}) - value(x, set(s)))
            assert found[r["id"]][f] == pytest.approx(phi, abs=1e-9)


def test_neighbouring_leaves_are_looked_up_together(spark, frame, boosted, monkeypatch):
    """A tree's leaves in a few tables, equal to leaf by leaf; also for values that are missing or without bound."""
    leaves = attribution.tree_leaves(spark, boosted)[0]
    assert 3 * len(attribution.leaf_groups(leaves)) < len(leaves)
    assert [x for g in attribution.leaf_groups(leaves) for x in g.leaves] == leaves
    assert all(g.cells <= 40 for g in attribution.leaf_groups(leaves, 40))
    odd = F.when(F.col("id") == 3, float("nan")).when(F.col("id") == 4, float("inf")).when(F.col("id") == 5, float("-inf"))
    for rows in (frame, frame.withColumn("a", F.coalesce(odd, "a"))):
        found = []
        for cells, kept in ((1024, 8_000_000), (40, 300), (1, 0)):
            monkeypatch.setattr(attribution, "CELLS", cells)
            monkeypatch.setattr(attribution, "TABLE_NUMBERS", kept)
            pushes = attribution.tree_attribution(rows, boosted, FEATURES, "id").orderBy("id").toPandas()
            found.append(pushes[FEATURES].to_numpy())
        assert len(found[0]) == 3000 and np.isfinite(found[0]).all()
        assert np.abs(found[0] - found[2]).max() < 1e-12 and np.abs(found[1] - found[2]).max() < 1e-12


def test_tree_attributions_add_up_to_the_log_odds(spark, frame, boosted, tmp_path):
    trees = stored_trees(spark, boosted, tmp_path)
    base = 2 * sum(boosted.treeWeights[t] * conditional(n, n[0], None, set()) for t, n in trees.items())
    total = attribution.tree_attribution(frame, boosted, FEATURES, "id").select(
        "id", (F.col("a") + F.col("b") + F.col("c") + base).alias("total"))
    scored = models.score_trees(boosted, frame, FEATURES)
    off = scored.join(total, "id").where(F.abs(F.ln(F.col("score") / (1 - F.col("score"))) - F.col("total")) > 1e-6)
    assert off.count() == 0


def test_linear_attribution_and_ranking(spark):
    df = spark.createDataFrame([(1, 1.0, 0.0), (2, 3.0, 0.0)], "id int, a double, b double")
    model = models.LinearModel(0.5, (("a", 2.0), ("b", -1.0)))
    pushes = attribution.linear_attribution(df, model, "id", {"a": 2.0, "b": 0.0})
    rows = [tuple(r) for r in attribution.attribution_ranking(pushes, "id").collect()]
    assert rows == [("a", 2.0, 100.0), ("b", 0.0, 0.0)]
    still = pushes.select("id", (F.col("a") * 0).alias("a"))
    assert [tuple(r) for r in attribution.attribution_ranking(still, "id").collect()] == [("a", 0.0, 0.0)]
    top = attribution.top_features(attribution.attribution_ranking(pushes, "id"), 1)
    assert [r["feature"] for r in top.collect()] == ["a"]


def test_comparison_run(spark, frame):
    loans = frame.withColumn("loan_status", F.when(F.col("y") == 1, "Charged Off").otherwise("Fully Paid")).drop("y")
    run = compare_models(loans, "id", trees=5, depth=3)
    manifest, baseline, primary = run.manifest.first(), run.baseline.first(), run.primary.first()
    assert (manifest["data_rows_after_filter"], manifest["test_set_size"], manifest["features_used"]) == (3000, 600, 3)
    assert manifest["baseline_roc_auc"] == baseline["value"] and manifest["primary_roc_auc"] == primary["value"]
    assert manifest["gini_coefficient"] == pytest.approx(2 * primary["value"] - 1, abs=2e-6)
    assert primary["lift_over_baseline"] == pytest.approx(primary["value"] - baseline["value"], abs=2e-6)
    assert manifest["primary_passed"] == primary["passed"]
    ranking = run.ranking.collect()
    assert ranking[0]["importance_score"] == 100.0 and len(ranking) == 3
    assert run.models.count() == 2
