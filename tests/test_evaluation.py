import numpy as np
import pytest
from pyspark.sql import functions as F

from scoremill.operators import evaluation
from scoremill.operators.evaluation import gate, majority_score, roc_curve, rule_score, score_metrics, verdict


def brute(scores, y):
    pos, neg = scores[y == 1], scores[y == 0]
    auc = np.mean([(neg < p).mean() + (neg == p).mean() / 2 for p in pos])
    ks = max(abs((neg <= s).mean() - (pos <= s).mean()) for s in np.unique(scores))
    return auc, ks, np.mean((scores - y) ** 2)


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(3)
    y = (rng.random(4000) < 0.3).astype(int)
    score = np.clip(np.where(rng.random(4000) < 0.34, 0.25, rng.beta(2 + y, 4, 4000).round(3)), 0, 1)
    df = spark.createDataFrame([(float(s), int(t)) for s, t in zip(score, y)],
                               "score double, default_status int").repartition(6)
    return df, score, y


@pytest.fixture(params=["one bucket", "many buckets"])
def buckets(request, monkeypatch):
    if request.param == "many buckets":
        monkeypatch.setattr(evaluation, "ROWS_PER_BUCKET", 40)


def test_metrics_equal_brute_force(scored, buckets):
    df, score, y = scored
    row = score_metrics(df).first()
    auc, ks, brier = brute(score, y)
    assert (row["n"], row["n_bad"]) == (4000, y.sum())
    assert [row["auc"], row["ks"], row["brier"]] == pytest.approx([auc, ks, brier], abs=1e-12)
    assert row["gini"] == pytest.approx(2 * auc - 1)


def test_reversed_scores_mirror_the_auc(scored, buckets):
    df, *_ = scored
    auc = score_metrics(df).first()["auc"]
    mirrored = score_metrics(df.withColumn("score", 1 - F.col("score"))).first()["auc"]
    assert auc + mirrored == pytest.approx(1, abs=1e-12)


def test_constant_score_and_single_class(spark):
    df = spark.createDataFrame([(0.5, 0), (0.5, 1), (0.5, 1)], "score double, default_status int")
    row = score_metrics(df).first()
    assert (row["auc"], row["ks"], row["brier"]) == (0.5, 0.0, 0.25)
    alone = score_metrics(df.where("default_status = 1")).first()
    assert (alone["auc"], alone["ks"], alone["n"]) == (None, None, 2)


def curve_points(score, y):
    cuts = np.unique(score)[::-1]
    return [(0.0, 0.0)] + [((score[y == 0] >= c).mean(), (score[y == 1] >= c).mean()) for c in cuts]


def test_roc_has_every_distinct_score(scored, buckets):
    df, score, y = scored
    found = sorted((r["fpr"], r["tpr"]) for r in roc_curve(df).collect())
    np.testing.assert_allclose(found, sorted(curve_points(score, y)), atol=1e-12)


def test_dropping_collinear_points_keeps_the_shape(scored, buckets):
    df, score, y = scored
    cuts = np.unique(score)[::-1]
    steps = [((score[y == 0] == c).sum(), (score[y == 1] == c).sum()) for c in cuts]
    kept = [i for i in range(len(cuts)) if i in (0, len(cuts) - 1) or steps[i] != steps[i + 1]]
    points = curve_points(score, y)
    expected = sorted([points[0]] + [points[i + 1] for i in kept])
    found = sorted((r["fpr"], r["tpr"]) for r in roc_curve(df, drop_collinear=True).collect())
    np.testing.assert_allclose(found, expected, atol=1e-12)


def test_gate_needs_both_conditions(spark):
    df = spark.createDataFrame([(0.76, 0.80), (0.79, 0.80), (0.60, 0.71)],
                               "baseline_auc double, primary_auc double")
    rows = gate(df).withColumn("text", verdict()).collect()
    assert [r["passed"] for r in rows] == [True, False, False]
    assert rows[0]["text"] == (
        "SUPPORTED: Boosted trees AUC = 0.8000, LR baseline AUC = 0.7600, lift = 0.0400 (required >= 0.04), "
        "AUC threshold passed = True, lift threshold passed = True")
    assert rows[1]["text"].startswith("NOT SUPPORTED")


def test_rule_and_majority(spark):
    df = spark.createDataFrame([("A", 10.0, 0), ("E", 10.0, 1), ("B", 30.1, 0), (None, None, 0), ("G", None, 1)],
                               "grade string, dti double, y int")
    assert [r["s"] for r in df.select(rule_score().alias("s")).collect()] == [0.0, 1.0, 1.0, 0.0, 1.0]
    assert majority_score(df, "y") == 0.0
    assert majority_score(df.where("y = 1"), "y") == 1.0


@pytest.fixture(scope="module")
def segments(spark):
    """A segment with most of the rows, one without bads, one without a name, ties throughout."""
    rng = np.random.default_rng(11)
    size = 6000
    name = np.where(rng.random(size) < 0.7, "hot", rng.choice(["a", "b", "none", "good"], size))
    y = np.where(name == "good", 0, rng.random(size) < 0.3).astype(int)
    score = np.round(rng.beta(2 + y, 4), 2)
    rows = [(None if n == "none" else str(n), float(s), int(t)) for n, s, t in zip(name, score, y)]
    return spark.createDataFrame(rows, "grade string, score double, default_status int").repartition(7), name, score, y


@pytest.mark.parametrize("rows_per_bucket", [None, 30])
def test_metrics_of_models_and_segments_equal_brute_force(segments, rows_per_bucket):
    df, name, score, y = segments
    long = evaluation.by_model_and_segment(df, "default_status", {"own": F.col("score"), "mirrored": 1 - F.col("score"), "same": F.lit(0.5)},
                                           {"grade": F.col("grade")})
    found = {(r["model"], r["segment"], r["value"]): r for r in
             evaluation.metrics_by(long, ["model", "segment", "value"], rows_per_bucket=rows_per_bucket).collect()}
    assert len(found) == 3 * 6
    for value in ("all", "hot", "a", "b", "none", "good"):
        inside = np.ones(len(y), bool) if value == "all" else name == value
        for model, s in (("own", score), ("mirrored", 1 - score), ("same", np.full(len(y), 0.5))):
            row = found[model, "all" if value == "all" else "grade", None if value in ("all", "none") else value]
            assert (row["n"], row["n_bad"]) == (inside.sum(), y[inside].sum())
            if value == "good":
                assert (row["auc"], row["gini"], row["ks"]) == (None, None, None)
                assert row["brier"] == pytest.approx(np.mean(s[inside] ** 2))
            else:
                assert [row["auc"], row["ks"], row["brier"]] == pytest.approx(brute(s[inside], y[inside]), abs=1e-9)


@pytest.mark.parametrize("rows_per_bucket", [None, 20])
@pytest.mark.parametrize("drop", [True, False])
def test_curves_of_segments_equal_their_own(segments, rows_per_bucket, drop):
    df, name, score, y = segments
    rows = evaluation.roc_by(df, ["grade"], drop_collinear=drop, rows_per_bucket=rows_per_bucket).collect()
    for value in ("hot", "a", "none"):
        wanted = None if value == "none" else value
        alone = roc_curve(df.where(F.col("grade").eqNullSafe(F.lit(wanted))), drop_collinear=drop).collect()
        pick = lambda rs: sorted((r["threshold"], r["fpr"], r["tpr"]) for r in rs)
        np.testing.assert_allclose(pick(r for r in rows if r["grade"] == wanted), pick(alone), atol=1e-12)
    assert all(r["tpr"] is None for r in rows if r["grade"] == "good" and r["threshold"] != float("inf"))
