import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from scoremill import ScorecardModel, ScorecardSpec, fit_scorecard
from scoremill.operators.points import FACTOR, OFFSET, point_range
from scoremill.plans.scorecard import PROBABILITY
from scoremill.streaming.scoring import read_new_files, score_stream
from scoremill_checks.loan_view import loan_view
from scoremill_checks.queries import SPEC
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def loans(spark):
    return loan_view(spark, SF_DIR).cache()


@pytest.fixture(scope="module")
def card(loans):
    return fit_scorecard(loans, SPEC)


def scores(df):
    return {r["loan_id"]: r[PROBABILITY] for r in df.select("loan_id", PROBABILITY).collect()}


def test_a_row_scores_the_same_alone_and_in_any_partitioning(card, loans):
    everything = scores(card.transform(loans))
    assert scores(card.transform(loans.repartition(7))) == everything
    few = scores(card.transform(loans.where("loan_id % 50 = 0")))
    assert few == {k: everything[k] for k in few} and few


def test_scoring_neither_shuffles_nor_leaves_the_jvm(card, spark):
    plan = card.transform(spark.read.parquet(f"{SF_DIR}/orders.parquet").select(
        F.col("o_totalprice").alias("loan_amnt")))._jdf.queryExecution().executedPlan().toString().replace("BroadcastExchange", "")
    assert not any(word in plan for word in ("Exchange", "Python", "Window", "Sort"))


def test_absent_and_text_columns(card, loans):
    everything = scores(card.transform(loans))
    as_text = loans.select(*[F.col(c).cast("string").alias(c) if c in ("annual_inc", "sum_qty") else F.col(c)
                             for c in loans.columns])
    assert scores(card.transform(as_text)) == everything
    dropped = card.transform(loans.drop("grade"))
    nulled = card.transform(loans.withColumn("grade", F.lit(None).cast("string")))
    assert scores(dropped) == scores(nulled)
    unparsable = card.transform(loans.withColumn("annual_inc", F.lit("n/k")))
    assert unparsable.where(F.col(PROBABILITY).isNull()).count() == 0


def test_saved_model_scores_alike(card, loans, spark, tmp_path):
    card.save(str(tmp_path / "card"))
    loaded = ScorecardModel.load(spark, str(tmp_path / "card"))
    assert scores(loaded.transform(loans)) == scores(card.transform(loans))
    assert loaded.spec == card.spec and loaded.bins == card.bins
    key = lambda r: (r["feature"], r["bin_id"])
    assert sorted(loaded.points().collect(), key=key) == sorted(card.points().collect(), key=key)


def test_output_columns_and_back_test(card, loans):
    out = card.score_file(loans)
    assert out.columns == ["id", "member_id", "loan_amnt", "term", "int_rate", "grade", "home_ownership",
                           "annual_inc", PROBABILITY]
    row = card.back_test(loans).first()
    assert row["n"] == loans.count() and 0.5 < row["auc"] < 1 and row["gini"] == 2 * row["auc"] - 1


def test_points(card):
    k = len(card.features)
    base = round(OFFSET - FACTOR * card.model.intercept / k)
    coefficient = dict(card.model.coefficients)
    for r in card.points().collect():
        w = next(w for w in card.weights if (w["feature"], w["bin_id"]) == (r["feature"], r["bin_id"]))
        assert r["points"] == round(-FACTOR * (w["woe"] * coefficient[r["feature"] + "_woe"])) + base
    ranges = point_range(card.points()).collect()
    assert {r["feature"] for r in ranges} == set(card.features)
    assert all(r["points_range"] == r["max_points"] - r["min_points"] >= 0 for r in ranges)
    with pytest.raises(ValueError):
        card.points("other")


def test_additive_points_are_on_the_scale(card, loans):
    both = card.total_points(card.transform(loans))
    exact = OFFSET - FACTOR * F.ln(F.col(PROBABILITY) / (1 - F.col(PROBABILITY)))
    gap = both.select(F.max(F.abs(F.col("score") - exact)).alias("g")).first()["g"]
    assert gap <= len(card.features)


def test_scale_constants():
    assert FACTOR == pytest.approx(28.8539, abs=1e-4) and OFFSET == pytest.approx(487.1229, abs=1e-4)


def test_fit_on_all_or_train(loans):
    train = fit_scorecard(loans, SPEC, closed_form=True)
    everyone = fit_scorecard(loans, replace(SPEC, fit_on="all"), closed_form=True)
    count = lambda c: sum(w["good_count"] + w["bad_count"] for w in c.weights if w["feature"] == "grade")
    assert count(train) < count(everyone)
    assert math.isclose(count(train) / count(everyone), 0.8, abs_tol=0.01)


def test_default_features_leave_out_leakage(spark, loans):
    card = fit_scorecard(loans, ScorecardSpec(key="loan_id", test_share=0.2))
    used = {b.feature for b in card.bins}
    assert not used & {"id", "member_id", "total_pymnt", "recoveries", "emp_title", "funded_amnt", "loan_status"}
    assert {"grade", "annual_inc", "emp_length", "term"} <= used


def test_nothing_to_select_is_an_error(spark, loans):
    with pytest.raises(ValueError, match="no feature"):
        fit_scorecard(loans, replace(SPEC, iv_range=(5.0, 6.0)))


def test_stream_scores_like_batch(card, loans, spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    loans.repartition(3).write.parquet(source)
    query = score_stream(card, read_new_files(spark, source, loans.schema, 1), out, str(tmp_path / "mark"), once=True)
    query.awaitTermination()
    found = {r["id"]: r[PROBABILITY] for r in spark.read.parquet(out).collect()}
    assert found == {r["id"]: r[PROBABILITY] for r in card.score_file(loans).collect()}
