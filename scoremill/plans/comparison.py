"""Logistic baseline against boosted trees on raw features: metrics, ranking, manifest."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoremill.functions.expressions import as_number, linear, sigmoid
from scoremill.operators.attribution import attribution_ranking, tree_attribution
from scoremill.operators.evaluation import (
    BASELINE_NAME, by_model_and_segment, gate, metric_record, metrics_by, verdict)
from scoremill.operators.models import (
    LinearModel, feature_matrix, fit_boosted_trees, fit_logistic, model_features, scaling,
    score_trees, standardise)
from scoremill.operators.quantiles import median_values
from scoremill.operators.split import ROW_KEY, add_split, with_row_key
from scoremill.operators.target import add_target
from scoremill.sources.staging import stage, stage_observed

PRIMARY_NAME = "Boosted trees"


@dataclass(frozen=True)
class Comparison:
    """Results of one comparison run; every member is a small table."""

    baseline: DataFrame       # metric record
    primary: DataFrame        # metric record with gate
    models: DataFrame         # model, roc_auc
    ranking: DataFrame        # attribution ranking
    manifest: DataFrame       # one row


def prepared(df: DataFrame, key: str | None, target: str = "defaultstatus", policy: str = "four_status",
             share: float = 0.2, seed: int = 42, features: Sequence[str] | None = None,
             fit_on: str = "train") -> tuple[DataFrame, list[str]]:
    """Labelled, split and median-filled feature matrix with ``key, target, is_test``.

    Without a key the rows get one of their own, ``ROW_KEY``. Rows that are split already stay so.
    """
    if key is None:
        df, key = with_row_key(df), ROW_KEY
    labelled = df if target in df.columns else add_target(df, policy, target=target)
    names = list(features or model_features(labelled, key, target, ["is_test"]))
    if "is_test" in df.columns:
        split = labelled.select(key, target, "is_test", *names)
    else:
        split = add_split(labelled.select(key, target, *names), key, target, share, seed)
    fit_frame = split if fit_on == "all" else split.where(~F.col("is_test"))
    matrix = feature_matrix(split, names, [key, target, "is_test"], fit_frame)
    return matrix, [c for c in names if c in matrix.columns]


def fit_baseline(matrix: DataFrame, features: Sequence[str], target: str,
                 inverse_penalty: float = 1.0) -> tuple[LinearModel, dict]:
    """Standardised logistic regression on the training rows, and its scaling (M2, M3)."""
    train = matrix.where(~F.col("is_test")).select(target, *features)
    scales = scaling(train, features)
    return fit_logistic(standardise(train, scales), features, target, inverse_penalty), scales


def score_baseline(matrix: DataFrame, model: LinearModel, scales: dict, keep: Sequence[str],
                   column: str = "score") -> DataFrame:
    return standardise(matrix, scales).select(*keep, model.probability().alias(column))


@dataclass(frozen=True)
class Baseline:
    """The fitted baseline as an expression over raw rows: medians, scaling and coefficients are literals."""

    model: LinearModel
    scales: dict[str, tuple[float, float]]
    medians: dict[str, float]

    def probability(self) -> Column:
        """Probability of the bad outcome; missing values count as the median, as in the fit."""
        def scaled(name: str) -> Column:
            mean, spread = self.scales[name]
            value = as_number(F.col(name))
            return ((F.coalesce(value, F.lit(self.medians[name])) if name in self.medians else value) - mean) / spread
        return sigmoid(linear(self.model.intercept, [(scaled(c), w) for c, w in self.model.coefficients]))


def baseline_of(split: DataFrame, features: Sequence[str], target: str, inverse_penalty: float = 1.0,
                rows: int | None = None) -> Baseline:
    """The baseline of rows that are split (M2, M3, P14): filled with the training rows' medians, scaled and fitted.

    Means and deviations are observed as the filled rows are written. ``rows``, if known, saves their count.
    """
    train = split.where(~F.col("is_test")).select(target, *features)
    medians = {c: m for c, m in median_values(train, features, rows=rows).items() if m is not None}
    filled = train.select(target, *[F.coalesce(as_number(F.col(c)), F.lit(m)).alias(c) for c, m in medians.items()])
    staged, seen = stage_observed(filled, "baseline-matrix", {(c, f): f(c) for c in medians for f in (F.avg, F.stddev_pop)})
    scales = {c: (seen[c, F.avg], seen[c, F.stddev_pop] or 1.0) for c in medians}
    return Baseline(fit_logistic(standardise(staged, scales), list(medians), target, inverse_penalty), scales, medians)


def primary_record(metrics: DataFrame, baseline_auc: float, name: str = PRIMARY_NAME) -> DataFrame:
    """The stored record of the primary model (E6, E7) with its gate against the baseline."""
    judged = gate(metrics.select("*", F.col("auc").alias("primary_auc"), F.lit(baseline_auc).alias("baseline_auc")))
    return judged.select(
        F.lit(name).alias("model"), F.lit("ROC-AUC").alias("metric_name"), F.bround("auc", 6).alias("value"),
        "passed", "threshold", F.bround("lift", 6).alias("lift_over_baseline"), "lift_threshold",
        F.bround("baseline_auc", 6).alias("baseline_logreg_auc"),
        F.bround("ks", 6).alias("KS"), F.bround("brier", 6).alias("Brier"))


def model_table(spark: SparkSession, found: Sequence[tuple[str, float]]) -> DataFrame:
    """``model, roc_auc``, one row a model."""
    return spark.createDataFrame(list(found), "model string, roc_auc double")


def manifest(rows: DataFrame, features: int, source_mode: str, primary_name: str = PRIMARY_NAME) -> DataFrame:
    """Run record (S10, E8) from one row ``data_rows_after_filter, test_set_size, primary_auc,
    baseline_auc``."""
    judged = gate(rows)
    return judged.select(
        F.lit(source_mode).alias("data_mode_used"), "data_rows_after_filter",
        F.lit(features).cast("long").alias("features_used"), "test_set_size",
        F.bround("baseline_auc", 6).alias("baseline_roc_auc"),
        F.bround("primary_auc", 6).alias("primary_roc_auc"),
        F.col("passed").alias("primary_passed"),
        F.bround(2 * F.col("primary_auc") - 1, 6).alias("gini_coefficient"),
        verdict(primary_name=primary_name).alias("hypothesis_result"))


def compare_models(df: DataFrame, key: str | None = None, source_mode: str = "raw", trees: int = 500,
                   depth: int = 6, policy: str = "four_status", target: str = "defaultstatus",
                   features: Sequence[str] | None = None, seed: int = 42, primary_name: str = PRIMARY_NAME) -> Comparison:
    """The whole comparison; the prepared matrix is written once and read by each step.

    Both models score a test row in one pass and are judged together. Every test row is attributed, where it lies.
    """
    spark = df.sparkSession
    matrix, names = prepared(df, key, target, policy, seed=seed, features=features)
    key = key or ROW_KEY
    matrix, counts = stage_observed(matrix, "comparison-matrix", {"n": F.count(F.lit(1)), "t": F.count_if("is_test")})
    train, test = matrix.where(~F.col("is_test")), matrix.where("is_test")
    model, scales = fit_baseline(matrix, names, target)
    boosted = fit_boosted_trees(train, names, target, key, trees=trees, depth=depth, seed=seed)
    scores = {BASELINE_NAME: Baseline(model, scales, {}).probability(), primary_name: F.col("score")}
    judged = metrics_by(by_model_and_segment(score_trees(boosted, test, names), target, scores, {}), ["model"], target=target)
    columns = "n long, n_bad long, auc double, gini double, ks double, brier double"
    found = dict.fromkeys(scores, (0, 0, None, None, None, None)) | {r["model"]: tuple(r)[1:] for r in judged.collect()}
    auc = {m: v[2] for m, v in found.items()}
    both = spark.createDataFrame([(counts["n"], counts["t"], auc[primary_name], auc[BASELINE_NAME])],
                                 "data_rows_after_filter long, test_set_size long, "
                                 "primary_auc double, baseline_auc double")
    metrics = {m: spark.createDataFrame([v], columns) for m, v in found.items()}
    return Comparison(
        baseline=metric_record(metrics[BASELINE_NAME], BASELINE_NAME),
        primary=primary_record(metrics[primary_name], auc[BASELINE_NAME], primary_name),
        models=model_table(spark, [("Baseline LR", auc[BASELINE_NAME]), (primary_name, auc[primary_name])]),
        ranking=attribution_ranking(tree_attribution(test, boosted, names, key), key),
        manifest=manifest(both, len(names), source_mode, primary_name))
