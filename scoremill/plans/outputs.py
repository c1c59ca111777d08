"""Writing the results of a run under one folder, as reports and reusable artifacts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoremill.operators import profiling, target
from scoremill.operators.cleaning import missing_profile
from scoremill.operators.points import point_range
from scoremill.plans.comparison import Comparison
from scoremill.plans.scorecard import ScorecardModel
from scoremill.sources.sinks import write_csv, write_json
from scoremill.spec import PROFILED_NUMBERS

# Column names of the report tables.
RANKING_NAMES = {"feature": "Feature", "importance": "SHAP_Importance", "importance_score": "SHAP_Score"}
CARD_NAMES = {"feature": "Feature", "category": "Category", "points": "Points"}
SELECTION_NAMES = {"iv": "IV_Score", "predictive_power": "Predictive_Power"}
MODEL_NAMES = {"model": "Model", "roc_auc": "ROC_AUC"}


def _report(df: DataFrame, path: str, first: str | None = None) -> None:
    write_csv(df, path, first, single_file=True)


def write_comparison(run: Comparison, folder: str, top: int = 10) -> None:
    """Metric records, ranking, model table and manifest."""
    ranking = run.ranking.cache()
    try:
        write_json(run.baseline, f"{folder}/baseline_metric")
        write_json(run.primary, f"{folder}/primary_metric")
        write_json(run.manifest.withColumn("generated_at", F.current_timestamp()), f"{folder}/manifest")
        _report(ranking.withColumnsRenamed(RANKING_NAMES), f"{folder}/scorecard_comparison")
        _report(ranking.orderBy(F.desc("importance"), "feature").limit(top)
                .withColumnsRenamed(RANKING_NAMES), f"{folder}/tables/top_features")
        _report(run.models.withColumnsRenamed(MODEL_NAMES), f"{folder}/tables/model_comparison")
    finally:
        ranking.unpersist()


def write_scorecard(card: ScorecardModel, folder: str, mode: str = "reference") -> None:
    """Weights, information values, selection, points and the reusable model."""
    card.save(f"{folder}/artifacts/scorecard")
    woe = card.woe_table()
    _report(woe.orderBy("feature", "bin_id").select(
        "feature", "bin", "good_count", "bad_count", "good_rate", "bad_rate", "woe", "iv"),
        f"{folder}/tables/woe_bins")
    iv = card.iv_table()
    _report(iv.select("feature", "iv"), f"{folder}/tables/iv_summary")
    _report(iv.withColumnsRenamed(SELECTION_NAMES), f"{folder}/tables/variable_selection", "feature")
    points = card.points(mode)
    _report(points.select("feature", "category", "points").withColumnsRenamed(CARD_NAMES),
            f"{folder}/tables/final_scorecard")
    _report(point_range(points), f"{folder}/tables/points_range")
    _report(card.coefficients(), f"{folder}/tables/coefficients")


def write_profile(df: DataFrame, folder: str, label: str = "default_status", raw: DataFrame | None = None,
                  digits: int = 6) -> None:
    """Every profile table of a cleaned, labelled frame that has the columns for it."""
    have = set(df.columns)
    numbers = [c for c in PROFILED_NUMBERS if c in have]
    tables = {"target_summary": target.target_summary(df, label),
              "default_rate_by_category": profiling.default_rate_by_category(df, label, top=None)}
    if raw is not None:
        tables["missing_profile"] = missing_profile(raw)
    if numbers:
        matrix = profiling.correlation_matrix(df, [label, *numbers])
        tables |= {"describe_by_class": profiling.describe_by_class(df, label),
                   "histograms": profiling.class_histograms(df, label),
                   "correlations": matrix,
                   "correlation_with_target": profiling.correlation_with_target(matrix, label),
                   "high_correlation_pairs": profiling.high_correlation_pairs(matrix, [label, *numbers])}
    if "grade" in have:
        tables["grade_default_rates"] = profiling.group_default_rates(df, label)
        tables["grade_crosstab"] = profiling.class_crosstab(df, label)
    if {"grade", "int_rate", "loan_amnt"} <= have:
        tables["grade_stats"] = profiling.grade_stats(df, label)
        tables["int_rate_boxes"] = profiling.box_summary(df, label)
    if {"purpose", "int_rate", "loan_amnt"} <= have:
        tables["purpose_stats"] = profiling.purpose_stats(df, label)
    for name, table in tables.items():
        _report(table, f"{folder}/tables/{name}")
