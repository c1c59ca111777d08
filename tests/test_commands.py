import json

import pytest

from scoremill.__main__ import main
from scoremill.sources.sinks import write_csv
from scoremill_checks.loan_view import loan_view
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def loan_file(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("loans") / "csv")
    write_csv(loan_view(spark, SF_DIR), path)
    return path


def header(folder):
    return next(folder.glob("part-*.csv")).read_text().splitlines()[0]


def test_probe(spark, loan_file, capsys):
    main(["probe", "--data", loan_file], spark)
    assert "loan_status" in capsys.readouterr().out
    with pytest.raises(FileNotFoundError):
        main(["probe", "--data", loan_file + "-absent"], spark)


def test_profile(spark, loan_file, tmp_path):
    main(["profile", "--data", loan_file, "--out", str(tmp_path)], spark)
    names = {p.name for p in (tmp_path / "tables").iterdir()}
    assert {"describe_by_class", "histograms", "correlations", "grade_stats", "purpose_stats",
            "missing_profile", "int_rate_boxes", "default_rate_by_category"} <= names
    assert header(tmp_path / "tables" / "grade_stats") == (
        "grade,Total_Loans,Defaults,Default_Rate,Avg_Interest_Rate,Interest_Rate_Std,Avg_Loan_Amount")


def test_compare(spark, loan_file, tmp_path):
    main(["compare", "--data", loan_file + "-absent", "--fallback", loan_file, "--trees", "3",
          "--depth", "3", "--out", str(tmp_path)], spark)
    read = lambda name: json.loads(next((tmp_path / name).glob("part-*.json")).read_text())
    manifest, primary = read("manifest"), read("primary_metric")
    assert manifest["data_mode_used"] == "fallback"
    assert manifest["primary_roc_auc"] == primary["value"]
    assert read("baseline_metric")["value"] == primary["baseline_logreg_auc"]
    assert header(tmp_path / "scorecard_comparison") == "Feature,SHAP_Importance,SHAP_Score"


def test_scorecard_then_score(spark, loan_file, tmp_path):
    main(["scorecard", "--data", loan_file, "--out", str(tmp_path)], spark)
    assert header(tmp_path / "tables" / "final_scorecard") == "Feature,Category,Points"
    assert header(tmp_path / "tables" / "woe_bins") == (
        "feature,bin,good_count,bad_count,good_rate,bad_rate,woe,iv")
    main(["score", "--data", loan_file, "--card", str(tmp_path / "artifacts" / "scorecard"),
          "--out", str(tmp_path / "scored")], spark)
    scored = spark.read.option("header", True).csv(str(tmp_path / "scored"))
    assert scored.count() == 1500 and "predicted_default_probability" in scored.columns
