"""The registered queries: one per operator, over the loan view of a scale-factor folder."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoremill.functions.columns import numeric_columns
from scoremill.operators import attribution, binning, cleaning, comoments, evaluation, models, points
from scoremill.operators import profiles, profiling, target
from scoremill.operators import woe as weight
from scoremill.operators.quantiles import exact_quantiles, median_values
from scoremill.operators.split import ROW_KEY, add_split, fixed_sample, with_row_key
from scoremill.plans import comparison
from scoremill.plans.scorecard import (
    PROBABILITY, ScorecardModel, fit_scorecard, fit_weights, with_target_and_split)
from scoremill.sources import loans as source
from scoremill.sources import versions
from scoremill.sources.session import tuned
from scoremill.sources.sinks import write_csv, write_json
from scoremill.sources.staging import new_path, stage, stage_observed
from scoremill.spec import ScorecardSpec
from scoremill.streaming.back_test import back_test_stream, period_metrics
from scoremill.streaming.scoring import read_new_files
from scoremill_checks.loan_view import KEY, TARGET, cleaned, input_files, loans

Query = Callable[[SparkSession, str], DataFrame]

NUMBERS = ("loan_amnt", "annual_inc", "n_items", "avg_disc", "sum_qty")
CATEGORIES = ("grade", "purpose", "addr_state")
PROFILED = ("loan_amnt", "funded_amnt", "int_rate", "installment", "annual_inc", "dti", "revol_util")
CORRELATED = (TARGET, "loan_amnt", "annual_inc", "n_items", "avg_disc", "sum_qty", "int_rate", "dti",
              "mths_since_last_delinq", "revol_util", "funded_amnt", "installment", "total_pymnt")
LOAN_NUMBERS = ("loan_id", "id", "member_id", "loan_amnt", "annual_inc", "n_items", "avg_disc", "sum_qty", "int_rate", "dti",
                "mths_since_last_delinq", "revol_util", "funded_amnt", "installment", "total_pymnt", "recoveries", "dti_joint")
NEW_LOANS_FROM = "1997-01-01"

SPEC = ScorecardSpec(key=KEY, target=TARGET, policy="four_status", test_share=0.2, fit_on="train",
                     features=NUMBERS + CATEGORIES)
ALL_NUMBERS = ("loan_amnt", "annual_inc", "n_items", "avg_disc", "sum_qty", "int_rate", "dti",
               "mths_since_last_delinq", "revol_util", "installment")
ALL_TEXTS = ("grade", "purpose", "addr_state", "employer", "term", "emp_length", "home_ownership")
STUMP = ("n_items", "grade_no", "months")
SAMPLE = 1000
SCORECARD = "WoE scorecard"
ROW_COLUMNS = ("loan_status", "grade", "purpose", "term")


def stump_columns() -> dict[str, Column]:
    return {"grade_no": F.ascii("grade") - 64, "months": F.regexp_extract("term", r"(\d+)", 1).cast("int")}


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Round every double so that engines that add in another order agree; -0 becomes 0."""
    def tidy(name: str, kind: str):
        if kind != "double":
            return F.col(name)
        value = F.round(F.col(name), special.get(name, digits))
        return F.when(value == 0, F.lit(0.0)).otherwise(value).alias(name)
    return df.select(*[tidy(c, t) for c, t in df.dtypes])


def longs(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("long").alias(c) if t in ("int", "smallint") else F.col(c)
                       for c, t in df.dtypes])


def tidy(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    return longs(rounded(df, digits, **special))


# --- sources, target, cleaning -------------------------------------------------------------

def with_date(df: DataFrame) -> DataFrame:
    return df.withColumn("issue_d", F.date_format("issue_d", "yyyy-MM-dd"))


def load_loans(spark, sf):
    """Write the view as CSV, then read it back the way a loan file is read."""
    path = new_path(spark, "loans-csv")
    write_csv(with_date(loans(spark, sf)), path)
    mode, found = source.resolve_source(spark, ("raw", path + "-absent"), ("fallback", path))
    return source.read_loans_csv(spark, found).select(F.lit(mode).alias("data_mode"), "*")


def written_lines(spark, sf, titles: str, line: Column) -> str:
    """A CSV file per grade, written as lines in the order of the key under its titles; a folder of them."""
    path = new_path(spark, "lines")
    rows = loans(spark, sf).select("grade", F.col(KEY).alias("at"), line.alias("value"))
    tops = rows.select("grade").distinct().select("grade", F.lit(None).cast("bigint").alias("at"), F.lit(titles).alias("value"))
    (rows.unionByName(tops).repartition("grade").sortWithinPartitions("grade", F.asc_nulls_first("at"))
     .select("grade", "value").write.partitionBy("grade").text(path))
    return path


def csv_types(spark, sf):
    """Text that only looks like numbers stays text, and a repeated name is numbered."""
    n = F.col("n_items")
    unit = F.concat(n.cast("string"), F.when(n % 2 == 0, "D").otherwise("F"))
    none = F.lit("")
    path = written_lines(spark, sf, "loan_id,unit,amount,amount,power", F.concat_ws(
        ",", KEY, F.coalesce(unit, none), "loan_amnt", F.coalesce(n.cast("string"), F.lit("NA")), F.coalesce(F.concat(n.cast("string"), F.lit("e2")), none)))
    found = source.read_loans_csv(spark, path, integers=[KEY])
    kinds = ",".join(f"{c}:{t}" for c, t in found.dtypes)
    return tidy(found.select(F.lit(kinds).alias("kinds"), KEY, "unit", "amount", F.col("`amount.1`").alias("items"), "power"))


def refused_rows(spark, sf):
    """Rows that lack a field, left out of the scan and written aside with their file and line."""
    fields = F.concat_ws(",", KEY, "purpose", F.when(F.coalesce(F.col("n_items"), F.lit(0)) != 3, F.col("loan_amnt").cast("string")))
    path, aside = written_lines(spark, sf, "loan_id,purpose,loan_amnt", fields), new_path(spark, "refused")
    kept = source.read_loans_csv(spark, path, refused_limit=10**9, quarantine=aside)
    refused = spark.read.parquet(aside)
    grade = F.regexp_extract("file", "grade=(.)", 1)
    return (refused.select(F.lit("refused").alias("fate"), grade.alias("grade"), F.col("line").cast("bigint").alias("line"), "text")
            .unionByName(kept.select(F.lit("kept").alias("fate"), F.lit(None).cast("string").alias("grade"),
                                     F.col(KEY).cast("bigint").alias("line"), F.col("purpose").alias("text"))))


def key_first_csv(spark, sf):
    """Write with the status in front, and read back: the first column's name and the rows."""
    path = new_path(spark, "key-first-csv")
    write_csv(loans(spark, sf).select("loan_id", "loan_amnt", "grade", "loan_status"), path, first="loan_status")
    read = source.read_loans_csv(spark, path)
    return longs(read.select(F.lit(read.columns[0]).alias("first_column"),
                             F.col("loan_id").cast("bigint").alias("loan_id"), "loan_amnt", "grade", "loan_status"))


def json_record(spark, sf):
    """Write a record as JSON, an empty field included, and read it back."""
    path = new_path(spark, "record-json")
    write_json(target.target_summary(labelled(spark, sf)).withColumn("note", F.lit(None).cast("string")), path)
    return tidy(spark.read.schema("total_rows bigint, good_loans bigint, bad_loans bigint, bad_rate double, "
                                  "note string").json(path))


def probe_columns(spark, sf):
    return source.probe(loans(spark, sf).orderBy(KEY))


def target_four_status(spark, sf):
    return longs(target.add_target(loans(spark, sf), "four_status", target="defaultstatus")
                 .select(KEY, "loan_status", "defaultstatus"))


def target_all_rows(spark, sf):
    return longs(target.add_target(loans(spark, sf), "all_rows").select(KEY, "loan_status", TARGET))


def target_summary(spark, sf):
    return tidy(target.target_summary(target.add_target(loans(spark, sf), "four_status")))


def status_distribution(spark, sf):
    return target.frequency(loans(spark, sf), "loan_status")


def event_distribution(spark, sf):
    return target.frequency(spark.read.parquet(f"{sf}/events.parquet"), "event_type")


def missing_profile(spark, sf):
    return tidy(cleaning.missing_profile(loans(spark, sf)))


def observed(spark, sf) -> tuple[DataFrame, dict]:
    """The labelled view, written again, with what was observed on the way."""
    df = labelled(spark, sf)
    return stage_observed(df, "observed-loans", {**cleaning.null_totals(df), **target.target_totals()})


def missing_profile_observed(spark, sf):
    """The missing values of the labelled rows, counted while they are written."""
    df, seen = observed(spark, sf)
    return tidy(cleaning.observed_missing(spark, {c: seen[c] for c in ["", *df.columns]}))


def target_summary_observed(spark, sf):
    df, seen = observed(spark, sf)
    return tidy(target.observed_summary(spark, seen, len(df.columns)))


def residual_nulls(spark, sf):
    return cleaning.residual_nulls(cleaned(spark, sf))


def impute_constants(spark, sf):
    return cleaning.fill_constants(loans(spark, sf)).select(
        KEY, "emp_length", "emp_title", "mths_since_last_delinq")


def impute_median(spark, sf):
    names = ["n_items", "avg_disc", "sum_qty", "revol_util"]
    df = loans(spark, sf)
    return tidy(cleaning.apply_fills(df, median_values(df, names)).select(KEY, *names))


def impute_mode(spark, sf):
    names = ["home_ownership", "emp_length", "emp_title"]
    df = loans(spark, sf)
    return cleaning.apply_fills(df, cleaning.mode_values(df, names)).select(KEY, *names)


def clean_loans(spark, sf):
    df = target.add_target(loans(spark, sf), "all_rows", target=TARGET)
    return tidy(cleaning.clean(df, target=TARGET))


def feature_matrix(spark, sf):
    df = target.add_target(loans(spark, sf), "four_status", target=TARGET)
    names = models.model_features(df, KEY, TARGET, ("dti_joint",))
    return tidy(models.feature_matrix(df, names, [KEY, TARGET]))


# --- profile -------------------------------------------------------------------------------

def default_rate_by_category(spark, sf):
    return tidy(profiling.default_rate_by_category(cleaned(spark, sf), TARGET))


def grade_stats(spark, sf):
    return profiling.grade_stats(cleaned(spark, sf), TARGET)


def purpose_stats(spark, sf):
    return profiling.purpose_stats(cleaned(spark, sf), TARGET)


def grade_default_rates(spark, sf):
    df = target.add_target(loans(spark, sf), "four_status", target=TARGET)
    return tidy(profiling.group_default_rates(df, TARGET))


def class_crosstab_pct(spark, sf):
    return tidy(profiling.class_crosstab(cleaned(spark, sf), TARGET))


def describe_by_class(spark, sf):
    return tidy(profiling.describe_by_class(cleaned(spark, sf), TARGET, PROFILED), 4)


def corr_matrix(spark, sf):
    return tidy(profiling.correlation_matrix(cleaned(spark, sf), CORRELATED))


def corr_all_numbers(spark, sf):
    """Every pair of the raw view's numbers, with the rows that hold both; one of them never has a value."""
    df = loans(spark, sf)
    return tidy(comoments.correlations(df, numeric_columns(df)))


def corr_with_target(spark, sf):
    matrix = profiling.correlation_matrix(cleaned(spark, sf), CORRELATED)
    return tidy(profiling.correlation_with_target(matrix, TARGET))


def high_corr_pairs(spark, sf):
    matrix = profiling.correlation_matrix(cleaned(spark, sf), CORRELATED)
    return tidy(profiling.high_correlation_pairs(matrix, CORRELATED))


def hist_by_class(spark, sf):
    return tidy(profiling.class_histograms(cleaned(spark, sf), TARGET, PROFILED), lo=4, hi=4, density=8)


def box_by_grade_class(spark, sf):
    return tidy(profiling.box_summary(cleaned(spark, sf), TARGET))


# --- weight of evidence --------------------------------------------------------------------

def labelled(spark, sf, policy="four_status"):
    return target.add_target(loans(spark, sf), policy, target=TARGET)


def fitted_weights(spark, sf):
    return fit_weights(labelled(spark, sf), SPEC)


def quantile_edges(spark, sf):
    return tidy(binning.edges_table(labelled(spark, sf), NUMBERS))


def quantile_edges_bracketed(spark, sf):
    """The same edges the way larger tables take: a sketch brackets the ranks, a scan counts exactly."""
    return tidy(binning.edges_table(labelled(spark, sf), NUMBERS, buffer_values=0))


def monthly_profile(spark, sf) -> tuple[DataFrame, profiles.Profile]:
    """The labelled view as files of two halves, and the profile of the halves: the second is read alone, when it comes."""
    folder, store = new_path(spark, "monthly"), new_path(spark, "profile")
    late = F.col("issue_d") >= F.lit(NEW_LOANS_FROM).cast("timestamp_ntz")
    rows = loans(spark, sf)
    for half in (~late, late):
        rows.where(half).write.mode("append").parquet(folder)
        profiles.update(spark, store, spark.read.parquet(folder).inputFiles(), lambda new: spark.read.schema(rows.schema).parquet(*new))
    return spark.read.parquet(folder), profiles.merged(spark, store)


def profile_merged(spark, sf):
    """Rows, missing values, range, deciles and whether there are few values, from the merged profile of two halves."""
    df, profile = monthly_profile(spark, sf)
    names = [c for c in LOAN_NUMBERS if profile.present[c]]
    deciles = exact_quantiles(df, {c: F.col(c) for c in names}, [k / 10 for k in range(1, 10)], profile=profile)
    few = binning.few_distinct(df, dict.fromkeys(LOAN_NUMBERS, 10), profile.sketch())
    rows = [(c, profile.rows, profile.missing()[c], *profile.ends[c], deciles.get(c), few[c]) for c in LOAN_NUMBERS]
    table = spark.createDataFrame(rows, "feature string, n long, missing long, low double, high double, deciles array<double>, few boolean")
    return tidy(table.select("feature", "n", "missing", "low", "high", "few", *[F.col("deciles")[k].alias(f"d{k + 1}") for k in range(9)]))


def clean_from_profile(spark, sf):
    """The cleaned table with what the merged profile knows of it."""
    df, profile = monthly_profile(spark, sf)
    return tidy(cleaning.clean(target.add_target(df, "all_rows", target=TARGET), target=TARGET, profile=profile))


def equal_width_edges(spark, sf):
    return tidy(binning.edges_table(labelled(spark, sf), NUMBERS, method="equal_width"))


def woe_bins(spark, sf):
    _, _, rows = fitted_weights(spark, sf)
    return tidy(weight.woe_frame(spark, rows).drop("bin"))


def all_variables(spark, sf) -> DataFrame:
    """Every column that may be binned; the employer has far more than 100 values."""
    return labelled(spark, sf).withColumn("employer", F.col("emp_title"))


def iv_all_variables(spark, sf):
    _, _, rows = fit_weights(all_variables(spark, sf), replace(SPEC, features=None))
    return tidy(weight.iv_table(weight.woe_frame(spark, rows)))


def iv_summary(spark, sf):
    _, _, rows = fitted_weights(spark, sf)
    return tidy(weight.iv_table(weight.woe_frame(spark, rows)))


def iv_selection(spark, sf):
    _, _, rows = fitted_weights(spark, sf)
    return tidy(weight.select_features(weight.iv_table(weight.woe_frame(spark, rows))))


def woe_transform(spark, sf):
    df = labelled(spark, sf)
    fills, bins, rows = fit_weights(df, SPEC)
    return tidy(weight.woe_matrix(cleaning.apply_fills(df, fills), bins, rows, [KEY, TARGET]))


def document_iv(spark, sf):
    """The same weights on another table: document quality by language, source and length."""
    read = lambda t: spark.read.parquet(f"{sf}/{t}.parquet")
    df = read("documents").select("doc_id", "lang", "source", "n_chars").join(
        read("labels").select("doc_id", "quality"), "doc_id")
    bins = binning.fit_bins(df, ["n_chars"], ["lang", "source"])
    return tidy(weight.iv_table(weight.woe_table(df, bins, "quality")))


# --- split, metrics ------------------------------------------------------------------------

def stratified_split(spark, sf):
    return longs(with_target_and_split(loans(spark, sf), SPEC).select(KEY, TARGET, "is_test"))


def stratified_split_rows(spark, sf):
    """The split of rows without an identifier; equal rows are counted together."""
    df = with_row_key(labelled(spark, sf).select(TARGET, *ROW_COLUMNS))
    return (add_split(df, ROW_KEY, TARGET, 0.2).groupBy(*ROW_COLUMNS)
            .agg(F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("n_test")))


def sampled_rows(spark, sf):
    """A sample of a fixed size (M7)."""
    return fixed_sample(loans(spark, sf).select(KEY, "grade"), KEY, SAMPLE)


def standardize(spark, sf):
    df = add_split(labelled(spark, sf), KEY, TARGET, SPEC.test_share)
    train = df.where(~F.col("is_test"))
    names = list(NUMBERS)
    matrix = models.feature_matrix(df, names, [KEY, "is_test"], train)
    scales = models.scaling(matrix.where(~F.col("is_test")), names)
    return tidy(models.standardise(matrix, scales), 5)


def fitted(spark, sf, closed_form: bool = False) -> tuple[ScorecardModel, DataFrame]:
    """A scorecard fitted on the training rows, and the split rows."""
    split = with_target_and_split(loans(spark, sf), SPEC)
    return fit_scorecard(split, SPEC, closed_form), split


def scored_test(spark, sf) -> DataFrame:
    """Held-out rows with the score of a scorecard fitted on the others."""
    card, split = fitted(spark, sf)
    return card.transform(split.where("is_test"), "score")


def metrics(spark, sf):
    return evaluation.score_metrics(scored_test(spark, sf).select("score", TARGET))


def metric_auc(spark, sf):
    return tidy(metrics(spark, sf).select("n", "n_bad", "auc", "gini"))


def metric_ks(spark, sf):
    return tidy(metrics(spark, sf).select("n", "n_bad", "ks"))


def metric_brier(spark, sf):
    return tidy(metrics(spark, sf).select("n", "n_bad", "brier"))


def metrics_in_buckets(spark, sf):
    """All metrics with the distinct scores spread over many buckets."""
    scored = scored_test(spark, sf).select("score", TARGET)
    return tidy(evaluation.score_metrics(scored, rows_per_bucket=50))


def closed_form_metrics(spark, sf):
    """Metrics of the scorecard whose log-odds are the weights' own sum."""
    card, split = fitted(spark, sf, closed_form=True)
    return tidy(evaluation.score_metrics(card.transform(split.where("is_test"), "score").select("score", TARGET)))


def roc_curve(spark, sf):
    return tidy(evaluation.roc_curve(scored_test(spark, sf).select("score", TARGET)), threshold=4)


def roc_curve_plotted(spark, sf):
    scored = scored_test(spark, sf).select("score", TARGET)
    return tidy(evaluation.roc_curve(scored, drop_collinear=True, rows_per_bucket=50), threshold=4)


def rule_scored(split: DataFrame) -> DataFrame:
    return split.where("is_test").select(TARGET, evaluation.rule_score().alias("score"))


def majority_scored(split: DataFrame) -> DataFrame:
    score = evaluation.majority_score(split.where(~F.col("is_test")), TARGET)
    return split.where("is_test").select(TARGET, F.lit(score).alias("score"))


def rules_baseline(spark, sf):
    return tidy(evaluation.score_metrics(rule_scored(with_target_and_split(loans(spark, sf), SPEC))))


def majority_baseline(spark, sf):
    return tidy(evaluation.score_metrics(majority_scored(with_target_and_split(loans(spark, sf), SPEC))))


def rivals(spark, sf) -> tuple[DataFrame, dict[str, Column], dict[str, int]]:
    """Held-out rows, the scores of every model over them, and how many rows were kept and held out.

    The split rows are written once; the scorecard's score is a column, the others are expressions.
    """
    split, seen = stage_observed(with_target_and_split(loans(spark, sf), SPEC), "split-rows", {
        "kept": F.count(F.lit(1)), "test": F.count_if("is_test"),
        **{f"train_{k}": F.count_if(~F.col("is_test") & (F.col(TARGET) == k)) for k in (0, 1)}})
    card = fit_scorecard(split, SPEC)
    baseline = comparison.baseline_of(split, NUMBERS, TARGET, rows=seen["kept"] - seen["test"])
    majority = evaluation.majority_of(seen["train_0"], seen["train_1"])
    scores = {evaluation.BASELINE_NAME: baseline.probability(), SCORECARD: F.col("score"),
              "Policy rule": evaluation.rule_score(), "Majority class": F.lit(majority)}
    return card.transform(split.where("is_test"), "score"), scores, seen


def metrics_by_segment(spark, sf):
    """Every model's metrics over all held-out rows, each grade and each month, in one set of jobs."""
    rows, scores, _ = rivals(spark, sf)
    long = evaluation.by_model_and_segment(rows, TARGET, scores, {"grade": F.col("grade"), "month": F.date_format("issue_d", "yyyy-MM")})
    return tidy(evaluation.metrics_by(long, ["model", "segment", "value"]), 5)


def roc_by_grade(spark, sf):
    """ROC points of every grade, its scores spread over several buckets."""
    scored = scored_test(spark, sf).select("grade", "score", TARGET)
    return tidy(evaluation.roc_by(scored, ["grade"], rows_per_bucket=200), threshold=4)


def gated(spark, sf) -> DataFrame:
    """``baseline_auc, primary_auc, primary_ks, primary_brier, test_set_size, data_rows_after_filter`` of the logistic
    baseline and the scorecard."""
    rows, scores, seen = rivals(spark, sf)
    two = {m: scores[m] for m in (evaluation.BASELINE_NAME, SCORECARD)}
    found = evaluation.metrics_by(evaluation.by_model_and_segment(rows, TARGET, two, {}), ["model"])
    of = lambda model, column: F.max(F.when(F.col("model") == model, F.col(column)))
    return found.agg(of(evaluation.BASELINE_NAME, "auc").alias("baseline_auc"), *[
        of(SCORECARD, c).alias(f"primary_{c}") for c in ("auc", "ks", "brier")], F.max("n").alias("test_set_size")).select(
        "*", F.lit(seen["kept"]).cast("long").alias("data_rows_after_filter"))


def model_table(spark, sf):
    found = gated(spark, sf).first()
    return tidy(comparison.model_table(spark, [("Baseline LR", found["baseline_auc"]), (SCORECARD, found["primary_auc"])]))


def primary_record(spark, sf):
    found = gated(spark, sf).first()
    measured = spark.createDataFrame([(found["primary_auc"], found["primary_ks"], found["primary_brier"])], "auc double, ks double, brier double")
    return tidy(comparison.primary_record(measured, found["baseline_auc"], SCORECARD))


def pass_gate(spark, sf):
    return tidy(evaluation.gate(gated(spark, sf).select("baseline_auc", "primary_auc")))


def metrics_report(spark, sf):
    rows, scores, _ = rivals(spark, sf)
    three = {m: scores[m] for m in ("Policy rule", "Majority class", SCORECARD)}
    found = evaluation.metrics_by(evaluation.by_model_and_segment(rows, TARGET, three, {}), ["model"])
    return tidy(evaluation.metric_record(found, F.col("model")))


# --- points, scoring -----------------------------------------------------------------------

def scorecard_points(spark, sf):
    return longs(fitted(spark, sf)[0].points().drop("category"))


def scorecard_categories(spark, sf):
    """The published card, with what each bin of a text feature stands for."""
    card = fitted(spark, sf)[0].points().where(F.col("feature").isin(*CATEGORIES))
    return longs(card.drop("bin_id"))


def scorecard_own_split(spark, sf):
    """The card under its own defaults: 30% held out, penalty 1 / 0.1."""
    spec = replace(SPEC, test_share=ScorecardSpec().test_share)
    return longs(fit_scorecard(with_target_and_split(loans(spark, sf), spec), spec).points().drop("category"))


def scorecard_points_additive(spark, sf):
    return longs(fitted(spark, sf)[0].points("additive").drop("category"))


def score_points(spark, sf):
    """Total points per held-out row."""
    card, split = fitted(spark, sf)
    return card.total_points(split.where("is_test")).select(KEY, "score")


def scorecard_comparison(spark, sf):
    card, split = fitted(spark, sf)
    weighted = weight.add_weights(card.prepare(split), card.used_bins(), card.weights)
    columns = card.model.features
    mean = weighted.where(~F.col("is_test")).agg(*[F.avg(c).alias(c) for c in columns]).first()
    rows = weighted.where("is_test").select(KEY, *columns)
    pushes = attribution.linear_attribution(rows, card.model, KEY, mean.asDict())
    ranking = attribution.attribution_ranking(pushes, KEY).withColumn(
        "feature", F.regexp_replace("feature", "_woe$", ""))
    return tidy(points.point_range(card.points()).join(F.broadcast(ranking), "feature", "left"), 5, importance_score=3)


def old_and_new(spark, sf) -> tuple[DataFrame, DataFrame]:
    df = loans(spark, sf)
    is_new = F.col("issue_d") >= F.lit(NEW_LOANS_FROM).cast("timestamp_ntz")
    return df.where(~is_new), df.where(is_new)


ALL_SPEC = replace(SPEC, policy="all_rows", fit_on="all")


def score_new(spark, sf):
    old, new = old_and_new(spark, sf)
    return tidy(fit_scorecard(old, ALL_SPEC).score_file(new), 6, **{PROBABILITY: 4})


def score_new_gaps(spark, sf):
    """New loans without one of the features and with numbers as text, some of it no number."""
    old, new = old_and_new(spark, sf)
    text = F.when(F.col("n_items") == 3, F.lit("three")).otherwise(F.col("n_items").cast("string"))
    torn = new.drop("avg_disc").withColumn("n_items", text)
    return tidy(fit_scorecard(old, ALL_SPEC).score_file(torn), 6, **{PROBABILITY: 4})


def score_new_metrics(spark, sf):
    old, new = old_and_new(spark, sf)
    return tidy(fit_scorecard(old, ALL_SPEC).back_test(new), 5)


def stream_back_test(spark, sf):
    """New loans and, up to 120 days later, their outcomes as two streams of files; metrics of each period that is over."""
    old, new = old_and_new(spark, sf)
    card = fit_scorecard(old, ALL_SPEC)
    at = F.col("issue_d").cast("timestamp")
    known = at + F.make_dt_interval(days=(F.col(KEY) % 120).cast("int"))
    folders = {n: new_path(spark, f"stream-{n}") for n in ("loans", "outcomes", "counts", "marks")}
    for name, df, when in (("loans", new.withColumn("scored_at", at), "scored_at"),
                           ("outcomes", new.select(KEY, "loan_status", known.alias("outcome_at")), "outcome_at")):
        closing = df.limit(1).withColumns({KEY: F.lit(-1).cast(df.schema[KEY].dataType), when: F.lit("2030-01-01").cast("timestamp")})
        df.unionByName(closing).write.parquet(folders[name])
    streams = [read_new_files(spark, folders[n], spark.read.parquet(folders[n]).schema) for n in ("loans", "outcomes")]
    waiting = spark.read.parquet(folders["loans"]).count()
    back_test_stream(card, *streams, folders["counts"], folders["marks"], once=True, waiting=waiting).awaitTermination()
    return tidy(period_metrics(spark, folders["counts"]).select(F.date_format("period", "yyyy-MM-dd").alias("period"), "n", "n_bad", "auc", "ks", "brier"), 4)


def comparison_run(spark, sf):
    """The whole comparison, from raw loans to the manifest, with trees that SQL can state."""
    coded = loans(spark, sf).withColumns(stump_columns())
    run = comparison.compare_models(coded, KEY, trees=1, depth=1, features=STUMP, target=TARGET)
    top = attribution.top_features(run.ranking, 1).first()
    base, best = run.baseline.first(), run.primary.first()
    found = run.manifest.select("data_mode_used", "data_rows_after_filter", "features_used", "test_set_size", "baseline_roc_auc",
                                "primary_roc_auc", "primary_passed", "gini_coefficient")
    return tidy(found.select("*", F.lit(top["feature"]).alias("top_feature"), *[
        F.lit(r[c]).alias(f"{n}_{c.lower()}") for n, r in (("baseline", base), ("primary", best)) for c in ("KS", "Brier")]), 5)


def artifacts(spark, sf):
    """Save the scorecard, then the half of a later save, load and score: the whole version is the one that is read."""
    path = new_path(spark, "scorecard")
    card, split = fitted(spark, sf)
    card.save(path)
    spark.range(1).write.parquet(f"{path}/{versions.PREFIX}99999999T000000-half/fills")
    return tidy(ScorecardModel.load(spark, path).transform(split.where("is_test")).select(KEY, PROBABILITY), 4)


def run_manifest(spark, sf):
    return tidy(comparison.manifest(gated(spark, sf), len(SPEC.features), "raw", SCORECARD))


# --- fitted models -------------------------------------------------------------------------

def matrix(spark, sf) -> DataFrame:
    prepared, _ = comparison.prepared(loans(spark, sf), KEY, TARGET, features=NUMBERS)
    return prepared


def lr_baseline(spark, sf):
    data = stage(matrix(spark, sf), "baseline-matrix")
    model, scales = comparison.fit_baseline(data, NUMBERS, TARGET)
    test = comparison.score_baseline(data.where("is_test"), model, scales, [TARGET])
    found = evaluation.metric_record(evaluation.score_metrics(test), evaluation.BASELINE_NAME)
    weights = F.map_from_arrays(F.array(*[F.lit(f) for f, _ in model.coefficients]),
                                F.array(*[F.lit(c) for _, c in model.coefficients]))
    wide = found.select("*", F.lit(model.intercept).alias("intercept"),
                        *[weights[f].alias(f"beta_{f}") for f in NUMBERS])
    return tidy(wide, 5)


def lr_woe(spark, sf):
    card, _ = fitted(spark, sf, closed_form=False)
    table = card.coefficients().select("feature", "coefficient", "unexpected_sign")
    constant = spark.range(1).select(F.lit("(intercept)").alias("feature"),
                                     F.lit(card.model.intercept).alias("coefficient"),
                                     F.lit(False).alias("unexpected_sign"))
    return tidy(table.unionByName(constant), 5)


_primaries: dict[tuple[str, str], tuple] = {}


def primary(spark, sf) -> tuple[DataFrame, list[str], models.GBTClassificationModel]:
    """The split matrix of all numbers and the trees fitted on it with the default settings; fitted once per session
    and state of the input files."""
    key = (spark.sparkContext.applicationId, input_files(spark, sf))
    if key not in _primaries:
        data, names = comparison.prepared(loans(spark, sf), KEY, TARGET)
        data = stage(data, "trees-matrix", kept=True)
        _primaries[key] = data, names, models.fit_boosted_trees(data.where(~F.col("is_test")), names, TARGET, KEY)
    return _primaries[key]


def gbt_primary(spark, sf):
    """Boosted trees on all numbers with the default settings, gated against the baseline."""
    data, names, fitted = primary(spark, sf)
    model, scales = comparison.fit_baseline(data, names, TARGET)
    scores = {evaluation.BASELINE_NAME: comparison.Baseline(model, scales, {}).probability(), comparison.PRIMARY_NAME: F.col("score")}
    scored = models.score_trees(fitted, data.where("is_test"), names)
    found = evaluation.metrics_by(evaluation.by_model_and_segment(scored, TARGET, scores, {}), ["model"])
    judged = {r["model"]: r for r in found.collect()}
    best = spark.createDataFrame([tuple(judged[comparison.PRIMARY_NAME][c] for c in ("auc", "ks", "brier"))], "auc double, ks double, brier double")
    record = comparison.primary_record(best, judged[evaluation.BASELINE_NAME]["auc"])
    return record.withColumn("trees", F.lit(fitted.getNumTrees).cast("bigint"))


def attribution_primary(spark, sf):
    """The ranking of the primary model's features over every held-out row, and by how much the attributions and the
    expectation miss a row's log-odds at most."""
    data, names, fitted = primary(spark, sf)
    test = data.where("is_test")
    base = attribution.tree_leaves(spark, fitted)[1]
    pushes = stage(attribution.tree_attribution(test, fitted, names, KEY), "attributions")
    total = pushes.select(KEY, sum((F.col(c) for c in names), F.lit(base)).alias("total"))
    odds = F.ln(F.col("score") / (1 - F.col("score")))
    row = (models.score_trees(fitted, test, names).select(KEY, "score").join(total, KEY)
           .agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(odds - F.col("total"))).alias("missed")).first())
    return attribution.attribution_ranking(pushes, KEY).select("*", F.lit(row["n"]).alias("n"), F.lit(row["missed"]).alias("missed"))


def stump(spark, sf):
    """One tree of one split on columns of few values, which SQL can state exactly."""
    coded = loans(spark, sf).withColumns(stump_columns())
    data, names = comparison.prepared(coded, KEY, TARGET, features=STUMP)
    data = stage(data, "stump-matrix")
    fitted = models.fit_boosted_trees(data.where(~F.col("is_test")), names, TARGET, KEY, trees=1, depth=1)
    return data.where("is_test"), names, fitted


def gbt_stump(spark, sf):
    test, names, fitted = stump(spark, sf)
    leaves, base = attribution.tree_leaves(spark, fitted)
    low, high = sorted(leaves, key=lambda leaf: leaf.low)
    found = evaluation.score_metrics(models.score_trees(fitted, test, names).select(TARGET, "score"))
    return tidy(found.select(
        F.lit(names[low.features[0]]).alias("feature"), F.lit(low.high[0]).alias("threshold"),
        F.lit(low.value).alias("low_log_odds"), F.lit(high.value).alias("high_log_odds"),
        F.lit(base).alias("expected_log_odds"), "n", "n_bad", "auc", "ks", "brier"))


def attributed(spark, sf):
    test, names, fitted = stump(spark, sf)
    return tidy(attribution.attribution_ranking(attribution.tree_attribution(test, fitted, names, KEY), KEY))


def attribution_ranking(spark, sf):
    return attributed(spark, sf)


def attribution_top(spark, sf):
    return attribution.top_features(attributed(spark, sf), 1)


def attribution_additivity(spark, sf):
    """Held-out rows, and those whose attributions and expectation do not add up to the log-odds."""
    data = stage(matrix(spark, sf), "additivity-matrix")
    test = data.where("is_test")
    fitted = models.fit_boosted_trees(data.where(~F.col("is_test")), NUMBERS, TARGET, KEY,
                                      trees=10, learning_rate=0.2, depth=4)
    base = attribution.tree_leaves(spark, fitted)[1]
    pushes = attribution.tree_attribution(test, fitted, NUMBERS, KEY)
    total = pushes.select(KEY, (sum((F.col(c) for c in NUMBERS), F.lit(base))).alias("total"))
    odds = F.ln(F.col("score") / (1 - F.col("score")))
    return (models.score_trees(fitted, test, NUMBERS).select(KEY, "score").join(total, KEY)
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.abs(odds - F.col("total")) > 1e-6).alias("off")))


ALL: tuple[Query, ...] = (
    load_loans, csv_types, refused_rows, key_first_csv, json_record, probe_columns, target_four_status, target_all_rows, target_summary,
    status_distribution, event_distribution, missing_profile, missing_profile_observed, target_summary_observed, residual_nulls, impute_constants,
    impute_median, impute_mode, clean_loans, feature_matrix, default_rate_by_category, grade_stats,
    purpose_stats, grade_default_rates, class_crosstab_pct, describe_by_class, corr_matrix,
    corr_all_numbers, corr_with_target, high_corr_pairs, hist_by_class, box_by_grade_class, quantile_edges,
    quantile_edges_bracketed,
    equal_width_edges, profile_merged, clean_from_profile, woe_bins, iv_all_variables, iv_summary, iv_selection, woe_transform, document_iv,
    stratified_split, stratified_split_rows, sampled_rows, standardize, metric_auc, metric_ks, metric_brier,
    metrics_in_buckets, metrics_by_segment, roc_by_grade, closed_form_metrics, model_table, primary_record, roc_curve,
    roc_curve_plotted, pass_gate, metrics_report, rules_baseline, majority_baseline,
    scorecard_points, scorecard_categories, scorecard_own_split, scorecard_points_additive, score_points, scorecard_comparison, score_new, score_new_gaps,
    score_new_metrics, stream_back_test, comparison_run, artifacts, run_manifest, lr_baseline, lr_woe, gbt_primary, attribution_primary, gbt_stump,
    attribution_ranking, attribution_top, attribution_additivity)


def _prepared(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(tuned(spark), sf_dir)
    return run


def queries() -> dict[str, Query]:
    return {q.__name__: _prepared(q) for q in ALL}
