"""Fitting a scorecard end to end, keeping it, and scoring new rows with it."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoremill.functions.columns import numeric_columns, present, string_columns
from scoremill.functions.expressions import parse_number
from scoremill.operators import woe as weight
from scoremill.operators.binning import Bins, Sketch, fit_bins, sketch_columns, sketch_of, sketch_totals
from scoremill.operators.cleaning import apply_fills, fills_from_table, fills_table, mode_values
from scoremill.operators.evaluation import score_metrics
from scoremill.operators.models import LinearModel, fit_logistic, naive_model
from scoremill.operators.points import base_points, scorecard
from scoremill.operators.quantiles import exact_quantiles
from scoremill.operators.split import ROW_KEY, add_split, with_row_key
from scoremill.operators.target import add_target, is_member
from scoremill.sources.staging import stage_observed
from scoremill.sources.versions import load_tables, save_tables
from scoremill.spec import ALL_ROWS_BAD, MODE_FALLBACK, SCORED_COLUMNS, ScorecardSpec

PROBABILITY = "predicted_default_probability"
ACTUAL = "actual_default_status"


@dataclass(frozen=True)
class ScorecardModel:
    """Everything scoring needs: a few hundred values at most, whatever the training size."""

    spec: ScorecardSpec
    fills: dict[str, object]
    bins: tuple[Bins, ...]          # of every binned feature
    weights: tuple[dict, ...]       # the WoE table's rows
    model: LinearModel              # on <feature>_woe columns
    spark: SparkSession

    @cached_property
    def features(self) -> list[str]:
        return [c.removesuffix("_woe") for c in self.model.features]

    def used_bins(self) -> list[Bins]:
        by_name = {b.feature: b for b in self.bins}
        return [by_name[f] for f in self.features]

    def woe_table(self) -> DataFrame:
        return weight.woe_frame(self.spark, self.weights)

    def iv_table(self) -> DataFrame:
        return weight.iv_table(self.woe_table())

    def coefficients(self) -> DataFrame:
        return self.model.table(self.spark, strip="_woe")

    def points(self, mode: str = "reference") -> DataFrame:
        return scorecard(self.woe_table(), self.coefficients(), self.model.intercept,
                         len(self.features), mode)

    def prepare(self, df: DataFrame) -> DataFrame:
        """Missing columns as null, text numbers parsed, missing values filled."""
        kinds = {b.feature: b.kind for b in self.used_bins()}
        types = dict(df.dtypes)

        def column(name: str) -> Column:
            wanted = "string" if kinds[name] == "category" else "double"
            if name not in types:
                return F.lit(None).cast(wanted).alias(name)
            if wanted == "double" and types[name] == "string":
                return parse_number(F.col(name)).alias(name)
            return F.col(name)

        others = [F.col(c) for c in df.columns if c not in kinds]
        shaped = df.select(*others, *[column(c) for c in kinds])
        return apply_fills(shaped, {c: v for c, v in self.fills.items() if c in kinds})

    def transform(self, df: DataFrame, column: str = PROBABILITY) -> DataFrame:
        """Add the probability of default.

        Imputation, bin lookup and the model are expressions with literals plus, for wide
        category sets, a broadcast lookup: one stage from scan to sink. The saved training edges
        are applied, so a row's score never depends on the rows beside it.
        """
        weighted = weight.add_weights(self.prepare(df), self.used_bins(), self.weights)
        return weighted.withColumn(column, self.model.probability()).select(*df.columns, column)

    def score_file(self, df: DataFrame) -> DataFrame:
        """The review columns the input has, with the probability."""
        return self.transform(df).select(*present(df, SCORED_COLUMNS), PROBABILITY)

    def back_test(self, df: DataFrame, bad: Sequence[str] = ALL_ROWS_BAD) -> DataFrame:
        """AUC and Gini against the outcomes of new rows."""
        actual = is_member(F.col(self.spec.status_column), bad).cast("int")
        scored = self.transform(df.withColumn(ACTUAL, actual)).select(ACTUAL, PROBABILITY)
        return score_metrics(scored, PROBABILITY, ACTUAL).select(
            "n", "n_bad", "auc", "gini")

    def total_points(self, df: DataFrame, mode: str = "additive", column: str = "score") -> DataFrame:
        """Add each row's points summed over the features; a bin without points gets the base."""
        base = self.spark.range(1).select(
            base_points(self.model.intercept, len(self.features), mode).alias("b")).first()["b"]
        points = {(r["feature"], r["bin_id"]): r["points"] for r in self.points(mode).collect()}
        rows = [{**w, "own": points[w["feature"], w["bin_id"]] - base} for w in self.weights
                if (w["feature"], w["bin_id"]) in points]
        wide = weight.add_weights(self.prepare(df), self.used_bins(), rows, "own", "_own")
        total = F.lit(base * len(self.features))
        for f in self.features:
            total = total + F.col(f"{f}_own")
        return wide.withColumn(column, total).select(*df.columns, column)

    def save(self, path: str, keep: int | None = None) -> str:
        """Write a version of the model under ``path`` as small Parquet tables, whole or not at all."""
        spark = self.spark
        bins = spark.createDataFrame(
            [(i, b.feature, b.kind, list(b.cuts)) for i, b in enumerate(self.bins)],
            "position int, feature string, kind string, cuts array<double>")
        head = spark.createDataFrame([(json.dumps(asdict(self.spec)), float(self.model.intercept))], "spec string, intercept double")
        return save_tables(spark, path, {"fills": fills_table(spark, self.fills), "woe": self.woe_table(),
                                         "coefficients": self.coefficients(), "bins": bins, "model": head}, keep)

    @classmethod
    def load(cls, spark: SparkSession, path: str, version: str | None = None) -> ScorecardModel:
        """The newest finished version, or the one named; one that does not match its manifest is refused."""
        tables = load_tables(spark, path, version)
        head = tables["model"].first()
        stored = {k: tuple(v) if isinstance(v, list) else v for k, v in json.loads(head["spec"]).items()}
        coefficients = tables["coefficients"].orderBy("position").collect()
        bins = tables["bins"].orderBy("position").collect()
        return cls(
            ScorecardSpec(**stored), fills_from_table(tables["fills"]),
            tuple(Bins(b["feature"], b["kind"], tuple(b["cuts"])) for b in bins),
            tuple(weight.collected(tables["woe"])),
            LinearModel(head["intercept"],
                        tuple((f"{c['feature']}_woe", c["coefficient"]) for c in coefficients)),
            spark)


def candidate_features(df: DataFrame, spec: ScorecardSpec) -> tuple[list[str], list[str]]:
    """Numeric and text columns that may be binned."""
    skip = {*spec.leakage, spec.key, spec.target, spec.status_column}
    numbers, texts = numeric_columns(df, skip), string_columns(df, skip)
    if spec.features is not None:
        numbers = [c for c in numbers if c in spec.features]
        texts = [c for c in texts if c in spec.features]
    return numbers, texts


def with_target_and_split(df: DataFrame, spec: ScorecardSpec) -> DataFrame:
    """Target by policy, then the exact stratified test flag; kept where already present."""
    if "is_test" in df.columns:
        return df
    if spec.key == ROW_KEY and ROW_KEY not in df.columns:
        df = with_row_key(df)
    labelled = df if spec.target in df.columns else add_target(
        df, spec.policy, spec.status_column, spec.target)
    return add_split(labelled, spec.key, spec.target, spec.test_share, spec.seed)


def fit_weights(df: DataFrame, spec: ScorecardSpec, sketch: Sketch | None = None):
    """Fills, bins and the WoE rows of a labelled frame.

    Scans: a sketch of all columns if none is at hand, quantiles, modes, bin counts; an exact distinct count
    if some column is near its limit; and quantiles again for the columns that fills have changed. Text
    columns that are surely over the category limit drop out before the modes are counted.
    """
    numbers, texts = candidate_features(df, spec)
    sketch = sketch or sketch_columns(df, numbers + texts)
    texts = [c for c in texts if not sketch.surely_over(c, spec.max_categories)]
    narrow = df.select(spec.target, *numbers, *texts)
    fills = {c: spec.fills[c] for c in numbers + texts if c in spec.fills}
    deciles = [k / spec.max_bins for k in range(spec.max_bins + 1)]
    raw = exact_quantiles(narrow, {c: F.col(c) for c in numbers if c not in fills},
                          [*deciles, 0.5], rows=sketch.rows)
    fills.update({c: q[-1] for c, q in raw.items() if q is not None})
    modes = mode_values(narrow, [c for c in texts if c not in fills], sketch.distinct)
    fills.update({c: MODE_FALLBACK if v is None else v for c, v in modes.items()})
    complete = {c: sorted(set(q[:-1])) for c, q in raw.items()
                if sketch.present[c] == sketch.rows and spec.edge_method == "quantile"}
    filled = apply_fills(narrow, fills)
    bins = fit_bins(filled, numbers, texts, spec.max_bins, spec.max_categories,
                    spec.edge_method, sketch, complete, rows=sketch.rows)
    return fills, bins, weight.collected(weight.woe_table(filled, bins, spec.target))


def fit_scorecard(df: DataFrame, spec: ScorecardSpec, closed_form: bool = False) -> ScorecardModel:
    """Clean, bin, weigh, select and model a loan table.

    The rows to fit on are written once with the target and the candidate features only, since
    many passes read them a few columns at a time; the row hash behind the split is then not
    computed again, and the columns are sketched as they are written. ``closed_form`` replaces the regression by the weights' own log-odds.
    """
    split = with_target_and_split(df, spec)
    numbers, texts = candidate_features(split, spec)
    wanted = split if spec.fit_on == "all" else split.where(~F.col("is_test"))
    narrow = wanted.select(spec.target, "is_test", *numbers, *texts)
    fit_frame, seen = stage_observed(narrow, "scorecard-rows", sketch_totals(narrow, numbers + texts))
    train = fit_frame.where(~F.col("is_test")) if spec.fit_on == "all" else fit_frame
    fills, bins, rows = fit_weights(fit_frame.drop("is_test"), spec, sketch_of(seen, numbers + texts))
    iv: dict[str, float] = {}
    for r in rows:
        iv[r["feature"]] = iv.get(r["feature"], 0.0) + r["iv"]
    chosen = weight.selected_names([{"feature": f, "iv": v} for f, v in iv.items()], spec.iv_range)
    if not chosen:
        raise ValueError("no feature has an information value in the selected range")
    if closed_form:
        model = naive_model(rows, chosen)
    else:
        by_name = {b.feature: b for b in bins}
        ready = apply_fills(train, {c: v for c, v in fills.items() if c in chosen})
        matrix = weight.woe_matrix(ready, [by_name[c] for c in chosen], rows, [spec.target])
        model = fit_logistic(matrix, [f"{c}_woe" for c in chosen], spec.target,
                             spec.inverse_penalty, few_values=True)
    return ScorecardModel(replace(spec), fills, tuple(bins), tuple(rows), model, df.sparkSession)
