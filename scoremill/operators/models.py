"""Feature matrix, standardisation, logistic regression and boosted trees."""

from __future__ import annotations

import json
import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoremill.functions.aggregates import scalars
from scoremill.functions.columns import numeric_columns
from scoremill.functions.expressions import as_number, linear, sigmoid
from scoremill.operators import regression
from scoremill.operators.quantiles import median_values
from scoremill.operators.split import key_hash
from scoremill.sources.staging import new_path
from scoremill.spec import IDENTIFIER_COLUMNS, LEAKAGE_COLUMNS

FEATURES = "features_vector"


@dataclass(frozen=True)
class LinearModel:
    """``intercept + Σ coefficient · feature`` on the log-odds of the bad outcome."""

    intercept: float
    coefficients: tuple[tuple[str, float], ...]

    @property
    def features(self) -> list[str]:
        return [name for name, _ in self.coefficients]

    def log_odds(self) -> Column:
        return linear(self.intercept, [(F.col(name), c) for name, c in self.coefficients])

    def probability(self) -> Column:
        """Probability of the bad outcome (M6), a plain expression."""
        return sigmoid(self.log_odds())

    def table(self, spark: SparkSession, strip: str = "") -> DataFrame:
        """``position, feature, coefficient, unexpected_sign``.

        On WoE features a coefficient should be negative, since the weight is ln(good/bad) and
        the outcome is bad; a positive one points at correlated features.
        """
        rows = [(i, name.removesuffix(strip), float(c), c > 0)
                for i, (name, c) in enumerate(self.coefficients)]
        return spark.createDataFrame(
            rows, "position int, feature string, coefficient double, unexpected_sign boolean")


def model_features(df: DataFrame, key: str, target: str, extra: Iterable[str] = ()) -> list[str]:
    """Raw numeric model features: no identifiers, no outcomes."""
    return numeric_columns(df, {key, target, *IDENTIFIER_COLUMNS, *LEAKAGE_COLUMNS, *extra})


def feature_matrix(df: DataFrame, features: Sequence[str], keep: Sequence[str],
                   fit_on: DataFrame | None = None) -> DataFrame:
    """The kept columns and the features as doubles, missing values at the median.

    A feature without a single value to fit on has no median and is left out.
    """
    medians = median_values(df if fit_on is None else fit_on, features)
    return df.select(*keep, *[F.coalesce(as_number(F.col(c)), F.lit(medians[c])).alias(c)
                              for c in features if medians[c] is not None])


def scaling(train: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per feature; a constant one gets 1 (M2)."""
    found = scalars(train, {(c, f): f(c) for c in features for f in (F.avg, F.stddev_pop)})
    return {c: (found[c, F.avg], found[c, F.stddev_pop] or 1.0) for c in features}


def standardise(df: DataFrame, scales: dict[str, tuple[float, float]]) -> DataFrame:
    """Replace every scaled feature by its z-score, in one projection (M2)."""
    return df.select(*[((F.col(c) - scales[c][0]) / scales[c][1]).alias(c) if c in scales
                       else F.col(c) for c in df.columns])


def _vectors(df: DataFrame, features: Sequence[str], *keep: str) -> DataFrame:
    assembler = VectorAssembler(inputCols=list(features), outputCol=FEATURES)
    return assembler.transform(df).select(FEATURES, *keep)


def fit_logistic(train: DataFrame, features: Sequence[str], target: str, inverse_penalty: float = 1.0,
                 few_values: bool = False) -> LinearModel:
    """L2 logistic regression with penalty 1 / (C · rows), intercept unpenalised (M3, M4).

    Newton steps, a pass each; with ``few_values`` equal rows are counted once and the passes read their counts.
    """
    if not features:
        raise ValueError("no features to fit")
    cells = regression.collapsed if few_values else regression.counted
    beta, _ = regression.newton(cells(train, features, target), features, inverse_penalty)
    return LinearModel(float(beta[0]), tuple(zip(features, (float(v) for v in beta[1:]))))


def unscaled(model: LinearModel, scales: dict[str, tuple[float, float]]) -> LinearModel:
    """The same model stated on the raw features."""
    shift = sum(c * scales[f][0] / scales[f][1] for f, c in model.coefficients)
    return LinearModel(model.intercept - shift,
                       tuple((f, c / scales[f][1]) for f, c in model.coefficients))


def naive_model(rows: Iterable[dict], features: Sequence[str], suffix: str = "_woe") -> LinearModel:
    """Log-odds from the weights alone: ln(bads / goods) - Σ woe.

    The regression's fixed point when features are independent given the outcome. It needs no
    iteration, so it serves to check everything downstream of a fit.
    """
    first = [r for r in rows if r["feature"] == features[0]]
    bads = sum(r["bad_count"] for r in first)
    goods = sum(r["good_count"] for r in first)
    return LinearModel(math.log(bads / goods), tuple((f + suffix, -1.0) for f in features))


def best_prefix(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """How many rounds have the least loss before ``patience`` rounds pass without a lesser one, and
    whether that many did pass."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def fit_boosted_trees(train: DataFrame, features: Sequence[str], target: str, key: str,
                      trees: int = 500, learning_rate: float = 0.05, depth: int = 6,
                      min_rows: int = 20, max_bins: int = 64, validation_share: float = 0.1,
                      patience: int = 50, seed: int = 42) -> GBTClassificationModel:
    """Gradient-boosted trees that stop early on a slice of the training rows (M5).

    The slice is chosen by key hash, so the reported test rows never steer the fit. Rounds are grown
    until the slice's loss has not fallen for ``patience`` of them, and the rounds up to the least
    loss are kept. MLlib's own indicator stops at the first round that gains under one percent,
    which at a small learning rate is the first of all; and it cannot go on from a fitted model. So
    four times the patience are grown first, and all of them only if that is not enough; of what is grown
    the first rounds are kept as they are. No round is grown more than twice.
    """
    spark = train.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(new_path(spark, "checkpoints"))
    limit = format(int(validation_share * 16 ** 8), "08x")
    held_out = F.substring(key_hash(key, "validation", seed), 1, 8) < F.lit(limit)
    data = _vectors(train.withColumn("held_out", F.coalesce(held_out, F.lit(False))), features, target, "held_out")
    fitted_on, judged_on = data.where("NOT held_out"), data.where("held_out")

    def grown(rounds: int) -> GBTClassificationModel:
        return GBTClassifier(
            featuresCol=FEATURES, labelCol=target, maxIter=rounds, stepSize=learning_rate,
            maxDepth=depth, minInstancesPerNode=min_rows, maxBins=max_bins, seed=seed,
            checkpointInterval=10).fit(fitted_on)

    if judged_on.isEmpty():
        return grown(trees)
    for rounds in sorted({min(trees, 4 * patience), trees}):
        model = grown(rounds)
        best, stopped = best_prefix(model.evaluateEachIteration(judged_on), patience)
        if stopped:
            break
    return first_rounds(model, best)


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The ensemble of the first ``rounds`` trees: the stored form without the others."""
    if rounds == model.getNumTrees:
        return model
    spark = SparkSession.getActiveSession()
    whole, part = new_path(spark, "trees"), new_path(spark, "trees")
    model.write().save(whole)
    for table in ("data", "treesMetadata"):  # in both the first column numbers the trees
        rows = spark.read.parquet(f"{whole}/{table}")
        rows.where(F.col(rows.columns[0]) < rounds).write.parquet(f"{part}/{table}")
    head = json.loads(spark.read.text(f"{whole}/metadata").first()["value"])
    spark.createDataFrame([(json.dumps({**head, "numTrees": rounds}),)], "value string").coalesce(1).write.text(f"{part}/metadata")
    return GBTClassificationModel.load(part)


def score_trees(model: GBTClassificationModel, df: DataFrame, features: Sequence[str],
                column: str = "score") -> DataFrame:
    """Add the trees' probability of the bad outcome (M6)."""
    assembler = VectorAssembler(inputCols=list(features), outputCol=FEATURES)
    scored = model.transform(assembler.transform(df))
    return scored.select(*df.columns, vector_to_array("probability")[1].alias(column))
