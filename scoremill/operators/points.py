"""From log-odds to scorecard points."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoremill.spec import POINTS_TO_DOUBLE, TARGET_ODDS, TARGET_SCORE

FACTOR = POINTS_TO_DOUBLE / math.log(2)
OFFSET = TARGET_SCORE - FACTOR * math.log(TARGET_ODDS)


def base_points(intercept: float, features: int, mode: str = "reference") -> Column:
    """Points every bin starts from (C2), rounded half to even.

    ``reference`` puts the whole offset into each feature, as the published card does, so totals
    grow with the number of features. ``additive`` shares it out, so that totals are on the scale.
    """
    if mode not in ("reference", "additive"):
        raise ValueError(f"unknown points mode {mode!r}")
    offset = OFFSET if mode == "reference" else OFFSET / features
    return F.bround(F.lit(offset - FACTOR * (intercept / features)), 0)


def scorecard(woe: DataFrame, coefficients: DataFrame, intercept: float, features: int,
              mode: str = "reference") -> DataFrame:
    """``feature, bin_id, category, points`` for every bin of the model's features.

    ``coefficients`` holds ``position, feature, coefficient``, one row per feature.
    """
    own = F.bround(-F.lit(FACTOR) * F.col("woe") * F.col("coefficient"), 0)
    return (woe.join(F.broadcast(coefficients), "feature")
            .select("position", "feature", "bin_id", F.col("bin").alias("category"),
                    (own + base_points(intercept, features, mode)).alias("points"))
            .orderBy("position", "bin_id").drop("position"))


def point_range(card: DataFrame) -> DataFrame:
    """Smallest and largest points per feature."""
    return card.groupBy("feature").agg(
        F.min("points").alias("min_points"), F.max("points").alias("max_points"),
        (F.max("points") - F.min("points")).alias("points_range"))
