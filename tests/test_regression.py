"""Newton steps over rows and over counted cells."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoremill.operators import models, regression
from tests.test_models import newton


@pytest.fixture(scope="module")
def coarse(spark):
    """Few values a column, so that 6,000 rows are a few dozen cells; a third of all rows are one cell."""
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(6000, 3))) / 2
    x[:2000] = [0.5, 0.0, -0.5]
    y = (rng.random(6000) < 1 / (1 + np.exp(-(x @ [1.0, -2.0, 0.3] - 0.7)))).astype(int)
    df = spark.createDataFrame([(*map(float, r), int(t)) for r, t in zip(x, y)], "a double, b double, c double, y int").repartition(5)
    return df.cache(), x, y


@pytest.mark.parametrize("few_values", [True, False])
@pytest.mark.parametrize("merged_by_spark", [True, False])
def test_cells_rows_and_both_ways_of_adding_up(coarse, monkeypatch, few_values, merged_by_spark):
    df, x, y = coarse
    if merged_by_spark:
        monkeypatch.setattr(regression, "MOST_COLLECTED", 0)
    model = models.fit_logistic(df, ["a", "b", "c"], "y", 0.5, few_values)
    assert [model.intercept, *(c for _, c in model.coefficients)] == pytest.approx(list(newton(x, y, 0.5)), abs=1e-9)


def test_cells_count_every_row_once_and_few_passes_settle(coarse):
    df, x, y = coarse
    cells = regression.collapsed(df, ["a", "b", "c"], "y")
    row = cells.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.count(F.lit(1)).alias("cells")).first()
    assert (row["n0"], row["n1"], row["cells"]) == ((y == 0).sum(), y.sum(), len(np.unique(x, axis=0)))
    assert regression.newton(cells, ["a", "b", "c"], 1.0)[1] <= 8


def test_separable_classes_and_copies_of_a_column_settle(spark):
    df = spark.createDataFrame([(float(i), float(i), int(i > 50)) for i in range(100)], "a double, b double, y int")
    beta, _ = regression.newton(regression.counted(df, ["a", "b"], "y"), ["a", "b"], 10.0)
    assert np.isfinite(beta).all() and beta[1] == pytest.approx(beta[2], abs=1e-6) and beta[1] > 0


def test_one_class_has_an_infinite_intercept(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 1)], "a double, y int")
    model = models.fit_logistic(df, ["a"], "y")
    assert (model.intercept, model.coefficients) == (float("inf"), (("a", 0.0),))
    assert models.fit_logistic(df.withColumn("y", F.lit(0)), ["a"], "y").intercept == float("-inf")


def test_missing_features_are_refused(spark):
    df = spark.createDataFrame([(1.0, 1), (None, 0), (3.0, 1)], "a double, y int")
    with pytest.raises(ValueError, match="missing"):
        models.fit_logistic(df, ["a"], "y")
