"""Pairwise co-moments against deviations from the mean, in any grouping of the merges."""

from functools import reduce

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scoremill.operators import comoments, profiling
from scoremill.operators.comoments import Moments, correlations, moments


def table(rows=5000, columns=12, seed=3):
    rng = np.random.default_rng(seed)
    values = rng.normal(size=(rows, columns)) * 10.0 ** rng.integers(-3, 6, columns) + 10.0 ** rng.integers(0, 9, columns)
    values[:, 1] = values[:, 0] * -2 + rng.normal(size=rows) * 1e-3
    values[rng.random((rows, columns)) < 0.2] = np.nan
    values[:, 4] = 3.3
    values[:, 5] = np.nan
    values[:, 6] = np.where(rng.random(rows) < 0.01, 1.0, 0.0)
    values[:, 7] = np.where(values[:, 6] == 1, 0.1, np.nan)    # constant wherever it is present
    return values


def same(found, want):
    assert np.array_equal(np.isnan(found), np.isnan(want))
    np.testing.assert_allclose(found, want, rtol=0, atol=1e-9)


def two_passes(values):
    """Deviations from the mean in extended precision, pair by pair."""
    width = values.shape[1]
    want = np.full((width, width), np.nan)
    for i in range(width):
        for j in range(width):
            rows = ~np.isnan(values[:, i]) & ~np.isnan(values[:, j])
            a, b = (values[rows, k].astype(np.longdouble) for k in (i, j))
            if len(np.unique(a)) > 1 and len(np.unique(b)) > 1:
                a, b = a - a.mean(), b - b.mean()
                want[i, j] = (a * b).sum() / np.sqrt((a * a).sum() * (b * b).sum())
    return want


def test_a_batch_equals_two_passes():
    values = table()
    same(moments(values).correlations(), two_passes(values))
    gentle = values[:, [0, 1, 2, 3]] % 10
    same(moments(gentle).correlations(), pd.DataFrame(gentle).corr().to_numpy())


@pytest.mark.parametrize("pieces", [2, 7, 100])
def test_merged_states_equal_one_pass(pieces):
    """In any grouping of the merges, with pieces that lack some columns altogether."""
    values = table()
    order = np.argsort(~np.isnan(values[:, 3]), kind="stable")  # the first pieces have nothing in one column
    parts = [moments(p) for p in np.array_split(values[order], pieces)]
    whole = two_passes(values)
    same(reduce(Moments.merged, parts).correlations(), whole)
    while len(parts) > 1:
        parts = [reduce(Moments.merged, parts[i:i + 3]) for i in range(0, len(parts), 3)]
    same(parts[0].correlations(), whole)
    np.testing.assert_array_equal(parts[0].n, moments(values).n)


@pytest.mark.parametrize("tile, fan", [(64, 64), (5, 2)])
def test_table_equals_two_passes(spark, monkeypatch, tile, fan):
    """Tiles smaller than the table, and a tree of several levels."""
    monkeypatch.setattr(comoments, "TILE", tile)
    monkeypatch.setattr(comoments, "FAN", fan)
    values = table(2000)
    names = [f"x{i}" for i in range(values.shape[1])]
    df = spark.createDataFrame(pd.DataFrame(values, columns=names)).repartition(9)
    rows = correlations(df, names).collect()
    assert len(rows) == len(names) ** 2 == len({(r["var1"], r["var2"]) for r in rows})
    found = np.full((len(names), len(names)), np.nan)
    for r in rows:
        i, j = names.index(r["var1"]), names.index(r["var2"])
        found[i, j] = np.nan if r["corr"] is None else r["corr"]
        assert r["n"] == (~np.isnan(values[:, i]) & ~np.isnan(values[:, j])).sum()
    same(found, two_passes(values))


def test_types_nulls_and_infinities(spark):
    df = spark.createDataFrame([(1, True, 1.0, None, float("inf")), (2, False, float("nan"), None, 1.0), (4, True, 3.0, None, 2.0),
                                (8, False, 5.0, None, 0.0)], "a int, b boolean, c double, d double, e double")
    found = {(r["var1"], r["var2"]): r["corr"] for r in correlations(df, ["a", "c", "d", "e"]).collect()}
    assert found["a", "c"] == pytest.approx(pd.Series([1, 4, 8]).corr(pd.Series([1.0, 3.0, 5.0])))
    assert found["a", "a"] == pytest.approx(1) and all(found["d", x] is None for x in "ace")
    assert all(found["e", x] is None for x in "ad")


def test_no_rows(spark):
    df = spark.createDataFrame([], "a double, b int")
    assert sorted(map(tuple, correlations(df, ["a", "b"]).collect())) == [
        ("a", "a", 0, None), ("a", "b", 0, None), ("b", "a", 0, None), ("b", "b", 0, None)]


def test_sixty_columns_are_one_scan(spark, tmp_path):
    wide = spark.range(3000).select(*[((F.col("id") * (i + 3)) % (17 + i)).cast("double").alias(f"c{i}") for i in range(60)])
    wide.write.parquet(f"{tmp_path}/wide")
    df = spark.read.parquet(f"{tmp_path}/wide")
    matrix = profiling.correlation_matrix(df, df.columns)
    plan = matrix._jdf.queryExecution().executedPlan().toString()
    assert f"{tmp_path}/wide" not in plan  # the table's scan is behind the states, which are written
    before = spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
    assert profiling.correlation_matrix(df, df.columns).count() == 3600
    assert spark.sparkContext._jsc.sc().dagScheduler().nextJobId() - before <= 8
