"""Profiles of files, merged, against the whole table."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoremill.operators import cleaning, profiles, quantiles
from scoremill.operators.binning import fit_bins
from scoremill.operators.quantiles import exact_quantiles, median_values

PROBS = [0.0, 0.1, 0.5, 0.77, 1.0]


@pytest.fixture
def months(spark, tmp_path):
    """Three months of files; one column never has a value, one has NaN, one has a value that a third of the rows hold."""
    rng = np.random.default_rng(2)
    for month in range(3):
        n = 4000
        x, y = rng.normal(month, 1, n), np.where(rng.random(n) < 0.33, 7.0, rng.exponential(1, n))
        rows = [(float(a), None if i % 9 == 0 else float(b), float("nan") if i % 5 == 0 else float(i), None, f"t{i % 3}", i)
                for i, (a, b) in enumerate(zip(x, y))]
        spark.createDataFrame(rows, "x double, y double, z double, empty double, text string, k int").repartition(2).write.mode(
            "append").parquet(f"{tmp_path}/months")

    return f"{tmp_path}/months", f"{tmp_path}/profile"


def read(spark, path):
    schema = spark.read.parquet(path).schema
    return lambda files: spark.read.schema(schema).parquet(*files)


def test_files_are_read_once_and_the_merged_profile_is_that_of_the_whole(spark, months):
    path, store = months
    files = sorted(spark.read.parquet(path).inputFiles())
    assert profiles.update(spark, store, files[:4], read(spark, path)) == files[:4]
    seen = []
    reader = read(spark, path)
    new = profiles.update(spark, store, files, lambda names: seen.extend(names) or reader(names))
    assert new == files[4:] == seen                       # the second time the first files are not opened
    assert profiles.update(spark, store, files, None) == []
    whole, df = profiles.merged(spark, store), spark.read.parquet(path)
    assert whole.rows == 12000
    assert whole.missing() == {"": 12000, **{r["column_name"]: r["missing_count"] for r in cleaning.missing_counts(
        df.withColumn("z", F.nanvl("z", F.lit(None)))).collect()}}
    assert whole.ends["x"] == tuple(df.agg(F.min("x"), F.max("x")).first()) and whole.ends["empty"] == (None, None)
    names = {c: F.col(c) for c in ("x", "y", "z", "empty", "k")}
    assert exact_quantiles(df, names, PROBS, profile=whole) == exact_quantiles(df, names, PROBS)
    assert median_values(df, ["y"], profile=whole) == median_values(df, ["y"])
    assert whole.distinct["text"] == 3 and whole.distinct["empty"] == 0
    assert abs(whole.distinct["x"] - 12000) < 600
    assert cleaning.fit_fills(df, profile=whole) == cleaning.fit_fills(df.withColumn("z", F.nanvl("z", F.lit(None))))
    assert fit_bins(df, ["x", "k"], ["text"], sketch=whole.sketch(), profile=whole) == fit_bins(df, ["x", "k"], ["text"])


def test_a_bracket_that_misses_is_made_wider(spark, months, monkeypatch):
    """A sketch too small for its brackets costs another scan, not the answer."""
    path, store = months
    monkeypatch.setattr(profiles, "KLL_K", 8)
    monkeypatch.setattr(quantiles, "PROFILE_REACH", 1e-6)
    df = spark.read.parquet(path)
    profiles.update(spark, store, df.inputFiles(), read(spark, path))
    names = {c: F.col(c) for c in ("x", "y")}
    assert exact_quantiles(df, names, PROBS, profile=profiles.merged(spark, store)) == exact_quantiles(df, names, PROBS)


def test_some_of_the_files_and_rows_that_came_twice(spark, months):
    path, store = months
    files = sorted(spark.read.parquet(path).inputFiles())
    profiles.update(spark, store, files, read(spark, path))
    spark.read.schema(profiles.SCHEMA).parquet(store).write.mode("append").parquet(store)  # two runs at once
    assert profiles.merged(spark, store).rows == 12000
    part = read(spark, path)(files[:2])
    assert profiles.merged(spark, store, files[:2]).rows == part.count()


def test_a_failed_scan_leaves_no_profile(spark, months):
    path, store = months
    files = spark.read.parquet(path).inputFiles()
    broken = lambda names: read(spark, path)(names).withColumn("x", F.raise_error(F.lit("torn")).cast("double"))
    with pytest.raises(Exception, match="torn"):
        profiles.update(spark, store, files, broken)
    assert profiles.update(spark, store, files, read(spark, path)) == list(files)
    assert profiles.merged(spark, store).rows == 12000
