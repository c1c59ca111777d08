import hashlib
import math

import pytest
from pyspark.sql import functions as F

from scoremill.operators import split
from scoremill.operators.split import ROW_KEY, add_split, fixed_sample, test_sizes as sizes_per_class, with_row_key


def by_hash(key, purpose):
    return hashlib.md5(f"{key}|{purpose}|42".encode()).hexdigest()


@pytest.fixture(scope="module")
def frame(spark):
    return spark.range(5000).select("id", F.when(F.col("id") % 10 < 3, 1).otherwise(0).alias("y"))


@pytest.mark.parametrize("share", [0.2, 0.3, 0.5])
@pytest.mark.parametrize("partitions", [1, 7])
def test_same_rows_as_ranking_each_class(frame, share, partitions):
    flagged = add_split(frame.repartition(partitions), "id", "y", share).collect()
    for y in (0, 1):
        keys = sorted((r["id"] for r in flagged if r["y"] == y), key=lambda k: (by_hash(k, "split"), k))
        size = round(share * len(keys))
        assert {r["id"] for r in flagged if r["y"] == y and r["is_test"]} == set(keys[:size])


def test_refined_buckets_give_the_same_split(frame, monkeypatch):
    whole = {r["id"] for r in add_split(frame, "id", "y", 0.2).where("is_test").collect()}
    monkeypatch.setattr(split, "SMALL_BUCKET", 1)
    monkeypatch.setattr(split, "DIGITS", 1)
    assert {r["id"] for r in add_split(frame, "id", "y", 0.2).where("is_test").collect()} == whole


def test_frames_without_a_key_split_exactly(spark, monkeypatch):
    df = spark.range(400).select((F.col("id") % 3).alias("a"), F.lit(None).cast("string").alias("b"),
                                 (F.col("id") % 2).cast("int").alias("y")).repartition(5)
    sides = []
    for small in (50_000, 1):
        monkeypatch.setattr(split, "SMALL_BUCKET", small)
        flagged = add_split(with_row_key(df), ROW_KEY, "y", 0.3)
        rows = flagged.groupBy("a", "y").agg(F.count_if("is_test").alias("n")).orderBy("a", "y").collect()
        assert flagged.where("is_test").count() == 120 and flagged.where("is_test AND y = 1").count() == 60
        sides.append([tuple(r) for r in rows])
    assert sides[0] == sides[1]


def test_null_keys_share_a_side(spark):
    df = spark.range(100).select(F.when(F.col("id") > 20, F.col("id")).alias("id"), F.lit(1).alias("y"))
    assert add_split(df, "id", "y", 0.5).where("id IS NULL").select("is_test").distinct().count() == 1


def test_sizes_add_up_by_largest_remainder():
    for counts in ({0: 547, 1: 653}, {0: 3, 1: 2}, {0: 10, 1: 11, 2: 13}, {0: 1}, {}):
        sizes = sizes_per_class(counts, 0.2)
        total = sum(counts.values())
        assert sum(sizes.values()) == math.ceil(0.2 * total)
        assert all(abs(sizes[c] - 0.2 * n) <= 1 for c, n in counts.items())
    assert sum(sizes_per_class({0: 547, 1: 653}, 0.2).values()) == 240


def test_a_missing_class_is_in_no_test_set_and_empty_frames_work(spark, frame):
    with_null = frame.withColumn("y", F.when(F.col("id") > 10, F.col("y")))
    assert add_split(with_null, "id", "y", 0.2).where("y is null and is_test").count() == 0
    assert add_split(frame.where("id < 0"), "id", "y", 0.2).count() == 0


def test_copies_of_a_key_stay_together(spark):
    df = spark.range(300).select((F.col("id") % 100).alias("id"), F.lit(1).alias("y"))
    sides = add_split(df, "id", "y", 0.2).groupBy("id").agg(F.count_distinct("is_test").alias("n"))
    assert sides.where("n > 1").count() == 0


def test_no_shuffle_of_the_flagged_rows(frame):
    plan = add_split(frame, "id", "y", 0.2)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_sample_is_a_top_k_by_its_own_hash(frame):
    found = [r["id"] for r in fixed_sample(frame.repartition(5), "id", 50).collect()]
    assert sorted(found) == sorted(sorted(range(5000), key=lambda k: by_hash(k, "sample"))[:50])
    assert fixed_sample(frame, "id", 10_000).count() == 5000 and fixed_sample(frame, "id", 0).count() == 0


@pytest.mark.parametrize("small", [20, 50_000])
def test_the_sample_stays_where_its_rows_lie(frame, monkeypatch, small):
    """However large it is: buckets of few rows, no task with all of its hashes, as many partitions as the table."""
    monkeypatch.setattr(split, "SMALL_BUCKET", small)
    sample = fixed_sample(frame.repartition(5), "id", 3000)
    assert {r["id"] for r in sample.collect()} == set(sorted(range(5000), key=lambda k: by_hash(k, "sample"))[:3000])
    assert sample.rdd.getNumPartitions() > 1
    assert all(p > 0 for p in sample.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect())


@pytest.mark.parametrize("size", [1, 7, 399, 400, 401, 800, 1100, 1199])
def test_a_sample_of_hot_keys_and_equal_rows_has_its_size(spark, size):
    """A third of the rows have one key and differ, a third are equal throughout, the others differ."""
    i = F.col("id")
    df = spark.range(0, 1200, numPartitions=4).select(
        F.when(i % 3 == 0, -1).when(i % 3 == 1, F.lit(None)).otherwise(i).alias("id"), F.when(i % 3 == 1, 0).otherwise(i).alias("x"))
    found = fixed_sample(df, "id", size)
    assert found.count() == size and found.columns == df.columns
    assert found.exceptAll(df).count() == 0
