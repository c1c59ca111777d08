"""Saving as one: whole versions, stopped saves, torn versions."""

import shutil
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from scoremill.sources.versions import TornVersion, load_tables, save_tables, versions


@pytest.fixture
def saved(spark, tmp_path):
    folder = str(tmp_path / "model")
    tables = lambda k: {"a": spark.range(k).withColumn("x", F.col("id") / 3), "b": spark.createDataFrame([(None, k)], "t string, k int")}
    return folder, tables


def values(tables):
    return {label: sorted(map(tuple, t.collect())) for label, t in tables.items()}


def test_the_newest_version_is_read_and_older_ones_stay_on_request(spark, saved):
    folder, tables = saved
    names = [save_tables(spark, folder, tables(k)) for k in (3, 5)]
    assert versions(spark, folder) == names[::-1]
    assert values(load_tables(spark, folder)) == values(tables(5))
    assert values(load_tables(spark, folder, names[0])) == values(tables(3))
    last = save_tables(spark, folder, tables(7), keep=2)
    assert versions(spark, folder) == [last, names[1]]


def test_a_save_that_stops_half_way_leaves_what_was_there(spark, saved):
    folder, tables = saved
    save_tables(spark, folder, tables(3))
    broken = {**tables(9), "c": spark.range(1).select(F.raise_error(F.lit("stopped")).cast("string").alias("x"))}
    with pytest.raises(PySparkException, match="stopped"):
        save_tables(spark, folder, broken)
    assert len(list(Path(folder).iterdir())) == 2         # what was written of it lies there
    assert values(load_tables(spark, folder)) == values(tables(3))


@pytest.mark.parametrize("harm", ["missing table", "missing rows", "other rows", "cut short"])
def test_a_torn_version_is_refused(spark, saved, harm):
    folder, tables = saved
    name = save_tables(spark, folder, tables(3))
    table = Path(folder) / name / "a"
    part = next(table.glob("part-*.parquet"))
    if harm == "missing table":
        shutil.rmtree(table)
    elif harm == "missing rows":
        part.unlink()
    elif harm == "cut short":
        part.write_bytes(part.read_bytes()[:-20])
        (table / f".{part.name}.crc").unlink()
    else:
        tables(4)["a"].coalesce(1).write.mode("overwrite").parquet(str(table))
    with pytest.raises(TornVersion):
        load_tables(spark, folder)


def test_nothing_saved(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_tables(spark, str(tmp_path / "none"))
