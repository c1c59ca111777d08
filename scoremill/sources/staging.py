"""Intermediate tables in the cluster's shared folder.

A frame that several passes read and that is dear to recompute (joins above it) is written
once as Parquet. Later passes then read only the columns they need, and a lost executor costs
no more than re-reading files, since the lineage ends at the written table.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Spark deletes the shuffle files of a query at its end, not when the driver's garbage is collected.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_folders: dict[str, str] = {}
_workspaces: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_folders.setdefault(context.applicationId, tempfile.mkdtemp(prefix="scoremill-"))


def new_path(spark: SparkSession, label: str, kept: bool = False) -> str:
    """A place of its own in the shared folder; the open workspaces own it unless it is ``kept``."""
    folder = shared_folder(spark).rstrip("/")
    path = f"{folder}/scoremill/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"
    if not kept:
        for owned in _workspaces:
            owned.append(path)
    return path


@contextmanager
def workspace(spark: SparkSession) -> Iterator[None]:
    """Owns what is staged inside and removes it at the end. Results have to be written by then."""
    owned: list[str] = []
    _workspaces.append(owned)
    try:
        yield
    finally:
        _workspaces.remove(owned)
        for path in owned:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def discard(*frames: DataFrame) -> None:
    """Removes what ``stage`` wrote of the frames, scans of it and unions of such; no frame that reads it can be used any more."""
    for frame in frames:
        ours = f"/scoremill/{frame.sparkSession.sparkContext.applicationId}/"
        for path in {unquote(file).rpartition("/")[0] for file in frame.inputFiles()}:
            if ours in path:
                _delete(frame.sparkSession, path)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting that holds inside and is as before afterwards."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def stage(df: DataFrame, label: str, kept: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of it. The shuffle files of the write go with its end."""
    spark = df.sparkSession
    path = new_path(spark, label, kept)
    with setting(spark, CLEANUP, "true"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_observed(df: DataFrame, label: str, totals: Mapping[str, Column], kept: bool = False) -> tuple[DataFrame, dict]:
    """``stage``, and the aggregates in ``totals``, observed while the rows are written: they cost no scan.

    Names of totals may be any text; there may be several hundred. They are taken in the tasks that write, and a task
    that has to run again counts once.
    """
    names = list(totals)
    seen = Observation()
    staged = stage(df.observe(seen, *[totals[n].alias(f"t{i}") for i, n in enumerate(names)]), label, kept)
    return staged, {n: seen.get[f"t{i}"] for i, n in enumerate(names)}
