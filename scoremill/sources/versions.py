"""Folders of small tables that are replaced as one.

Every save writes a version of its own and, last of all, a manifest with each table's rows and checksum. A version
without a manifest was not finished: readers take the newest one that has it, so a save that stops half-way leaves what
was there before. A version whose tables are not those of its manifest is refused.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from scoremill.functions.aggregates import union_all

MANIFEST = "manifest"
PREFIX = "version-"


class TornVersion(RuntimeError):
    """A version whose tables differ from its manifest."""


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, folder: str) -> list[str]:
    """Names of the finished versions, the newest first."""
    place, system = _files(spark, folder)
    if not system.exists(place):
        return []
    names = sorted((s.getPath().getName() for s in system.listStatus(place) if s.getPath().getName().startswith(PREFIX)), reverse=True)
    return [n for n in names if system.exists(_files(spark, f"{folder}/{n}/{MANIFEST}/_SUCCESS")[0])]


def _totals(df: DataFrame) -> dict[str, Column]:
    """Rows, and a checksum of them that does not depend on their order."""
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")
    return {"rows": F.count(F.lit(1)), "checksum": F.coalesce(F.sum(hashed).cast("string"), F.lit("none"))}


def save_tables(spark: SparkSession, folder: str, tables: Mapping[str, DataFrame], keep: int | None = None) -> str:
    """Writes a version of ``tables`` and returns its name; with ``keep``, older finished ones beyond that many go."""
    name = f"{PREFIX}{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    found = []
    for label, table in tables.items():
        seen = Observation()
        observed = table.coalesce(1).observe(seen, *[v.alias(n) for n, v in _totals(table).items()])
        observed.write.parquet(f"{folder}/{name}/{label}")
        found.append((label, seen.get["rows"], seen.get["checksum"]))
    (spark.createDataFrame(found, "label string, rows long, checksum string").coalesce(1)
     .write.json(f"{folder}/{name}/{MANIFEST}"))
    for old in versions(spark, folder)[keep:] if keep else ():
        place, system = _files(spark, f"{folder}/{old}")
        system.delete(place, True)
    return name


def load_tables(spark: SparkSession, folder: str, version: str | None = None) -> dict[str, DataFrame]:
    """The tables of the newest finished version, or of the one named, checked against their manifest."""
    name = version or next(iter(versions(spark, folder)), None)
    if name is None:
        raise FileNotFoundError(f"no finished version in {folder}")
    listed = spark.read.schema("label string, rows long, checksum string").json(f"{folder}/{name}/{MANIFEST}").collect()
    if not listed:
        raise TornVersion(f"the manifest of {name} in {folder} is empty")
    try:
        tables = {r["label"]: spark.read.parquet(f"{folder}/{name}/{r['label']}") for r in listed}
        found = union_all([t.agg(F.lit(label).alias("label"), *[v.alias(n) for n, v in _totals(t).items()])
                           for label, t in tables.items()]).collect()
    except (PySparkException, Py4JJavaError) as error:  # a file that is gone or cut short
        raise TornVersion(f"{name} in {folder} cannot be read") from error
    if other := sorted(r["label"] for r in set(listed) ^ set(found)):
        raise TornVersion(f"{', '.join(dict.fromkeys(other))} of {name} in {folder} is not what the manifest says")
    return tables
