"""What several operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoremill.sources.staging import stage

__all__ = ["ascii_lower", "documents", "in_arrow", "no_nulls", "stage", "table"]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def no_nulls(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def documents(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, of which the first is the key; other columns cannot clash."""
    return docs.select(*[F.col(c) for c in columns])


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z alone. A text of ASCII alone takes the fast built-in."""
    return (F.when(F.octet_length(text) == F.length(text), F.lower(text))
            .otherwise(F.translate(text, UPPER, UPPER.lower())))


def in_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """Apply ``function(batch) -> iterable of record batches`` to each Arrow batch of ``df``."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from function(batch)
    return df.mapInArrow(each, schema)
