"""Scoring loan files as they arrive.

Scoring is stateless and map-side, so the batch transform serves a stream unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from scoremill.plans.scorecard import ScorecardModel


def read_new_files(spark: SparkSession, folder: str, schema: StructType,
                   files_per_batch: int | None = None) -> DataFrame:
    """Parquet files appearing in a folder, as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def score_stream(model: ScorecardModel, loans: DataFrame, output: str, checkpoint: str,
                 once: bool = False) -> StreamingQuery:
    """Append scored rows to ``output``; ``once`` stops after the files present now."""
    writer = (model.score_file(loans).writeStream.format("parquet").outputMode("append")
              .option("path", output).option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if once else writer).start()
