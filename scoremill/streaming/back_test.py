"""Judging a scorecard as outcomes arrive.

Loans are scored when they come, and what became of them is known months later. Both are streams: a score waits as state
for its outcome until the time it may take has passed, and each pair adds one to the goods or bads of its score in its
period. Counts of a period are handed out once it is over for good; metrics are made of the counts, never of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from scoremill.operators.evaluation import metrics_of_counts
from scoremill.operators.target import is_member
from scoremill.plans.scorecard import PROBABILITY, ScorecardModel
from scoremill.sources.staging import setting
from scoremill.spec import ALL_ROWS_BAD

STORE = "spark.sql.streaming.stateStore.providerClass"
ON_HEAP = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
ON_DISK = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
COUNTED = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
BUFFER = "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB"
PARTITIONS = "spark.sql.shuffle.partitions"

IN_PART = 80_000     # loans to a part of the state, whose stores are then searched in the processor's caches
MOST_PARTS = 48      # four stores each, whose buffers of BUFFER_MB are native memory
BUFFER_MB = 16

COUNTS = "period timestamp, score double, n0 long, n1 long"


def outcome_counts(scored: DataFrame, outcomes: DataFrame, key: str, scored_at: str = "scored_at", outcome_at: str = "outcome_at",
                   status: str = "loan_status", bad: Sequence[str] = ALL_ROWS_BAD, wait: str = "365 days",
                   late: str = "30 days", period: str = "30 days", digits: int = 6) -> DataFrame:
    """``period, score, n0, n1``: goods and bads by score for each period of outcomes; streams or tables alike.

    An outcome counts if it lies at most ``wait`` after its score; rows may come ``late`` after others of their
    stream. Scores are told apart to ``digits`` places, which bounds the state of a period. A loan without a key or a
    time, and an outcome without its loan, counts nowhere; of several outcomes each counts.
    """
    left = scored.select(F.col(key).alias("k"), F.col(scored_at).cast("timestamp").alias("at"),
                         F.round(F.col(PROBABILITY), digits).alias("score")).withWatermark("at", late)
    right = outcomes.select(F.col(key).alias("j"), F.col(outcome_at).cast("timestamp").alias("known"),
                            is_member(F.col(status), bad).cast("int").alias("y")).withWatermark("known", late)
    pairs = left.join(right, F.expr(f"k = j AND known >= at AND known <= at + INTERVAL {wait}"))
    return (pairs.groupBy(F.window("known", period).alias("w"), "score")
            .agg(F.count_if(F.col("y") == 0).alias("n0"), F.count_if(F.col("y") == 1).alias("n1"))
            .select(F.col("w.start").alias("period"), "score", "n0", "n1"))


def back_test_stream(model: ScorecardModel, loans: DataFrame, outcomes: DataFrame, output: str, checkpoint: str,
                     once: bool = False, waiting: int = 0, **options) -> StreamingQuery:
    """Appends the counts of each period that is over to ``output``; ``once`` stops after the files present now.

    ``loans`` holds the model's columns, the key and ``scored_at``; ``outcomes`` the key, the status and ``outcome_at``.
    All scores and outcomes of a year wait as state, about 400 bytes each, more than executors hold as objects. So the
    state is kept by RocksDB, on the executors' disks, unless the session names a store of its own; a stream that goes
    on from a checkpoint keeps the store it began with. Rows of the state are not counted, since that is a lookup for each that
    is put or removed. ``waiting`` is about how many loans wait at once; for many the state has more parts than the session's
    shuffles. A stream keeps the number of parts it began with.
    """
    spark = loans.sparkSession
    store = spark.conf.get(STORE)
    counts = outcome_counts(model.transform(loans), outcomes, model.spec.key, status=model.spec.status_column, **options)
    writer = (counts.writeStream.format("parquet").outputMode("append")
              .option("path", output).option("checkpointLocation", checkpoint))
    parts = max(int(spark.conf.get(PARTITIONS)), min(MOST_PARTS, -(-waiting // IN_PART)))
    with (setting(spark, STORE, ON_DISK if store == ON_HEAP else store), setting(spark, CHANGELOG, "true"),
          setting(spark, COUNTED, "false"), setting(spark, BUFFER, str(BUFFER_MB)), setting(spark, PARTITIONS, str(parts))):
        return (writer.trigger(availableNow=True) if once else writer).start()


def period_metrics(spark: SparkSession, output: str) -> DataFrame:
    """``period, n, n_bad, auc, gini, ks, brier`` of the periods handed out so far."""
    return metrics_of_counts(spark.read.schema(COUNTS).parquet(output), ["period"])
