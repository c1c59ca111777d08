"""Exact duplicates by a heavy-hitter split.

A Misra-Gries summary (``freqItems``) names the few digests that may be frequent. Their exact counts
and winners are found by a map-side aggregation, verified, and broadcast: at most ``1 / support`` rows
whatever the input. Rows of those groups are decided where they lie. What remains has no group above
``support`` of the rows, and is grouped by an ordinary shuffle of digests, never of texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scoremill.llm.common import ascii_lower, no_nulls, stage

SUPPORT = 0.002


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text_sha256`` of the text with A-Z lower-cased; null counts as empty."""
    return docs.select(F.col(key).alias("doc_id"), F.sha2(ascii_lower(no_nulls(text)), 256).alias("text_sha256"))


def frequent(staged: DataFrame, support: float = SUPPORT) -> list[str]:
    """Digests that Misra-Gries keeps: every one above ``support`` of the rows, ``1 / support`` at most."""
    row = staged.stat.freqItems(["text_sha256"], support).first()
    return list(row[0] or []) if row else []


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                     support: float = SUPPORT) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the largest identifier stays. Null texts equal empty ones. Rows that repeat an
    identifier count as rows and share its verdict. A null identifier loses against any other; a group
    of null identifiers alone keeps them. No rows give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    staged = stage(digests(docs, key, text), "digests")
    candidates = spark.createDataFrame([(d,) for d in frequent(staged, support)], "text_sha256 string")
    kind = dict(staged.dtypes)["doc_id"]
    verified = (staged.join(F.broadcast(candidates), "text_sha256", "left_semi").groupBy("text_sha256")
                .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
                .filter("group_size > 1").collect())
    winners = F.broadcast(spark.createDataFrame(
        [tuple(r) for r in verified], f"text_sha256 string, keep_id {kind}, group_size bigint"))
    hot = staged.join(winners, "text_sha256")
    group = W.partitionBy("text_sha256")
    rest = (staged.join(winners, "text_sha256", "left_anti")
            .withColumn("keep_id", F.max("doc_id").over(group))
            .withColumn("group_size", F.count(F.lit(1)).over(group)))
    return hot.unionByName(rest).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256")


ORACLE_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
