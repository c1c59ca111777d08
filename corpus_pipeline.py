"""A training corpus from raw documents: toxicity, quality, exact and near duplicates, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, written as Parquet and read again as the
next one's documents. All but the last return the columns of documents; their verdicts decide which rows go on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoremill.llm import exact_dedup, near_dedup, packing, quality, toxicity
from scoremill.llm.common import stage, table
from scoremill.llm.registered import RANKS, TOKENIZER

# A classifier and expectation-maximisation decide; SQL cannot state them.
ORACLE_SQL = None

ROW = "corpus_row"


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more probably clean than not."""
    return toxicity.clean_rows(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are more probably good than not."""
    return quality.good_rows(docs)


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number of each row, written out so that it stays: identifiers may repeat or be null."""
    return stage(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: one with the largest identifier, a null one if there is no other."""
    rows = _numbered(docs)
    verdicts = exact_dedup.exact_duplicates(rows.select(F.struct("doc_id", ROW).alias("doc_id"), "text"))
    dropped = verdicts.filter("NOT kept").select(F.col("doc_id")[ROW].alias(ROW))
    return rows.join(dropped, ROW, "left_anti").select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: one with the smallest identifier, a null one if there is no other."""
    rows = _numbered(docs)
    found = near_dedup.near_duplicates(rows, ROW).select(F.col("doc_id").alias(ROW), "component_id")
    first = F.min(F.struct(F.isnull("doc_id").alias("unnamed"), "doc_id", ROW))
    stays = (found.join(rows.select(ROW, "doc_id"), ROW).groupBy("component_id").agg(first.alias("first"))
             .select(F.col("first")[ROW].alias(ROW)))
    return rows.join(stays, ROW, "left_semi").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what stays, in sequences."""
    return packing.pack(docs, TOKENIZER, RANKS, public_tokenizers.PATTERN)


STAGES = [("toxicity", toxicity_stage), ("quality", quality_stage), ("exact_dedup", exact_stage),
          ("near_dedup", near_stage), ("packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
