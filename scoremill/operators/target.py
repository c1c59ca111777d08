"""Building the binary target from the loan status."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoremill.spec import ALL_ROWS_BAD, FOUR_STATUS_BAD, FOUR_STATUS_KEPT


def is_member(column: Column, values) -> Column:
    """Set membership where a missing value is simply not a member."""
    return F.coalesce(column.isin(list(values)), F.lit(False))


def add_target(df: DataFrame, policy: str = "all_rows", status: str = "loan_status",
               target: str = "default_status") -> DataFrame:
    """Add the 0/1 target.

    ``four_status`` keeps finished loans only; ``all_rows`` keeps every row and counts late and
    running loans as good.
    """
    if policy == "four_status":
        kept = df.where(F.col(status).isin(list(FOUR_STATUS_KEPT)))
        return kept.withColumn(target, is_member(F.col(status), FOUR_STATUS_BAD).cast("int"))
    if policy == "all_rows":
        return df.withColumn(target, is_member(F.col(status), ALL_ROWS_BAD).cast("int"))
    raise ValueError(f"unknown target policy {policy!r}")


def target_summary(df: DataFrame, target: str = "default_status") -> DataFrame:
    """Rows, columns, goods, bads and their rates in one aggregate."""
    return summary_of(df.agg(*[v.alias(n) for n, v in target_totals(target).items()]), len(df.columns))


def target_totals(target: str = "default_status") -> dict[str, Column]:
    """The aggregates of the summary, which may also be observed while a frame is written."""
    y = F.col(target)
    return {"total_rows": F.count(F.lit(1)), "good_loans": F.count_if(y == 0), "bad_loans": F.count_if(y == 1),
            "labelled": F.count(y), "bad_sum": F.sum(y.cast("double"))}


def summary_of(totals: DataFrame, columns: int) -> DataFrame:
    """The summary from a row of the totals."""
    return totals.select("total_rows", F.lit(columns).cast("long").alias("total_columns"), "good_loans", "bad_loans",
                         F.try_divide("good_loans", "labelled").alias("good_rate"),
                         F.try_divide("bad_sum", "labelled").alias("bad_rate"))


def observed_summary(spark: SparkSession, totals: Mapping[str, object], columns: int) -> DataFrame:
    """``target_summary`` from observed totals, without a scan."""
    names = list(target_totals())
    row = spark.createDataFrame([tuple(totals[n] for n in names)],
                                ", ".join(f"{n} {'double' if n == 'bad_sum' else 'long'}" for n in names))
    return summary_of(row, columns)


def frequency(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; missing values are not counted (A5)."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column))
