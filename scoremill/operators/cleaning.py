"""Column drops, missing-value profile and imputation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoremill.functions.aggregates import aggregate_rows, union_all
from scoremill.functions.columns import in_groups, numeric_columns, present, string_columns
from scoremill.functions.expressions import as_number
from scoremill.operators.quantiles import median_values
from scoremill.spec import CONSTANT_FILLS, MODE_FALLBACK, NON_PREDICTIVE_COLUMNS, SPARSE_COLUMNS

FEW_VALUES = 100_000   # distinct values that may be counted one by one
TRACKED = 12_288       # values that the sketch of frequent ones follows; its error is 3.5 / TRACKED of the rows
CANDIDATES = 64        # of them counted exactly

FILL_SCHEMA = "feature string, kind string, number double, text string"


def drop_unusable(df: DataFrame) -> DataFrame:
    """Drop the sparse and the non-predictive columns the frame has."""
    return df.drop(*SPARSE_COLUMNS, *NON_PREDICTIVE_COLUMNS)


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column_name, rows, missing_count`` of every column."""
    names = list(columns or df.columns)
    return aggregate_rows(df, [
        F.struct(F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("rows"),
                 F.count_if(F.col(c).isNull()).alias("missing_count")) for c in names])


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing count and percentage of the columns with any, largest first."""
    return (missing_counts(df, columns).where(F.col("missing_count") > 0)
            .select("column_name", "missing_count",
                    (F.col("missing_count") * 100.0 / F.col("rows")).alias("missing_pct"))
            .orderBy(F.desc("missing_count"), "column_name"))


def residual_nulls(df: DataFrame) -> DataFrame:
    """Missing values left in the whole table, and whether there are none."""
    cells = F.sum("missing_count")
    return missing_counts(df).agg(cells.alias("remaining_nulls"), (cells == 0).alias("complete"))


def null_totals(df: DataFrame) -> dict[str, Column]:
    """What to observe while ``df`` is written: its rows, and each column's missing values."""
    return {"": F.count(F.lit(1)), **{c: F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns}}


def observed_missing(spark: SparkSession, totals: Mapping[str, int]) -> DataFrame:
    """``missing_profile`` from observed totals, without a scan."""
    rows = sorted(((c, n) for c, n in totals.items() if c and n), key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame([(c, n, n * 100.0 / totals[""]) for c, n in rows],
                                 "column_name string, missing_count long, missing_pct double")


def observed_nulls(spark: SparkSession, totals: Mapping[str, int]) -> DataFrame:
    """``residual_nulls`` from observed totals, without a scan."""
    left = sum(n for c, n in totals.items() if c)
    return spark.createDataFrame([(left, left == 0)], "remaining_nulls long, complete boolean")


def fill_constants(df: DataFrame, fills: Mapping[str, object] = CONSTANT_FILLS) -> DataFrame:
    """Replace missing values by fixed ones where the column exists."""
    return apply_fills(df, {c: fills[c] for c in present(df, fills)})


def mode_values(df: DataFrame, names: Sequence[str], distinct: Mapping[str, int] | None = None) -> dict[str, str | None]:
    """Most frequent value per column, the smallest on a tie, None if all are missing.

    A column of few values (``distinct``, if known, says so) is counted by value. Of the others a bounded sketch of
    frequent values names candidates, and one scan counts those alone: where the best of them beats the bound on
    every other value, nothing else is shuffled. Only a column without such a leader is counted by value in full.
    """
    wide = [c for c in names if distinct is None or distinct[c] > FEW_VALUES]
    found = _leaders(df, wide) if wide else {}
    found |= _counted_modes(df, [c for c in names if c not in found])
    return {c: found.get(c) for c in names}


def _leaders(df: DataFrame, names: Sequence[str]) -> dict[str, str | None]:
    """The modes of those columns whose leading value the sketch's error bound lets be told."""
    found = {}
    for group in in_groups(list(names), 6):
        row = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"n{i}") for i, c in enumerate(group)],
                     *[F.expr(f"approx_top_k(`{c}`, {CANDIDATES}, {TRACKED})").alias(f"top{i}") for i, c in enumerate(group)]).first()
        # A value that is not listed is found at most this often: twice the sketch's error, or the least estimate of a full list.
        listed = {c: [(t["item"], t["count"]) for t in row[f"top{i}"] or () if t["item"] is not None] for i, c in enumerate(group)}
        others = {c: max(2 * 3.5 / TRACKED * row["rows"], min(n for _, n in listed[c]) if len(listed[c]) >= CANDIDATES - 1 else 0)
                  for i, c in enumerate(group) if listed[c]}
        found |= {c: None for i, c in enumerate(group) if not row[f"n{i}"]}
        counted = _value_counts(df, {c: [v for v, _ in listed[c]] for c in others}) if others else ()
        best: dict[str, tuple] = {}
        for r in counted:
            best[r["feature"]] = min(best.get(r["feature"], (0, "")), (-r["n"], r["value"]))
        found |= {c: value for c, (n, value) in best.items() if -n > others[c]}
    return found


def _value_counts(df: DataFrame, wanted: Mapping[str, Sequence[str]]) -> list:
    """How often each wanted value stands in its column: a row for each, counted in the tasks."""
    long = df.select(*[F.when(F.col(c).isin(list(values)), F.col(c)).alias(c) for c, values in wanted.items()])
    return (long.unpivot([], list(wanted), "feature", "value").where(F.col("value").isNotNull())
            .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")).collect())


def _counted_modes(df: DataFrame, names: Sequence[str]) -> dict[str, str | None]:
    """Counted per distinct value, so that a column of very many is spread over the cluster."""
    if not names:
        return {}
    parts = [df.select(*group).unpivot([], group, "feature", "value")
             .where(F.col("value").isNotNull())
             .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
             for group in in_groups(list(names), 6)]
    best = (union_all(parts).groupBy("feature")
            .agg(F.min(F.struct((-F.col("n")).alias("rank"), F.col("value"))).alias("top")))
    return {r["feature"]: r["top"]["value"] for r in best.collect()}


def fit_fills(df: DataFrame, constants: Mapping[str, object] = CONSTANT_FILLS,
              skip: Sequence[str] = (), only_missing: bool = True,
              rows: int | None = None, profile=None) -> dict[str, object]:
    """The fill of every column: fixed, median (numbers) or mode (text).

    ``only_missing`` leaves out columns without a missing value; switch it off to keep a fill
    for every column that later data may lack. A merged ``profile`` of the frame saves the count of missing
    values and the scan that brackets the medians.
    """
    fills = {c: constants[c] for c in present(df, constants) if c not in skip}
    taken = set(skip) | set(fills)
    numbers, texts = numeric_columns(df, taken), string_columns(df, taken)
    if only_missing:
        if profile is None:
            lacking = {r["column_name"] for r in missing_profile(df, numbers + texts).collect()}
        else:
            lacking = {c for c, n in profile.missing().items() if n}
        numbers = [c for c in numbers if c in lacking]
        texts = [c for c in texts if c in lacking]
    medians = median_values(df, numbers, rows=rows, profile=profile)
    fills.update({c: v for c, v in medians.items() if v is not None})
    fills.update({c: MODE_FALLBACK if v is None else v for c, v in mode_values(df, texts, profile and profile.distinct).items()})
    return fills


def apply_fills(df: DataFrame, fills: Mapping[str, object]) -> DataFrame:
    """Fill missing values in one projection; a numeric fill makes the column a double."""
    def filled(name: str):
        value = fills.get(name)
        if value is None:
            return F.col(name)
        if isinstance(value, str):
            return F.coalesce(F.col(name), F.lit(value)).alias(name)
        return F.coalesce(as_number(F.col(name)), F.lit(float(value))).alias(name)
    return df.select(*[filled(c) for c in df.columns])


def clean(df: DataFrame, status: str = "loan_status", target: str = "default_status", profile=None) -> DataFrame:
    """Drops, then every imputation rule, fitted on the frame itself."""
    kept = drop_unusable(df)
    return apply_fills(kept, fit_fills(kept, skip=[status, target], profile=profile))


def fills_table(spark: SparkSession, fills: Mapping[str, object]) -> DataFrame:
    """The fills as a small table, for storing."""
    rows = [(c, "text", None, v) if isinstance(v, str) else (c, "number", float(v), None)
            for c, v in fills.items()]
    return spark.createDataFrame(rows, FILL_SCHEMA)


def fills_from_table(table: DataFrame) -> dict[str, object]:
    return {r["feature"]: r["text"] if r["kind"] == "text" else r["number"]
            for r in table.collect()}
