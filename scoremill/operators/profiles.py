"""Profiles of files that are kept and merged, so that a new month costs a scan of that month.

A profile has a row for each file and column: rows, present values, the least and the largest one, a KLL sketch of the
numbers and an HLL sketch of the values. Merged over all files these give row and missing counts exactly (A6), distinct
counts well enough to tell few values from many (A16), and a bracket round every wanted rank. Quantiles, edges and
medians (A17, I4) are then counted exactly inside the brackets, by the one scan that exactness needs; the scan that
would have sketched the whole table is saved.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoremill.functions.aggregates import union_all
from scoremill.functions.columns import in_groups, numeric_columns, string_columns
from scoremill.functions.expressions import as_number
from scoremill.operators.binning import Sketch

KLL_K = 4000             # size of a sketch, about 80 kB
RANK_ERROR = 0.0013      # of its ranks, one-sided, with 99 % confidence
HLL_LOG_K = 12           # distinct counts to 1.6 %
COLUMNS_PER_SCAN = 16

SCHEMA = "file string, name string, rows long, present long, low double, high double, kll binary, hll binary"


def profile_rows(df: DataFrame, file: str = "__file") -> DataFrame:
    """A row for each file and column of numbers or text; ``file`` names the column that tells files apart.

    Sketches are built in the tasks and merged per file; NaN counts as missing.
    """
    numbers, texts = numeric_columns(df, {file}), string_columns(df, {file})
    parts = []
    for group in in_groups(numbers + texts, COLUMNS_PER_SCAN):
        cells = []
        for c in group:
            number = as_number(F.col(c)) if c in numbers else F.lit(None).cast("double")
            value = number if c in numbers else F.col(c)
            kll = F.kll_sketch_agg_double(number, F.lit(KLL_K)) if c in numbers else F.lit(None).cast("binary")
            cells.append(F.struct(F.lit(c).alias("name"), F.count(F.lit(1)).alias("rows"), F.count(value).alias("present"),
                                  F.min(number).alias("low"), F.max(number).alias("high"), kll.alias("kll"),
                                  F.hll_sketch_agg(value.cast("string"), HLL_LOG_K).alias("hll")))
        parts.append(df.groupBy(F.col(file).alias("file")).agg(F.array(*cells).alias("cells")).select("file", F.inline("cells")))
    return union_all(parts)


def update(spark: SparkSession, store: str, files: Sequence[str], read: Callable[[list[str]], DataFrame]) -> list[str]:
    """Profiles those of ``files`` that ``store`` does not know, and returns them. ``read`` gives a frame of the files.

    A file is known by its path: files that are there do not change. Nothing is written if the scan fails.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(store)
    known = set()
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        known = {r["file"] for r in spark.read.schema(SCHEMA).parquet(store).select("file").distinct().collect()}
    new = [f for f in files if f not in known]
    if new:
        named = read(new).withColumn("__file", F.input_file_name())
        profile_rows(named).write.mode("append").parquet(store)
    return new


@dataclass(frozen=True)
class Profile:
    """The merged profile: a row for each column, on the cluster, and its counts."""

    merged: DataFrame
    rows: int
    present: dict[str, int]
    distinct: dict[str, int]
    ends: dict[str, tuple[float, float]]

    def sketch(self) -> Sketch:
        """What decides which columns hold few values."""
        return Sketch(self.rows, self.present, self.distinct)

    def missing(self) -> dict[str, int]:
        return {"": self.rows, **{c: self.rows - n for c, n in self.present.items()}}

    def brackets(self, names: Sequence[str], probs: Sequence[float], reach: float) -> tuple[list, list[int]]:
        """For each name the merged closed brackets round the wanted ranks, and its present values."""
        fractions = sorted({f for p in probs for f in (max(p - reach, 0.0), min(p + reach, 1.0))})
        rows = self.merged.where(F.col("name").isin(list(names)) & (F.col("present") > 0)).select("name", F.kll_sketch_get_quantile_double(
            "kll", F.array(*[F.lit(f) for f in fractions])).alias("q")).collect()
        found = {r["name"]: dict(zip(fractions, r["q"])) for r in rows}
        brackets = []
        for name in names:
            merged: list[list[float]] = []
            if name in found:
                low, high = self.ends[name]
                at = lambda f: low if f <= 0 else high if f >= 1 else found[name][f]  # noqa: E731, B023
                for a, b in sorted((at(max(p - reach, 0.0)), at(min(p + reach, 1.0))) for p in probs):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
            brackets.append(merged)
        return brackets, [self.present[n] for n in names]


def merged(spark: SparkSession, store: str, files: Sequence[str] | None = None) -> Profile:
    """The profile of all files of the store, or of the named ones."""
    rows = spark.read.schema(SCHEMA).parquet(store).dropDuplicates(["file", "name"])
    if files is not None:
        rows = rows.where(F.col("file").isin(list(files)))
    whole = rows.groupBy("name").agg(
        F.sum("rows").alias("rows"), F.sum("present").alias("present"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.kll_merge_agg_double("kll", F.lit(KLL_K)).alias("kll"), F.hll_union_agg("hll").alias("hll"))
    found = whole.select("name", "rows", "present", "low", "high", F.hll_sketch_estimate("hll").alias("distinct")).collect()
    return Profile(whole, max((r["rows"] for r in found), default=0), {r["name"]: r["present"] for r in found},
                   {r["name"]: r["distinct"] or 0 for r in found}, {r["name"]: (r["low"], r["high"]) for r in found})
