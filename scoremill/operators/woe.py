"""Weight of evidence, information value, selection and the WoE transform."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scoremill.functions.aggregates import union_all
from scoremill.functions.columns import in_groups
from scoremill.functions.expressions import as_number, interval_value
from scoremill.operators.binning import Bins
from scoremill.spec import IV_RANGE, POWER_ABOVE, POWER_LABELS, WOE_SMOOTHING

FEATURES_PER_SCAN = 4   # wider projections outgrow the JIT compiler's method limit
CASE_CATEGORIES = 16    # up to here categories are compared inline, above they are joined

WOE_COLUMNS = ("feature", "bin_id", "lo", "hi", "category", "bin", "good_count", "bad_count",
               "good_rate", "bad_rate", "woe", "iv")
WOE_SCHEMA = ("feature string, bin_id int, lo double, hi double, category string, bin string, "
              "good_count double, bad_count double, good_rate double, bad_rate double, "
              "woe double, iv double")


def bin_counts(df: DataFrame, bins: Sequence[Bins], target: str) -> DataFrame:
    """Goods and bads per bin: ``feature, bin_id, number, category, good, bad``.

    Features are read in small groups, each an own column-pruned scan that is cut, turned into
    narrow rows and counted map-side, all in one shuffle that carries at most bins x 1 rows per task.
    Missing values belong to no bin.
    """
    parts = []
    for kind in ("interval", "value", "category"):
        for group in in_groups([b for b in bins if b.kind == kind], FEATURES_PER_SCAN):
            names = [b.feature for b in group]
            cells = df.select(F.col(target).alias("__target"), *[
                (F.col(c) if kind == "category" else as_number(F.col(c))).alias(c) for c in names])
            if kind == "interval":
                cells = cells.select("__target", *[b.index(F.col(b.feature)).alias(b.feature)
                                                   for b in group])
            long = (cells.unpivot(["__target"], names, "feature", "cell").where(F.col("cell").isNotNull()))
            parts.append(long.select(
                "feature",
                *[(F.col("cell") if kind == k else F.lit(None)).cast(t).alias(name)
                  for k, t, name in (("interval", "int", "bin_id"), ("value", "double", "number"),
                                     ("category", "string", "category"))],
                "__target"))
    return union_all(parts).groupBy("feature", "bin_id", "number", "category").agg(
        F.count_if(F.col("__target") == 0).alias("good"), F.count_if(F.col("__target") == 1).alias("bad"))


def _interval_label(lo: Column, hi: Column) -> Column:
    """``(lo, hi]`` with inf for the open ends; null without bounds."""
    def text(edge: Column) -> Column:
        return F.regexp_replace(edge.cast("string"), "Infinity", "inf")
    return F.concat(F.lit("("), text(lo), F.lit(", "), text(hi), F.lit("]"))


def weights(counts: DataFrame, bins: Sequence[Bins], smoothing: float = WOE_SMOOTHING) -> DataFrame:
    """The WoE table from the bin counts (W2, W3, W7). Works on a few rows per feature."""
    spark = counts.sparkSession
    bounds = spark.createDataFrame(
        [(b.feature, i, low, high) for b in bins if b.kind == "interval"
         for i, (low, high) in enumerate(b.bounds())] or [(None, None, None, None)],
        "feature string, bin_id int, lo double, hi double")
    per_feature = Window.partitionBy("feature")
    rank = F.row_number().over(per_feature.orderBy("number", "category")) - 1
    number = F.col("number")
    smooth = (counts.join(F.broadcast(bounds), ["feature", "bin_id"], "left")
              .select("feature",
                      F.coalesce("bin_id", rank).cast("int").alias("bin_id"),
                      F.coalesce("lo", number).alias("lo"), F.coalesce("hi", number).alias("hi"),
                      "category",
                      F.coalesce(_interval_label(F.col("lo"), F.col("hi")),
                                 number.cast("string"), "category").alias("bin"),
                      (F.col("good") + smoothing).alias("good_count"),
                      (F.col("bad") + smoothing).alias("bad_count")))
    rated = smooth.withColumns({
        "good_rate": F.col("good_count") / F.sum("good_count").over(per_feature),
        "bad_rate": F.col("bad_count") / F.sum("bad_count").over(per_feature)})
    return (rated.withColumn("woe", F.ln(F.col("good_rate") / F.col("bad_rate")))
            .withColumn("iv", (F.col("good_rate") - F.col("bad_rate")) * F.col("woe"))
            .select(*WOE_COLUMNS))


def woe_table(df: DataFrame, bins: Sequence[Bins], target: str,
              smoothing: float = WOE_SMOOTHING) -> DataFrame:
    return weights(bin_counts(df, bins, target), bins, smoothing)


def power_label(iv: Column) -> Column:
    """Label of an information value."""
    label = F.lit(POWER_ABOVE)
    for limit, name in reversed(POWER_LABELS):
        label = F.when(iv < limit, name).otherwise(label)
    return label


def iv_table(woe: DataFrame) -> DataFrame:
    """Information value and power per feature, highest first."""
    return (woe.groupBy("feature").agg(F.sum("iv").alias("iv"))
            .withColumn("predictive_power", power_label(F.col("iv")))
            .orderBy(F.desc("iv"), "feature"))


def select_features(iv: DataFrame, iv_range: tuple[float, float] = IV_RANGE) -> DataFrame:
    """Features whose information value lies in ``[low, high)``, highest first."""
    low, high = iv_range
    return iv.where((F.col("iv") >= low) & (F.col("iv") < high)).orderBy(F.desc("iv"), "feature")


def selected_names(iv_rows: Iterable, iv_range: tuple[float, float] = IV_RANGE) -> list[str]:
    low, high = iv_range
    kept = [r for r in iv_rows if low <= r["iv"] < high]
    return [r["feature"] for r in sorted(kept, key=lambda r: (-r["iv"], r["feature"]))]


def collected(woe: DataFrame) -> list[dict]:
    """The WoE table on the driver: at most features x (bins or category limit) rows."""
    rows = [r.asDict() for r in woe.collect()]
    return sorted(rows, key=lambda r: (r["feature"], r["bin_id"]))


def woe_frame(spark: SparkSession, rows: Sequence[Mapping]) -> DataFrame:
    return spark.createDataFrame([tuple(r[c] for c in WOE_COLUMNS) for r in rows], WOE_SCHEMA)


def add_weights(df: DataFrame, bins: Sequence[Bins], rows: Sequence[Mapping], column: str = "woe",
                suffix: str = "_woe") -> DataFrame:
    """Add ``<feature><suffix>`` for every bin set, from fitted rows.

    Intervals, raw values and small category sets become comparisons with literals; a larger
    category set is a broadcast lookup of at most the category limit. A missing or unseen value
    weighs 0. No shuffle either way.
    """
    by_feature: dict[str, list[Mapping]] = {}
    for r in rows:
        by_feature.setdefault(r["feature"], []).append(r)
    added, joined = {}, []
    numbers = [as_number(F.col(b.feature)).alias(f"__{b.feature}") for b in bins if b.kind != "category"]
    for b in bins:
        own = sorted(by_feature.get(b.feature, ()), key=lambda r: r["bin_id"])
        if b.kind == "interval":
            leaves = [0.0] * (len(b.cuts) + 1)
            for r in own:
                leaves[r["bin_id"]] = float(r[column])
            x = F.col(f"__{b.feature}")
            value = F.when(x.isNotNull(), interval_value(x, b.cuts, leaves)).otherwise(0.0)
        elif b.kind == "value" or len(own) <= CASE_CATEGORIES:
            cell = F.col(f"__{b.feature}" if b.kind == "value" else b.feature)
            value = F.lit(0.0)
            for r in reversed(own):
                match = r["lo"] if b.kind == "value" else r["category"]
                value = F.when(cell == F.lit(match), float(r[column])).otherwise(value)
        else:
            table = df.sparkSession.createDataFrame(
                [(r["category"], float(r[column])) for r in own],
                f"`{b.feature}` string, `{b.feature}{suffix}__` double")
            joined.append((b.feature, table))
            value = F.coalesce(F.col(f"{b.feature}{suffix}__"), F.lit(0.0))
        added[f"{b.feature}{suffix}"] = value
    wide = df.select("*", *numbers)
    for feature, table in joined:
        wide = wide.join(F.broadcast(table), feature, "left")
    return wide.select(*[F.col(c) for c in df.columns],
                       *[value.alias(name) for name, value in added.items()])


def woe_matrix(df: DataFrame, bins: Sequence[Bins], rows: Sequence[Mapping],
               keep: Sequence[str]) -> DataFrame:
    """The kept columns plus one WoE column per feature, and nothing else."""
    wide = add_weights(df, bins, rows)
    return wide.select(*keep, *[f"{b.feature}_woe" for b in bins])
