"""Exact quantiles of many columns, at any table size.

The built-in ``percentile`` is exact but keeps one entry per distinct value in a single final
buffer, so it is used only when rows times columns fit a fixed budget. Beyond the budget:

1. one scan builds a bounded sketch per column and brackets every wanted rank between two values;
2. a second scan counts, per column, the rows of each gap between brackets, and the distinct
   values inside the brackets (well under one percent of the rows, ties already collapsed);
3. the few values at the wanted ranks are read from that small table in sub-buckets, so that no
   window holds more than a sliver of it.

A rank that a bracket turns out to miss is bracketed again, wider; results are exact either way.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoremill.functions.aggregates import union_all
from scoremill.functions.columns import in_groups
from scoremill.functions.expressions import as_number, balanced
from scoremill.sources.staging import stage

BUFFER_VALUES = 4_000_000   # values that built-in percentile buffers may hold in total
SKETCH_ACCURACY = 10_000    # rank error of the sketch: rows / accuracy
SUB_BUCKETS = 64
PROFILE_REACH = 0.003       # twice the rank error of a profile's sketch
COLUMNS_PER_SCAN = 2        # keeps generated code small enough for the JIT compiler


def exact_quantiles(df: DataFrame, columns: Mapping[str, Column], probs: Sequence[float],
                    rows: int | None = None, buffer_values: int = BUFFER_VALUES,
                    accuracy: int = SKETCH_ACCURACY, profile=None) -> dict[str, list[float] | None]:
    """Linearly interpolated quantiles of each column's non-null values; None for an empty one.

    The result is ``len(columns) * len(probs)`` numbers on the driver. ``profile``, the merged profile of just these
    rows with the columns under the same names, saves the scan that brackets the ranks.
    """
    if not columns:
        return {}
    numbers = {name: as_number(column) for name, column in columns.items()}
    if profile is not None:
        return _by_bracketing(df, numbers, probs, accuracy, profile)
    if rows is None:
        rows = df.count()
    if rows * len(numbers) <= buffer_values:
        wanted = F.array(*[F.lit(float(p)) for p in probs])
        row = df.agg(*[F.percentile(c, wanted).alias(f"q{i}")
                       for i, c in enumerate(numbers.values())]).first()
        return {name: row[f"q{i}"] for i, name in enumerate(numbers)}
    return _by_bracketing(df, numbers, probs, accuracy)


def median_values(df: DataFrame, names: Sequence[str], **options) -> dict[str, float | None]:
    """Exact medians of the named columns (I4)."""
    found = exact_quantiles(df, {c: F.col(c) for c in names}, [0.5], **options)
    return {c: None if q is None else q[0] for c, q in found.items()}


def _positions(prob: float, count: int) -> tuple[int, int, float]:
    spot = prob * (count - 1)
    low = math.floor(spot)
    return low, min(low + 1, count - 1), spot - low


def _by_bracketing(df, numbers, probs, accuracy, profile=None):
    names = list(numbers)
    reach = 2.0 / accuracy
    values: dict[tuple[int, int], float] = {}
    known = profile.brackets(names, probs, PROFILE_REACH) if profile else None
    while True:
        brackets, counts = known or _sketch(df, numbers, probs, accuracy, reach)
        known = None
        wanted = {i: {r for p in probs for r in _positions(p, n)[:2]} - {r for j, r in values if j == i}
                  for i, n in enumerate(counts) if n}
        wanted = {i: sorted(ranks) for i, ranks in wanted.items() if ranks}
        values.update(_values_at(df, [numbers[c] for c in names],
                                 {i: brackets[i] for i in wanted}, wanted))
        if all((i, r) in values for i, ranks in wanted.items() for r in ranks):
            break
        reach *= 8
    result: dict[str, list[float] | None] = {}
    for i, name in enumerate(names):
        if not counts[i]:
            result[name] = None
            continue
        row = []
        for p in probs:
            low, high, part = _positions(p, counts[i])
            a, b = values[i, low], values[i, high]
            row.append(a if part == 0 or a == b else (1 - part) * a + part * b)
        result[name] = row
    return result


def _sketch(df, numbers, probs, accuracy, reach):
    """Per column: merged closed brackets around the wanted probabilities, and the value count."""
    ends = [(max(p - reach, 0.0), min(p + reach, 1.0)) for p in probs]
    fractions = sorted({f for pair in ends for f in pair})
    spots = {f: k for k, f in enumerate(fractions)}
    wanted = F.array(*[F.lit(f) for f in fractions])
    row = df.agg(*[
        F.struct(F.count(c).alias("n"), F.min(c).alias("lo"), F.max(c).alias("hi"),
                 F.percentile_approx(c, wanted, accuracy).alias("q")).alias(f"s{i}")
        for i, c in enumerate(numbers.values())]).first()
    brackets, counts = [], []
    for i in range(len(numbers)):
        s = row[f"s{i}"]
        counts.append(s["n"])
        merged: list[list[float]] = []
        if s["n"]:
            at = lambda f: s["lo"] if f <= 0 else s["hi"] if f >= 1 else s["q"][spots[f]]
            for low, high in sorted((at(a), at(b)) for a, b in ends):
                if merged and low <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], high)
                else:
                    merged.append([low, high])
        brackets.append(merged)
    return brackets, counts


def _segment(x: Column, brackets: Sequence[Sequence[float]]) -> Column:
    """Even numbers for the gaps between brackets, odd numbers inside a bracket."""
    tests = []
    for low, high in brackets:
        tests += [lambda low=low: x < F.lit(low), lambda high=high: x <= F.lit(high)]
    leaves = [F.lit(k) for k in range(2 * len(brackets) + 1)]
    return F.when(x.isNotNull(), balanced(tests, leaves))


def _values_at(df, columns, brackets, wanted):
    """The values at the wanted ranks that lie inside the brackets."""
    if not wanted:
        return {}
    parts = []
    for group in in_groups(sorted(brackets), COLUMNS_PER_SCAN):
        cells = df.select(*[
            F.struct(_segment(columns[i], brackets[i]).alias("segment"),
                     columns[i].alias("value")).alias(str(i)) for i in group])
        long = cells.unpivot([], [str(i) for i in group], "column", "cell")
        parts.append(
            long.where(F.col("cell.segment").isNotNull())
            .select(F.col("column").cast("int").alias("column"), F.col("cell.segment").alias("segment"),
                    F.when(F.col("cell.segment") % 2 == 1, F.col("cell.value")).alias("value"))
            .groupBy("column", "segment", "value").agg(F.count(F.lit(1)).alias("n")))
    table = stage(union_all(parts), "quantile-brackets")

    inner = table.where(F.col("value").isNotNull())
    splits = inner.groupBy("column", "segment").agg(F.percentile_approx(
        "value", F.array(*[F.lit(k / SUB_BUCKETS) for k in range(1, SUB_BUCKETS)]), 1000)
        .alias("splits"))   # one row per column and bracket
    tagged = (inner.join(F.broadcast(splits), ["column", "segment"])
              .withColumn("bucket", F.size(F.filter("splits", lambda s: s < F.col("value"))))
              .drop("splits"))
    gaps = table.where(F.col("value").isNull()).withColumn("bucket", F.lit(0))
    totals = (tagged.select("column", "segment", "bucket", "n")
              .unionByName(gaps.select("column", "segment", "bucket", "n"))
              .groupBy("column", "segment", "bucket").agg(F.sum("n").alias("n")).collect())

    picks, passed = [], {}
    for r in sorted(totals, key=lambda r: (r["column"], r["segment"], r["bucket"])):
        before = passed.get(r["column"], 0)
        passed[r["column"]] = before + r["n"]
        if r["segment"] % 2 == 1:
            picks += [(r["column"], r["segment"], r["bucket"], before, rank)
                      for rank in wanted.get(r["column"], ()) if before <= rank < before + r["n"]]
    if not picks:
        return {}
    spark = df.sparkSession
    targets = spark.createDataFrame(picks, "column int, segment int, bucket int, before long, rank long")
    places = targets.groupBy("column", "segment", "bucket", "before").agg(
        F.collect_list("rank").alias("ranks"))
    order = (Window.partitionBy("column", "segment", "bucket").orderBy("value")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    hits = (tagged.join(F.broadcast(places), ["column", "segment", "bucket"])
            .withColumn("through", F.col("before") + F.sum("n").over(order))
            .withColumn("rank", F.explode("ranks"))
            .where((F.col("through") - F.col("n") <= F.col("rank")) & (F.col("rank") < F.col("through")))
            .select("column", "rank", "value").collect())
    return {(h["column"], h["rank"]): h["value"] for h in hits}
