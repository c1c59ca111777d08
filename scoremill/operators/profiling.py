"""Profiles of a cleaned loan table: rates per group, per-class statistics, correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoremill.functions.aggregates import scalars, union_all
from scoremill.functions.columns import in_groups, present
from scoremill.functions.expressions import as_number
from scoremill.operators.comoments import correlations
from scoremill.operators.quantiles import exact_quantiles
from scoremill.sources.staging import stage
from scoremill.spec import PROFILED_CATEGORIES, PROFILED_NUMBERS

GROUP_ACCURACY = 10_000   # a group's ranks are bracketed to one in this many


def default_rate_by_category(df: DataFrame, target: str,
                             variables: Sequence[str] = PROFILED_CATEGORIES,
                             top: int | None = 10) -> DataFrame:
    """Count, bads and bad rate per value of each variable, worst ``top`` values each (A1).

    ``top=None`` keeps every value.
    """
    parts = []
    for group in in_groups(present(df, variables), 6):
        long = (df.select(F.col(target).alias("__target"),
                          *[F.col(c).cast("string").alias(c) for c in group])
                .unpivot(["__target"], group, "variable", "value").where(F.col("value").isNotNull()))
        parts.append(long.groupBy("variable", "value").agg(
            F.count("__target").alias("total_count"), F.sum("__target").alias("default_count"),
            F.avg("__target").alias("default_rate")))
    rates = union_all(parts)
    if top is not None:
        place = F.row_number().over(
            Window.partitionBy("variable").orderBy(F.desc("default_rate"), "value"))
        rates = rates.withColumn("__place", place).where(F.col("__place") <= top).drop("__place")
    return rates.orderBy("variable", F.desc("default_rate"), "value")


def _group_base(df, group, target):
    return df.where(F.col(group).isNotNull()).groupBy(group), F.col(target)


def grade_stats(df: DataFrame, target: str, group: str = "grade", rate: str = "int_rate",
                amount: str = "loan_amnt", digits: int = 3) -> DataFrame:
    """Counts, bad rate, interest mean and spread, mean amount per grade (A2)."""
    grouped, y = _group_base(df, group, target)
    return grouped.agg(
        F.count(y).alias("Total_Loans"), F.sum(y).alias("Defaults"),
        F.bround(F.avg(y), digits).alias("Default_Rate"),
        F.bround(F.avg(rate), digits).alias("Avg_Interest_Rate"),
        F.bround(F.stddev_samp(rate), digits).alias("Interest_Rate_Std"),
        F.bround(F.avg(amount), digits).alias("Avg_Loan_Amount")).orderBy(group)


def purpose_stats(df: DataFrame, target: str, group: str = "purpose", rate: str = "int_rate",
                  amount: str = "loan_amnt", digits: int = 3) -> DataFrame:
    """The same without the spread, riskiest purpose first (A3)."""
    grouped, y = _group_base(df, group, target)
    return grouped.agg(
        F.count(y).alias("Total_Loans"), F.sum(y).alias("Defaults"),
        F.bround(F.avg(y), digits).alias("Default_Rate"),
        F.bround(F.avg(rate), digits).alias("Avg_Interest_Rate"),
        F.bround(F.avg(amount), digits).alias("Avg_Loan_Amount")
    ).orderBy(F.desc("Default_Rate"), group)


def group_default_rates(df: DataFrame, target: str, group: str = "grade") -> DataFrame:
    """Loans, bads and bad rate per group, riskiest first."""
    grouped, y = _group_base(df, group, target)
    return grouped.agg(F.count(y).alias("total_loans"), F.sum(y).alias("defaults"),
                       F.avg(y).alias("default_rate")).orderBy(F.desc("default_rate"), group)


def class_crosstab(df: DataFrame, target: str, group: str = "grade") -> DataFrame:
    """Row percentages of good and bad per group, 0 where a class is absent."""
    grouped, y = _group_base(df, group, target)
    rows = F.count_if(y.isNotNull())
    return grouped.agg(
        F.count_if(y == 0).alias("good_count"), F.count_if(y == 1).alias("bad_count"),
        (F.try_divide(F.count_if(y == 0), rows) * 100).alias("good_pct"),
        (F.try_divide(F.count_if(y == 1), rows) * 100).alias("bad_pct")).orderBy(group)


def describe_by_class(df: DataFrame, target: str, variables: Sequence[str] = PROFILED_NUMBERS,
                      **options) -> DataFrame:
    """Mean, median and standard deviation of goods and bads, and their difference (A10).

    The result has three rows per variable.
    """
    names = present(df, variables)
    y = F.col(target)
    cells = {(c, k): F.when(y == k, as_number(F.col(c))) for c in names for k in (0, 1)}
    moments = scalars(df, {(c, k, label): f(x) for (c, k), x in cells.items()
                           for label, f in (("mean", F.avg), ("std", F.stddev_samp))})
    medians = exact_quantiles(df, {f"{c}\t{k}": x for (c, k), x in cells.items()}, [0.5], **options)
    rows = []
    for c in names:
        stats = {"mean": [moments[c, k, "mean"] for k in (0, 1)],
                 "median": [(medians[f"{c}\t{k}"] or [None])[0] for k in (0, 1)],
                 "std": [moments[c, k, "std"] for k in (0, 1)]}
        rows += [(c, s, good, bad, None if good is None or bad is None else bad - good)
                 for s, (good, bad) in stats.items()]
    return df.sparkSession.createDataFrame(
        rows, "variable string, statistic string, good double, bad double, difference double")


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlations of all ordered pairs, diagonal included, as rows ``var1, var2, corr``.

    Each pair uses the rows where both values are present; null where one of them is constant there
    (A11). However many columns there are, they are scanned once.
    """
    return correlations(df, columns).select("var1", "var2", "corr")


def correlation_with_target(matrix: DataFrame, target: str, top: int = 15) -> DataFrame:
    """The ``top`` absolute correlations with the target, itself left out."""
    return (matrix.where((F.col("var1") == target) & (F.col("var2") != target))
            .select(F.col("var2").alias("variable"), F.abs("corr").alias("abs_corr"))
            .where(F.col("abs_corr").isNotNull())
            .orderBy(F.desc("abs_corr"), "variable").limit(top))


def high_correlation_pairs(matrix: DataFrame, columns: Sequence[str], limit: float = 0.8) -> DataFrame:
    """Pairs in column order whose absolute correlation exceeds ``limit``."""
    place = {c: i for i, c in enumerate(columns)}
    order = F.create_map(*[F.lit(v) for item in place.items() for v in item])
    return matrix.where((order[F.col("var1")] < order[F.col("var2")]) & (F.abs("corr") > limit))


def class_histograms(df: DataFrame, target: str, variables: Sequence[str] = PROFILED_NUMBERS,
                     bins: int = 50) -> DataFrame:
    """Density histograms of goods and bads, each over its own range.

    The class ranges are one small aggregate; bins are then counted map-side. An edge value
    belongs to the bin above, the maximum to the last one. The quotient that places a value may
    round across an edge, so it is checked against the edges themselves. A class with a single
    value gets a unit-wide range around it.
    """
    names = present(df, variables)
    y = F.col(target)
    ends = scalars(df, {(c, k, label): f(F.when(y == k, as_number(F.col(c))))
                        for c in names for k in (0, 1)
                        for label, f in (("lo", F.min), ("hi", F.max), ("n", F.count))})
    ranges = {}
    for c in names:
        for k in (0, 1):
            low, high, n = (ends[c, k, label] for label in ("lo", "hi", "n"))
            if n:
                ranges[c, k] = (low - 0.5, high + 0.5, n) if low == high else (low, high, n)
    parts = [_histogram_counts(df, y, c, ranges, bins) for c in names]
    frame = df.sparkSession.createDataFrame(
        [(c, k, b, low + (high - low) / bins * b, low + (high - low) / bins * (b + 1),
          n * ((high - low) / bins))
         for (c, k), (low, high, n) in ranges.items() for b in range(bins)],
        "variable string, class int, bin long, lo double, hi double, area double")
    return (frame.join(F.broadcast(union_all(parts)), ["variable", "class", "bin"], "left")
            .select("variable", "class", "bin", "lo", "hi", F.coalesce("n", F.lit(0)).alias("n"),
                    (F.coalesce("n", F.lit(0)) / F.col("area")).alias("density")))


def _histogram_counts(df, y, name, ranges, bins):
    """Rows per class and bin of one variable: a scan of two columns, at most 2 x bins groups."""
    def by_class(pick):
        return F.coalesce(*[F.when(F.col("class") == k, F.lit(pick(*ranges[name, k][:2])))
                            for k in (0, 1) if (name, k) in ranges], F.lit(None).cast("double"))

    placed = (df.select(y.cast("int").alias("class"), as_number(F.col(name)).alias("x"))
              .where(F.col("x").isNotNull() & F.col("class").isin(0, 1))
              .select("class", "x", by_class(lambda low, high: low).alias("low"),
                      by_class(lambda low, high: high - low).alias("span"))
              .withColumn("width", F.col("span") / bins)
              .withColumn("guess", F.least(
                  F.floor((F.col("x") - F.col("low")) / F.col("span") * bins), F.lit(bins - 1))))
    edge = lambda k: F.col("low") + k * F.col("width")
    guess = F.col("guess")
    exact = (F.when(F.col("x") < edge(guess), guess - 1)
             .when((F.col("x") >= edge(guess + 1)) & (guess < bins - 1), guess + 1).otherwise(guess))
    return (placed.groupBy("class", exact.cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(name).alias("variable"), "class", "bin", "n"))


def group_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float],
                    accuracy: int = GROUP_ACCURACY) -> DataFrame:
    """The keys, ``n`` and ``quantiles`` (exact, linearly interpolated) of each group.

    A sketch of each group brackets the wanted ranks; the rows inside a bracket, a few in ten thousand
    of a large group, are counted by value and ranked. However many groups there are, the data is read twice, and however
    large one is, no task holds more of it than a bracket.
    """
    keys, reach = list(keys), 4.0 / accuracy
    x = F.col(value)
    ends = [f for q in probs for f in (max(q - reach, 0.0), min(q + reach, 1.0))]
    sketched = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min(x).alias("lo"), F.max(x).alias("hi"),
        F.percentile_approx(x, F.array(*[F.lit(e) for e in ends]), accuracy).alias("q"))
    spot = lambda q: F.lit(float(q)) * (F.col("n") - 1)
    few = F.col("n") <= accuracy  # a bracket would be narrower than two ranks; all of the group is
    bracket = [F.struct(
        F.lit(i).alias("p"), F.when(few | F.lit(ends[2 * i] <= 0), F.col("lo")).otherwise(F.col("q")[2 * i]).alias("low"),
        F.when(few | F.lit(ends[2 * i + 1] >= 1), F.col("hi")).otherwise(F.col("q")[2 * i + 1]).alias("high"),
        F.floor(spot(q)).alias("rank"), (spot(q) - F.floor(spot(q))).alias("part")) for i, q in enumerate(probs)]
    brackets = stage(sketched.select(*keys, "n", F.array(*bracket).alias("brackets")), "group-brackets")
    # A value under a bracket counts as one row without a value; one above it is left out.
    seen = F.transform(F.filter("brackets", lambda b: F.col(value) <= b["high"]), lambda b: F.struct(
        b["p"].alias("p"), F.when(F.col(value) >= b["low"], F.col(value)).alias("v")))
    counted = (df.join(brackets, keys).select(*keys, F.inline(seen))
               .groupBy(*keys, "p", "v").agg(F.count(F.lit(1)).alias("m")))
    through = F.sum("m").over(Window.partitionBy(*keys, "p").orderBy(F.col("v").asc_nulls_first())
                              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranks = brackets.select(*keys, "n", F.inline("brackets")).select(*keys, "n", "p", "rank", "part")
    at = lambda rank: F.max(F.when((F.col("t") > rank) & (F.col("t") - F.col("m") <= rank), F.col("v")))
    found = (counted.withColumn("t", through).join(ranks, [*keys, "p"])
             .groupBy(*keys, "n", "p", "part").agg(
                 at(F.col("rank")).alias("a"), at(F.least(F.col("rank") + 1, F.col("n") - 1)).alias("b"))
             .withColumn("v", F.when((F.col("part") == 0) | (F.col("a") == F.col("b")), F.col("a"))
                         .otherwise((1 - F.col("part")) * F.col("a") + F.col("part") * F.col("b"))))
    return found.groupBy(*keys, "n").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("p", "v"))), lambda s: s["v"]).alias("quantiles"))


def box_summary(df: DataFrame, target: str, value: str = "int_rate", group: str = "grade") -> DataFrame:
    """Quartiles, whiskers within 1.5 interquartile ranges, and outliers per group and class."""
    rows = (df.select(F.col(group), F.col(target).cast("int").alias("class"), as_number(F.col(value)).alias("x"))
            .where(F.col(group).isNotNull() & F.col("class").isNotNull() & F.col("x").isNotNull()))
    quartiles = group_quantiles(rows, [group, "class"], "x", [0.25, 0.5, 0.75])
    fences = quartiles.select(
        group, "class", "n", *[F.col("quantiles")[i].alias(c) for i, c in enumerate(("q1", "median", "q3"))])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    fences = fences.withColumns({"fence_lo": F.col("q1") - reach, "fence_hi": F.col("q3") + reach})
    inside = (F.col("x") >= F.col("fence_lo")) & (F.col("x") <= F.col("fence_hi"))
    return (rows.join(fences, [group, "class"])
            .groupBy(group, "class", "n", "q1", "median", "q3")
            .agg(F.min(F.when(inside, F.col("x"))).alias("whisker_lo"),
                 F.max(F.when(inside, F.col("x"))).alias("whisker_hi"),
                 F.count_if(~inside).alias("outliers"))
            .orderBy(group, "class"))
