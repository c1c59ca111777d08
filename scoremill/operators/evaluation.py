"""Ranking and calibration metrics of scored rows, exact and distributed, for any number of models and segments at once.

Rows are collapsed to one row per distinct score of each key, which is written once: whatever it took to score a
row is not done again. Where there are many, distinct scores are dealt by ranges of key and score into buckets, as many
as keep a bucket small; running counts are taken inside each bucket, and the bucket totals supply the offsets. No
window ever spans the whole table, and a key that holds most of the rows is spread over as many buckets as it fills.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoremill.functions.expressions import as_number
from scoremill.sources.staging import stage, stage_observed
from scoremill.spec import (
    AUC_THRESHOLD, LIFT_THRESHOLD, RULE_DTI, RULE_GRADES, VERDICT_FORMAT, VERDICT_WORDS)

ROWS_PER_BUCKET = 1_000_000

BASELINE_NAME = "Logistic Regression"


def _counts(df: DataFrame, keys: Sequence[str], score: str, y: Column) -> DataFrame:
    """``keys, score, n0, n1`` of scored rows."""
    return (df.select(*keys, as_number(F.col(score)).alias("score"), y.alias("y"))
            .where("score IS NOT NULL AND y IS NOT NULL").groupBy(*keys, "score")
            .agg(F.count_if(F.col("y") == 0).alias("n0"), F.count_if(F.col("y") == 1).alias("n1")))


def _bucketed(counts: DataFrame, keys: Sequence[str], rows_per_bucket: int | None) -> tuple[DataFrame, bool]:
    """The counts with their ``bucket``, written; and whether there are several buckets.

    The number of distinct scores is observed while they are written, so it costs no scan.
    """
    distinct, seen = stage_observed(counts, "scores", {"rows": F.count(F.lit(1))})
    wanted = seen["rows"] // (rows_per_bucket or ROWS_PER_BUCKET) + 1
    if wanted == 1:
        return distinct.withColumn("bucket", F.lit(0)), False
    dealt = distinct.repartitionByRange(wanted, *keys, "score").withColumn("bucket", F.spark_partition_id())
    return stage(dealt, "score-buckets"), True


def _ranked(counts: DataFrame, keys: Sequence[str], rows_per_bucket: int | None) -> DataFrame:
    """Each key's distinct scores with ``c0, c1`` (goods and bads up to the score), ``t0, t1`` (of the key) and
    ``below`` (the counts of the next lower score)."""
    distinct, many = _bucketed(counts, keys, rows_per_bucket)
    whole = Window.partitionBy(*keys, "bucket")
    ordered = whole.orderBy("score")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = distinct.select(
        *keys, "bucket", "score", "n0", "n1", F.sum("n0").over(so_far).alias("c0"), F.sum("n1").over(so_far).alias("c1"),
        F.lag(F.struct("n0", "n1")).over(ordered).alias("below"),
        *([] if many else [F.sum("n0").over(whole).alias("t0"), F.sum("n1").over(whole).alias("t1")]))
    if not many:
        return local
    # A row per key and bucket from here on.
    totals = distinct.groupBy(*keys, "bucket").agg(
        F.sum("n0").alias("s0"), F.sum("n1").alias("s1"), F.max_by(F.struct("n0", "n1"), "score").alias("last"))
    of_key = Window.partitionBy(*keys, F.lit(0))
    before = of_key.orderBy("bucket")
    earlier = before.rowsBetween(Window.unboundedPreceding, -1)
    marks = [F.col(k).alias(f"__{k}") for k in keys]
    offsets = totals.select(
        *marks, F.col("bucket").alias("__bucket"), F.coalesce(F.sum("s0").over(earlier), F.lit(0)).alias("b0"),
        F.coalesce(F.sum("s1").over(earlier), F.lit(0)).alias("b1"), F.lag("last").over(before).alias("last"),
        F.sum("s0").over(of_key).alias("t0"), F.sum("s1").over(of_key).alias("t1"))
    same = F.col("bucket") == F.col("__bucket")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return local.join(offsets, same).select(
        *keys, "score", "n0", "n1", (F.col("c0") + F.col("b0")).alias("c0"), (F.col("c1") + F.col("b1")).alias("c1"),
        F.coalesce("below", "last").alias("below"), "t0", "t1")


def metrics_by(df: DataFrame, keys: Sequence[str], score: str = "score", target: str = "default_status",
               positives: Column | None = None, rows_per_bucket: int | None = None) -> DataFrame:
    """``n, n_bad, auc, gini, ks, brier`` of every key (E1-E4); null where a class is empty.

    AUC counts ties half. However many keys there are, rows are scored and collapsed once.
    """
    return metrics_of_counts(_counts(df, keys, score, F.col(target) if positives is None else positives), keys, rows_per_bucket)


def metrics_of_counts(counts: DataFrame, keys: Sequence[str], rows_per_bucket: int | None = None) -> DataFrame:
    """The same from ``keys, score, n0, n1``: the goods and bads of each key's distinct scores."""
    ranked = _ranked(counts, keys, rows_per_bucket)
    p, both = F.col("score"), F.col("t0") * F.col("t1") > 0
    t0, t1 = F.col("t0").cast("double"), F.col("t1").cast("double")
    # Bad scores beaten: goods strictly below plus half of the ties.
    wins = F.col("n1") * (F.col("c0") - F.col("n0") / 2.0)
    gap = F.abs(F.try_divide(F.col("c0"), t0) - F.try_divide(F.col("c1"), t1))
    found = ranked.groupBy(*keys).agg(
        F.coalesce(F.sum(F.col("n0") + F.col("n1")), F.lit(0)).alias("n"), F.coalesce(F.sum("n1"), F.lit(0)).alias("n_bad"),
        F.sum(F.when(both, wins / (t0 * t1))).alias("auc"), F.max(F.when(both, gap)).alias("ks"),
        F.sum(F.col("n0") * p * p + F.col("n1") * (1 - p) * (1 - p)).alias("error"))
    return found.select(*keys, "n", "n_bad", "auc", (2 * F.col("auc") - 1).alias("gini"), "ks",
                        F.try_divide(F.col("error"), F.col("n")).alias("brier"))


def score_metrics(df: DataFrame, score: str = "score", target: str = "default_status",
                  positives: Column | None = None, rows_per_bucket: int | None = None) -> DataFrame:
    """One row ``n, n_bad, auc, gini, ks, brier`` (E1-E4); null where a class is empty."""
    return metrics_by(df, [], score, target, positives, rows_per_bucket)


def roc_by(df: DataFrame, keys: Sequence[str], score: str = "score", target: str = "default_status",
           drop_collinear: bool = False, rows_per_bucket: int | None = None) -> DataFrame:
    """ROC points ``threshold, fpr, tpr`` of every key from its highest score down, after (0, 0) (E5).

    One point per distinct score. ``drop_collinear`` leaves out points in the middle of a
    straight run, as plotting libraries do. Rates are null for an empty class.
    """
    ranked = _ranked(_counts(df, keys, score, F.col(target)), keys, rows_per_bucket)
    top = (F.col("c0") == F.col("t0")) & (F.col("c1") == F.col("t1"))
    if drop_collinear:
        straight = (F.col("below.n0") == F.col("n0")) & (F.col("below.n1") == F.col("n1")) & ~top
        ranked = ranked.where(~F.coalesce(straight, F.lit(False)))
    rate = lambda k: F.try_divide(F.col(f"t{k}") - F.col(f"c{k}") + F.col(f"n{k}"), F.col(f"t{k}").cast("double"))
    point = F.struct(F.col("score").alias("threshold"), rate(0).alias("fpr"), rate(1).alias("tpr"))
    start = F.struct(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return ranked.select(*keys, F.inline(F.when(top, F.array(start, point)).otherwise(F.array(point))))


def roc_curve(df: DataFrame, score: str = "score", target: str = "default_status",
              drop_collinear: bool = False, rows_per_bucket: int | None = None) -> DataFrame:
    """ROC points of all rows together (E5)."""
    return roc_by(df, [], score, target, drop_collinear, rows_per_bucket)


def by_model_and_segment(df: DataFrame, target: str, scores: Mapping[str, Column], segments: Mapping[str, Column]) -> DataFrame:
    """Rows for ``metrics_by``: ``model, segment, value, score`` and the target, once for every model and every segment
    a row lies in. The segment ``all`` holds every row."""
    pair = lambda names, a, b: F.named_struct(F.lit(names[0]), a, F.lit(names[1]), b)
    of_model = F.array(*[pair(("model", "score"), F.lit(m), s.cast("double")) for m, s in scores.items()])
    inside = F.array(*[pair(("segment", "value"), F.lit(n), v.cast("string"))
                       for n, v in {"all": F.lit(None), **segments}.items()])
    return (df.select(target, F.inline(of_model), inside.alias("__inside"))
            .select(target, "model", "score", F.inline("__inside")))


def gate(metrics: DataFrame, auc_threshold: float = AUC_THRESHOLD,
         lift_threshold: float = LIFT_THRESHOLD) -> DataFrame:
    """Lift over the baseline and the pass flag, from ``primary_auc, baseline_auc``."""
    lift = F.col("primary_auc") - F.col("baseline_auc")
    return metrics.select(
        "*", lift.alias("lift"), F.lit(auc_threshold).alias("threshold"),
        F.lit(lift_threshold).alias("lift_threshold"),
        ((F.col("primary_auc") >= auc_threshold) & (lift >= lift_threshold)).alias("passed"))


def verdict(auc_threshold: float = AUC_THRESHOLD, lift_threshold: float = LIFT_THRESHOLD,
            primary_name: str = "Boosted trees", baseline_name: str = "LR baseline") -> Column:
    """The hypothesis sentence (E8) for a row with ``primary_auc, baseline_auc, lift, passed``."""
    def word(condition: Column) -> Column:
        return F.when(condition, "True").otherwise("False")
    return F.format_string(
        VERDICT_FORMAT.format(primary=primary_name, baseline=baseline_name, lift=lift_threshold),
        F.when(F.col("passed"), VERDICT_WORDS[0]).otherwise(VERDICT_WORDS[1]),
        F.col("primary_auc"), F.col("baseline_auc"), F.col("lift"),
        word(F.col("primary_auc") >= auc_threshold), word(F.col("lift") >= lift_threshold))


def metric_record(metrics: DataFrame, model: str | Column) -> DataFrame:
    """The stored record of one model or, given the column that names it, of each; rounded to six places."""
    return metrics.select(
        (F.lit(model) if isinstance(model, str) else model).alias("model"), F.lit("ROC-AUC").alias("metric_name"),
        F.bround("auc", 6).alias("value"), F.bround("ks", 6).alias("KS"),
        F.bround("brier", 6).alias("Brier"))


def rule_score(grade: str = "grade", dti: str = "dti") -> Column:
    """Policy rule: bad for the weak grades or a high debt ratio (C7). Missing values pass."""
    weak = F.coalesce(F.col(grade).isin(list(RULE_GRADES)), F.lit(False))
    indebted = F.coalesce(F.col(dti) > RULE_DTI, F.lit(False))
    return F.when(weak | indebted, 1.0).otherwise(0.0)


def majority_of(goods: int, bads: int) -> float:
    """The more frequent outcome, the smaller on a tie."""
    return 1.0 if bads > goods else 0.0


def majority_score(train: DataFrame, target: str) -> float:
    """The most frequent outcome of the training rows."""
    row = train.agg(F.count_if(F.col(target) == 1).alias("bad"),
                    F.count_if(F.col(target) == 0).alias("good")).first()
    return majority_of(row["good"], row["bad"])
