import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scoremill.operators import binning
from scoremill.operators import woe as weight
from scoremill.operators.binning import Bins, few_distinct, fit_bins, quantile_edges


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema).repartition(3)


def table(df, bins, target="y"):
    return weight.collected(weight.woe_table(df, bins, target))


def test_intervals_are_right_closed_with_ties_on_edges(spark):
    df = frame(spark, [(float(x), x % 2) for x in range(1, 21)] + [(10.0, 1), (None, 1)], "x double, y int")
    bins = Bins("x", "interval", (5.0, 10.0))
    rows = table(df, [bins])
    counted = {(r["lo"], r["hi"]): round(r["good_count"] + r["bad_count"], 3) for r in rows}
    assert counted == {(-math.inf, 5.0): 5.0, (5.0, 10.0): 6.0, (10.0, math.inf): 10.0}
    assert [r["bin"] for r in rows] == ["(-inf, 5.0]", "(5.0, 10.0]", "(10.0, inf]"]


def test_few_values_stay_values_and_duplicate_edges_drop(spark):
    df = frame(spark, [(float(i % 10), float(i % 11), float(max(0, i - 80)), i % 2) for i in range(110)],
               "ten double, eleven double, mostly_zero double, y int")
    bins = {b.feature: b for b in fit_bins(df, ["ten", "eleven", "mostly_zero"], [])}
    assert bins["ten"].kind == "value" and bins["eleven"].kind == "interval"
    assert bins["mostly_zero"].cuts == tuple(sorted(set(bins["mostly_zero"].cuts)))
    assert len(bins["mostly_zero"].cuts) < 9
    assert len(table(df, [bins["ten"]])) == 10


def test_edge_methods(spark):
    df = frame(spark, [(float(i),) for i in range(101)], "x double")
    assert quantile_edges(df, ["x"])["x"] == pytest.approx([10.0 * k for k in range(11)])
    assert quantile_edges(df, ["x"], 4, "equal_width")["x"] == [0.0, 25.0, 50.0, 75.0, 100.0]
    with pytest.raises(ValueError):
        quantile_edges(df, ["x"], method="other")


def test_weights_match_the_formula_with_a_zero_cell(spark):
    df = frame(spark, [("a", 0)] * 30 + [("a", 1)] * 10 + [("b", 0)] * 5 + [(None, 1)] * 9, "c string, y int")
    rows = {r["category"]: r for r in table(df, [Bins("c", "category")])}
    good, bad = {"a": 30.0001, "b": 5.0001}, {"a": 10.0001, "b": 0.0001}
    for c in "ab":
        share_good, share_bad = good[c] / sum(good.values()), bad[c] / sum(bad.values())
        assert rows[c]["woe"] == pytest.approx(math.log(share_good / share_bad))
        assert rows[c]["iv"] == pytest.approx((share_good - share_bad) * math.log(share_good / share_bad))
    assert set(rows) == {"a", "b"}


def test_properties_hold_for_every_feature(spark):
    df = frame(spark, [(float(i * 7 % 101), f"k{i % 30}", 1.0, int(i % 3 == 0)) for i in range(500)],
               "x double, c string, constant double, y int")
    bins = fit_bins(df, ["x", "constant"], ["c"])
    rows = table(df, bins)
    for f in ("x", "c", "constant"):
        own = [r for r in rows if r["feature"] == f]
        assert sum(r["good_rate"] for r in own) == pytest.approx(1)
        assert sum(r["bad_rate"] for r in own) == pytest.approx(1)
        assert all(r["iv"] >= 0 for r in own)
    iv = {r["feature"]: r["iv"] for r in weight.iv_table(weight.woe_frame(spark, rows)).collect()}
    assert iv["constant"] == 0.0 and iv["x"] > 0


def test_one_class_only_still_gives_finite_weights(spark):
    df = frame(spark, [("a", 0), ("b", 0)], "c string, y int")
    assert all(math.isfinite(r["woe"]) for r in table(df, [Bins("c", "category")]))


def test_cardinality_guard_is_exact_at_the_limit(spark):
    df = frame(spark, [(f"v{i % 100}", f"v{i % 101}", f"v{i % 5000}") for i in range(5000)],
               "at string, over string, far string")
    assert few_distinct(df, {"at": 100, "over": 100, "far": 100}) == {"at": True, "over": False, "far": False}
    assert [b.feature for b in fit_bins(df, [], ["at", "over", "far"])] == ["at"]


def test_power_labels_and_selection(spark):
    ivs = [0.0, 0.0199, 0.02, 0.0999, 0.1, 0.2999, 0.3, 0.4999, 0.5, 3.0]
    df = spark.createDataFrame([(f"f{i}", v) for i, v in enumerate(ivs)], "feature string, iv double")
    labels = [r["p"] for r in df.orderBy("feature").select(weight.power_label(F.col("iv")).alias("p")).collect()]
    assert labels == ["Not useful"] * 2 + ["Weak"] * 2 + ["Medium"] * 2 + ["Strong"] * 2 + ["Suspicious"] * 2
    assert [r["feature"] for r in weight.select_features(df).collect()] == ["f7", "f6", "f5", "f4", "f3", "f2"]
    assert weight.selected_names(df.collect()) == ["f7", "f6", "f5", "f4", "f3", "f2"]


@pytest.mark.parametrize("size", [3, 40])
def test_category_lookup_inline_and_joined_agree(spark, size):
    df = frame(spark, [(i, f"c{i % size}", int(i % 7 == 0)) for i in range(400)], "id int, c string, y int")
    bins = [Bins("c", "category")]
    rows = table(df, bins)
    known = {r["category"]: r["woe"] for r in rows}
    new = frame(spark, [(1, "c0"), (2, "unseen"), (3, None)], "id int, c string")
    found = {r["id"]: r["c_woe"] for r in weight.add_weights(new, bins, rows).collect()}
    assert found == {1: known["c0"], 2: 0.0, 3: 0.0}


def test_transform_reads_nan_and_null_as_missing(spark):
    df = frame(spark, [(float(i), i % 2) for i in range(50)], "x double, y int")
    bins = fit_bins(df, ["x"], [])
    rows = table(df, bins)
    new = frame(spark, [(1, float("nan")), (2, None), (3, 1e9), (4, -1e9)], "id int, x double")
    found = {r["id"]: r["x_woe"] for r in weight.add_weights(new, bins, rows).collect()}
    assert found[1] == found[2] == 0.0
    assert found[3] == rows[-1]["woe"] and found[4] == rows[0]["woe"]
    assert table(df.unionByName(df.select(F.lit(float("nan")).alias("x"), "y")), bins) == rows


def test_sketch_counts_nan_as_missing(spark):
    df = frame(spark, [(float("nan"),), (1.0,), (None,)], "x double")
    sketch = binning.sketch_columns(df, ["x"])
    assert (sketch.rows, sketch.present["x"], sketch.distinct["x"]) == (3, 1, 1)


@pytest.mark.parametrize("seed", range(4))
def test_bins_and_weights_equal_pandas_cuts(spark, seed):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"spread": rng.normal(0, 50, 700).round(seed), "steps": rng.integers(0, 13, 700) / 4,
                        "skewed": np.where(rng.random(700) < 0.6, 0.0, rng.exponential(9, 700).round(1)),
                        "y": (rng.random(700) < 0.3).astype(int)})
    df = spark.createDataFrame(pdf).repartition(4)
    names = ["spread", "steps", "skewed"]
    rows = table(df, fit_bins(df, names, []))
    for name in names:
        edges = np.unique(pd.qcut(pdf[name], 10, retbins=True, duplicates="drop")[1])
        edges[0], edges[-1] = -np.inf, np.inf
        counts = pd.crosstab(pd.cut(pdf[name], edges), pdf["y"]) + 0.0001
        share = counts / counts.sum()
        woe = np.log(share[0] / share[1])
        own = [r for r in rows if r["feature"] == name]
        assert [r["good_count"] for r in own] == list(counts[0])
        assert [r["woe"] for r in own] == pytest.approx(list(woe))
        assert sum(r["iv"] for r in own) == pytest.approx(((share[0] - share[1]) * woe).sum())
