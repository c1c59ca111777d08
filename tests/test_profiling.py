import numpy as np
import pytest
from pyspark.sql import functions as F

from scoremill.operators import profiling


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(9)
    n = 3000
    a = rng.normal(1e6, 5, n)
    columns = {"a": a, "b": -2 * a + rng.normal(0, 1, n), "c": rng.exponential(1, n), "k": np.full(n, 3.3)}
    rows = [(int(i % 4 == 0), "ABC"[i % 3], *(None if (i + j) % 11 == 0 else float(v[i])
                                            for j, v in enumerate(columns.values()))) for i in range(n)]
    return spark.createDataFrame(rows, "y int, grade string, a double, b double, c double, k double").repartition(5)


def test_the_number_of_columns_does_not_change_a_correlation(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 50 == 0, F.col("id").cast("double")).alias("a"),
        F.when(F.col("id") % 50 == 0, 1e6 + 0.1 * F.col("id")).otherwise(0.0).alias("b"),
        *[(F.col("id") % (i + 2)).cast("double").alias(f"c{i}") for i in range(18)])
    for names in (["a", "b"], df.columns):
        found = profiling.correlation_matrix(df, names).where("var1 = 'a' AND var2 = 'b'").first()
        assert found["corr"] == pytest.approx(1.0)


def test_correlations_are_pairwise_complete_and_null_for_constants(frame):
    names = ["a", "b", "c", "k", "y"]
    found = {(r["var1"], r["var2"]): r["corr"] for r in profiling.correlation_matrix(frame, names).collect()}
    expected = frame.select(*names).toPandas().corr()
    assert len(found) == 25
    for i in names:
        for j in names:
            if "k" in (i, j):
                assert found[i, j] is None
            else:
                assert found[i, j] == pytest.approx(expected.loc[i, j], abs=1e-9)


def test_pairs_and_target_correlations(frame):
    matrix = profiling.correlation_matrix(frame, ["a", "b", "c", "y"])
    pairs = profiling.high_correlation_pairs(matrix, ["a", "b", "c", "y"]).collect()
    assert [(r["var1"], r["var2"]) for r in pairs] == [("a", "b")]
    ranked = profiling.correlation_with_target(matrix, "y", 2).collect()
    assert len(ranked) == 2 and ranked[0]["abs_corr"] >= ranked[1]["abs_corr"]


def test_histograms_equal_numpy(frame):
    rows = profiling.class_histograms(frame, "y", ["a", "c"]).collect()
    pdf = frame.toPandas()
    for c in ("a", "c"):
        for k in (0, 1):
            values = pdf.loc[pdf.y == k, c].dropna()
            counts, edges = np.histogram(values, bins=50)
            own = sorted((r for r in rows if r["variable"] == c and r["class"] == k), key=lambda r: r["bin"])
            assert [r["n"] for r in own] == list(counts)
            np.testing.assert_allclose([r["lo"] for r in own], edges[:-1])
            assert sum(r["density"] * (r["hi"] - r["lo"]) for r in own) == pytest.approx(1)


def test_histogram_of_a_constant(frame):
    rows = profiling.class_histograms(frame, "y", ["k"]).collect()
    assert {(r["class"], r["bin"]) for r in rows if r["n"]} == {(0, 25), (1, 25)}


@pytest.mark.parametrize("options", [{}, {"buffer_values": 0}])
def test_describe_and_box(frame, options):
    pdf = frame.toPandas()
    rows = {(r["variable"], r["statistic"]): r for r in
            profiling.describe_by_class(frame, "y", ["a", "c", "absent"], **options).collect()}
    assert len(rows) == 6
    good, bad = pdf[pdf.y == 0]["c"], pdf[pdf.y == 1]["c"]
    assert rows["c", "median"]["good"] == pytest.approx(good.median())
    assert rows["c", "std"]["bad"] == pytest.approx(bad.std())
    assert rows["c", "mean"]["difference"] == pytest.approx(bad.mean() - good.mean())
    for r in profiling.box_summary(frame, "y", "c").collect():
        x = pdf[(pdf.grade == r["grade"]) & (pdf.y == r["class"])]["c"].dropna()
        q1, q3 = x.quantile(0.25), x.quantile(0.75)
        inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
        assert (r["whisker_lo"], r["whisker_hi"], r["outliers"], r["n"]) == (
            inside.min(), inside.max(), len(x) - len(inside), len(x))


def test_rates_skip_missing_keys_and_keep_the_worst(spark):
    df = spark.createDataFrame([(f"P{i % 15:02d}", int(i % 15 > 7), None) for i in range(150)],
                               "purpose string, y int, grade string")
    rows = profiling.default_rate_by_category(df, "y").collect()
    assert [r["value"] for r in rows] == [f"P{i:02d}" for i in range(8, 15)] + ["P00", "P01", "P02"]
    assert profiling.default_rate_by_category(df, "y", top=None).count() == 15
    crosstab = profiling.class_crosstab(df, "y", "purpose").first()
    assert (crosstab["good_pct"], crosstab["bad_pct"]) == (100.0, 0.0)


@pytest.mark.parametrize("accuracy", [20, 100, 10_000])
def test_quantiles_of_groups_equal_the_exact_ones(spark, accuracy):
    df = spark.range(3000).select(
        F.when(F.col("id") % 7 == 0, "few").when(F.col("id") == 1, "one").otherwise("many").alias("g"),
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.pmod(F.hash("id"), F.lit(997)) / 7).alias("x")).repartition(4)
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    found = {r["g"]: (r["n"], r["quantiles"]) for r in profiling.group_quantiles(df, ["g"], "x", probs, accuracy).collect()}
    for g, x in df.toPandas().groupby("g")["x"]:
        assert found[g][0] == len(x)
        assert found[g][1] == pytest.approx([x.quantile(p) for p in probs])
