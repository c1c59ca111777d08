import numpy as np
import pytest
from pyspark.sql import functions as F

from scoremill.operators import quantiles
from scoremill.operators.quantiles import exact_quantiles, median_values

PROBS = [k / 10 for k in range(11)]


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(1)
    n = 20_000
    hot = np.where(rng.random(n) < 0.34, 7.0, rng.normal(0, 100, n).round(3))
    rows = [(float(a), float(b) if i % 5 else None, int(c), float("nan") if i % 7 == 0 else float(a))
            for i, (a, b, c) in enumerate(zip(hot, rng.exponential(3, n), rng.integers(0, 4, n)))]
    return spark.createDataFrame(rows, "hot double, gaps double, few int, nan double").repartition(7)


def expected(frame, name):
    values = frame.select(name).toPandas()[name].dropna().to_numpy(dtype=float)
    return np.quantile(values, PROBS)


@pytest.mark.parametrize("options", [{}, {"buffer_values": 0}, {"buffer_values": 0, "accuracy": 50},
                                     {"buffer_values": 0, "accuracy": 3}])
def test_equals_a_sort(frame, options):
    names = ["hot", "gaps", "few", "nan"]
    found = exact_quantiles(frame, {c: F.col(c) for c in names}, PROBS, **options)
    for c in names:
        np.testing.assert_allclose(found[c], expected(frame, c), rtol=1e-12, atol=1e-12)


def test_a_missed_rank_is_bracketed_again(frame, monkeypatch):
    """A sketch that points nowhere near the ranks only costs more passes."""
    honest, calls = quantiles._sketch, []

    def misleading(df, numbers, probs, accuracy, reach):
        calls.append(reach)
        brackets, counts = honest(df, numbers, probs, accuracy, reach)
        return ([[[0.1, 0.2]]] * len(brackets) if len(calls) < 3 else brackets), counts

    monkeypatch.setattr(quantiles, "_sketch", misleading)
    found = exact_quantiles(frame, {"hot": F.col("hot")}, PROBS, buffer_values=0)
    assert len(calls) >= 3
    np.testing.assert_allclose(found["hot"], expected(frame, "hot"), rtol=1e-12)


@pytest.mark.parametrize("options", [{}, {"buffer_values": 0}])
def test_edges_of_the_domain(spark, options):
    df = spark.createDataFrame([(None, 5.0, 1.0), (None, None, 1.0)], "none double, one double, same double")
    found = exact_quantiles(df, {c: F.col(c) for c in df.columns}, [0.0, 0.5, 1.0], **options)
    assert found == {"none": None, "one": [5.0] * 3, "same": [1.0] * 3}


def test_median_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert median_values(df, ["x"]) == median_values(df, ["x"], buffer_values=0) == {"x": 2.5}
