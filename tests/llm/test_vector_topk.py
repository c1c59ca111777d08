import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoremill.llm.best import Best
from scoremill.llm.registered import op12_vector_topk
from scoremill.llm.vector_topk import ORACLE_SQL, Side, search, top_k
from scoremill_checks.compare import difference, duck

SF = "/root/testdata/sf0.001"


def brute(rows, is_query, k=5, scale=256.0):
    good = [(i, key, [math.floor(scale * x) for x in v]) for i, (key, v) in enumerate(rows)
            if key is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, key, v in good:
        if is_query(key):
            scored = [(-max(min(sum(a * b for a, b in zip(v, w)), 2 ** 63 - 1), 1 - 2 ** 63), other)
                      for j, other, w in good if i != j]
            out += [(key, rank, other, -s) for rank, (s, other) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def answer(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, rows, kind="double"):
    return spark.createDataFrame([(k, v, 7, 1, "x") for k, v in rows],
                                 f"vec_id long, embedding array<{kind}>, row long, key int, body string")


AWKWARD = [(50, [0.5, 0.25, 0.1]), (1, [0.5, 0.25, 0.1]), (2, None), (3, [0.5, None, 1.0]), (4, [float("nan"), 0.0, 0.0]),
           (5, [float("inf"), 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (6, [0.5, 0.25, 0.1]), (6, [0.5, 0.25, 0.1]), (0, [-1.0, 0.0, 3.0]),
           (7, []), (8, [1.0]), (9, [1.0, 2.0, 3.0, 4.0, 5.0]), (100, []), (50, [0.5, 0.25, 0.1]), (10, [0.0, 0.0, 0.0]),
           (150, [200.5, -300.25, 1e5]), (11, [1e9, 1e9, -1e9]), (12, [1e200, -1e200, 1.0]), (200, [3e30, 0.0, 0.0]), (13, [-1e9, 1e8])]


@pytest.mark.parametrize("k", [1, 5, 50])
def test_awkward_vectors(spark, k):
    """Nulls, non-finite numbers, repeats, ties, unequal lengths, numbers past floats, clashing names."""
    assert answer(top_k(frame(spark, AWKWARD), lambda i: i % 50 == 0, k=k)) == brute(AWKWARD, lambda i: i % 50 == 0, k)


def test_no_rows_and_no_queries(spark):
    assert answer(top_k(frame(spark, []), lambda i: i % 50 == 0)) == []
    found = top_k(frame(spark, [(1, [1.0]), (2, [1.0])]), lambda i: i % 50 == 0)
    assert answer(found) == [] and found.columns == ["query_id", "rank", "vec_id", "score"]
    assert dict(found.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}


def test_several_cells(spark, monkeypatch):
    """More queries and candidates than one cell takes, some of them in many copies."""
    from scoremill.llm import vector_topk
    for name, value in [("QUERIES", 8), ("CANDIDATES", 40), ("FEWEST", 10), ("STEP", 16), ("AT_ONCE", 4)]:
        monkeypatch.setattr(vector_topk, name, value)
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(240, 20))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    vectors[80:160] = vectors[80]
    rows = [(int(k), v.tolist()) for k, v in zip(rng.permutation(240), vectors)]
    assert answer(top_k(frame(spark, rows), lambda i: i % 7 == 0)) == brute(rows, lambda i: i % 7 == 0)


@pytest.mark.parametrize("scale", [1, 300, 1e5])
def test_bounds_drop_pairs_and_lose_none(scale):
    """Near neighbours with most of their mass in the first dimensions: few pairs are summed to the end."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(50, 64)) * np.linspace(3, 0.1, 64)
    vectors = np.floor((centres[rng.integers(0, 50, 3000)] + rng.normal(size=(3000, 64)) * 0.02) * scale)
    keys = rng.permutation(3000)
    queries, candidates = Side(np.arange(60), keys[:60], vectors[:60]), Side(np.arange(3000), keys, vectors)
    counts = {"dense": 0, "compacted": 0}
    best = search(queries, candidates, 5, counts=counts)
    exact = queries.vectors @ candidates.vectors.T
    exact[queries.rows[:, None] == candidates.rows[None, :]] = -np.inf
    for i in range(60):
        order = np.lexsort((candidates.keys, -exact[i]))[:5]
        assert best.scores[i].tolist() == exact[i][order].astype(int).tolist() and best.keys[i].tolist() == candidates.keys[order].tolist()
    if scale > 1:
        assert counts["dense"] + counts["compacted"] < 0.4 * 8 * exact.size


def test_best_of_many():
    rng = np.random.default_rng(3)
    owner, score, key = rng.integers(0, 9, 3000), rng.integers(-5, 6, 3000), rng.integers(0, 500, 3000)
    best = Best(9, 4)
    for part in np.array_split(np.arange(3000), 13):
        best.merge(owner[part], score[part], key[part])
    for i in range(9):
        want = sorted(zip(-score[owner == i], key[owner == i]))[:4]
        assert list(zip(-best.scores[i], best.keys[i])) == want


def test_query_equals_its_sql(spark):
    assert difference(op12_vector_topk(spark, SF), duck(SF).sql(ORACLE_SQL).to_arrow_table()) is None


def test_floats_become_doubles_first(spark):
    rows = [(50, [0.1, 0.2]), (1, [0.3, 0.7]), (2, [-0.1, 0.9])]
    exact = [(k, [float(np.float32(x)) for x in v]) for k, v in rows]
    found = top_k(frame(spark, rows, "float").withColumn("more", F.lit(1)), lambda i: i % 50 == 0)
    assert answer(found) == brute(exact, lambda i: i % 50 == 0)
