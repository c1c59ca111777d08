import hashlib
from collections import defaultdict

from scoremill.llm.exact_dedup import ORACLE_SQL, exact_duplicates
from scoremill.llm.registered import op10_exact_dedup
from scoremill_checks.compare import difference, duck

from .conftest import AWKWARD

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(map(str, out))


def test_awkward_texts(awkward, empty):
    rows = exact_duplicates(awkward).collect()
    assert sorted(str(tuple(r)) for r in rows) == brute(AWKWARD)
    assert exact_duplicates(empty).collect() == []


def test_frequent_and_rare_groups(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"É{i // 4}") for i in range(600)] + [(9999, "HOT"), (700, "é1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for support in (0.5, 0.01):
        got = sorted(str(tuple(r)) for r in exact_duplicates(docs, support=support).collect())
        assert got == brute(rows)


def test_query_equals_its_sql(spark):
    assert difference(op10_exact_dedup(spark, SF), duck(SF).execute(ORACLE_SQL).to_arrow_table()) is None


def test_no_python_in_the_plan(spark):
    plan = op10_exact_dedup(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
