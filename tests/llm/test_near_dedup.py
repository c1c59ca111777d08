import random
import re
from collections import defaultdict

from scoremill.llm import near_dedup
from scoremill.llm.components import components
from scoremill.llm.near_dedup import near_duplicates
from scoremill.llm.registered import op4_near_dedup
from scoremill_checks.compare import duck

from .conftest import AWKWARD

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 85 * (len(sets[i]) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    least = defaultdict(lambda: None)
    for i, (doc, _) in enumerate(rows):
        known = [x for x in (least[find(i)], doc) if x is not None]
        least[find(i)] = min(known) if known else None
    return sorted(str((doc, len(s), least[find(i)], doc == least[find(i)]))
                  for i, ((doc, _), s) in enumerate(zip(rows, sets)))


def answer(frame):
    return sorted(str(tuple(r)) for r in frame.collect())


def test_awkward_texts(awkward, empty):
    assert answer(near_duplicates(awkward)) == brute(AWKWARD)
    assert near_duplicates(empty).collect() == []


def near_copies(seed, copies, size, edits, shared=0):
    """Groups of near copies, chains, and texts that share a passage but are not alike."""
    pick = random.Random(seed)
    word = lambda: "w%d" % pick.randint(0, 400)
    passage = [word() for _ in range(shared)]
    base = [word() for _ in range(size)]
    rows = []
    for i in range(copies):
        words = list(base)
        for _ in range(pick.randint(0, edits)):
            words[pick.randrange(size)] = word()
        rows.append((i, " ".join(words)))
    for i in range(copies, 2 * copies):
        rows.append((i, " ".join([word() for _ in range(size // 3)] + passage + [word() for _ in range(size // 3)])))
    pick.shuffle(rows)
    return rows


def test_near_copies_equal_brute_force(spark):
    rows = near_copies(1, 60, 150, 4, 60)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert answer(near_duplicates(docs)) == brute(rows)


def test_long_lists_and_groups_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "LIST_BLOCK", 16)
    monkeypatch.setattr(near_dedup, "SET_BLOCK", 8)
    rows = near_copies(2, 90, 120, 6, 90)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert answer(near_duplicates(docs)) == brute(rows)


def test_components(spark):
    pick = random.Random(4)
    edges = [(pick.randint(0, 300), pick.randint(0, 300)) for _ in range(150)] + [(i, i + 1) for i in range(400, 460)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {(x, find(x)) for x in parent if x != find(x)}
    got = components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert {tuple(r) for r in got} == want


def test_query_equals_brute_force(spark):
    rows = duck(SF).execute("SELECT doc_id, text FROM documents").fetchall()
    assert answer(op4_near_dedup(spark, SF)) == brute(rows)


def test_tasks_hand_few_rows_to_python_at_once(spark, monkeypatch):
    name, seen, signatures = "spark.sql.execution.arrow.maxRecordsPerBatch", [], near_dedup.signatures
    before = spark.conf.get(name)
    monkeypatch.setattr(near_dedup, "signatures", lambda *a: seen.append(spark.conf.get(name)) or signatures(*a))
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "A b c d e f"), (3, None)], "doc_id long, text string")
    found = near_dedup.near_duplicates(docs)
    assert seen == [str(near_dedup.ARROW_ROWS)] and spark.conf.get(name) == before
    assert sorted((r["doc_id"], r["component_id"]) for r in found.collect()) == [(1, 1), (2, 1), (3, 3)]
