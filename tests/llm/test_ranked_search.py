import math
import re
from collections import Counter

import numpy as np
import pytest

from scoremill.llm import ranked_search as ranked
from scoremill.llm.ranked_search import ORACLE_SQL, Asked, Piece, Search, factor, ranked_search, visits
from scoremill.llm.registered import op13_ranked_search
from scoremill_checks.compare import difference, duck

from .conftest import AWKWARD

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, k=10):
    read = [(i, Counter(terms(t))) for i, t in docs]
    read = [(i, c, sum(c.values())) for i, c in read if c]
    n, length = len(read), sum(x[2] for x in read)
    df = Counter(t for _, c, _ in read for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, size in read:
            m = 100 - 90 + (90 * size * n) // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in set(terms(text)) if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, rank, None if null else i, -s) for rank, (s, null, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def answer(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


ITEMS = [(1, "Hello WORLD test word"), (2, None), (3, ""), (4, " -- !"), (5, "1 2 3 1 2 3"), (5, "1 2 3 1 2 3"), (6, "no such termx"),
         (None, "héllo 漢字 word identifier"), (7, "a" * 9000), (8, "word " * 3000), (9, "endoftext x y it s we ll they")]


@pytest.fixture
def items(spark):
    return spark.createDataFrame([(i, t, 1, "m", 2) for i, t in ITEMS], "item_id long, text string, doc_id int, m string, n long")


@pytest.mark.parametrize("k", [1, 3, 10])
def test_brute_force(awkward, items, k):
    """Nulls, empty and long texts, repeated rows of both tables, items without an answer, clashing names."""
    assert answer(ranked_search(awkward, items, k=k)) == brute(AWKWARD, ITEMS, k)


def test_slices_of_items_and_small_pieces(spark, awkward, items, monkeypatch):
    for name, value in [("TERMS", 4), ("POSTINGS", 5), ("DOCUMENTS", 3), ("VISITED", 2), ("ADDED", 3)]:
        monkeypatch.setattr(ranked, name, value)
    assert answer(ranked_search(awkward, items)) == brute(AWKWARD, ITEMS)


def test_no_documents_or_no_items(spark, empty, awkward, items):
    found = ranked_search(empty, items)
    assert found.collect() == [] and dict(found.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert ranked_search(awkward, items.limit(0)).collect() == []


def test_ties_go_to_the_smaller_identifier(spark):
    docs = spark.createDataFrame([(i, "same words here") for i in range(60, 0, -1)] + [(99, "other text altogether")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "words here")], "item_id long, text string")
    assert [(r["rank"], r["doc_id"]) for r in ranked_search(docs, items).orderBy("rank").collect()] == [(i, i) for i in range(1, 11)]


def test_strata_are_skipped_and_no_document_is_lost():
    """Bounds leave out most visits; the answers are those of adding up everything."""
    rng = np.random.default_rng(4)
    size, vocabulary, items = 6000, 300, 40
    m = np.sort(rng.integers(10, 400, size))
    held = [np.unique(rng.zipf(1.4, 12) % vocabulary) for _ in range(size)]
    counts = np.array([len(h) for h in held])
    words, tfs = np.concatenate(held), rng.integers(1, 6, counts.sum())
    ids = rng.permutation(size)
    pairs = [(i, t) for i in range(items) for t in np.unique(rng.zipf(1.4, 8) % vocabulary).tolist()]
    owners, asked_terms = np.array(pairs).T
    asked = Asked(np.arange(vocabulary, dtype=np.uint64), np.arange(items), owners, asked_terms)
    weight = rng.integers(0, 9000, vocabulary)
    search = Search(asked, weight, 10, least=32)
    search.read(Piece(ids, m, counts, words, tfs))
    owner = np.repeat(np.arange(size), counts)
    impact = np.zeros((size, vocabulary), dtype=np.int64)
    impact[owner, words] = weight[words] * factor(tfs, m[owner])
    for i in range(items):
        exact = impact[:, asked_terms[owners == i]].sum(axis=1)
        want = sorted(zip(-exact[exact > 0], ids[exact > 0]))[:10]
        held_here = search.best.scores[i] > np.iinfo(np.int64).min
        assert list(zip(-search.best.scores[i][held_here], search.best.keys[i][held_here])) == want
    assert search.skipped > search.visited


def test_visits_hold_whole_strata():
    assert visits(np.array([1, 1, 1, 2, 3, 3, 4]), 2).tolist() == [0, 3, 6, 7]
    assert visits(np.array([5]), 10).tolist() == [0, 1]


def test_query_equals_its_sql(spark):
    assert difference(op13_ranked_search(spark, SF), duck(SF).sql(ORACLE_SQL).to_arrow_table()) is None
