import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from scoremill.llm import collocations as mined
from scoremill.llm.collocations import ORACLE_SQL, Parts, Tiles, collocations
from scoremill.llm.registered import op11_collocations
from scoremill_checks.compare import difference, duck

from .conftest import AWKWARD

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def brute(rows, least=10, top=2000, share=50):
    """(text, lang) rows; every phrase counted one by one, with Python's whole numbers."""
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in (1, 2, 3):
                counts[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in found.items():
            if any(100 * found.get(q, 0) >= share * a for q in found if len(q) > len(p) and p in (q[:2], q[1:])):
                continue
            cuts = [(10 ** 6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -s))
    return sorted(out)


def answer(df):
    return sorted(tuple(r) for r in df.collect())


ROWS = [("New York, new york.  NEW york new\tyork", "en")] * 12 + [(None, "en"), ("", None), (" . , ", "en")] + [
    ("a b a b a b a b a b a b a b; É é É", None), ("x y z " * 200, "und"), ("x\ny\nx y", "en"), ("z x y z q" * 30, "")]


@pytest.fixture
def rows(spark):
    """Nulls, empty texts, repeated rows, and extra columns whose names clash."""
    return spark.createDataFrame([(t, g, 1, 2, "k", "r", 3) for t, g in ROWS],
                                 "text string, lang string, n long, key long, word string, rank string, k1 long")


@pytest.mark.parametrize("head", [1, 3, 1 << 15])
def test_brute_force(rows, head):
    assert answer(collocations(rows, head=head)) == brute(ROWS)


@pytest.mark.parametrize("least, top, share", [(2, 3, 50), (1, 2000, 100), (3, 5, 1)])
def test_parameters(rows, least, top, share):
    assert answer(collocations(rows, least=least, top=top, share=share)) == brute(ROWS, least, top, share)


def test_awkward_texts(awkward):
    texts = [(t, "en") for _, t in AWKWARD]
    assert answer(collocations(awkward, least=2)) == brute(texts, 2)


def test_no_rows(empty):
    found = collocations(empty)
    assert found.collect() == [] and found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_products_past_64_bits(spark):
    big = spark.createDataFrame([(3_000_000_000_000, 4_000_000_000_000, 3_500_000_000_001)], "a long, l long, r long")
    a, left, right = 3_000_000_000_000, 4_000_000_000_000, 3_500_000_000_001
    assert big.select(mined._score("a", "l", "r").alias("s")).first()["s"] == 10 ** 6 * a * a // (left * right)


def parts(keys):
    keys = np.array(keys, dtype=np.uint64)
    order = np.argsort(keys)
    return Parts(keys[order], order, keys[None, :], np.full(4096, 255, dtype=np.uint8))


@pytest.mark.parametrize("tile, buffered", [(2, 10), (4, 50), (8, 1 << 20)])
def test_tiles_count_every_pair(tile, buffered):
    """Dense and sorted tiles, buffers that fill up, and words without an id give the counts of a plain counter."""
    rng = np.random.default_rng(5)
    pairs = rng.zipf(1.3, (4000, 2)).astype(np.uint64) * np.uint64(7919)
    ids = parts([7919 * (i + 1) for i in range(20)])
    tiles, found = Tiles(ids, ids, tile, buffered), Counter()
    for chunk in np.array_split(pairs, 9):
        for left, right, n in tiles.add(chunk[:, 0], chunk[:, 1], [chunk[:, 0], chunk[:, 1]]):
            found.update(dict(zip(zip(left.tolist(), right.tolist()), n.tolist())))
    assert tiles.dense
    for left, right, n in tiles.rest():
        for a, b, k in zip(left.tolist(), right.tolist(), n.tolist()):
            found[a, b] += k
    assert found == Counter(map(tuple, pairs.tolist()))


def test_query_equals_its_sql(spark):
    assert difference(op11_collocations(spark, SF), duck(SF).sql(ORACLE_SQL).to_arrow_table()) is None


def test_counts_go_back_in_batches_of_bounded_size():
    n = 2 * mined.HANDED_BACK + 5
    keys, counts = np.arange(n, dtype=np.uint64), np.arange(n)
    batches = list(mined._batches([(keys, keys + np.uint64(1), counts), (keys[:0], keys[:0], counts[:0])], ["k1", "k2"]))
    assert [b.num_rows for b in batches] == [mined.HANDED_BACK, mined.HANDED_BACK, 5]
    assert [b.schema.names for b in batches] == [["k1", "k2", "n"]] * 3
    assert np.concatenate([np.asarray(b.column("n")) for b in batches]).tolist() == counts.tolist()
    assert np.concatenate([np.asarray(b.column("k2")) for b in batches]).tolist() == (keys + np.uint64(1)).tolist()


def test_tasks_hand_few_texts_to_python_at_once(spark, rows, monkeypatch):
    name, seen, counted = "spark.sql.execution.arrow.maxRecordsPerBatch", [], mined._counted
    before = spark.conf.get(name)
    monkeypatch.setattr(mined, "_counted", lambda *a: seen.append(spark.conf.get(name)) or counted(*a))
    found = collocations(rows)
    assert seen == [str(mined.ARROW_ROWS)] * 2 and spark.conf.get(name) == before
    assert answer(found) == brute(ROWS)
