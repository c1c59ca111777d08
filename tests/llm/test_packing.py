import itertools
import operator
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from scoremill.llm import packing
from scoremill.llm.packing import best_plan, column_generation, cuts, pack, padded, whole_plan
from scoremill.llm.registered import RANKS, TOKENIZER, op3_packing
from scoremill_checks.compare import duck

from .conftest import AWKWARD

SF = "/root/testdata/sf0.001"


def check(rows, texts, capacity):
    """Pieces cover each document once, sequences have no gap; returns the share of padding."""
    tokenizer, docs, sequences = Tokenizer.from_file(TOKENIZER), defaultdict(list), defaultdict(list)
    for doc, start, length, crc, tokens, sequence, offset in rows:
        docs[doc].append((start, length, crc, tokens))
        sequences[sequence].append((offset, length))
    expected = defaultdict(list)
    for doc, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        expected[doc].append(np.array(ids, dtype="<u4"))
    assert set(docs) == set(expected)
    for doc, versions in expected.items():
        for ids in versions:
            mine, at = sorted(p for p in docs[doc] if p[3] == len(ids)), 0
            for start, length, crc, tokens in mine:
                assert start == at and crc == zlib.crc32(ids[start:start + length].tobytes())
                at += length
            assert at == len(ids)
    room = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        room += padded(at, capacity)
    total = sum(len(v) for vs in expected.values() for v in vs)
    return room / total - 1


def test_awkward_texts(awkward, empty):
    rows = [tuple(r) for r in pack(awkward, TOKENIZER, RANKS, P.PATTERN, 64).collect()]
    check(rows, AWKWARD, 64)
    assert pack(empty, TOKENIZER, RANKS, P.PATTERN).collect() == []


def test_query_packs_every_token_with_little_padding(spark):
    texts = duck(SF).execute("SELECT doc_id, text FROM documents").fetchall()
    assert check([tuple(r) for r in op3_packing(spark, SF).collect()], texts, 1024) < 0.02


def test_program_is_near_the_best_cover():
    pick = random.Random(5)
    demand = {k: pick.randint(1, 50) for k in (700, 520, 333, 300, 181, 64, 33, 7)}
    cover = column_generation(demand)
    covered = defaultdict(float)
    for pattern, times in cover.patterns:
        assert sum(k * n for k, n in pattern) <= 1024
        for k, n in pattern:
            covered[k] += n * times
    assert all(abs(covered[k] - n) < 1e-6 for k, n in demand.items())
    assert cover.room == pytest.approx(sum(padded(sum(k * n for k, n in p), 1024) * x for p, x in cover.patterns))
    assert cover.bound <= cover.room <= cover.bound * 1.0006 and cover.rounds > 0
    assert defaultdict(int, demand) == _held(whole_plan(demand))


@pytest.mark.parametrize("seed", range(6))
def test_program_equals_every_pattern_tried(seed):
    """Small sequences, so that all patterns can be listed; the linear program over them has the least room."""
    pick = random.Random(seed)
    lengths = pick.sample(range(3, 24), 4)
    demand = {k: pick.randint(5, 40) for k in lengths}
    patterns = [p for p in itertools.product(*[range(24 // k + 1) for k in lengths]) if 0 < sum(map(operator.mul, p, lengths)) <= 24]
    cost = np.array([padded(sum(map(operator.mul, p, lengths)), 24) for p in patterns], dtype=float)
    a = np.array(patterns, dtype=float).T
    best = np.inf  # over every basis of four patterns
    want = np.array([demand[k] for k in lengths], dtype=float)
    chosen = np.array(list(itertools.combinations(range(len(patterns)), 4)))
    mats = a[:, chosen].transpose(1, 0, 2)
    sound = np.abs(np.linalg.det(mats)) > 1e-9
    x = np.linalg.solve(mats[sound], np.broadcast_to(want[:, None], (sound.sum(), 4, 1)))[..., 0]
    rooms = np.where((x >= -1e-9).all(axis=1), (cost[chosen[sound]] * x).sum(axis=1), np.inf)
    best = rooms.min()
    cover = column_generation(demand, 24, gap=0.0)
    assert cover.room == pytest.approx(best) and cover.bound <= best + 1e-6


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_patterns_are_priced_at_every_size(sf):
    """On the tables' real lengths the program starts far from the bound and pricing takes it there."""
    lengths = duck(f"/root/testdata/{sf}").execute("SELECT length(coalesce(text, '')) FROM documents").fetchall()
    demand = Counter(piece for (n,) in lengths for piece in cuts((n // 3 + 1) % 1024, 1024, False))
    cover = column_generation(dict(demand))
    start = sum(padded(k * (1024 // k), 1024) * n / (1024 // k) for k, n in demand.items())
    assert cover.rounds > 50 and cover.room <= cover.bound * 1.0006 and start > 1.02 * cover.room
    print(sf, cover.rounds, "rounds of pricing")


def _held(plan):
    held = defaultdict(int)
    for pattern, copies in plan:
        for k, n in pattern:
            held[k] += n * copies
    return held


def test_equal_lengths_need_no_padding_either():
    share, plan = best_plan({(600, salt): 100 for salt in range(64)})
    total = 600 * 6400
    room = sum(padded(sum(k * n for k, n in p), 1024) * c for p, c in plan)
    assert room <= 1.005 * total + 1024 and share > 0


def test_cuts_add_up():
    for n in range(1, 1024):
        assert sum(cuts(n, 1024, True)) == sum(cuts(n, 1024, False)) == n


def test_equal_rows_without_identifiers_are_dealt_out(spark):
    """They share text and identifier, not their lot; each is packed for itself."""
    docs = spark.createDataFrame([(None, "the same words in every row")] * 3000, "doc_id long, text string").repartition(3)
    rows = pack(docs, TOKENIZER, RANKS, P.PATTERN, 64).collect()
    size = rows[0]["doc_tokens"]
    places = {(r["sequence_id"], r["offset"]) for r in rows}
    assert sum(r["length"] for r in rows) == 3000 * size and len(places) == len(rows)
    room = Counter()
    for r in rows:
        room[r["sequence_id"]] = max(room[r["sequence_id"]], r["offset"] + r["length"])
    assert max(room.values()) <= 64 and sum(padded(n, 64) for n in room.values()) < 1.03 * 3000 * size


def test_tasks_hand_few_texts_to_python_at_once(spark, monkeypatch):
    name, seen, staged = "spark.sql.execution.arrow.maxRecordsPerBatch", [], packing.stage_observed
    before = spark.conf.get(name)
    monkeypatch.setattr(packing, "stage_observed", lambda *a: seen.append(spark.conf.get(name)) or staged(*a))
    docs = spark.createDataFrame([(1, "some words"), (2, None), (2, "<|endoftext|> more")], "doc_id long, text string")
    found = packing.pack(docs, TOKENIZER, RANKS, P.PATTERN)
    assert seen == [str(packing.ARROW_ROWS)] and spark.conf.get(name) == before
    assert sorted(r["doc_id"] for r in found.filter("start = 0").collect()) == [1, 2, 2]
