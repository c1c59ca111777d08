import base64
import hashlib
import random
import struct

import public_tokenizers as P
import tiktoken

from scoremill.llm.bpe import ByteBpe, decode_ids, encode_texts, round_trip
from scoremill.llm.registered import MULTI_RANKS, op2_byte_bpe
from scoremill_checks.compare import duck

from .conftest import AWKWARD

SF = "/root/testdata/sf0.001"


def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(MULTI_RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_tree_equals_the_library_for_any_leaf_size():
    whole, pick = library(), random.Random(3)
    atoms = ["a", "b", "the", "'", "'ll", "'s", " ", "  ", "\n", "\t", "9", "!", "é", "漢", "🙂", " ", "\x1f", "_"]
    for leaf in (1, 2, 3, 7, 20):
        bpe = ByteBpe(MULTI_RANKS, P.PATTERN, leaf)
        for _ in range(300):
            text = "".join(pick.choices(atoms, k=pick.randint(0, 120)))
            ids = bpe.encode(text)
            assert ids == whole.encode_ordinary(text), (leaf, text)
            assert bpe.decode(ids) == text.encode()


def expected(text):
    ids = library().encode_ordinary(text or "")
    return (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


def test_awkward_texts(awkward, empty):
    rows = round_trip(awkward, MULTI_RANKS, P.PATTERN).collect()
    assert sorted(map(str, [tuple(r) for r in rows])) == sorted(str((i, *expected(t))) for i, t in AWKWARD)
    assert round_trip(empty, MULTI_RANKS, P.PATTERN).collect() == []


def test_encode_then_decode(awkward):
    encoded = encode_texts(awkward, MULTI_RANKS, P.PATTERN)
    back = decode_ids(encoded, MULTI_RANKS, P.PATTERN).collect()
    assert sorted(str((r[0], bytes(r[1]).decode())) for r in back) == sorted(str((i, t or "")) for i, t in AWKWARD)


def test_query_equals_the_library(spark):
    texts = dict(duck(SF).execute("SELECT doc_id, text FROM documents").fetchall())
    got = {r[0]: tuple(r[1:]) for r in op2_byte_bpe(spark, SF).collect()}
    assert got == {i: expected(t) for i, t in texts.items()}
