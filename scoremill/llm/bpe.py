"""Byte-level BPE by a monoid: encode halves, join neighbours, concatenate on the way back.

A text longer than a leaf is halved. Two encoded neighbours are joined by encoding anew only a window
round their border. The window grows to both sides until each end stands where a letter or digit is
followed by a space or a line feed. No match of the pattern can reach over such a place from either
side: white space is only ever a match's first character or all of it, and what ends a match before
it is that white space itself. So the tokens outside the window are those of the whole text, proven
rather than hoped for. Where no such place exists, the window becomes the whole text.

Decoding runs up the same tree: the bytes of a span are those of its halves, one after the other.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoremill.llm.common import in_arrow, no_nulls

LEAF_CHARS = 4096
FIRST_WINDOW = 32
RANKS_FILE = "byte_bpe_multi_50k.tiktoken"

_sync = re.compile(r"[^\W_](?=[ \n])")
_encodings: dict[tuple[str, str], ByteBpe] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class ByteBpe:
    """Encodes and decodes by the ranks in a file; each match of ``pattern`` is merged on its own."""

    def __init__(self, path: str, pattern: str, leaf: int = LEAF_CHARS):
        import tiktoken
        ranks = read_ranks(path)
        self.encoding = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.leaf = leaf

    @classmethod
    def cached(cls, path: str, pattern: str) -> ByteBpe:
        """One per worker process."""
        if (path, pattern) not in _encodings:
            _encodings[path, pattern] = cls(path, pattern)
        return _encodings[path, pattern]

    def encode(self, text: str) -> list[int]:
        return self._encode(text, 0, len(text))

    def _encode(self, text: str, low: int, high: int) -> list[int]:
        if high - low <= self.leaf:
            return self.encoding.encode_ordinary(text[low:high])
        middle = (low + high) // 2
        left, right = self._encode(text, low, middle), self._encode(text, middle, high)
        return self._join(text, low, middle, high, left, right)

    def _join(self, text: str, low: int, middle: int, high: int, left: list[int], right: list[int]) -> list[int]:
        begin, end, reach = None, None, FIRST_WINDOW
        while begin is None or end is None:
            if begin is None:
                a = max(low, middle - reach)
                places = [m.end() for m in _sync.finditer(text, a, middle)]
                begin = places[-1] if places and places[-1] < middle else low if a == low else None
            if end is None:
                b = min(high, middle + reach)
                place = _sync.search(text, middle, b)
                end = place.end() if place and place.end() < b else high if b == high else None
            reach *= 4
        keep = self._without_tail(left, len(text[begin:middle].encode())) if begin > low else 0
        skip = self._after_head(right, len(text[middle:end].encode())) if end < high else len(right)
        return left[:keep] + self.encoding.encode_ordinary(text[begin:end]) + right[skip:]

    def _without_tail(self, ids: list[int], size: int) -> int:
        """How many tokens stand before the last ``size`` bytes."""
        i = len(ids)
        while size > 0:
            i -= 1
            size -= len(self.bytes_of[ids[i]])
        return i

    def _after_head(self, ids: list[int], size: int) -> int:
        i = 0
        while size > 0:
            size -= len(self.bytes_of[ids[i]])
            i += 1
        return i

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= self.leaf:
            return self.encoding.decode_bytes(ids)
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


def encode_texts(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids``: every whole text as token identifiers. A null or empty text has none."""
    def encoded(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        bpe = ByteBpe.cached(path, pattern)
        ids = [bpe.encode(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])
    narrow = docs.select(F.col(key).alias("doc_id"), no_nulls(text).alias("text"))
    return in_arrow(narrow, encoded, f"doc_id {dict(narrow.dtypes)['doc_id']}, ids array<int>")


def decode_ids(encoded: DataFrame, path: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``doc_id, content``: the bytes the identifiers stand for. Null or no identifiers: no bytes."""
    def decoded(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        bpe = ByteBpe.cached(path, pattern)
        content = [bpe.decode(x or []) for x in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(content, pa.binary())], ["doc_id", "content"])
    narrow = encoded.select(F.col(key).alias("doc_id"), F.col(ids).alias("ids"))
    return in_arrow(narrow, decoded, f"doc_id {dict(narrow.dtypes)['doc_id']}, content binary")


def round_trip(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every text, encoded and decoded again.

    One pass: identifiers never leave the task. Null texts count as empty, with no tokens; any length
    of text is taken whole; rows that repeat are answered one by one; no rows give no rows. Other
    columns are not read.
    """
    def digested(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        bpe = ByteBpe.cached(path, pattern)
        counts, of_ids, of_bytes = [], [], []
        for t in batch.column("text").to_pylist():
            ids = bpe.encode(t)
            counts.append(len(ids))
            of_ids.append(hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest())
            of_bytes.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()),
             pa.array(of_bytes, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    narrow = docs.select(F.col(key).alias("doc_id"), no_nulls(text).alias("text"))
    return in_arrow(narrow, digested, f"doc_id {dict(narrow.dtypes)['doc_id']}, n_tokens bigint, "
                                      "ids_sha256 string, decoded_sha256 string")
