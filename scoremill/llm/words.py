"""Words of many texts at once, as 64-bit hashes.

The texts of an Arrow column lie in one buffer. Word borders, hashes and shingles are found by numpy
over that buffer, in blocks of bounded size, so that no Python object is made per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19
BATCH_BYTES = 4 << 20

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def random_numbers(count: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, count + 1, dtype=np.uint64) * _GOLDEN + np.uint64(seed))


_BYTE_VALUES = random_numbers(256, 7)
_BASE = 0x9E3779B97F4A7C15 | 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_class(separators: bytes) -> np.ndarray:
    """True for the bytes of which words are made."""
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


#: Words [^\x20\x09-\x0D]+.
BY_SPACE = byte_class(b" \t\n\x0b\x0c\r")
#: Letters after lower-casing A-Z, and everything beyond ASCII.
LETTERS = byte_class(bytes(i for i in range(128) if not 97 <= i <= 122))

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    size = BLOCK_BYTES + 1 if size <= BLOCK_BYTES + 1 else size
    if size not in _powers:
        made = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            factors = np.full(size, base, dtype=np.uint64)
            factors[0] = 1
            made.append(np.multiply.accumulate(factors))
        if size > BLOCK_BYTES + 1:  # one very long word: not kept
            return made[0], made[1]
        _powers[size] = (made[0], made[1])
    return _powers[size]


class Words:
    """The words of a batch of texts; ``first[i]:first[i + 1]`` are those of text ``i``."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray):
        self.data, self.starts, self.ends, self.first = data, starts, ends, first

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def blocks(self):
        """Ranges of words that lie within about a block of bytes."""
        i, n = 0, len(self.starts)
        while i < n:
            j = int(np.searchsorted(self.ends, self.starts[i] + BLOCK_BYTES, "right"))
            j = max(j, i + 1)
            yield i, j
            i = j

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word."""
        return self.prefix_hashes(None)

    def prefix_hashes(self, length: int | None) -> np.ndarray:
        """A hash of each word's first ``length`` bytes (of all bytes if None or if it is shorter)."""
        out = np.empty(len(self.starts), dtype=np.uint64)
        for i, j in self.blocks():
            low, high = int(self.starts[i]), int(self.ends[j - 1])
            powers, inverse = _power_tables(high - low + 1)
            sums = np.zeros(high - low + 1, dtype=np.uint64)
            np.multiply(_BYTE_VALUES[self.data[low:high]], powers[:high - low], out=sums[1:])
            np.add.accumulate(sums, out=sums)
            a, b = self.starts[i:j] - low, self.ends[i:j] - low
            if length is not None:
                b = np.minimum(b, a + length)
            out[i:j] = mix((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64))
        return out

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()


def words_of(texts: pa.Array, word_bytes: np.ndarray = BY_SPACE, lower: bool = True) -> Words:
    """Words of every text; a null text has none."""
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    low, high = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(raw, dtype=np.uint8)[low:high] if raw is not None else np.zeros(0, np.uint8)
    offsets = offsets - low
    if lower:
        data = _LOWER[data]
    inside = word_bytes[data]
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return Words(data, none, none, np.zeros(len(texts) + 1, dtype=np.int64))
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    borders = offsets[:-1]
    borders = borders[borders < len(data)]
    opens[borders] = inside[borders]
    closes = np.empty_like(inside)
    closes[-1] = inside[-1]
    closes[:-1] = inside[:-1] & (~inside[1:] | opens[1:])
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets).astype(np.int64))


def slices(batch: pa.RecordBatch, column: str, most: int = BATCH_BYTES):
    """Parts of a batch whose texts have about ``most`` bytes together; a longer text comes alone."""
    texts = batch.column(column)
    if not len(texts):
        return
    sizes = np.frombuffer(texts.cast(pa.large_string()).buffers()[1], dtype=np.int64)
    sizes = sizes[:len(texts) + 1]
    i = 0
    while i < len(texts):
        j = int(np.searchsorted(sizes, sizes[i] + most, "right")) - 1
        j = min(max(j, i + 1), len(texts))
        yield batch.slice(i, j - i)
        i = j


def shingles(hashes: np.ndarray, width: int = 5) -> np.ndarray:
    """Hashes of the runs of ``width`` words of one text; with fewer words, of the whole sequence."""
    if not len(hashes):
        return hashes
    if len(hashes) < width:
        width = len(hashes)
    factors = random_numbers(width, 1000 + width) | np.uint64(1)
    out = np.zeros(len(hashes) - width + 1, dtype=np.uint64)
    for k in range(width):
        out += hashes[k:k + len(out)] * factors[k]
    return mix(out)
