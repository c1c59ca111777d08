"""Phrases of two and three words that stand together more often than their parts suggest.

Words are ranked by frequency. Ids of the ``HEAD`` most frequent address a table of pairs directly: it is cut into
square tiles, and in each task a tile that many pairs of the text fall into is a dense array counted with bincount.
Pairs of thinner tiles, and those of words without an id, are sorted as (left, right, count). Frequent pairs are then
ranked in turn, and a phrase of three words is a pair of (pair, word), counted by the same code.

A phrase cannot be more frequent than its parts. A bitmap of the parts that are frequent enough, of a size bounded by
``MOST_BITS``, is broadcast, and phrases of other parts are not counted at all. A bit may also stand for a rare part
that shares it; what is found is filtered by its exact count, so the bitmap saves work and decides nothing.

Everything is per language: a word's key is a 64-bit hash of language and word. Two words with one key, which a corpus
of a hundred million different words has with a chance of one in three thousand, would be counted as one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoremill.llm.common import in_arrow, stage
from scoremill.llm.words import Words, byte_class, mix, random_numbers, slices, words_of
from scoremill.sources.staging import setting

HEAD = 1 << 15           # ids, and so at most as many keys broadcast
TILE = 1 << 9            # a tile has its square of cells
DENSE = 32               # a tile is dense where one cell in this many is hit by a slice of the text
TILES = 16               # dense tiles that a task holds; any others are sorted
BUFFERED = 1 << 19       # pairs sorted at once
ARROW_ROWS = 1000        # texts that a task hands to Python at once
SLICE_BYTES = 1 << 20    # of texts looked at together
HANDED_BACK = 1 << 16    # counts that Python hands to the task at once
MOST_BITS = 1 << 26      # of a bitmap, 8 MB; the count of parts decides below that
BITS_PER_PART = 16
SALTS = 64               # a language's candidates are ranked in as many groups, and their best once more

BREAKS = b".,;:!?\n\x0b\x0c\r"
WORD_BYTES = byte_class(b" \t" + BREAKS)
_BREAK = ~byte_class(BREAKS)
_LEFT, _RIGHT = random_numbers(2, 11) | np.uint64(1)

ORACLE_SQL = r"""
WITH pieces AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split),
one AS (SELECT lang, w[i] AS a1, count(*) AS f FROM places GROUP BY ALL),
two AS (SELECT lang, w[i] AS a1, w[i + 1] AS a2, count(*) AS f FROM places WHERE i + 1 <= len(w) GROUP BY ALL HAVING f >= 10),
three AS (SELECT lang, w[i] AS a1, w[i + 1] AS a2, w[i + 2] AS a3, count(*) AS f FROM places WHERE i + 2 <= len(w)
          GROUP BY ALL HAVING f >= 10),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM one GROUP BY lang),
scored2 AS (SELECT t.lang, t.a1 || ' ' || t.a2 AS phrase, t.f AS a, x.f AS l, y.f AS r,
                   ((1000000::HUGEINT * t.f * t.f) // (x.f::HUGEINT * y.f))::BIGINT AS score, t.a1, t.a2
            FROM two t JOIN one x ON x.lang = t.lang AND x.a1 = t.a1 JOIN one y ON y.lang = t.lang AND y.a1 = t.a2),
cuts AS (SELECT t.lang, t.a1 || ' ' || t.a2 || ' ' || t.a3 AS phrase, t.f AS a, x.f AS l1, yz.f AS r1, xy.f AS l2, z.f AS r2,
                ((1000000::HUGEINT * t.f * t.f) // (x.f::HUGEINT * yz.f))::BIGINT AS s1,
                ((1000000::HUGEINT * t.f * t.f) // (xy.f::HUGEINT * z.f))::BIGINT AS s2
         FROM three t JOIN one x ON x.lang = t.lang AND x.a1 = t.a1 JOIN one z ON z.lang = t.lang AND z.a1 = t.a3
         JOIN two xy ON xy.lang = t.lang AND xy.a1 = t.a1 AND xy.a2 = t.a2
         JOIN two yz ON yz.lang = t.lang AND yz.a1 = t.a2 AND yz.a2 = t.a3),
inside AS (SELECT lang, a1, a2, max(f) AS f FROM (SELECT lang, a1, a2, f FROM three UNION ALL SELECT lang, a2, a3, f FROM three)
           GROUP BY ALL),
candidates AS (
  SELECT s.lang, s.phrase, s.a, s.l, s.r, s.score FROM scored2 s LEFT JOIN inside i USING (lang, a1, a2)
  WHERE i.f IS NULL OR 100 * i.f < 50 * s.a
  UNION ALL
  SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2) FROM cuts),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM candidates)
SELECT lang, rank::BIGINT AS rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def _pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * _LEFT + right * _RIGHT)


# --- words of the text ------------------------------------------------------------------------

def _keyed(part: pa.RecordBatch) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words, the text of each, and the key of each."""
    words = words_of(part.column("text"), WORD_BYTES)
    owner = np.repeat(np.arange(part.num_rows), words.counts)
    languages = mix(np.asarray(part.column("lang_key")).view(np.uint64))
    return words, owner, mix(words.hashes() + languages[owner])


def _followed(words: Words, owner: np.ndarray) -> np.ndarray:
    """For each word but the last, whether the next stands in the same piece of the same text."""
    if len(words) < 2:
        return np.zeros(0, dtype=bool)
    breaks = np.flatnonzero(_BREAK[words.data])
    before = np.searchsorted(breaks, words.starts)
    return (before[1:] == before[:-1]) & (owner[1:] == owner[:-1])


def _word_counts(texts: DataFrame) -> DataFrame:
    """``key, lang, word, n``, and a row without a word for all of a language's words."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                words, owner, keys = _keyed(part)
                found, at, n = np.unique(keys, return_index=True, return_counts=True)
                lang = part.column("lang")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), lang.take(pa.array(owner[at])),
                     pa.array([words.text(i) for i in at.tolist()], pa.binary()), pa.array(n, pa.int64())],
                    ["key", "lang", "word", "n"])
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(part.num_rows, pa.int64()), lang, pa.nulls(part.num_rows, pa.binary()), pa.array(words.counts, pa.int64())],
                    ["key", "lang", "word", "n"])
    rows = texts.mapInArrow(each, "key bigint, lang string, word binary, n bigint")
    return rows.groupBy("key", "lang", F.col("word").cast("string").alias("word")).agg(F.sum("n").alias("n"))


# --- what is broadcast ------------------------------------------------------------------------

@dataclass(frozen=True)
class Parts:
    """Ids of the most frequent parts, and a bitmap that holds every frequent one."""
    keys: np.ndarray      # sorted
    ids: np.ndarray       # of the sorted keys; 0 for the most frequent
    columns: np.ndarray   # by id: the words' keys that make up the part, a row for each word
    bitmap: np.ndarray    # bytes

    def ranks(self, keys: np.ndarray) -> np.ndarray:
        """Ids; -1 for parts without one."""
        if not len(self.keys):
            return np.full(len(keys), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ids[at], -1)

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        bit = (keys & np.uint64(len(self.bitmap) * 8 - 1)).astype(np.int64)
        return (self.bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def _parts(frequent: DataFrame, columns: list[str], head: int) -> Parts:
    """From ``key, n`` and the named columns. The bitmap is made in the tasks and merged page by page."""
    count = frequent.count()
    bits = 1 << 15
    while bits < min(MOST_BITS, BITS_PER_PART * count):
        bits *= 2
    bit = F.col("key").bitwiseAND(F.lit(bits - 1))
    pages = (frequent.select(bit.alias("bit")).groupBy(F.expr("bit div 32768").alias("page"))
             .agg(F.bitmap_construct_agg(F.col("bit") % 32768).alias("bytes")).toArrow())
    bitmap = np.zeros(bits // 8, dtype=np.uint8)
    for page, data in zip(pages.column("page").to_pylist(), pages.column("bytes").to_pylist()):
        bitmap[page * 4096:(page + 1) * 4096] = np.frombuffer(data, dtype=np.uint8)
    rows = frequent.orderBy(F.desc("n"), "key").limit(head)
    rows = rows.select(F.col("key").alias("part"), *columns).toArrow()
    keys = np.asarray(rows.column("part")).astype(np.int64).view(np.uint64)
    order = np.argsort(keys)
    held = np.array([np.asarray(rows.column(c)).astype(np.int64).view(np.uint64) for c in columns]).reshape(len(columns), -1)
    return Parts(keys[order], order, held, bitmap)


# --- counting ---------------------------------------------------------------------------------

class Tiles:
    """Counts of (left part, right word) in one task: dense tiles by id, all others sorted."""

    def __init__(self, left: Parts, right: Parts, tile: int = TILE, buffered: int = BUFFERED):
        self.left, self.right, self.tile, self.buffered = left, right, tile, buffered
        self.across = -(-max(1, len(right.keys)) // tile)
        self.dense: dict[int, np.ndarray] = {}
        self.sparse: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, left: np.ndarray, right: np.ndarray, words: list[np.ndarray]) -> Iterable[tuple]:
        """Counts occurrences; yields sorted counts whenever the buffer is full."""
        a, b = self.left.ranks(left), self.right.ranks(right)
        tile = np.where((a >= 0) & (b >= 0), a // self.tile * self.across + b // self.tile, -1)
        names, place, hits = np.unique(tile, return_inverse=True, return_counts=True)
        cells, sorted_too = self.tile * self.tile, np.ones(len(names), dtype=bool)
        for k, name in enumerate(names.tolist()):
            if name < 0 or name not in self.dense and (hits[k] * DENSE < cells or len(self.dense) >= TILES):
                continue
            sorted_too[k] = False
            here = np.flatnonzero(place == k)
            offsets = a[here] % self.tile * self.tile + b[here] % self.tile
            self.dense[name] = self.dense.get(name, 0) + np.bincount(offsets, minlength=cells)
        rest = np.flatnonzero(sorted_too[place])
        if len(rest):
            self.sparse.append((*[w[rest] for w in words], np.ones(len(rest), dtype=np.int64)))
            self.size += len(rest)
        if self.size >= self.buffered:
            merged = self._merged()
            if len(merged[-1]) * 2 > self.buffered:
                yield merged
                self.sparse, self.size = [], 0
            else:
                self.sparse, self.size = [merged], len(merged[-1])

    def _merged(self) -> tuple[np.ndarray, ...]:
        *words, n = [np.concatenate(x) for x in zip(*self.sparse)]
        code = words[0]
        for w in words[1:]:
            code = _pair_keys(code, w)
        order = np.argsort(code, kind="stable")
        code = code[order]
        first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        return *[w[order[first]] for w in words], np.add.reduceat(n[order], first)

    def rest(self) -> Iterable[tuple]:
        if self.size:
            yield self._merged()
        for name, counts in self.dense.items():
            cell = np.flatnonzero(counts)
            a = name // self.across * self.tile + cell // self.tile
            b = name % self.across * self.tile + cell % self.tile
            yield *[c[a] for c in self.left.columns], self.right.columns[0][b], counts[cell]


def _batches(counted: Iterable[tuple], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Columns of keys and counts as batches of at most ``HANDED_BACK`` rows: the JVM holds a whole one off its heap."""
    for *keys, n in counted:
        for a in range(0, len(n), HANDED_BACK):
            b = a + HANDED_BACK
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(k[a:b].view(np.int64)) for k in keys], pa.array(n[a:b].astype(np.int64))], [*names, "n"])


def _counted(texts: DataFrame, words: Parts, pairs: Parts | None, least: int) -> DataFrame:
    """Phrases of two words, or of three given ``pairs``, and how often each is found: ``least`` times or more."""
    shared = texts.sparkSession.sparkContext.broadcast((words, pairs))
    names = ["k1", "k2", "k3"][:2 if pairs is None else 3]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        words, pairs = shared.value
        tiles = Tiles(words if pairs is None else pairs, words)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                found, owner, keys = _keyed(part)
                frequent = words.may_hold(keys)
                at = np.flatnonzero(_followed(found, owner) & frequent[:-1] & frequent[1:]) if len(keys) > 1 else np.zeros(0, np.int64)
                if pairs is None:
                    yield from _batches(tiles.add(keys[at], keys[at + 1], [keys[at], keys[at + 1]]), names)
                    continue
                joint = _pair_keys(keys[at], keys[at + 1])
                good = pairs.may_hold(joint)
                at, joint = at[good], joint[good]
                next_too = np.flatnonzero(at[1:] == at[:-1] + 1) if len(at) > 1 else np.zeros(0, np.int64)
                i = at[next_too]
                yield from _batches(tiles.add(joint[next_too], keys[i + 2], [keys[i], keys[i + 1], keys[i + 2]]), names)
        yield from _batches(tiles.rest(), names)

    counted = texts.mapInArrow(each, ", ".join(f"{n} bigint" for n in [*names, "n"]))
    return counted.groupBy(*names).agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _keyed_pairs(pairs: DataFrame) -> DataFrame:
    """Frequent pairs as parts of their own: ``key, k1, k2, n``."""
    def each(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        k1, k2 = (np.asarray(batch.column(c)).view(np.uint64) for c in ("k1", "k2"))
        yield pa.RecordBatch.from_arrays([pa.array(_pair_keys(k1, k2).view(np.int64)), *(batch.column(c) for c in ("k1", "k2", "n"))],
                                         ["key", "k1", "k2", "n"])
    return in_arrow(pairs, each, "key bigint, k1 bigint, k2 bigint, n bigint")


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a² / (l r)), exact: the products have 38 digits."""
    return F.expr(f"(cast(1000000 as decimal(38,0)) * {a} * {a}) div (cast({left} as decimal(19,0)) * {right})")


def _best(candidates: DataFrame, top: int) -> DataFrame:
    """Each language's first ``top``; ranked in salted groups first, so that no task has a language's candidates."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = candidates.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = (salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
            .filter(F.col("rank") <= top).drop("rank", "salt"))
    return (some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
            .filter(F.col("rank") <= top))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 10, top: int = 2000,
                 share: int = 50, head: int = HEAD) -> DataFrame:
    """Each language's ``top`` phrases: ``lang, rank, phrase, a, l, r, n, score``.

    A candidate is found ``least`` times within pieces; one that lies inside a longer candidate as frequent as
    ``share`` per cent of it is dropped. Null texts are empty, null languages are ``und``; empty texts have no words.
    Texts are read whole, in blocks of whole texts. Rows that repeat count as often as they stand there; ties are
    broken by count and then by the phrase's bytes. No rows, or no frequent phrase, give no rows. Other columns are
    not read.
    """
    with setting(docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS)):
        return _collocations(docs, text, lang, least, top, share, head)


def _collocations(docs: DataFrame, text: str, lang: str, least: int, top: int, share: int, head: int) -> DataFrame:
    """All that runs in Python is written out here, so the size of its batches holds for it."""
    language = F.coalesce(F.col(lang).cast("string"), F.lit("und"))
    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"), language.alias("lang"),
                        F.xxhash64(language).alias("lang_key"))
    counts = stage(_word_counts(texts).filter(F.col("word").isNull() | (F.col("n") >= least)), "words")
    totals = counts.filter("word IS NULL").groupBy("lang").agg(F.sum("n").alias("total"))
    frequent = counts.filter("word IS NOT NULL")
    words = _parts(frequent, ["key"], head)
    pairs = stage(_counted(texts, words, None, least), "pairs")
    triples = stage(_counted(texts, words, _parts(_keyed_pairs(pairs), ["k1", "k2"], head), least), "triples")

    first = frequent.select(F.col("key").alias("k1"), "lang", F.col("word").alias("w1"), F.col("n").alias("f1"))
    second = frequent.select(F.col("key").alias("k2"), F.col("word").alias("w2"), F.col("n").alias("f2"))
    named = stage(pairs.withColumnRenamed("n", "a").join(first, "k1").join(second, "k2"), "named")
    inside = (triples.select("k1", "k2", "n").unionByName(triples.select(F.col("k2").alias("k1"), F.col("k3").alias("k2"), "n"))
              .groupBy("k1", "k2").agg(F.max("n").alias("longer")))
    two = (named.join(inside, ["k1", "k2"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
           .select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"))
           .withColumn("score", _score("a", "l", "r")))
    start = named.select("k1", "k2", "lang", "w1", "w2", "f1", F.col("a").alias("f12"))
    end = named.select(F.col("k1").alias("k2"), F.col("k2").alias("k3"), F.col("w2").alias("w3"), F.col("f2").alias("f3"),
                       F.col("a").alias("f23"))
    three = (triples.withColumnRenamed("n", "a").join(start, ["k1", "k2"]).join(end, ["k2", "k3"])
             .withColumn("early", _score("a", "f1", "f23")).withColumn("late", _score("a", "f12", "f3"))
             .select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
                     F.when(F.expr("early <= late"), F.col("f1")).otherwise(F.col("f12")).alias("l"),
                     F.when(F.expr("early <= late"), F.col("f23")).otherwise(F.col("f3")).alias("r"),
                     F.least("early", "late").alias("score")))
    return (_best(two.unionByName(three), top).join(totals, "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score"))

