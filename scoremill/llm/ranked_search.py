"""Ranked lexical search over a length-stratified index.

A document's score depends on its length only through a whole number m, so documents are grouped by equal m. In such a
stratum a term's postings are ordered by tf, and what a posting adds (the term's weight times a factor of tf and m) is
computed once per tf. A term's largest impact stands first, and the sum of the items' largest impacts bounds every
document of a stratum. Strata are visited by descending bounds, each only for the items it may still serve; thin ones
(long documents have an m of their own) are visited together, under the largest of their impacts.

Documents are dealt to tasks by ranges of m, a stratum of very many documents to several of them. A task reads its part
of the index in bounded pieces and holds the best of each item; the tasks' best are ranked once more.

Items are asked in slices of a bounded number of terms, so what is broadcast does not grow with their table.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoremill.llm.best import LAST, Best
from scoremill.llm.common import stage
from scoremill.llm.words import byte_class, slices, words_of

TERMS = 200_000          # (item, term) pairs of a slice, on average; the hash of an item deals it out
POSTINGS = 1 << 20       # held at once by a task, and
DOCUMENTS = 1 << 15      # so many documents
VISITED = 256            # documents that are visited together at least, where strata are thinner
ADDED = 1 << 22          # impacts added up at once
EXACT = 1 << 52          # sums below are exact in doubles

#: Digits, letters after lower-casing A-Z, and everything beyond ASCII.
TERM_BYTES = byte_class(bytes(i for i in range(128) if not (48 <= i <= 57 or 97 <= i <= 122)))

ORACLE_SQL = r"""
WITH read AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
docs AS (SELECT r, doc_id, terms, len(terms) AS n FROM read WHERE len(terms) > 0),
sizes AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM docs),
asked AS (SELECT row_number() OVER () AS i, item_id, list_distinct(regexp_extract_all(translate(coalesce(text, ''),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS terms FROM benchmark),
pairs AS (SELECT i, item_id, unnest(terms) AS term FROM asked),
postings AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(terms) AS term FROM docs)
             WHERE term IN (SELECT term FROM pairs) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1)))::BIGINT AS w
            FROM postings, sizes GROUP BY term, big_n),
impacts AS (SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * big_n) // big_l))) AS impact
            FROM postings JOIN weights USING (term), sizes),
scored AS (SELECT i, item_id, r, doc_id, sum(impact)::BIGINT AS score FROM pairs JOIN impacts USING (term) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


# --- items ------------------------------------------------------------------------------------

def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """``item (row), item_id, term (hash)``, once each."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in slices(batch, "text"):
                words = words_of(part.column("text"), TERM_BYTES)
                owner = np.repeat(np.arange(part.num_rows), words.counts)
                hashes = words.hashes()
                order = np.lexsort((hashes, owner))
                owner, hashes = owner[order], hashes[order]
                first = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (hashes != np.roll(hashes, 1)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + owner[first]), part.column("item_id").take(pa.array(owner[first])),
                     pa.array(hashes[first].view(np.int64))], ["item", "item_id", "term"])
                row += part.num_rows
    narrow = items.select(F.col(key).alias("item_id"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(each, f"item bigint, item_id {narrow.schema['item_id'].dataType.simpleString()}, term bigint")


@dataclass(frozen=True)
class Asked:
    """Items and the terms they hold; ``terms[i]`` of pair ``i`` is a place in the sorted ``vocabulary``."""
    vocabulary: np.ndarray
    items: np.ndarray        # rows of the items' table
    owners: np.ndarray       # of each pair, a place in ``items``; ascending
    terms: np.ndarray

    @classmethod
    def of(cls, pairs: DataFrame) -> Asked:
        rows = pairs.select("item", "term").toArrow()
        item, term = np.asarray(rows.column("item")).astype(np.int64), np.asarray(rows.column("term")).astype(np.int64)
        vocabulary, terms = np.unique(term.view(np.uint64), return_inverse=True)
        items, owners = np.unique(item, return_inverse=True)
        order = np.argsort(owners, kind="stable")
        return cls(vocabulary, items, owners[order], terms[order])


# --- the index --------------------------------------------------------------------------------

def indexed(docs: DataFrame, key: str, text: str, vocabulary: np.ndarray) -> DataFrame:
    """Every document's ``doc_id, n, terms, tfs``: of the vocabulary's terms it holds, and how often."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                words = words_of(part.column("text"), TERM_BYTES)
                hashes = words.hashes()
                at = np.minimum(np.searchsorted(vocabulary, hashes), max(len(vocabulary) - 1, 0))
                hit = np.flatnonzero(vocabulary[at] == hashes) if len(vocabulary) else np.zeros(0, np.int64)
                owner = np.repeat(np.arange(part.num_rows), words.counts)[hit]
                codes, tfs = np.unique(owner * max(len(vocabulary), 1) + at[hit], return_counts=True)
                ends = pa.array(np.searchsorted(codes, np.arange(part.num_rows + 1) * max(len(vocabulary), 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(words.counts, pa.int64()),
                     pa.ListArray.from_arrays(ends, pa.array(codes % max(len(vocabulary), 1), pa.int32())),
                     pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64()))], ["doc_id", "n", "terms", "tfs"])
    narrow = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(each, "doc_id bigint, n bigint, terms array<int>, tfs array<bigint>")


def weights(index: DataFrame, size: int, documents: int) -> np.ndarray:
    """floor(1000 ln((2 N + 2) / (2 df + 1))) of each of the ``size`` terms; df is counted in the tasks."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        df = np.zeros(size, dtype=np.int64)
        for batch in batches:
            df += np.bincount(np.asarray(batch.column("terms").flatten(), dtype=np.int64), minlength=size)
        found = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(df[found])], ["term", "df"])
    rows = index.select("terms").mapInArrow(each, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(size, dtype=np.int64)
    for term, df in zip(rows.column("term").to_pylist(), rows.column("df").to_pylist()):
        out[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
    return out


# --- one task's search ------------------------------------------------------------------------

def factor(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


@dataclass(frozen=True)
class Piece:
    """Documents in order of m, and their postings: one after the other, by document."""
    ids: np.ndarray
    m: np.ndarray
    counts: np.ndarray
    terms: np.ndarray
    tfs: np.ndarray


def visits(m: np.ndarray, least: int = VISITED) -> np.ndarray:
    """Borders of the groups of whole strata that are visited together: ``least`` documents or more each."""
    ends = np.append(np.flatnonzero(m[1:] != m[:-1]) + 1, len(m))
    borders, last = [0], 0
    for end in ends.tolist():
        if end - last >= least:
            borders.append(end)
            last = end
    if last < len(m):
        borders.append(len(m))
    return np.array(borders)


class Search:
    """The best documents of each item so far."""

    def __init__(self, asked: Asked, weight: np.ndarray, k: int, least: int = VISITED):
        self.asked, self.weight, self.least, self.best = asked, weight, least, Best(len(asked.items), k)
        self.first = np.searchsorted(asked.owners, np.arange(len(asked.items)))
        self.longest = int(np.bincount(asked.owners).max(initial=0))
        self.visited = self.skipped = 0   # pairs of a visit and an item

    def read(self, piece: Piece) -> None:
        if not len(piece.terms) or not len(self.asked.owners):
            return
        owner = np.repeat(np.arange(len(piece.ids)), piece.counts)
        # By stratum, term and descending tf: an impact is computed at the first of equal ones.
        order = np.lexsort((-piece.tfs, piece.terms, piece.m[owner]))
        owner, terms, tfs = owner[order], piece.terms[order], piece.tfs[order]
        m = piece.m[owner]
        new = np.concatenate([[True], (terms[1:] != terms[:-1]) | (m[1:] != m[:-1]) | (tfs[1:] != tfs[:-1])])
        firsts = np.flatnonzero(new)
        once = self.weight[terms[firsts]] * factor(tfs[firsts], m[firsts])
        impacts = once[np.cumsum(new) - 1]
        borders = visits(piece.m, self.least)
        ends = np.searchsorted(m, piece.m[borders[:-1]])  # a visit starts where a stratum does
        ends = np.append(ends, len(m))
        runs = np.searchsorted(firsts, ends)
        bounds = np.array([self._bound(terms[firsts[a:b]], once[a:b]) for a, b in zip(runs, runs[1:])])
        for v in np.argsort(-bounds.max(axis=1), kind="stable").tolist():
            active = (bounds[v] > 0) & (bounds[v] >= self.best.worst)
            self.visited += int(active.sum())
            self.skipped += int((~active).sum())
            if active.any():
                part = slice(ends[v], ends[v + 1])
                self._visit(active, piece.ids, owner[part], terms[part], impacts[part])

    def _bound(self, terms: np.ndarray, impacts: np.ndarray) -> np.ndarray:
        """The sum of each item's largest impacts."""
        largest = np.zeros(len(self.weight), dtype=np.int64)
        np.maximum.at(largest, terms, impacts)
        return np.add.reduceat(largest[self.asked.terms], self.first)

    def _visit(self, active: np.ndarray, ids: np.ndarray, owner: np.ndarray, terms: np.ndarray, impacts: np.ndarray) -> None:
        """Adds up the impacts of every document for every active item, and offers the sums."""
        pairs = np.flatnonzero(active[self.asked.owners])
        by_term = pairs[np.argsort(self.asked.terms[pairs], kind="stable")]
        sorted_terms, items = self.asked.terms[by_term], self.asked.owners[by_term]
        rank = np.cumsum(active) - 1
        width = int(active.sum())
        low, high = np.searchsorted(sorted_terms, terms, "left"), np.searchsorted(sorted_terms, terms, "right")
        docs, local = np.unique(owner, return_inverse=True)
        by_doc = np.argsort(local, kind="stable")
        low, times, local, impacts = low[by_doc], (high - low)[by_doc], local[by_doc], impacts[by_doc]
        starts = np.searchsorted(local, np.arange(len(docs) + 1))
        upto = np.concatenate([[0], np.cumsum(times)])
        a = 0
        while a < len(docs):  # whole documents, of a bounded number of impacts
            b = int(np.searchsorted(upto[starts], upto[starts[a]] + ADDED, "right")) - 1
            b = min(max(b, a + 1), len(docs), a + max(1, ADDED // width))
            some = slice(starts[a], starts[b])
            n = times[some]
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[some], n)
            cell = np.repeat(local[some] - a, n) * width + rank[items[place]]
            added = np.repeat(impacts[some], n)
            if len(added) and float(impacts[some].max()) * self.longest < EXACT:
                sums = np.bincount(cell, added, minlength=(b - a) * width).astype(np.int64)
            else:
                sums = np.zeros((b - a) * width, dtype=np.int64)
                np.add.at(sums, cell, added)
            found = np.flatnonzero(sums)
            who = np.flatnonzero(active)[found % width]
            self.best.merge(who, sums[found], ids[docs[a + found // width]])
            a = b


def _pieces(batches: Iterator[pa.RecordBatch], documents: int, postings: int) -> Iterable[Piece]:
    """Bounded runs of the sorted index."""
    held, size, rows = [], 0, 0
    for batch in batches:
        low, ends = 0, np.cumsum(np.asarray(batch.column("terms").value_lengths()).astype(np.int64))
        while low < batch.num_rows:
            before = ends[low - 1] if low else 0
            high = int(np.searchsorted(ends, before + postings - size, "right"))
            high = min(max(high, low + 1), batch.num_rows, low + documents - rows)
            held.append(batch.slice(low, high - low))
            size, rows, low = size + int(ends[high - 1] - before), rows + high - low, high
            if size >= postings or rows >= documents or low < batch.num_rows:
                yield _piece(held)
                held, size, rows = [], 0, 0
    if held:
        yield _piece(held)


def _piece(held: list[pa.RecordBatch]) -> Piece:
    rows = pa.Table.from_batches(held).combine_chunks()
    ids = np.asarray(rows.column("doc_id").fill_null(LAST)).astype(np.int64)
    terms, tfs = (np.concatenate([np.asarray(c.flatten()).astype(np.int64) for c in rows.column(name).chunks]) for name in ("terms", "tfs"))
    counts = np.concatenate([np.asarray(c.value_lengths()).astype(np.int64) for c in rows.column("terms").chunks])
    return Piece(ids, np.asarray(rows.column("m")).astype(np.int64), counts, terms, tfs)


def _answers(index: DataFrame, asked: Asked, weight: np.ndarray, k: int) -> DataFrame:
    """``item, doc_id, score``: the best of every task."""
    shared = index.sparkSession.sparkContext.broadcast((asked, weight))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        asked, weight = shared.value
        search = Search(asked, weight, k)
        for piece in _pieces((b for b in batches if b.num_rows), DOCUMENTS, POSTINGS):
            search.read(piece)
        owner, score, ids = search.best.entries()
        yield pa.RecordBatch.from_arrays([pa.array(asked.items[owner]), pa.array(ids, mask=ids == LAST), pa.array(score)],
                                         ["item", "doc_id", "score"])
    return index.mapInArrow(each, "item bigint, doc_id bigint, score bigint")


def ranked_search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                  item_text: str = "text", k: int = 10) -> DataFrame:
    """Each item's ``k`` best documents with a score above 0: ``item_id, rank, doc_id, score``.

    Null and empty texts have no terms: such documents count nowhere, such items find nothing. Texts are read whole.
    Equal scores are ranked by ascending identifier, documents without one last. Rows that repeat, documents or
    items, count and are answered one by one. No documents or no items give no rows. Other columns are not read.
    Terms are 64-bit hashes: a term of the corpus is taken for one of a slice's with a chance below one in 10^13.
    """
    spark = docs.sparkSession
    pairs = stage(item_terms(items, item, item_text), "item-terms")
    parts = max(1, -(-pairs.count() // TERMS))
    found = None
    for part in range(parts):
        asked = Asked.of(pairs if parts == 1 else pairs.filter(F.pmod(F.xxhash64("item"), F.lit(parts)) == part))
        index = stage(indexed(docs, key, text, asked.vocabulary), "index")
        size = index.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        weight = weights(index, len(asked.vocabulary), size["documents"])
        m = F.expr(f"100 - 90 + (90 * n * {size['documents']}L) div {max(1, size['terms'])}L")
        sorted_index = (index.filter(F.size("terms") > 0).withColumn("m", m)
                        .repartitionByRange("m", F.xxhash64("doc_id", "n")).sortWithinPartitions("m"))
        answers = _answers(sorted_index, asked, weight, k)
        found = answers if found is None else found.unionByName(answers)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    best = (found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k))
    names = pairs.select("item", "item_id").distinct()
    return best.join(names, "item").select("item_id", "rank", "doc_id", "score")
