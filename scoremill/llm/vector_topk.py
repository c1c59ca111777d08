"""Exact top-k by inner product: branch and bound over a vertical layout.

Vectors become whole numbers. Queries and candidates are dealt into cells of bounded size, each query meeting each
candidate in one cell. A cell lays its candidates out by dimension. Products are summed up one block of dimensions
after the other; what the remaining dimensions can add is at most the product of the two remaining masses (Cauchy and
Schwarz), and pairs that cannot reach the query's k-th best score any more are dropped. While many pairs are left, a
block is one matrix product; afterwards the surviving pairs are compacted and only they are summed further.

Numbers are exact: products run in 32-bit floats where norms keep all sums below 2^23, in 64-bit floats below 2^52,
and in Python's whole numbers beyond.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoremill.llm.best import LAST, NONE, Best
from scoremill.llm.common import stage

QUERIES = 4096           # of a cell, on average; the hash of a row deals it out
CANDIDATES = 16384
FEWEST = 1024            # candidates of a cell, before cells are made only to keep all cores busy
DIMENSIONS = 8           # of a block
AT_ONCE = 64             # queries of one matrix product
STEP = 2048              # candidates between two looks at the best scores so far,
SEED = 128               # and the first of them
LARGEST = 1e308
COMPACTED = 0.1          # share of pairs left from which they are summed one by one

ORACLE_SQL = """
WITH vectors AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.r <> c.r WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


# --- vectors as rows --------------------------------------------------------------------------

def quantised(vectors: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """``row, key, wide, body``: floor(scale * x) as 16-bit numbers, or as doubles where they do not fit."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            column = batch.column("vector")
            counts = np.asarray(column.value_lengths()).astype(np.int64)
            values = np.floor(np.clip(np.asarray(column.flatten(), dtype=np.float64), -LARGEST / scale, LARGEST / scale) * scale)
            ends = np.concatenate([[0], np.cumsum(counts)])
            parts = [values[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            wide = [bool(len(p)) and float(np.abs(p).max()) > 32767 for p in parts]
            body = [p.tobytes() if w else p.astype("<i2").tobytes() for p, w in zip(parts, wide)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + len(parts))), batch.column("key"), pa.array(wide, pa.bool_()), pa.array(body, pa.binary())],
                ["row", "key", "wide", "body"])
            row += len(parts)

    numbers = F.col(vector).cast("array<double>")
    usable = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    narrow = (vectors.filter(F.col(key).isNotNull() & F.col(vector).isNotNull()).filter(usable)
              .select(F.col(key).cast("bigint").alias("key"), numbers.alias("vector")))
    return narrow.mapInArrow(each, "row bigint, key bigint, wide boolean, body binary")


def matrix(wide: pa.ChunkedArray, body: pa.ChunkedArray) -> np.ndarray:
    """A row a vector, as doubles; shorter vectors end in zeros."""
    bodies, kinds = body.to_pylist(), wide.to_pylist()
    lengths = {(len(b), k) for b, k in zip(bodies, kinds)}
    if len(lengths) == 1:
        return np.frombuffer(b"".join(bodies), dtype="<f8" if kinds[0] else "<i2").reshape(len(bodies), -1).astype(np.float64)
    rows = [np.frombuffer(b, dtype="<f8" if k else "<i2") for b, k in zip(bodies, kinds)]
    out = np.zeros((len(rows), max(map(len, rows), default=0)))
    for place, row in zip(out, rows):
        place[:len(row)] = row
    return out


def _remaining(vectors: np.ndarray, block: int) -> np.ndarray:
    """The norm of what follows each block of dimensions, rounded up; the first row is the norm of all."""
    starts = np.arange(0, vectors.shape[1], block)
    squares = np.add.reduceat(vectors ** 2, starts, axis=1) if len(starts) else np.zeros((len(vectors), 0))
    left = np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]
    return np.vstack([np.sqrt(left).T * (1 + 1e-6), np.zeros(len(vectors))])


# --- one cell ---------------------------------------------------------------------------------

class Side:
    """Queries or candidates of a cell."""

    def __init__(self, rows: np.ndarray, keys: np.ndarray, vectors: np.ndarray, block: int = DIMENSIONS):
        order = np.argsort(keys, kind="stable")
        self.rows, self.keys, self.vectors = rows[order], keys[order], vectors[order]
        self.remaining = _remaining(self.vectors, block)
        norms = self.remaining[0]
        # Products of two of the first kind stay below 2^23, of the first two below 2^52.
        self.kind = np.where(norms < 2 ** 11, 0, np.where(norms < 2 ** 25, 1, 2))

    def after(self, step: int) -> np.ndarray:
        """What is left of each norm after the blocks up to ``step``."""
        return self.remaining[min(step + 1, len(self.remaining) - 1)]

    def of(self, kind: int) -> np.ndarray:
        return np.flatnonzero(self.kind == kind)


def _bounded(queries: Side, q: np.ndarray, candidates: Side, c: np.ndarray, best: Best, dtype, block: int, counts: dict) -> None:
    """Offers to ``best`` every pair of the named queries and candidates that may be wanted."""
    dims = max(queries.vectors.shape[1], candidates.vectors.shape[1])
    edges = list(range(0, dims, block))
    layout = [np.ascontiguousarray(candidates.vectors[c, e:e + block].T, dtype=dtype) for e in edges]  # one array a block
    ends = [0]
    while ends[-1] < len(c):  # short steps first: until some scores are known nothing is bounded
        ends.append(min(ends[-1] + min(STEP, max(SEED, ends[-1])), len(c)))
    for here in map(slice, ends, ends[1:]):
        rows = c[here]
        for first in range(0, len(q), AT_ONCE):
            mine = q[first:first + AT_ONCE]
            asked = queries.vectors[mine].astype(dtype)
            sums = np.zeros((len(mine), len(rows)), dtype=dtype)
            pairs, worst = None, np.where(best.worst[mine] == NONE, -np.inf, best.worst[mine])
            for step, e in enumerate(edges):
                part = asked[:, e:e + block]
                tile = layout[step][:part.shape[1], here]
                part = part[:, :len(tile)]
                left, right = queries.after(step)[mine], candidates.after(step)[rows]
                if pairs is None:
                    sums += part @ tile
                    counts["dense"] += sums.size
                    if step + 1 == len(edges) or np.isneginf(worst).any():
                        continue
                    may = sums + (np.outer(left, right) + 1) >= worst[:, None]
                    if np.count_nonzero(may) <= COMPACTED * may.size:
                        pairs = np.nonzero(may)
                        kept = sums[pairs].astype(np.float64)
                else:
                    a, b = pairs
                    kept = kept + np.einsum("ij,ij->i", part[a], tile[:, b].T)
                    counts["compacted"] += len(a)
                    alive = np.flatnonzero(kept + left[a] * right[b] + 1 >= worst[a])
                    if len(alive) < len(a):
                        pairs, kept = (a[alive], b[alive]), kept[alive]
                    if not len(alive):
                        break
            if pairs is None:
                a, b = np.nonzero(sums >= worst[:, None])
                kept = sums[a, b]
            else:
                a, b = pairs
            other = queries.rows[mine[a]] != candidates.rows[rows[b]]
            a, b, kept = a[other], b[other], kept[other]
            best.merge(mine[a], kept.astype(np.int64), candidates.keys[rows[b]])


def _one_by_one(queries: Side, q: np.ndarray, candidates: Side, c: np.ndarray, best: Best) -> None:
    """Pairs of numbers too large for floats; scores beyond 64 bits are the largest or smallest such number."""
    whole = [[int(x) for x in v] for v in candidates.vectors[c].tolist()]
    for i in q.tolist():
        asked = [int(x) for x in queries.vectors[i].tolist()]
        scores = np.array([min(max(sum(map(int.__mul__, asked, v)), NONE + 1), LAST) for v in whole], dtype=np.int64)
        other = np.flatnonzero(candidates.rows[c] != queries.rows[i])
        best.merge(np.full(len(other), i), scores[other], candidates.keys[c[other]])


def search(queries: Side, candidates: Side, k: int, block: int = DIMENSIONS, counts: dict | None = None) -> Best:
    """The best candidates of each query but its own row. ``counts`` gets the pairs that blocks were summed for."""
    best, counts = Best(len(queries.keys), k), {"dense": 0, "compacted": 0} if counts is None else counts
    for a in range(3):
        for b in range(3):
            q, c = queries.of(a), candidates.of(b)
            if len(q) and len(c):
                if max(a, b) == 2:
                    _one_by_one(queries, q, candidates, c, best)
                else:
                    _bounded(queries, q, candidates, c, best, np.float64 if max(a, b) else np.float32, block, counts)
    return best


# --- all cells --------------------------------------------------------------------------------

def top_k(vectors: DataFrame, asked: Callable[[Column], Column], key: str = "vec_id", vector: str = "embedding", k: int = 5,
          scale: float = 256.0) -> DataFrame:
    """Each query's ``k`` best candidates: ``query_id, rank, vec_id, score``.

    Rows for which ``asked`` of the key holds are queries; every other row is a candidate for them, also one
    with the same identifier. Vectors that are null or hold nulls or non-finite numbers, and rows without an
    identifier, take no part; vectors of unequal length are compared over the dimensions they share, empty ones
    score 0. Equal scores are ranked by ascending identifier. Rows that repeat are answered one by one; no rows,
    or no queries, give none. Other columns are not read.
    """
    spark = vectors.sparkSession
    held = stage(quantised(vectors, key, vector, scale), "vectors")
    numbered = held.withColumn("asked", F.coalesce(asked(F.col("key")), F.lit(False)))
    size = numbered.agg(F.count(F.lit(1)).alias("n"), F.count_if("asked").alias("asked")).first()
    cores = spark.sparkContext.defaultParallelism
    across = max(1, -(-size["n"] // CANDIDATES), min(2 * cores, size["n"] // FEWEST))
    down = max(1, -(-size["asked"] // QUERIES))
    columns = ["row", "key", "wide", "body"]
    c = numbered.select(*columns, F.pmod(F.xxhash64("row"), F.lit(across)).alias("c"), F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("q"))
    q = numbered.filter("asked").select(*columns, F.pmod(F.xxhash64("row", F.lit(1)), F.lit(down)).alias("q"),
                                        F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("c"))

    def side(rows: pa.Table) -> Side:
        return Side(np.asarray(rows.column("row")), np.asarray(rows.column("key")), matrix(rows.column("wide"), rows.column("body")))

    def each(asked: pa.Table, held: pa.Table) -> pa.Table:
        if not asked.num_rows or not held.num_rows:
            return pa.table({"query": pa.array([], pa.int64()), "query_id": pa.array([], pa.int64()),
                             "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        queries = side(asked)
        owner, score, found = search(queries, side(held), k).entries()
        return pa.table({"query": queries.rows[owner], "query_id": queries.keys[owner], "vec_id": found, "score": score})

    tasks, cell = min(across * down, 100_000), F.col("q") * across + F.col("c")
    dealt = [x.select(*columns, cell.alias("cell")).repartition(tasks, "cell").groupBy("cell") for x in (q, c)]
    found = dealt[0].cogroup(dealt[1]).applyInArrow(each, "query bigint, query_id bigint, vec_id bigint, score bigint")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
