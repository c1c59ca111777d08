"""Pairwise co-moments of any number of columns in one scan.

For every pair of columns, over the rows where both are present: the count, both means, both sums of squared deviations
and the sum of products. All pairs of an Arrow batch are a handful of matrix products of the values (missing ones as 0)
and the mask of present ones. Values are shifted by the first one of their column, and means are kept relative to that
shift, so that large offsets cost no digits.

Two states merge exactly as one pass over both inputs would go (the parallel update of means and deviations), so every
task keeps one state, and the tasks' states are merged in a tree. A state is cut into tiles of column pairs; tiles merge
independently, and none is larger than ``TILE`` x ``TILE`` x ``MOMENTS`` numbers, however wide the table is.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoremill.functions.expressions import as_number
from scoremill.sources.staging import stage

TILE = 64
MOMENTS = 8
FAN = 64                 # states of a tile that one task merges
ROWS = 8192              # of a batch at once
DOUBTFUL = 1e-9          # of a sum of squares: below, what is left after the mean is summed again from the deviations


@dataclass(frozen=True)
class Moments:
    """Of pair (i, j), over rows with both: ``n``, the mean of i and of j less their shifts, both sums of squared
    deviations, and of products."""
    n: np.ndarray
    left_shift: np.ndarray
    right_shift: np.ndarray
    left: np.ndarray
    right: np.ndarray
    left_squares: np.ndarray
    right_squares: np.ndarray
    products: np.ndarray

    def parts(self) -> tuple[np.ndarray, ...]:
        return self.n, self.left_shift, self.right_shift, self.left, self.right, self.left_squares, self.right_squares, self.products

    def merged(self, other: Moments) -> Moments:
        n = self.n + other.n
        with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
            share = np.where(n > 0, other.n / np.maximum(n, 1), 0.0)
            a = other.left - self.left + (other.left_shift - self.left_shift)
            b = other.right - self.right + (other.right_shift - self.right_shift)
            both = self.n * share
            # Where one side has no rows, the other's numbers stay as they are.
            pick = lambda x, y, joint: np.where(self.n == 0, y, np.where(other.n == 0, x, joint))
            return Moments(
                n, pick(self.left_shift, other.left_shift, self.left_shift), pick(self.right_shift, other.right_shift, self.right_shift),
                pick(self.left, other.left, self.left + a * share), pick(self.right, other.right, self.right + b * share),
                pick(self.left_squares, other.left_squares, self.left_squares + other.left_squares + a * a * both),
                pick(self.right_squares, other.right_squares, self.right_squares + other.right_squares + b * b * both),
                pick(self.products, other.products, self.products + other.products + a * b * both))

    def tile(self, rows: slice, columns: slice) -> Moments:
        return Moments(*[p[rows, columns] for p in self.parts()])

    def to_bytes(self) -> bytes:
        return np.stack(self.parts()).astype("<f8").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes, rows: int) -> Moments:
        return cls(*np.frombuffer(data, dtype="<f8").reshape(MOMENTS, rows, -1))

    def correlations(self) -> np.ndarray:
        """NaN where a column is constant, or absent, over the pair's rows."""
        with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
            spread = np.sqrt(self.left_squares) * np.sqrt(self.right_squares)
            return np.where(spread > 0, self.products / spread, np.nan)


def moments(values: np.ndarray) -> Moments:
    """Of the columns of a batch; NaN is missing."""
    present = ~np.isnan(values)
    first = np.take_along_axis(values, present.argmax(axis=0)[None, :], axis=0)[0]
    shift = np.where(np.isfinite(first), first, 0.0)
    shifted = np.where(present, values - shift, 0.0)
    finite = np.isfinite(shifted).all(axis=0)
    x, mask = np.where(finite, shifted, 0.0), present.astype(np.float64)
    n = mask.T @ mask
    rows = np.maximum(n, 1.0)
    with np.errstate(over="ignore", invalid="ignore"):
        sums, squares, products = x.T @ mask, (x * x).T @ mask, x.T @ x
        mean = sums / rows
        left = squares - sums * mean
        both = products - sums * mean.T
    shifts, spread = np.repeat(shift[:, None], len(shift), axis=1), np.maximum(left, 0.0)
    out = Moments(n, shifts, shifts.T.copy(), mean, mean.T.copy(), spread, spread.T.copy(), both)
    doubtful = (n > 0) & (squares != 0) & ((left <= DOUBTFUL * squares) | ~np.isfinite(squares))
    again = doubtful | doubtful.T | (n > 0) & (~finite[:, None] | ~finite[None, :])
    for i, j in zip(*np.nonzero(again)):
        _again(out, values, present, i, j)
    return out


def _again(out: Moments, values: np.ndarray, present: np.ndarray, i: int, j: int) -> None:
    """One pair from its deviations, which are exactly 0 for a constant."""
    rows = present[:, i] & present[:, j]
    a, b = values[rows, i], values[rows, j]
    with np.errstate(invalid="ignore", over="ignore"):
        means = [v[0] if (v == v[0]).all() else v[0] + (v - v[0]).mean() for v in (a, b)]
        da, db = a - means[0], b - means[1]
        found = means[0], means[1], 0.0, 0.0, (da * da).sum(), (db * db).sum(), (da * db).sum()
    for part, value in zip(out.parts()[1:], found):
        part[i, j] = value


def nothing(width: int) -> Moments:
    return Moments(*np.zeros((MOMENTS, width, width)))


def _tiles(width: int) -> list[tuple[int, slice, slice]]:
    """The tiles on and above the diagonal, with their numbers."""
    edges = [slice(a, min(a + TILE, width)) for a in range(0, width, TILE)]
    return [(i * len(edges) + j, edges[i], edges[j]) for i in range(len(edges)) for j in range(i, len(edges))]


def comoments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``tile, state``: a row for each tile of column pairs, after one scan of the columns.

    Missing and NaN values leave a pair's row out. No rows give states that count none.
    """
    names = list(columns)
    tiles = _tiles(len(names))
    numbers = df.select(*[as_number(F.col(c)).alias(f"c{i}") for i, c in enumerate(names)])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        state = nothing(len(names))
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                state = state.merged(moments(np.column_stack(
                    [c.to_numpy(zero_copy_only=False).astype(np.float64) for c in part.columns])))
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()] * len(tiles), pa.int64()), pa.array([t for t, _, _ in tiles], pa.int32()),
             pa.array([state.tile(a, b).to_bytes() for _, a, b in tiles], pa.binary())], ["part", "tile", "state"])

    states = stage(numbers.mapInArrow(each, "part bigint, tile int, state binary"), "co-moments")
    parts = states.agg(F.max("part")).first()[0]
    if parts is None:  # a table without a partition
        empty = [(t, bytearray(nothing(len(names)).tile(a, b).to_bytes())) for t, a, b in tiles]
        return df.sparkSession.createDataFrame(empty, "tile int, state binary")
    while parts:
        states = _merged(states.withColumn("part", F.expr(f"part div {FAN}")), {t: a.stop - a.start for t, a, _ in tiles})
        parts //= FAN
    return states.select("tile", "state")


def _merged(states: DataFrame, heights: dict[int, int]) -> DataFrame:
    """One state for each part and tile; ``heights`` has the rows of a tile."""
    def each(rows: pa.Table) -> pa.Table:
        tile = rows.column("tile")[0].as_py()
        found = [Moments.from_bytes(b, heights[tile]) for b in rows.column("state").to_pylist()]
        return pa.table({"part": pa.array([rows.column("part")[0].as_py()], pa.int64()), "tile": pa.array([tile], pa.int32()),
                         "state": pa.array([reduce(Moments.merged, found).to_bytes()], pa.binary())})
    return states.groupBy("part", "tile").applyInArrow(each, "part bigint, tile int, state binary")


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``var1, var2, n, corr`` of all ordered pairs, the diagonal included; null where a column is constant."""
    names, width = list(columns), len(columns)
    where = {t: (a, b) for t, a, b in _tiles(width)}

    def each(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for tile, state in zip(batch.column("tile").to_pylist(), batch.column("state").to_pylist()):
                rows, across = where[tile]
                found = Moments.from_bytes(state, rows.stop - rows.start)
                corr, n = found.correlations(), found.n.astype(np.int64)
                i, j = np.meshgrid(np.arange(rows.start, rows.stop), np.arange(across.start, across.stop), indexing="ij")
                i, j, corr, n = (x.ravel() for x in (i, j, corr, n))
                if rows != across:  # the tile below the diagonal
                    i, j, corr, n = np.append(i, j), np.append(j, i), np.tile(corr, 2), np.tile(n, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[k] for k in i.tolist()]), pa.array([names[k] for k in j.tolist()]), pa.array(n),
                     pa.array(corr, mask=np.isnan(corr))], ["var1", "var2", "n", "corr"])
    return comoments(df, names).mapInArrow(each, "var1 string, var2 string, n bigint, corr double")
