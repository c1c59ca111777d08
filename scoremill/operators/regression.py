"""Logistic regression by Newton steps, each one pass over the rows or over the distinct rows with their counts.

Weights of evidence take few values, so a table of them collapses to (values, goods, bads): one shuffle, after which a
step reads a small table. Each task sums the loss, its gradient and its Hessian over its rows and hands over these few
numbers; the driver solves for the step. The loss is convex and the penalty makes its minimum unique, so six to eight
steps reach it to the last digits, where a quasi-Newton method takes a pass for each of some forty.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoremill.sources.staging import stage

STEPS = 60
MOST_COLLECTED = 1 << 20   # numbers of all tasks that come to the driver as they are; more are added up by Spark
PART = "__part"


def collapsed(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """``features, n0, n1``: distinct rows with the goods and bads that hold them, written."""
    return stage(df.groupBy(*features).agg(F.count_if(F.col(target) == 0).alias("n0"),
                                           F.count_if(F.col(target) == 1).alias("n1")), "regression-cells")


def counted(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """The same columns with every row as it is, for features of many values."""
    return df.select(*features, (F.col(target) == 0).cast("long").alias("n0"), (F.col(target) == 1).cast("long").alias("n1"))


def loss_and_slopes(x: np.ndarray, n0: np.ndarray, n1: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """Loss, goods, bads, gradient and upper triangle of the Hessian, in one row of numbers."""
    x = np.column_stack([np.ones(len(x)), x])
    z = x @ beta
    p = 0.5 * (1 + np.tanh(z / 2))
    n = n0 + n1
    loss = n1 @ np.logaddexp(0, -z) + n0 @ np.logaddexp(0, z)
    hessian = (x * (n * p * (1 - p))[:, None]).T @ x
    return np.concatenate([[loss, n0.sum(), n1.sum()], x.T @ (n * p - n1), hessian[np.triu_indices(len(beta))]])


def _pass(cells: DataFrame, features: Sequence[str], beta: np.ndarray) -> np.ndarray:
    """The sums over all rows."""
    size = 3 + len(beta) + len(beta) * (len(beta) + 1) // 2

    def each(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns]
            if batch.num_rows:
                total += loss_and_slopes(np.column_stack(columns[:-2]), columns[-2], columns[-1], beta)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([total.tolist()])], [PART, "sums"])

    parts = (cells.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)], "n0", "n1")
             .mapInArrow(each, f"{PART} bigint, sums array<double>"))
    if parts.rdd.getNumPartitions() * size <= MOST_COLLECTED:
        rows = sorted(parts.collect(), key=lambda r: r[PART])  # added in one order, so that runs agree
        return np.sum([r["sums"] for r in rows], axis=0) if rows else np.zeros(size)
    total = np.zeros(size)
    for r in parts.select(F.posexplode("sums").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect():
        total[r["i"]] = r["v"]
    return total


def newton(cells: DataFrame, features: Sequence[str], inverse_penalty: float, tolerance: float = 1e-9) -> tuple[np.ndarray, int]:
    """Intercept and coefficients of the L2 logistic regression, and the passes it took.

    The penalty is 1 / ``inverse_penalty`` times half the squared coefficients, added to the summed loss; the
    intercept has none. A step that does not lower the loss is halved. With a single class there is no finite
    intercept: the coefficients are 0 and it is infinite.
    """
    size = len(features) + 1
    ridge = np.concatenate([[0.0], np.full(size - 1, 1.0 / inverse_penalty)])
    at, best, step = np.zeros(size), None, np.zeros(size)
    for passes in range(1, STEPS + 1):
        found = _pass(cells, features, at)
        if not np.isfinite(found).all():
            raise ValueError("a feature is missing or not finite")
        loss, goods, bads = found[:3]
        if not goods or not bads:
            return np.concatenate([[np.inf if bads else -np.inf], np.zeros(size - 1)]), passes
        loss += ridge @ (at * at) / 2
        if best is not None and loss > best[1] + 1e-12 * abs(best[1]):
            step = step / 2
            if np.abs(step).max() <= tolerance * (1 + np.abs(best[0]).max()):
                return best[0], passes
            at = best[0] + step
            continue
        best = at, loss
        slopes = found[3:3 + size] + ridge * at
        hessian = np.zeros((size, size))
        hessian[np.triu_indices(size)] = found[3 + size:]
        hessian += np.triu(hessian, 1).T + np.diag(ridge)
        step = -np.linalg.lstsq(hessian, slopes, rcond=None)[0] if np.linalg.cond(hessian) > 1e14 else -np.linalg.solve(hessian, slopes)
        at = at + step
        if np.abs(step).max() <= tolerance * (1 + np.abs(at).max()):
            return at, passes
    raise RuntimeError(f"the regression has not settled after {STEPS} passes")
