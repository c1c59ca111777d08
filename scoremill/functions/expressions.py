"""Column expressions shared by the operators; all run in the JVM."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_number(column: Column) -> Column:
    """The column as a double with NaN read as missing."""
    return F.nanvl(column.cast("double"), F.lit(None).cast("double"))


#: How numbers are written in data files. Java's parser would also take ``1D``, ``2f`` and ``0x1p3``.
NUMBER = r"^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity))\s*$"


def parse_number(column: Column) -> Column:
    """Text to double, null where it is no number (P15). ANSI ``cast`` would fail the job."""
    return F.when(column.rlike(NUMBER), F.trim(column).try_cast("double"))


def interval_value(x: Column, cuts: Sequence[float], leaves: Sequence) -> Column:
    """``leaves[i]`` for the i-th right-closed interval between ``cuts`` that holds ``x``.

    The caller handles a null ``x``.
    """
    return balanced([lambda c=c: x <= F.lit(c) for c in cuts], [F.lit(v) for v in leaves])


def balanced(tests: Sequence[Callable[[], Column]], leaves: Sequence[Column]) -> Column:
    """The leaf chosen by ordered tests, of which each says "at or below boundary i".

    A balanced tree: log2(tests) comparisons per row, no lambda and no lookup array.
    """
    if not tests:
        return leaves[0]
    mid = len(tests) // 2
    return (F.when(tests[mid](), balanced(tests[:mid], leaves[:mid + 1]))
            .otherwise(balanced(tests[mid + 1:], leaves[mid + 1:])))


def sigmoid(z: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-z))


def linear(intercept: float, terms: Sequence[tuple[Column, float]]) -> Column:
    """``intercept + Σ coefficient · column`` in a fixed order, so equal rows score equally."""
    total = F.lit(float(intercept))
    for column, coefficient in terms:
        total = total + column * F.lit(float(coefficient))
    return total
