"""Bins: right-closed intervals, raw values of columns with few of them, or categories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoremill.functions.aggregates import scalars
from scoremill.functions.expressions import as_number, interval_value
from scoremill.operators.quantiles import exact_quantiles

SKETCH_ERROR = 0.05   # relative standard deviation of the distinct-count sketch
SKETCH_MARGIN = 0.5   # estimates this far from a limit decide alone: 10 deviations


@dataclass(frozen=True)
class Bins:
    """How one feature is cut. ``cuts`` are the inner edges of an interval feature."""

    feature: str
    kind: str                        # interval | value | category
    cuts: tuple[float, ...] = ()

    def index(self, x: Column) -> Column:
        """0-based interval of a value without NaN, null for a missing one."""
        return F.when(x.isNotNull(), interval_value(x, self.cuts, list(range(len(self.cuts) + 1))))

    def bounds(self) -> list[tuple[float, float]]:
        edges = [float("-inf"), *self.cuts, float("inf")]
        return list(zip(edges[:-1], edges[1:]))


@dataclass(frozen=True)
class Sketch:
    """Row count, and per column the non-null values and the estimated distinct ones."""

    rows: int
    present: Mapping[str, int]      # non-null values
    distinct: Mapping[str, int]

    def surely_over(self, name: str, limit: int) -> bool:
        return self.distinct[name] > limit * (1 + SKETCH_MARGIN) + 3

    def surely_within(self, name: str, limit: int) -> bool:
        return self.distinct[name] < limit * (1 - SKETCH_MARGIN) - 3


def _value(df: DataFrame, name: str) -> Column:
    """The column, with NaN read as missing."""
    numeric = isinstance(df.schema[name].dataType, T.NumericType)
    return as_number(F.col(name)) if numeric else F.col(name)


def sketch_totals(df: DataFrame, names: Sequence[str]) -> dict[tuple, Column]:
    """The aggregates of a sketch, a bounded buffer per column; they may be observed while ``df`` is written."""
    return {("rows", None): F.count(F.lit(1)), **{
        (label, c): f(_value(df, c)) for c in names for label, f in (
            ("present", F.count), ("distinct", lambda x: F.approx_count_distinct(x, SKETCH_ERROR)))}}


def sketch_of(found: Mapping[tuple, float], names: Sequence[str]) -> Sketch:
    return Sketch(int(found["rows", None]), {c: int(found["present", c]) for c in names},
                  {c: int(found["distinct", c]) for c in names})


def sketch_columns(df: DataFrame, names: Sequence[str]) -> Sketch:
    """One job over the columns."""
    return sketch_of(scalars(df, sketch_totals(df, names)), names)


def few_distinct(df: DataFrame, limits: Mapping[str, int], sketch: Sketch | None = None) -> dict[str, bool]:
    """Whether each column has at most its limit of distinct non-null values.

    The sketch settles the clear cases; only columns estimated near the limit are counted
    exactly, and those hold few distinct values by construction.
    """
    if not limits:
        return {}
    sketch = sketch or sketch_columns(df, list(limits))
    verdict = {c: False for c, limit in limits.items() if sketch.surely_over(c, limit)}
    verdict.update({c: True for c, limit in limits.items() if sketch.surely_within(c, limit)})
    unclear = [c for c in limits if c not in verdict]
    if unclear:
        exact = df.agg(*[F.size(F.collect_set(_value(df, c))).alias(f"d{i}") for i, c in enumerate(unclear)]).first()
        verdict.update({c: exact[f"d{i}"] <= limits[c] for i, c in enumerate(unclear)})
    return verdict


def quantile_edges(df: DataFrame, names: Sequence[str], max_bins: int = 10,
                   method: str = "quantile", **options) -> dict[str, list[float]]:
    """All edges per column, outer ones included, duplicates dropped."""
    if method == "equal_width":
        ends = df.agg(*[F.min(as_number(F.col(c))).alias(f"a{i}") for i, c in enumerate(names)],
                      *[F.max(as_number(F.col(c))).alias(f"b{i}") for i, c in enumerate(names)]).first()
        edges = {}
        for i, c in enumerate(names):
            low, high = ends[f"a{i}"], ends[f"b{i}"]
            if low is not None:
                width = (high - low) / max_bins
                edges[c] = sorted({low + k * width for k in range(max_bins)} | {high})
        return edges
    if method != "quantile":
        raise ValueError(f"unknown edge method {method!r}")
    probs = [k / max_bins for k in range(max_bins + 1)]
    found = exact_quantiles(df, {c: F.col(c) for c in names}, probs, **options)
    return {c: sorted(set(q)) for c, q in found.items() if q is not None}


def edges_table(df: DataFrame, names: Sequence[str], **options) -> DataFrame:
    """The edges as rows ``(feature, edge_no, edge)``."""
    rows = [(c, i, e) for c, edges in quantile_edges(df, names, **options).items()
            for i, e in enumerate(edges)]
    return df.sparkSession.createDataFrame(rows, "feature string, edge_no int, edge double")


def fit_bins(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], max_bins: int = 10,
             max_categories: int = 100, method: str = "quantile", sketch: Sketch | None = None,
             known_edges: Mapping[str, Sequence[float]] | None = None, **options) -> list[Bins]:
    """Decide the bins of every feature; categories over the limit are left out.

    ``sketch`` may stem from the same frame before its missing values were filled, and
    ``known_edges`` saves the pass for columns whose edges are at hand.
    """
    limits = {**{c: max_bins for c in numeric}, **{c: max_categories for c in categorical}}
    few = few_distinct(df, limits, sketch)
    edges = dict(known_edges or {})
    spread = [c for c in numeric if not few[c] and c not in edges]
    if spread:
        edges.update(quantile_edges(df, spread, max_bins, method, **options))
    bins = [Bins(c, "value") if few[c] else Bins(c, "interval", tuple(edges[c][1:-1])) for c in numeric]
    return bins + [Bins(c, "category") for c in categorical if few[c]]
