"""Choosing columns by name and type. Metadata only: nothing here starts a job."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns in schema order, minus ``exclude``."""
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """String columns in schema order, minus ``exclude``."""
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in skip]


def present(df: DataFrame, wanted: Iterable[str]) -> list[str]:
    """The wanted columns the frame has, in the wanted order (P10)."""
    have = set(df.columns)
    return [c for c in wanted if c in have]


def in_groups(items: list, size: int) -> list[list]:
    return [items[i:i + size] for i in range(0, len(items), size)]
