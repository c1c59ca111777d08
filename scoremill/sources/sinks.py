"""Writing results. Output folders are created by the writers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, first: str | None = None, single_file: bool = False) -> None:
    """CSV with a header (S6); ``first`` moves a key column to the front.

    ``single_file`` suits report tables of a bounded size, never row-level output.
    """
    if first is not None:
        df = df.select(first, *[c for c in df.columns if c != first])
    if single_file:
        df = df.coalesce(1)
    (df.write.mode("overwrite")
     .options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
     .csv(path))


def write_json(record: DataFrame, path: str) -> None:
    """A metric record as JSON."""
    record.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)
