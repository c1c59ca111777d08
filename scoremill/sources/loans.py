"""Reading loan files and checking them."""

from __future__ import annotations

import csv
import itertools
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoremill.functions.expressions import NUMBER
from scoremill.sources.staging import stage_observed
from scoremill.spec import IDENTIFIER_COLUMNS, REQUIRED_COLUMNS

# Text that stands for a missing value in a loan file.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def resolve_source(spark: SparkSession, *candidates: tuple[str, str]) -> tuple[str, str]:
    """The first ``(mode, path)`` whose path exists."""
    for mode, path in candidates:
        try:
            spark.read.text(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        else:
            return mode, path
    places = ", ".join(f"{mode}: {path}" for mode, path in candidates)
    raise FileNotFoundError(f"no loan file found ({places})")


def read_loans_csv(spark: SparkSession, path: str, numeric: Iterable[str] | None = None,
                   integers: Iterable[str] = IDENTIFIER_COLUMNS, multi_line: bool = False,
                   refused_limit: int = 0, quarantine: str | None = None) -> DataFrame:
    """Scan a loan CSV with a header.

    The files are read once: lines are cut into fields and written as columns of text, and whether each value of a
    column is a number is observed on the way. A column is numeric if all its values are written as numbers are (digits,
    a point, an exponent, or infinity; not ``1D`` or ``0x1p3``); with ``numeric`` given, those columns are, and what
    is no number is missing. Identifiers of whole numbers are whole numbers. Later passes read the columns they need.

    A name that comes again in the header gets ``.1``, ``.2`` and so on, a blank one is ``Unnamed:`` and its place.

    Files whose header differs are refused. Rows with more or fewer fields than the header, or with a quote left open,
    are refused: more than ``refused_limit`` of them end the scan, fewer are left out and written to ``quarantine``,
    if that is given, as ``file, line, text``. With ``multi_line`` quoted text may hold line breaks; files are then
    read whole by one task each, and any such row ends the scan.
    """
    header, raw_names = _header(spark, path)
    names = pandas_names(raw_names)
    whole = [c for c in names if c in set(integers)]
    kinds = {c: "bigint" if c in whole else "double" for c in (names if numeric is None else {*numeric, *whole}) if c in names}
    if multi_line:
        texts, numbers = _read_multi_line(spark, path, raw_names, names, kinds)
    else:
        texts, numbers = _read_lines(spark, path, raw_names, names, kinds, refused_limit, quarantine)
    found = kinds if numeric is not None else {c: k for c, k in kinds.items() if numbers[c]}
    return texts.select(*[_as(found[c], F.col(f"`{c}`")).alias(c) if c in found else F.col(f"`{c}`") for c in names])


def _header(spark: SparkSession, path: str) -> tuple[str, list[str]]:
    """The first line of one file, and its fields."""
    first = (F.col("_metadata.file_block_start") == 0) & (F.trim("value") != "")
    lines = spark.read.text(path).where(first).select("value").take(1)
    if not lines:
        raise ValueError(f"no header in {path}")
    line = lines[0]["value"].removeprefix("\ufeff")
    return line, next(csv.reader([line]))


def pandas_names(names: Sequence[str]) -> list[str]:
    """Column names of a header: blank ones by place, repeated ones numbered past every name of the header."""
    wanted = [name or f"Unnamed: {i}" for i, name in enumerate(names)]
    out: list[str] = []
    for name in wanted:
        taken = {*wanted, *out}
        numbered = (f"{name}.{k}" for k in itertools.count(1))
        out.append(name if name not in out else next(n for n in numbered if n not in taken))
    return out


def plain_names(df: DataFrame) -> DataFrame:
    """Names without points, which the operators would take for fields of a struct: ``x.1`` becomes ``x_1``."""
    out: list[str] = []
    for c in df.columns:
        name = c.replace(".", "_")
        while name in out or name != c and name in df.columns:
            name += "_"
        out.append(name)
    return df.toDF(*out)


def is_number(column: Column) -> Column:
    """Whether text is written as a number is in a data file."""
    return column.rlike(NUMBER)


def _as(kind: str, column: Column) -> Column:
    return F.when(is_number(column), F.trim(column).try_cast(kind))


def _not(kind: str, column: Column) -> Column:
    """How many values are no such numbers."""
    return F.count_if(column.isNotNull() & _as(kind, column).isNull())


def _read_lines(spark, path, raw_names, names, kinds, limit, quarantine):
    """The fields of every row as written text without missing tokens, and which columns hold numbers alone."""
    fields = [f"f{i}" for i in range(len(names))]
    schema = ", ".join(f"{f} string" for f in [*fields, "bad"])
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"}
    lines = spark.read.text(path).select(
        F.regexp_replace("value", "^\ufeff", "").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    cut = lines.select("*", F.from_csv("line", F.lit(schema), options).alias("r")).select("line", "file", "block", "at", "r.*")
    given = F.array(*[F.coalesce(F.col(f), F.lit("")) for f in fields])
    marked = cut.select(
        "file", "block", "at", "line", *fields, (F.trim("line") == "").alias("blank"),
        ((F.col("block") == 0) & (given == F.array(*[F.lit(c) for c in raw_names]))).alias("titles"),
        (F.col("bad").isNotNull() | _open_quote(F.col("line"))).alias("refused"))
    row = ~F.col("blank") & ~F.col("titles") & ~F.col("refused")
    kept = marked.select(
        "file", "block", "at", "titles", "blank", (F.col("refused") & ~F.col("blank")).alias("refused"),
        F.when(F.col("refused") & ~F.col("blank"), F.col("line")).alias("line"),
        *[F.when(~F.col(f).isin(list(MISSING_TOKENS)), F.col(f)).alias(f) for f in fields])
    place = dict(zip(names, fields))
    staged, seen = stage_observed(kept, "csv-text", {
        "refused": F.count_if("refused"), **{c: _not(k, F.when(row, F.col(place[c]))) for c, k in kinds.items()}})
    # The first line of every file has to be the titles; a later line that repeats them is a row like any other.
    first = staged.where(~F.col("blank")).groupBy("file").agg(F.min_by("titles", F.struct("block", "at")).alias("titled"), F.count_if("titles").alias("n"))
    files = first.agg(F.min(F.when(~F.col("titled"), F.col("file"))).alias("other"), F.max("n").alias("n")).first()
    if files["other"] is not None:
        raise ValueError(f"the header of {files['other']} differs")
    if seen["refused"]:
        _quarantined(staged, seen["refused"], limit, quarantine)
    rows = staged.where(~F.col("blank") & ~F.col("refused"))
    if files["n"] == 1:
        rows = rows.where(~F.col("titles"))
    else:
        tops = staged.where("titles").groupBy("file").agg(F.min("at").alias("at")).select("at")
        rows = rows.join(tops, "at", "left_anti")
        seen = dict.fromkeys(kinds, 1)  # the titles are text in every column
    return rows.select(*[F.col(f).alias(c) for c, f in place.items()]), {c: not seen[c] for c in kinds}


def _open_quote(line: Column) -> Column:
    """Whether the line ends inside a quoted field: the field goes on in the next line."""
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    return (quotes % 2 == 1) & line.rlike(r'^(?:(?:"(?:[^"]++|"")*+"[^,]*+|[^",][^,]*+|),)*+"(?:[^"]++|"")*+$')


def _quarantined(staged: DataFrame, refused: int, limit: int, quarantine: str | None) -> None:
    """Writes the refused rows with file and line, or ends the scan where there are more than ``limit``.

    Lines are counted per block of a file; a block's first line is the sum of the blocks before it.
    """
    blocks = staged.groupBy("file", "block").agg(F.min("at").alias("start"), F.count(F.lit(1)).alias("lines"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("lines").over(before), F.lit(0))).drop("lines")
    rows = (staged.where("refused").join(blocks, ["file", "block"])
            .select("file", (F.col("before") + F.col("at") - F.col("start") + 1).alias("line"), F.col("line").alias("text")))
    if refused > limit:
        some = "; ".join(f"{r['file']} line {r['line']}" for r in rows.orderBy("file", "line").limit(3).collect())
        raise ValueError(f"{refused} MALFORMED rows, {limit} allowed: {some}")
    if quarantine:
        rows.write.mode("overwrite").parquet(quarantine)


def _read_multi_line(spark, path, raw_names, names, kinds):
    """The same of files whose quoted text holds line breaks. Their header has to be free of repeated names."""
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": True}
    texts = T.StructType([T.StructField(c, T.StringType()) for c in raw_names])
    raw = normalise_missing(
        spark.read.schema(texts).options(**options, mode="FAILFAST", enforceSchema=False, columnPruning=False).csv(path))
    staged, seen = stage_observed(raw.toDF(*names), "csv-text", {c: _not(k, F.col(f"`{c}`")) for c, k in kinds.items()})
    return staged, {c: not seen[c] for c in kinds}


def read_loans_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Scan a columnar loan table."""
    return normalise_missing(spark.read.parquet(path))


def normalise_missing(df: DataFrame, tokens: Sequence[str] = MISSING_TOKENS) -> DataFrame:
    """NaN and the missing tokens become null, in one projection."""
    def clean(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return F.when(~F.isnan(column), column).alias(field.name)
        if isinstance(field.dataType, T.StringType):
            return F.when(~column.isin(list(tokens)), column).alias(field.name)
        return column
    return df.select(*[clean(field) for field in df.schema])


def missing_columns(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> list[str]:
    have = set(df.columns)
    return [c for c in required if c not in have]


def require_columns(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> None:
    """Fail if a required column is absent."""
    absent = missing_columns(df, required)
    if absent:
        raise ValueError(f"missing columns: {absent}")


def probe(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS, rows: int = 5) -> DataFrame:
    """Check the columns, then show the first rows of them."""
    require_columns(df, required)
    return df.select(*required).limit(rows)
