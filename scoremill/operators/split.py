"""Exact stratified split and fixed-size sample by hashing the row key."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoremill.sources.staging import stage, stage_observed

DIGITS = 3             # hash digits looked at in one round: 4,096 buckets per class
SMALL_BUCKET = 50_000  # rows of a bucket that are ranked; a larger one is split by further digits

# The key of frames that have none: a hash of the whole row, then a number of its own.
ROW_KEY = "__row"
_CONTENT = 32


def with_row_key(df: DataFrame) -> DataFrame:
    """A written copy of ``df`` with ``ROW_KEY``, for frames without an identifier.

    Rows are told apart by what they hold; only among equal rows does the order of reading decide, and
    there it makes no difference which of them is taken.
    """
    values = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x00")) for c in df.columns]
    content = F.md5(F.concat_ws("\x1f", *values).cast("binary"))
    return stage(df.withColumn(ROW_KEY, F.concat(
        content, F.monotonically_increasing_id().cast("string"))), "keyed-rows")


def key_hash(key: str, purpose: str, seed: int) -> Column:
    """md5 of the key with a purpose, so that splits and samples are independent. A null key hashes
    like an empty one. A row key's hash is that of its content, then that of its number."""
    def hashed(value: Column) -> Column:
        return F.md5(F.concat(value, F.lit(f"|{purpose}|{seed}")).cast("binary"))
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    if key == ROW_KEY:
        return F.concat(hashed(F.substring(text, 1, _CONTENT)), hashed(text))
    return hashed(text)


def test_sizes(class_counts: Mapping[object, int], share: float) -> dict[object, int]:
    """Test rows per class: ceil(share x rows) in total, training side by largest remainder."""
    total = sum(class_counts.values())
    train = total - math.ceil(share * total)
    exact = {c: n * train / total for c, n in class_counts.items()} if total else {}
    kept = {c: math.floor(v) for c, v in exact.items()}
    order = sorted(exact, key=lambda c: (-(exact[c] - kept[c]), str(c)))
    for c in order[:train - sum(kept.values())]:
        kept[c] += 1
    return {c: n - kept[c] for c, n in class_counts.items()}


def add_split(df: DataFrame, key: str, stratum: str, share: float, seed: int = 42,
              column: str = "is_test") -> DataFrame:
    """Add a boolean test flag with an exact share of every class (M1).

    Rows are ordered by a hash of their key inside each class. Hash buckets are counted to find the one
    where a class is cut, and that bucket is split by further digits until few rows are left to rank.
    The flag itself is then a plain comparison on each row: the data is never shuffled, and any frame
    with the same keys can be flagged again. Rows with equal keys stay together.
    """
    cuts = _cut_points(df, key, stratum, share, seed)
    h = key_hash(key, "split", seed)
    flag = F.lit(False)
    for value, cut in cuts.items():
        flag = F.when(F.col(stratum) == F.lit(value), h <= F.lit(cut)).otherwise(flag)
    return df.withColumn(column, flag)


def _cut_points(df, key, stratum, share, seed, small=None):
    """Per class, the hash of the last test row."""
    # Goods and bads are observed as the hashes are written; other strata are counted.
    hashes = df.select(F.col(stratum).alias("stratum"), key_hash(key, "split", seed).alias("h")).where(F.col("stratum").isNotNull())
    binary = isinstance(df.schema[stratum].dataType, T.IntegralType)
    keyed, seen = stage_observed(hashes, "split-hashes", {"rows": F.count(F.lit(1)), **(
        {k: F.count_if(F.col("stratum") == k) for k in (0, 1)} if binary else {})})
    counts = {k: seen[k] for k in (0, 1) if seen.get(k)}
    if sum(counts.values()) < seen["rows"]:
        counts = {r["stratum"]: r["n"] for r in keyed.groupBy("stratum").agg(F.count(F.lit(1)).alias("n")).collect()}
    width = 2 * _CONTENT if key == ROW_KEY else _CONTENT
    return {c: h for c, (h, _, _) in least_rows(keyed, counts, test_sizes(counts, share), width, small).items()}


def least_rows(keyed: DataFrame, counts: Mapping, wanted: Mapping, width: int, small: int | None = None) -> dict:
    """For each stratum of ``keyed`` (``stratum, h``) the hash of its ``wanted``-th row in hash order, that row's place
    among the rows with the same hash, and how many those are.

    No task holds the wanted rows: buckets are counted by leading digits, and only the one that holds the place is
    looked into further, until few rows are left to rank.
    """
    small = SMALL_BUCKET if small is None else small
    # For each class: the prefix its cut lies in, and the cut row's place among the rows with it.
    open_cuts = {c: ("", n) for c, n in wanted.items() if n > 0}
    sizes = dict(counts)
    depth = 0
    while open_cuts and depth < width and max(sizes[c] for c in open_cuts) > small:
        # At most classes x 4,096 counts reach the driver.
        rows = (_inside(keyed, open_cuts).groupBy("stratum", F.substring("h", depth + 1, DIGITS).alias("next"))
                .agg(F.count(F.lit(1)).alias("n")).collect())
        depth += DIGITS
        passed = dict.fromkeys(open_cuts, 0)
        found = {}
        for r in sorted(rows, key=lambda r: r["next"]):
            c, (prefix, place) = r["stratum"], open_cuts[r["stratum"]]
            before = passed[c]
            passed[c] += r["n"]
            if before < place <= passed[c]:
                found[c], sizes[c] = (prefix + r["next"], place - before), r["n"]
        open_cuts = found
    if not open_cuts:
        return {}
    # Copies of a key collapse first; what is left of a class is one small bucket, or one hash.
    order = (Window.partitionBy("stratum").orderBy("h")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    place = F.coalesce(*[F.when(F.col("stratum") == F.lit(c), F.lit(p)) for c, (_, p) in open_cuts.items()])
    inside = (_inside(keyed, open_cuts).groupBy("stratum", "h").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("through", F.sum("n").over(order)).withColumn("place", place)
              .where((F.col("through") >= place) & (F.col("through") - F.col("n") < place)))
    return {r["stratum"]: (r["h"], r["place"] - (r["through"] - r["n"]), r["n"]) for r in inside.collect()}


def _inside(keyed, open_cuts):
    """The rows whose hash starts with their class's prefix."""
    wanted = F.lit(False)
    for c, (prefix, _) in open_cuts.items():
        wanted = F.when(F.col("stratum") == F.lit(c), F.col("h").startswith(prefix)).otherwise(wanted)
    return keyed.where(wanted)


def fixed_sample(df: DataFrame, key: str, size: int, seed: int = 42) -> DataFrame:
    """``size`` rows (all, if fewer) by hash order (M7).

    The hash of the last row is found first, as for the split; rows are then kept where they lie, so neither the
    sample nor its hashes pass through one task. Of rows with the last row's key as many as are wanted stay, chosen by
    what they hold, and of rows that are equal throughout any.
    """
    if size <= 0:
        return df.limit(0)
    h = key_hash(key, "sample", seed)
    found = _last_row(df, h, size, 2 * _CONTENT if key == ROW_KEY else _CONTENT)
    if found is None:
        return df
    last, place, equal = found
    if place == equal:
        return df.where(h <= last)
    ties, rest = df.where(h == last), df.where(h < last)
    content = F.md5(F.concat_ws("\x1f", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x00")) for c in df.columns]).cast("binary"))
    last, place, equal = _last_row(ties, content, place, _CONTENT)
    rest = rest.unionByName(ties.where(content < last))
    if place == equal:
        return rest.unionByName(ties.where(content == last))
    copies = stage(ties.where(content == last).withColumn(ROW_KEY, F.monotonically_increasing_id()), "equal-rows")
    number = F.md5(F.col(ROW_KEY).cast("string").cast("binary"))
    last, _, _ = _last_row(copies, number, place, _CONTENT)
    return rest.unionByName(copies.where(number <= last).drop(ROW_KEY))


def _last_row(df: DataFrame, h: Column, size: int, width: int) -> tuple[str, int, int] | None:
    """The hash of the ``size``-th row, its place among rows with that hash, and their number; None if there are no more."""
    keyed, seen = stage_observed(df.select(F.lit(0).alias("stratum"), h.alias("h")), "sample-hashes", {"rows": F.count(F.lit(1))})
    if seen["rows"] <= size:
        return None
    return least_rows(keyed, {0: seen["rows"]}, {0: size}, width)[0]
