"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoremill.llm.common import stage


def _to_least(both: DataFrame) -> DataFrame:
    """Of edges (u, v) seen from u: each v with the least of u and its neighbours."""
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least"))
    return both.join(least, "u")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component``: every node of ``edges`` but the least of its component, with that least one.

    Each round connects neighbours to the least one, first those above a node and then those below it;
    the number of rounds grows with the logarithm of a component's diameter. Rounds are written out by
    one task a core, so that no lineage and no heap of small files grows. Self-loops and null ends are
    ignored.
    """
    cores = edges.sparkSession.sparkContext.defaultParallelism
    now = stage(edges.filter(F.col(a) != F.col(b))
                .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct().coalesce(cores), "edges")
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_to_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
                 .filter("u != v"))
        down = _to_least(large)
        small = (down.select(F.col("v").alias("u"), F.col("least").alias("v"))
                 .unionByName(down.select("u", F.col("least").alias("v"))).filter("u != v").distinct())
        now = stage(small.coalesce(cores), "edges")
