"""Near duplicates by an inverted join of signature coordinates.

1. A text's signature holds, for each of ``COORDINATES`` hash functions, the least hash of its shingles. Texts
   with one set of shingles become one class at once.
2. Every class is posted under each of its (coordinate, value) pairs. Pairs that only one class has are dropped;
   a class with fewer than ``THRESHOLD`` left can match no other.
3. Two classes that agree in ``THRESHOLD`` coordinates must share one of the rarest that are left after their
   ``THRESHOLD - 1`` commonest are skipped (one order for all). Only those lists are merged; collisions are then
   counted over the whole signatures. Long lists are dealt out as pairs of blocks. Each merge returns no more
   edges than it takes to connect what agrees, so nothing grows with the pairs of a group.
4. Within each group so connected, links are confirmed on the full sets, block against block: first every block
   by itself and with the first one, then what those links have not joined yet.

With 64 coordinates and a threshold of 38 a link of similarity 0.85 is missed less than once in six million.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoremill.llm.common import in_arrow, stage
from scoremill.llm.components import components
from scoremill.llm.words import mix, random_numbers, shingles, slices, words_of
from scoremill.sources.staging import setting

COORDINATES = 64
THRESHOLD = 38
WIDTH = 5
LINK = (85, 100)
LIST_BLOCK = 2048
SET_BLOCK = 256
ARROW_ROWS = 1000        # of texts, signatures or sets that a task hands to Python at once
SLICE_BYTES = 1 << 20    # of texts looked at together
_CHUNK = 2048

_factors = random_numbers(COORDINATES, 4242) | np.uint64(1)
_tags = random_numbers(COORDINATES, 777)


# --- signatures -----------------------------------------------------------------------------

def signature(found: np.ndarray) -> np.ndarray:
    """For each coordinate the least hash of a set of shingles, marked with the coordinate."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for a in range(0, len(found), _CHUNK):
        np.minimum(least, (found[a:a + _CHUNK][None, :] * _factors[:, None]).min(axis=1), out=least)
    return mix(least ^ _tags)


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """Each text's sorted distinct shingle hashes; empty without words."""
    words = words_of(texts)
    hashes = words.hashes()
    for a, b in zip(words.first, words.first[1:]):
        yield np.unique(shingles(hashes[a:b], WIDTH))


def _set_hash(found: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        return int(found.sum(dtype=np.uint64)), int(mix(found ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))


def signatures(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``doc_id, n_shingles, set_a, set_b, signature`` of every row; 128 bits name the set."""
    def each(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        for part in slices(batch, "text", SLICE_BYTES):
            n, names, rows = [], [], []
            for found in shingle_sets(part.column("text")):
                n.append(len(found))
                names.append(_set_hash(found))
                if len(found):
                    rows.append(signature(found))
            names = np.array(names, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            ends = np.concatenate([[0], np.cumsum(np.array(n) > 0)]) * COORDINATES
            flat = np.concatenate(rows).view(np.int64) if rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(names[:, 0].copy()), pa.array(names[:, 1].copy()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                ["doc_id", "n_shingles", "set_a", "set_b", "signature"])
    narrow = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return in_arrow(narrow, each, f"doc_id {dict(narrow.dtypes)['doc_id']}, n_shingles bigint, set_a bigint, "
                                  "set_b bigint, signature array<bigint>")


# --- inverted join --------------------------------------------------------------------------

def prefixes(classes: DataFrame, threshold: int) -> DataFrame:
    """``rep, key``: the postings that have to be merged, of the classes that can match any other."""
    posted = classes.select("rep", F.explode("signature").alias("key"))
    shared = posted.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    kept = (posted.join(shared, "key").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("left"))
            .filter(F.size("left") >= threshold))
    return kept.select("rep", F.explode(F.slice("left", F.lit(1), F.size("left") - (threshold - 1))).alias("p")).select("rep", "p.key")


def _cells(members: DataFrame, group: str, block: str) -> DataFrame:
    """Deals each group's blocks out as pairs ``(i, j)``, i <= j; one alone is the pair (0, 0).

    Every row needs ``blocks``, how many its group has. A row of block b goes to the pairs it is part of; with
    several blocks, a block meets itself within the pairs with others.
    """
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: (x != F.col(block)) | (F.col("blocks") == 1))
    return (members.withColumn("other", F.explode(others))
            .withColumn("i", F.least(block, "other")).withColumn("j", F.greatest(block, "other")).drop("other"))


class _Sets:
    """Disjoint sets over positions."""

    def __init__(self, size: int):
        self.parent, self.count = list(range(size)), size

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.parent[max(x, y)] = min(x, y)
        self.count -= 1
        return True


def agreeing(matrix: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Edges that connect the rows which agree in ``threshold`` places; stops once all are connected."""
    joined, edges = _Sets(len(matrix)), []
    for i in range(len(matrix) - 1):
        if joined.count == 1:
            break
        same = (matrix[i + 1:] == matrix[i]).sum(axis=1)
        for j in np.flatnonzero(same >= threshold):
            if joined.join(i, i + 1 + int(j)):
                edges.append((i, i + 1 + int(j)))
    return edges


def _runs(batches: Iterable[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """Whole runs of equal ``by`` values, of sorted batches; only the open run is held."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        part = pa.Table.from_batches([batch])
        columns = [np.asarray(part.column(c)) for c in by]
        new = np.zeros(part.num_rows, dtype=bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(new).tolist(), part.num_rows]
        if held and any(held[-1].column(c)[-1].as_py() != v[0] for c, v in zip(by, columns)):
            yield pa.concat_tables(held)
            held = []
        for a, b in zip(starts, starts[1:]):
            if a:
                yield pa.concat_tables(held)
                held = []
            held.append(part.slice(a, b - a))
    if held:
        yield pa.concat_tables(held)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([np.asarray(c.flatten()) for c in column.chunks]).reshape(len(column), -1)


def candidate_edges(classes: DataFrame, threshold: int, block: int) -> DataFrame:
    """``a, b``: edges that connect all classes which agree in ``threshold`` coordinates, directly or not."""
    merged = stage(prefixes(classes, threshold), "prefixes")
    lists = merged.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    dealt = _cells(merged.join(lists, "key").withColumn("blocks", blocks)
                   .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")), "key", "block")
    cells = (dealt.select("key", "i", "j", "rep").join(classes.select("rep", "signature"), "rep")
             .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j"))
    kind = dict(classes.dtypes)["rep"]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for run in _runs(batches, ["key", "i", "j"]):
            edges = agreeing(_matrix(run.column("signature")), threshold)
            if edges:
                reps = run.column("rep").combine_chunks()
                yield pa.RecordBatch.from_arrays([reps.take(pa.array([x[k] for x in edges], pa.int64())) for k in (0, 1)], ["a", "b"])
    return cells.mapInArrow(each, f"a {kind}, b {kind}")


# --- confirmation on full sets --------------------------------------------------------------

def confirmed(sets: list[np.ndarray], matrix: np.ndarray, groups: np.ndarray, threshold: int,
              link: tuple[int, int] = LINK) -> list[tuple[int, int]]:
    """Links that connect all linked rows, each confirmed on the full sets.

    Pairs are tried in order of agreement; a pair that is connected already needs no test. Rows of
    one group count as connected.
    """
    joined, first = _Sets(len(sets)), {}
    for i, g in enumerate(groups.tolist()):
        joined.join(first.setdefault(g, i), i)
    sizes, pairs = np.array([len(s) for s in sets]), []
    for i in range(len(sets) - 1):
        same = (matrix[i + 1:] == matrix[i]).sum(axis=1)
        other = sizes[i + 1:]
        able = (same >= threshold) & (groups[i + 1:] != groups[i]) & (
            link[1] * np.minimum(other, sizes[i]) >= link[0] * np.maximum(other, sizes[i]))
        found = np.flatnonzero(able)
        if len(found):
            pairs.append(np.column_stack([np.full(len(found), i), found + i + 1, same[found]]))
    out = []
    if pairs:
        every = np.concatenate(pairs)
        for i, j, _ in every[np.argsort(-every[:, 2], kind="stable")].tolist():
            if joined.count == 1:
                break
            if joined.find(i) != joined.find(j):
                small, large = sorted((sets[i], sets[j]), key=len)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                common = int((large[at] == small).sum())
                if link[1] * common >= link[0] * (len(small) + len(large) - common):
                    joined.join(i, j)
                    out.append((i, j))
    return out


def _confirm(cells: DataFrame, kind: str, threshold: int, link: tuple[int, int]) -> DataFrame:
    """Links within each cell ``(cluster, i, j)`` of rows ``rep, joined, members``."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for run in _runs(batches, ["cluster", "i", "j"]):
            reps = run.column("rep").combine_chunks()
            order = np.argsort(np.asarray(reps), kind="stable")
            keep = order[np.concatenate([[True], np.diff(np.asarray(reps)[order]) != 0])]
            run, reps = run.take(pa.array(keep)), reps.take(pa.array(keep))
            sets = [np.frombuffer(x.as_py(), dtype=np.uint64) for x in run.column("members")]
            matrix = np.array([signature(s) for s in sets])
            links = confirmed(sets, matrix, np.asarray(run.column("joined")), threshold, link)
            if links:
                yield pa.RecordBatch.from_arrays([reps.take(pa.array([x[k] for x in links], pa.int64())) for k in (0, 1)], ["a", "b"])
    dealt = cells.select("cluster", "i", "j", "rep", "joined", "members")
    return (dealt.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
            .mapInArrow(each, f"a {kind}, b {kind}"))


def _member_sets(docs: DataFrame, members: DataFrame) -> DataFrame:
    """``rep, cluster, n_shingles, members``: the full sets of the classes in a cluster."""
    def each(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        for part in slices(batch, "text", SLICE_BYTES):
            wanted = np.asarray(part.column("set_a"))
            sets = list(shingle_sets(part.column("text")))
            keep = [i for i, s in enumerate(sets) if np.uint64(_set_hash(s)[0]).astype(np.int64) == wanted[i]]
            rows = part.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [rows.column("rep"), rows.column("cluster"), rows.column("n_shingles"),
                 pa.array([sets[i].tobytes() for i in keep], pa.binary())], ["rep", "cluster", "n_shingles", "members"])
    kind = dict(members.dtypes)["rep"]
    joined = members.join(docs.withColumnRenamed("doc_id", "rep"), "rep").select("rep", "cluster", "n_shingles", "set_a", "text")
    return in_arrow(joined, each, f"rep {kind}, cluster {kind}, n_shingles bigint, members binary")


def _blocks(rows: DataFrame, size: int, *group: str) -> DataFrame:
    """Deals the rows of each group to ``blocks`` blocks of about ``size`` rows, by hash: nothing is sorted."""
    sizes = (rows.groupBy(*[F.col(g).alias(f"of_{g}") for g in group])
             .agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("blocks")))
    same = [F.col(g).eqNullSafe(F.col(f"of_{g}")) for g in group]
    return (rows.join(sizes, same).drop(*[f"of_{g}" for g in group])
            .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("bigint")))


def links(docs: DataFrame, classes: DataFrame, threshold: int, link: tuple[int, int]) -> DataFrame:
    """``a, b``: confirmed links that connect all linked classes."""
    kind = dict(classes.dtypes)["rep"]
    grouped = components(candidate_edges(classes, threshold, LIST_BLOCK), "a", "b")
    heads = grouped.select(F.col("component").alias("node"), "component").distinct()
    clusters = grouped.unionByName(heads).select(F.col("node").alias("rep"), F.col("component").alias("cluster"))
    members = classes.select("rep", "n_shingles", "set_a").join(clusters, "rep")
    sets = stage(_member_sets(docs, members), "sets")
    narrow = sets.select("rep", "cluster")

    first = _blocks(narrow, SET_BLOCK, "cluster")
    others = (F.when((F.col("block") == 0) & (F.col("blocks") > 1), F.sequence(F.lit(1).cast("bigint"), F.col("blocks").cast("bigint") - 1))
              .otherwise(F.array("block")))
    star = (first.withColumn("j", F.explode(others)).withColumn("i", F.lit(0).cast("bigint")).withColumn("joined", F.col("rep"))
            .select("rep", "cluster", "i", "j", "joined").join(sets.select("rep", "members"), "rep"))
    found = stage(_confirm(star, kind, threshold, link), "links")

    joined = components(found, "a", "b")
    labelled = (narrow.join(joined.withColumnRenamed("node", "rep"), "rep", "left")
                .withColumn("joined", F.coalesce("component", "rep")).drop("component"))
    several = (first.filter("blocks > 1").select("rep").join(labelled, "rep").groupBy("cluster")
               .agg(F.min("joined").alias("low"), F.max("joined").alias("high")).filter(F.col("low") != F.col("high")).select("cluster"))
    still_open = stage(labelled.join(several, "cluster", "left_semi"), "open")
    # what is joined already and fills blocks of its own need not meet itself again; the rest is pooled
    large = still_open.groupBy("cluster", "joined").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > SET_BLOCK)
    pooled = still_open.join(large.select("cluster", "joined", F.col("joined").alias("pool")), ["cluster", "joined"], "left")
    open_rows = stage(_blocks(pooled, SET_BLOCK, "cluster", "pool").withColumn("block", F.xxhash64("pool", "block")), "open")
    groups = open_rows.groupBy("cluster", "block").agg(F.min("joined").alias("low"), F.max("joined").alias("high"))
    left = groups.select("cluster", F.col("block").alias("i"), F.col("low").alias("i_low"), F.col("high").alias("i_high"))
    right = groups.select("cluster", F.col("block").alias("j"), F.col("low").alias("j_low"), F.col("high").alias("j_high"))
    crossing = (left.join(right, "cluster").filter("i < j AND (i_low != i_high OR j_low != j_high OR i_low != j_low)")
                .select("cluster", "i", "j"))
    dealt = (crossing.withColumn("block", F.explode(F.array("i", "j"))).join(open_rows, ["cluster", "block"])
             .select("rep", "cluster", "i", "j", "joined").join(sets.select("rep", "members"), "rep"))
    return found.unionByName(_confirm(dealt, kind, threshold, link))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = THRESHOLD,
                    link: tuple[int, int] = LINK) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    A null text, or one without words, has no shingles and no links; its component is itself. Rows that repeat an
    identifier are answered one by one. A null identifier never names a component: a class of such rows alone
    has a null one and keeps them. No rows give no rows; other columns are not read.
    """
    with setting(docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS)):
        return _near_duplicates(docs, key, text, threshold, link)


def _near_duplicates(docs: DataFrame, key: str, text: str, threshold: int, link: tuple[int, int]) -> DataFrame:
    """All that runs in Python is written out here, so the size of its batches holds for it."""
    narrow = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    signed = stage(signatures(narrow, "doc_id", "text"), "signatures")
    name = ["n_shingles", "set_a", "set_b"]
    # rows of one class have one signature, so any of them will do
    classes = stage(signed.filter("n_shingles > 0").groupBy(*name).agg(
        F.min("doc_id").alias("rep"), F.first("signature").alias("signature")), "classes")
    known = classes.filter("rep IS NOT NULL")
    joined = components(links(narrow, known, threshold, link), "a", "b")
    labels = stage(classes.select(*name, "rep").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
                   .select(*name, F.coalesce("component", "rep").alias("component_id")), "labels")
    found = signed.select("doc_id", *name).join(labels, name, "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"),
                        F.col("doc_id").eqNullSafe(component).alias("kept"))


ORACLE_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g)
  WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reached AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reached r JOIN both_ways l ON r.b = l.a),
least_one AS (SELECT a, min(b) AS b FROM reached GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(l.b, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(l.b, d.doc_id)) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least_one l ON l.a = d.doc_id
"""
