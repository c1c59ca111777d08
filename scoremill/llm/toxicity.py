"""Toxicity as an ordinal regression on sparse text features.

A cumulative-link (proportional odds) model: P(grade > k) = logistic(w . x - theta_k), with one weight per
feature shared by all thresholds. Features are the presence of words and of the first 6 and 8 bytes of longer
ones, as 64-bit hashes, so a vocabulary is never gathered. Severity is the expected grade, the sum of P(grade > k).

The model is fitted on at most ``SAMPLE`` labelled texts, one for each of the smallest hashed identifiers. Features are
what is clearly commoner in toxic or in clean texts; the sample bounds their number. A text without any is taken
for clean, as if as many clean texts had none. Labels say toxic or not; a toxic text with ``SEVERE`` or more distinct marker words is graded 2, another one 1. A marker
word is a word of which any feature is in the model, however many are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoremill.llm.common import in_arrow
from scoremill.llm.words import LETTERS, Words, random_numbers, slices, words_of

SAMPLE = 12_000
SEVERE = 3
SETTLED = 1e-6           # of the loss, in ten rounds
REJECTED = 0.5
SLICE_BYTES = 1 << 20    # of texts looked at together
PREFIXES = (None, 6, 8)

_kinds = random_numbers(len(PREFIXES), 99)


@dataclass(frozen=True)
class Model:
    features: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    thresholds: np.ndarray = field(default_factory=lambda: np.array([20.0, 21.0]))

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k), a column for each threshold."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds[None, :], -500, 500)))


def _features(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind of feature, the words that have it and its hashes; only longer words have a prefix."""
    lengths = words.ends - words.starts
    for kind, length in zip(_kinds, PREFIXES):
        having = np.arange(len(words)) if length is None else np.flatnonzero(lengths > length)
        yield having, words.prefix_hashes(length)[having] ^ kind


def _found(texts: pa.Array, features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, Words]:
    """Text, word and feature of each occurrence of the sorted features, and all words."""
    words = words_of(texts, LETTERS)
    owner = np.repeat(np.arange(len(texts)), words.counts)
    where, which = [], []
    for having, ids in _features(words):
        at = np.minimum(np.searchsorted(features, ids), max(len(features) - 1, 0))
        hit = features[at] == ids if len(features) else np.zeros(len(ids), dtype=bool)
        where.append(having[hit])
        which.append(at[hit])
    word, feature = np.concatenate(where), np.concatenate(which)
    return owner[word], word, feature, words


def present(texts: pa.Array, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) pairs, each once, of the sorted features that occur in the texts."""
    text, _, feature, _ = _found(texts, features)
    pairs = np.unique(text * max(len(features), 1) + feature)
    return pairs // max(len(features), 1), pairs % max(len(features), 1)


def _sample(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """``text, toxic`` of the labelled identifiers whose hashes are smallest; of rows that share one, the least text."""
    chosen = (labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id")
              .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    return (docs.select("doc_id", "text").filter("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")
            .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic"))


def _candidates(sample: DataFrame, least: int) -> np.ndarray:
    """Features of at least ``least`` texts of the sample."""
    def each(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        for part in slices(batch, "text", SLICE_BYTES):
            words = words_of(part.column("text"), LETTERS)
            owner, out = np.repeat(np.arange(part.num_rows), words.counts), []
            for having, ids in _features(words):
                order = np.lexsort((ids, owner[having]))
                ids, own = ids[order], owner[having][order]
                new = np.ones(len(ids), dtype=bool)
                new[1:] = (ids[1:] != ids[:-1]) | (own[1:] != own[:-1])
                out.append(ids[new])
            ids, counts = np.unique(np.concatenate(out), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(ids.view(np.int64)), pa.array(counts.astype(np.int64))], ["feature", "n"])
    rows = (in_arrow(sample, each, "feature bigint, n bigint").groupBy("feature")
            .agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("feature").toArrow())
    return np.sort(np.asarray(rows.column("feature")).astype(np.int64).view(np.uint64))


def _active(sample: DataFrame, features: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """The sample's labels and, for each text, its (distinct word, feature) pairs as two arrays; the words of
    a text are numbered. A bounded number of rows."""
    def each(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        for part in slices(batch, "text", SLICE_BYTES):
            text, word, feature, words = _found(part.column("text"), features)
            _, same = np.unique(words.hashes()[word], return_inverse=True)
            order = np.lexsort((feature, same, text))
            text, same, feature = text[order], same[order], feature[order]
            new = np.ones(len(text), dtype=bool)
            new[1:] = (text[1:] != text[:-1]) | (same[1:] != same[:-1]) | (feature[1:] != feature[:-1])
            text, same, feature = text[new], same[new], feature[new]
            ends = pa.array(np.searchsorted(text, np.arange(part.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (same, feature)]
            yield pa.RecordBatch.from_arrays([part.column("toxic"), *lists], ["toxic", "words", "active"])
    rows = in_arrow(sample, each, "toxic int, words array<int>, active array<int>").toArrow()
    held = []
    for name in ("words", "active"):
        lists = rows.column(name).combine_chunks()
        lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
        flat, ends = np.asarray(lists.flatten()), np.asarray(lists.offsets)
        ends = ends - ends[0]
        held.append([flat[a:b] for a, b in zip(ends, ends[1:])])
    return np.asarray(rows.column("toxic")), held[0], held[1]


def _marked(toxic: np.ndarray, active: list[np.ndarray], count: int) -> tuple[np.ndarray, np.ndarray]:
    """Features far commoner in toxic than in clean texts, and far rarer, by a likelihood-ratio statistic."""
    present_in = {c: np.bincount(np.concatenate([a for a, t in zip(active, toxic) if bool(t) == c] or [np.zeros(0, int)]).astype(int),
                                 minlength=count) for c in (True, False)}
    n, m = max(1, int((toxic > 0).sum())), max(1, int((toxic == 0).sum()))
    a, b = present_in[True] + 0.5, present_in[False] + 0.5
    ratio = np.log(a / (n + 1)) - np.log(b / (m + 1))
    expected = (a + b) * n / (n + m)
    statistic = 2 * (a * np.log(a / expected) + b * np.log(b / np.maximum(a + b - expected, 1e-9)))
    clear = (np.abs(ratio) > np.log(3)) & (statistic > 15)
    return np.flatnonzero(clear & (ratio > 0)), np.flatnonzero(clear & (ratio < 0))


def cumulative_link(rows: np.ndarray, columns: np.ndarray, grades: np.ndarray, width: int, levels: int,
                    penalty: float = 0.3, rounds: int = 5_000) -> tuple[np.ndarray, np.ndarray]:
    """Weights and increasing thresholds of the proportional-odds model, by its penalised likelihood.

    ``rows, columns`` are the places of ones in the feature matrix. Thresholds are a first one and
    positive steps, so that they stay in order. Steps shrink, and end when the loss has settled.
    """
    n, k = len(grades), levels - 1
    share = [(np.sum(grades > j) + 1) / (n + 2) for j in range(k)]
    first = np.log((1 - share[0]) / share[0])
    steps = [max(0.1, np.log((1 - b) / b) - np.log((1 - a) / a)) for a, b in zip(share, share[1:])]
    parameters = np.concatenate([np.zeros(width), [first], np.log(steps)])
    mean, square, losses = np.zeros_like(parameters), np.zeros_like(parameters), []
    for t in range(1, rounds + 1):
        weights, theta = parameters[:width], _thresholds(parameters[width:])
        score = np.bincount(rows, weights[columns], minlength=n)
        above = 1 / (1 + np.exp(-np.clip(score[:, None] - theta[None, :], -50, 50)))
        edges = np.hstack([np.ones((n, 1)), above, np.zeros((n, 1))])
        slope = np.hstack([np.zeros((n, 1)), above * (1 - above), np.zeros((n, 1))])
        each = np.arange(n)
        chance = np.maximum(edges[each, grades] - edges[each, grades + 1], 1e-12)
        losses.append(-np.log(chance).sum() + penalty / 2 * weights @ weights)
        if t > 100 and max(losses[-10:]) - min(losses[-10:]) <= SETTLED * losses[-1]:
            break
        of_score = -(slope[each, grades] - slope[each, grades + 1]) / chance
        of_theta = np.zeros(k)
        for j in range(k):
            low, high = grades == j + 1, grades == j
            of_theta[j] = np.sum(slope[low, j + 1] / chance[low]) - np.sum(slope[high, j + 1] / chance[high])
        gradient = np.concatenate([
            np.bincount(columns, of_score[rows], minlength=width) + penalty * weights,
            [of_theta.sum()], np.array([of_theta[j + 1:].sum() for j in range(k - 1)]) * np.exp(parameters[width + 1:])])
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient ** 2
        parameters = parameters - 0.05 / (1 + t / 300) * (mean / (1 - 0.9 ** t)) / (np.sqrt(square / (1 - 0.99 ** t)) + 1e-8)
    return parameters[:width], _thresholds(parameters[width:])


def _thresholds(parameters: np.ndarray) -> np.ndarray:
    return np.concatenate([parameters[:1], parameters[0] + np.cumsum(np.exp(parameters[1:]))])


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, severe: int = SEVERE) -> Model:
    """A model from ``labels (doc_id, toxic)``. Without toxic labels nothing is toxic."""
    sample = _sample(docs, labels, most)
    counts = sample.agg(F.sum(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic"),
                        F.count(F.lit(1)).alias("n")).first()
    if not counts["toxic"]:
        return Model()
    candidates = _candidates(sample, max(3, counts["toxic"] // 300))
    toxic, words, pairs = _active(sample, candidates)
    active = [np.unique(p) for p in pairs]
    toxic_side, clean_side = _marked(toxic, active, len(candidates))
    marked = np.concatenate([toxic_side, clean_side])
    place = np.full(len(candidates) + 1, -1)
    place[marked] = np.arange(len(marked))
    held = [place[a][place[a] >= 0] for a in active]
    rows = np.repeat(np.arange(len(held)), [len(h) for h in held])
    columns = np.concatenate(held).astype(int) if held else np.zeros(0, int)
    markers = np.array([len(np.unique(w[(place[p] >= 0) & (place[p] < len(toxic_side))])) for w, p in zip(words, pairs)])
    grades = np.where(toxic > 0, np.where(markers >= severe, 2, 1), 0)
    # As many texts without a feature are clean: what a text lacks is no evidence against it.
    anchored = np.concatenate([grades, np.zeros(int((grades == 0).sum()), dtype=grades.dtype)])
    weights, thresholds = cumulative_link(rows, columns, anchored, len(marked), 3)
    order = np.argsort(candidates[marked])
    return Model(candidates[marked][order], weights[order], thresholds)


def _severity(part: pa.RecordBatch, text: str, model: Model) -> np.ndarray:
    """P(grade > k) of each row, a column for each threshold."""
    owner, feature = present(part.column(text), model.features)
    scores = np.bincount(owner, model.weights[feature], minlength=part.num_rows) if len(feature) else np.zeros(part.num_rows)
    return model.above(scores)


def severity(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: ``doc_id, expected_severity, grade, toxic``.

    ``grade`` is the most probable one, ``toxic`` whether a grade above 0 is as probable as not. A null
    or empty text has no features. Long texts are read whole, in blocks. Rows that repeat are answered one
    by one; no rows give no rows; other columns are not read.
    """
    def each(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        for part in slices(batch, "text", SLICE_BYTES):
            above = _severity(part, "text", model)
            n = part.num_rows
            chances = np.hstack([np.ones((n, 1)), above]) - np.hstack([above, np.zeros((n, 1))])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(above.sum(axis=1)),
                 pa.array(chances.argmax(axis=1).astype(np.int32)), pa.array(above[:, 0] >= REJECTED)],
                ["doc_id", "expected_severity", "grade", "toxic"])
    narrow = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return in_arrow(narrow, each, f"doc_id {dict(narrow.dtypes)['doc_id']}, expected_severity double, "
                                  "grade int, toxic boolean")


def clean_rows(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not toxic, with all their columns, in one pass."""
    def each(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        for part in slices(batch, text, SLICE_BYTES):
            yield part.filter(pa.array(_severity(part, text, model)[:, 0] < REJECTED))
    return docs.mapInArrow(lambda batches: (out for b in batches for out in each(b)), docs.schema)
