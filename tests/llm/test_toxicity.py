import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from scoremill.llm.toxicity import PREFIXES, Model, _kinds, _sample, clean_rows, cumulative_link, fit, severity
from scoremill.llm.words import LETTERS, words_of
from scoremill_checks.compare import duck

from .conftest import AWKWARD

SF = "/root/testdata/sf0.01"
MARKERS = "trash pathetic idiot worthless disgusting stupid clown scum loser moron".split()


def test_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = fit(docs, labels.filter("doc_id % 3 != 0"))
    held = {i: t for i, t in duck(SF).execute("SELECT doc_id, toxic FROM labels WHERE doc_id % 3 = 0").fetchall()}
    got = {r["doc_id"]: r for r in severity(docs, model).collect()}
    assert sum(got[i]["toxic"] == bool(t) for i, t in held.items()) >= 0.93 * len(held)
    assert sum(got[i]["toxic"] for i, t in held.items() if not t) <= 0.01 * sum(not t for t in held.values())
    assert all(0 <= r["expected_severity"] <= 2 for r in got.values())


def test_marked_texts_are_found_and_clean_ones_left(spark):
    rows = [(i, f"you are a reader {i} and a friend of topic {i} and more", 0) for i in range(200)]
    rows += [(200 + i, f"you are a {MARKERS[i % 10]} and a {MARKERS[(i + 3) % 10]} of topic {i}", 1) for i in range(60)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = fit(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"))
    new = [(1, "plain words about a topic"), (2, "what an IDIOT, a total moron"), (3, None), (4, ""),
           (5, "word " * 30000 + "such a stupid loser"), (5, "repeated plain words"), (None, "scum and trash")]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in new], "doc_id long, text string, toxic string, grade int")
    got = sorted((str(r["doc_id"]), r["toxic"]) for r in severity(frame, model).collect())
    want = [False, True, False, False, True, False, True]
    assert got == sorted((str(i), w) for (i, _), w in zip(new, want))
    assert clean_rows(frame, model).columns == frame.columns and clean_rows(frame, model).count() == 4


def test_no_rows_and_no_labels(spark, empty, awkward):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert severity(empty, fit(empty, none)).collect() == []
    assert not any(r["toxic"] for r in severity(awkward, Model()).collect())


def test_cumulative_link_recovers_ordered_thresholds():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3)) < 0.4
    score = x @ np.array([2.0, -1.0, 0.0])
    noise = np.log(1 / rng.random(4000) - 1)
    grades = (score + noise > 0).astype(int) + (score + noise > 1.5)
    rows, columns = np.nonzero(x)
    weights, thresholds = cumulative_link(rows, columns, grades, 3, 3, penalty=0.01)
    assert np.allclose(weights, [2, -1, 0], atol=0.25) and np.allclose(thresholds, [0, 1.5], atol=0.2)


def test_grades_count_marker_words_not_their_features(spark):
    rows = [(i, f"you are a reader {i} and a friend of topic {i} and more", 0) for i in range(200)]
    rows += [(200 + i, f"you are a {MARKERS[i % 10]} of topic {i}", 1) for i in range(100)]
    rows += [(300 + i, f"you are a {MARKERS[i % 10]} and a {MARKERS[(i + 3) % 10]} and a {MARKERS[(i + 5) % 10]} "
              f"of topic {i}", 1) for i in range(100)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = fit(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"))
    new = [(0, "plain words about a topic"), (1, "such a disgusting topic"), (1, "a scum, scum, SCUM topic"),
           (2, "a pathetic, worthless moron"), (2, "idiot clown and loser, stupid trash")]
    got = severity(spark.createDataFrame(new, "doc_id long, text string"), model).collect()
    assert all(r["grade"] == r["doc_id"] and r["toxic"] == (r["doc_id"] > 0) for r in got), got


def test_rejected_by_the_chance_of_any_grade(spark):
    feature = np.sort(words_of(pa.array(["moron"]), LETTERS).hashes() ^ _kinds[0])
    docs = spark.createDataFrame([(1, "a moron")], "doc_id long, text string")
    row = severity(docs, Model(feature, np.array([1.0]), np.array([1.5, 1.6]))).first()
    assert row["expected_severity"] > 0.5 and not row["toxic"]
    assert clean_rows(docs, Model(feature, np.array([1.0]), np.array([1.5, 1.6]))).count() == 1


def test_one_text_for_each_labelled_identifier(spark):
    """An identifier that a million rows share comes to the fit once."""
    docs = spark.range(5000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(2, "other"), (3, None), (None, "x"), (2, "another")], "doc_id long, text string"))
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 1), (None, 1)], "doc_id long, toxic int")
    assert sorted(tuple(r) for r in _sample(docs, labels, 10).collect()) == [("another", 0), ("text 0", 1)]
    assert _sample(docs, labels, 1).count() <= 1


def test_clean_features_lower_a_score(spark):
    rows = [(i, f"kindly note the minutes of meeting {i}, regards", 0) for i in range(300)]
    rows += [(300 + i, f"such {MARKERS[i % 10]} stuff in entry {i}", 1) for i in range(150)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = fit(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"))
    assert (model.weights > 0).any() and (model.weights < 0).any()
    texts = spark.createDataFrame([(1, "moron"), (2, "moron, kindly note the minutes of the meeting, regards")], "doc_id long, text string")
    one, two = (r["expected_severity"] for r in severity(texts, model).orderBy("doc_id").collect())
    assert two < one


def test_scores_of_a_given_model_equal_brute_force(spark, awkward):
    """Presence of words and of the first bytes of longer ones, each once, weighed and compared with the thresholds."""
    terms = [(None, "the"), (None, "hello"), (None, "word"), (6, "identi"), (8, "identifi"), (6, "repeat"), (None, "it")]
    hashes = [words_of(pa.array([t]), LETTERS).hashes()[0] ^ _kinds[PREFIXES.index(k)] for k, t in terms]
    order = np.argsort(hashes)
    weight = np.array([0.5, -1.25, 2.0, 0.75, -0.5, 3.0, 1.5])
    model = Model(np.array(hashes, dtype=np.uint64)[order], weight[order], np.array([0.6, 1.7]))
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})

    def slow(text):
        words = [w.encode() for w in re.findall(r"[^\x00-\x60\x7B-\x7F]+", (text or "").translate(lower))]
        score = sum(w for (k, t), w in zip(terms, weight) if any(
            x == t.encode() if k is None else len(x) > k and x[:k] == t.encode() for x in words))
        above = [1 / (1 + math.exp(-(score - t))) for t in (0.6, 1.7)]
        chances = [1 - above[0], above[0] - above[1], above[1]]
        return round(sum(above), 9), chances.index(max(chances)), above[0] >= 0.5
    got = sorted((str(r["doc_id"]), round(r["expected_severity"], 9), r["grade"], r["toxic"]) for r in severity(awkward, model).collect())
    assert got == sorted((str(i), *slow(t)) for i, t in AWKWARD)


def test_clean_rows_looks_at_a_bounded_size_of_texts_at_once():
    class Frame:
        schema = None

        def mapInArrow(self, function, schema):
            return list(function(iter([pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["clean words " * 40_000] * 6)], ["doc_id", "text"])])))

    parts = clean_rows(Frame(), Model())
    assert [x for p in parts for x in p.column("doc_id").to_pylist()] == list(range(6))
    assert max(p.nbytes for p in parts) <= 1.1 * 2 ** 20
