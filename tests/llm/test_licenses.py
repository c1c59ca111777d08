import re

import math

import pytest

from scoremill.llm.licenses import LEAST, PHRASES, TEMPLATES, licenses, vocabulary
from scoremill.llm.registered import op7_license_scan
from scoremill_checks.compare import duck

from .conftest import AWKWARD

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places = [(i, label) for phrase, label in PHRASES.items() for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in places})))


def check(frame, rows):
    got = sorted(str((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]))
                 for r in frame.collect())
    assert got == sorted(str((i, *base(t))) for i, t in rows)


def test_awkward_texts(awkward, empty):
    check(licenses(awkward), AWKWARD)
    assert licenses(empty).collect() == []


TEXTS = [
    (1, "x Released under the MIT License. y", "mit", "mit"),
    (2, "Licensed under CC BY-NC 4.0.", "", "cc-by-nc"),
    (3, "This work is licensed under the GNU General Public License, version 3.", "gpl", "gpl"),
    (4, "license licensed under the by nc public", "", ""),
    (5, "mit license, apache license and the general public license; MIT LICENSE", "apache,gpl,mit", "apache,gpl,mit"),
    (6, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "", "mit"),
    (7, "License " * 3000, "", ""),
    (8, "GNU Lesser General Public License", "", "lgpl"),
    (9, None, "", ""),
]


def test_labels(spark):
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in TEXTS] + [(100 + i, "no such words") for i in range(50)],
                                 "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses(docs).collect()}
    for i, _, base_labels, labels in TEXTS:
        want = base_labels if i != 8 else "gpl"
        if i == 8:
            labels = "gpl,lgpl"
        assert (got[i]["base_labels"], got[i]["labels"]) == (want, labels), i
        assert 0 <= got[i]["score"] <= 1 and (got[i]["score"] > 0.5) >= (i in (1, 2, 3, 6))
    check(licenses(docs), [(i, t) for i, t, _, _ in TEXTS] + [(100 + i, "no such words") for i in range(50)])


def test_query_equals_brute_force_and_is_native(spark):
    frame = op7_license_scan(spark, SF)
    check(frame, duck(SF).execute("SELECT doc_id, text FROM documents").fetchall())
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_every_notice_of_a_file_is_looked_up(spark):
    every = ". ".join(t for _, t, _ in TEMPLATES)
    others = [w for w in vocabulary() if w not in "permission is hereby granted free of charge".split()]
    rows = [(1, every), (2, " ".join(others[::-1]) + " " + TEMPLATES[1][1])]
    # one source's notice makes its words the least rare
    rows += [(10 + i, f"{TEMPLATES[1][1]} in file {i}") for i in range(40)] + [(100 + i, "no such words") for i in range(20)]
    got = {r["doc_id"]: r["labels"] for r in licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == ",".join(sorted({label for label, _, _ in TEMPLATES}))
    assert got[2] == got[10] == "mit"


def brute(rows):
    """Labels and scores, template by template and word by word."""
    texts = [(i, re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))) for i, t in rows]
    idf = {w: math.log((len(rows) + 1) / (sum(w in ws for _, ws in texts) + 1)) for w in vocabulary()}
    out = {}
    for (i, ws), (_, text) in zip(texts, rows):
        labels, score = set(base(text)[-1].split(",")) - {""}, 0.0
        for label, template, phrase in TEMPLATES:
            parts, key = template.split(), phrase.split()
            indexed = [k for k, w in enumerate(parts) if w in idf]
            key_at = next(k for k in range(len(parts)) if parts[k:k + len(key)] == key)
            around = [k for k in indexed if not key_at <= k < key_at + len(key)]

            def share(of, met):
                whole = sum(idf[parts[k]] for k in of)
                met = [k for k in of if k in met]
                return sum(idf[parts[k]] for k in met) / whole if whole > 0 else len(met) / len(of) if of else 1.0
            for place in range(len(ws) - len(key) + 1):
                if ws[place:place + len(key)] == key:
                    start = place - key_at
                    met = [k for k in indexed if 0 <= start + k < len(ws) and ws[start + k] == parts[k]]
                    if "license" in key or share(around, met) >= LEAST:
                        labels.add(label)
                        score = max(score, share(indexed, met))
        out[i] = (",".join(sorted(labels)), pytest.approx(min(score, 1.0), abs=1e-9))
    return out


OTHER_WORDS = [
    "permission is hereby granted free of charge to anyone to enter the park", "this catalogue does not use CC BY NC at all",
    "may endorse or promote products derived from this software of ours", "unless required by applicable law or agreed to in writing, visitors leave by six"]


def test_words_of_a_phrase_alone_are_no_notice(spark):
    rows = list(enumerate(OTHER_WORDS)) + [(10 + i, t) for i, (_, t, _) in enumerate(TEMPLATES)] + [(100 + i, "no such words") for i in range(40)]
    got = {r["doc_id"]: r for r in licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i]["labels"] == "" and got[i]["score"] == 0 for i in range(len(OTHER_WORDS)))
    assert all(label in got[10 + i]["labels"].split(",") for i, (label, _, _) in enumerate(TEMPLATES))


def test_labels_and_scores_equal_brute_force(spark):
    """Whole notices, pieces of them, several in a file, and the tables' own documents."""
    rows = [(i, t) for i, (_, t, _, _) in enumerate(TEXTS)] + [(50 + i, t) for i, t in enumerate(OTHER_WORDS)]
    for i, (_, template, _) in enumerate(TEMPLATES):
        parts = template.split()
        rows += [(100 + i, template), (200 + i, " ".join(parts[len(parts) // 3:])), (300 + i, " ".join(parts[:-len(parts) // 3])),
                 (400 + i, f"{template} {TEMPLATES[i - 1][1]} {template}")]
    rows += [(1000 + i, t) for i, t in duck(SF).execute("SELECT doc_id, text FROM documents").fetchall()]
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)
