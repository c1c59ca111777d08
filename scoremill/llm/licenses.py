"""Licence scan by a positional index of rare licence words, with built-in functions only.

The templates' words, but for function words, form an index: word -> (template, position). A first pass
counts in how many documents each of them occurs and keeps the words of those documents that have any.
Each such document then looks up its ``LOOKED_UP`` words of highest inverse document frequency and, so that
no template is missed however many notices a file holds, the indexed words of every template's mandatory phrase.
A posting and a place in the document give where the template would begin; postings are intersected by that
place, and only where ``AGREEING`` words agree is there a candidate. Its phrase must then stand at exactly its
place. The share of the template's index words found at their places, by weight, is the score. A phrase that names
a licence decides; one of plain words does where ``LEAST`` of the index words around it, by weight, stand at their places.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoremill.llm.common import ascii_lower, no_nulls, stage

# Phrases of the contract, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Fixed values: (label, template, mandatory phrase within it); usual notices in lower case.
TEMPLATES = (
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software "
            "and associated documentation files", "permission is hereby granted free of charge"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the software", "permission notice shall be included in all copies or substantial portions"),
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is "
               "distributed on an as is basis", "unless required by applicable law or agreed to in writing"),
    ("gpl", "licensed under the gnu general public license version 3", "gnu general public license"),
    ("gpl", "free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation", "gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license", "gnu affero general public license"),
    ("mpl", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     "redistribution and use in source and binary forms"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
            "products derived from this software without specific prior written permission",
     "endorse or promote products derived from this software"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license",
     "creative commons attribution"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without "
            "fee is hereby granted", "permission to use copy modify and or distribute this software"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "free and unencumbered software released into the public domain"),
)
# Words too common to point at a licence.
FUNCTION_WORDS = frozenset(("a any and are as by can for in into is it of or person the this to use v with "
                            "without you 0 2 3 4").split())
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOOKED_UP = 8
AGREEING = 2
LEAST = 0.4
_PLACE = 1 << 40


def vocabulary() -> list[str]:
    """The indexed words."""
    return sorted({w for _, t, _ in TEMPLATES for w in t.split()} - FUNCTION_WORDS)


def words(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), SEPARATORS), lambda w: w != "")


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body``."""
    return F.transform(F.array(value), body)[0]


def with_licence_words(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``doc_id, n_words, rare, words``: the words are kept only where an indexed one is among them."""
    found = _let(words(no_nulls(text)), lambda ws: _let(
        F.array_intersect(ws, _strings(vocabulary())), lambda rare: F.struct(
            F.size(ws).cast("bigint").alias("n_words"), rare.alias("rare"),
            F.when(F.size(rare) > 0, ws).alias("words"))))
    return docs.select(F.col(key).alias("doc_id"), found.alias("found")).select("doc_id", "found.*")


def inverse_frequencies(found: DataFrame) -> dict[str, float]:
    """ln((documents + 1) / (documents with the word + 1)) of every indexed word; that many rows."""
    rows = (found.select(F.explode(F.concat("rare", _strings([""]))).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect())
    counts = {r["word"]: r["n"] for r in rows}
    return {w: math.log((counts.get("", 0) + 1) / (counts.get(w, 0) + 1)) for w in vocabulary()}


def base_places(ws: Column) -> Column:
    """Where each phrase stands: array of (start, label)."""
    def at(w: Column, i: Column) -> Column:
        tests = None
        for phrase, label in PHRASES.items():
            parts = phrase.split()
            same = w == parts[-1]
            for back, part in enumerate(reversed(parts[:-1]), 1):
                same = same & (F.get(ws, i - back) == part)
            place = F.struct((i - (len(parts) - 1)).cast("bigint").alias("start"), F.lit(label).alias("label"))
            tests = F.when(same, place) if tests is None else tests.when(same, place)
        return tests
    return F.filter(F.transform(ws, at), lambda x: x.isNotNull())


def _key_at(template: str, phrase: str) -> int:
    """Where the mandatory phrase begins in its template, in words."""
    parts, key = template.split(), phrase.split()
    return next(i for i in range(len(parts)) if parts[i:i + len(key)] == key)


def postings(weights: dict[str, float]) -> dict[str, list[int]]:
    """Each indexed word -> its places, each as template * 2^40 + position."""
    index: dict[str, list[int]] = {}
    for t, (_, template, _) in enumerate(TEMPLATES):
        for position, word in enumerate(template.split()):
            if word in weights:
                index.setdefault(word, []).append(t * _PLACE + position)
    return index


def phrase_words(weights: dict[str, float]) -> list[str]:
    """The indexed words of the mandatory phrases: of each that stands in a file, at least two are looked up."""
    return sorted({w for _, _, phrase in TEMPLATES for w in phrase.split() if w in weights})


def _postings(index: dict[str, list[int]]) -> Column:
    return F.create_map(*[x for w, places in sorted(index.items())
                          for x in (F.lit(w), F.array(*[F.lit(p).cast("bigint") for p in places]))])


def _shares(template: str, phrase: str, weights: dict[str, float]) -> list[tuple[int, str, float, float]]:
    """Of each indexed word: its place, itself, its share of the template's weight, and of that around the phrase."""
    parts, low = template.split(), _key_at(template, phrase)
    indexed = [(i, w, not low <= i < low + len(phrase.split())) for i, w in enumerate(parts) if w in weights]
    whole, around = sum(weights[w] for _, w, _ in indexed), sum(weights[w] for _, w, out in indexed if out)
    count = max(1, sum(out for _, _, out in indexed))
    return [(i, w, weights[w] / whole if whole > 0 else 1 / len(indexed),
             0.0 if not out else weights[w] / around if around > 0 else 1 / count) for i, w, out in indexed]


def decides(template: str, phrase: str, weights: dict[str, float]) -> bool:
    """Whether the phrase is a notice by itself: it names a licence, or has no indexed word around it."""
    return "license" in phrase.split() or not any(around for *_, around in _shares(template, phrase, weights))


def _templates(weights: dict[str, float]) -> Column:
    rows = []
    for label, template, phrase in TEMPLATES:
        rows.append(F.struct(
            F.lit(label).alias("label"), F.lit(_key_at(template, phrase)).alias("key_at"), _strings(phrase.split()).alias("key"),
            F.lit(0.0 if decides(template, phrase, weights) else LEAST).alias("least"),
            F.array(*[F.struct(F.lit(i).alias("at"), F.lit(w).alias("word"), F.lit(share).alias("weight"), F.lit(around).alias("around"))
                      for i, w, share, around in _shares(template, phrase, weights)]).alias("indexed")))
    return F.array(*rows)


def wanted_words(rare: Column, weights: dict[str, float]) -> Column:
    """Of a document's indexed words, the rarest and those of the mandatory phrases."""
    by_rarity = sorted(weights, key=lambda w: (-weights[w], w))
    return F.array_union(F.slice(F.array_intersect(_strings(by_rarity), rare), 1, LOOKED_UP),
                         F.array_intersect(_strings(phrase_words(weights)), rare))


def starts(ws: Column, wanted: Column) -> Column:
    """Where a template would begin, by ``AGREEING`` postings or more: template * 2^40 + that place.

    Places of one beginning stand together once sorted. A beginning may lie before the document, so places are shifted to
    stay above 0.
    """
    found = F.array_sort(F.flatten(F.filter(F.transform(ws, lambda w, i: F.when(
        F.array_contains(wanted, w), F.transform(F.col("postings")[w], lambda p: p - p % _PLACE + i.cast("bigint") - p % _PLACE + _PLACE // 2))),
        lambda x: x.isNotNull())))
    return _let(found, lambda places: F.array_distinct(F.filter(
        places, lambda c, i: F.coalesce(F.get(places, i - (AGREEING - 1)) == c, F.lit(False)))))


def method_matches(ws: Column, rare: Column, weights: dict[str, float]) -> Column:
    """Verified templates: array of (label, score)."""
    def share(m: Column, of: str) -> Column:
        return F.aggregate(m["t"]["indexed"], F.lit(0.0), lambda a, x: a + F.when(
            F.get(ws, m["start"] + x["at"]) == x["word"], x[of]).otherwise(0.0))

    def verified(c: Column) -> Column:
        return _let(F.struct(F.col("templates")[F.floor(c / _PLACE).cast("int")].alias("t"),
                             (c % _PLACE - _PLACE // 2).cast("int").alias("start")), lambda m: F.when(
            (m["start"] + m["t"]["key_at"] >= 0) & (F.slice(
                ws, F.greatest(m["start"] + m["t"]["key_at"] + 1, F.lit(1)), F.size(m["t"]["key"])) == m["t"]["key"])
            & (share(m, "around") >= m["t"]["least"]),
            F.struct(m["t"]["label"].alias("label"), share(m, "weight").alias("score"))))
    return _let(wanted_words(rare, weights), lambda wanted: _let(starts(ws, wanted), lambda candidates: F.filter(
        F.transform(candidates, verified), lambda x: x.isNotNull())))


def licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``score`` is the best accepted template's, 0 without one. Null counts as empty; a text without words
    has no places, empty labels and score 0. Long texts are searched whole. Rows that repeat are answered
    one by one; no rows give no rows; other columns are not read.
    """
    found = stage(with_licence_words(docs, key, text), "licence-words")
    weights = inverse_frequencies(found)
    none = F.array().cast("array<string>")
    ws = F.coalesce(F.col("words"), none)
    searched = found.select(
        "doc_id", "n_words", ws.alias("words"), "rare", _postings(postings(weights)).alias("postings"),
        _templates(weights).alias("templates"))
    matched = searched.select(
        "doc_id", "n_words",
        F.when(F.array_contains("rare", "license"), base_places(F.col("words"))).alias("places"),
        F.when(F.arrays_overlap("rare", _strings(phrase_words(weights))),
               method_matches(F.col("words"), F.col("rare"), weights)).alias("matches"))
    places = F.col("places.start")
    base = F.array_sort(F.array_distinct(F.coalesce(F.col("places.label"), none)))
    every = F.array_sort(F.array_union(base, F.coalesce(F.col("matches.label"), none)))
    return matched.select(
        "doc_id", "n_words", F.coalesce(F.size("places"), F.lit(0)).cast("bigint").alias("n_base"),
        F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
        F.least(F.lit(1.0), F.coalesce(F.array_max("matches.score"), F.lit(0.0))).alias("score"))
