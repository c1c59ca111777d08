"""Quality by weak supervision, with built-in functions only.

Each rule looks at one measure of a text and votes good, bad or abstains. How often a rule votes bad or
good on good and on bad texts is not known; expectation-maximisation estimates it from how the rules
agree, over the histogram of vote patterns (3 to the number of rules at most, whatever the corpus). The
posterior probability that a text is good replaces all-must-pass filtering.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoremill.llm.common import no_nulls, stage

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 5
BAD, ABSTAIN, GOOD = -1, 0, 1
ROUNDS = 50
FALSE_ALARMS = 0.001
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper",
            "n_marks", "n_distinct")


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body``."""
    return F.transform(F.array(value), body)[0]


def _left(text: Column, pattern: str) -> Column:
    """How many characters stay when the pattern's matches go."""
    return F.length(F.regexp_replace(text, pattern, "")).cast("bigint")


def repeated_words(ws: Column) -> Column:
    """Words in 5-word windows that occur twice or more, the first time included.

    Windows are compared as 64-bit hashes within one text. Only a text with a repeated window is sorted.
    """
    hashes = F.when(F.size(ws) >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.size(ws) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(ws, i, F.lit(WINDOW)))))

    def covered(starts: Column) -> Column:
        reach = F.transform(starts, lambda s, j: F.least(
            F.lit(WINDOW), F.coalesce(F.get(starts, j + 1) - s, F.lit(WINDOW))))
        return F.aggregate(reach, F.lit(0), lambda a, x: a + x)

    def repeats(hs: Column) -> Column:
        ordered = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return _let(ordered, lambda o: _let(F.sort_array(F.filter(F.transform(o, lambda x, j: F.when(
            (F.get(o, j - 1)["h"] == x["h"]) | (F.get(o, j + 1)["h"] == x["h"]), x["i"])),
            lambda i: i.isNotNull())), covered))

    counted = _let(hashes, lambda hs: F.when(F.size(F.array_distinct(hs)) < F.size(hs), repeats(hs)))
    return F.coalesce(counted, F.lit(0)).cast("bigint")


def measures(text: Column) -> Column:
    """A struct of MEASURES, all long, of a text that is not null."""
    ws = F.filter(F.split(text, SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    return _let(ws, lambda w: _let(lines, lambda ls: F.struct(
        F.size(w).cast("bigint").alias("n_words"),
        _left(text, SPACE).alias("word_chars"),
        _left(text, r"[^#*$%&|<>]+").alias("n_symbols"),
        (F.size(ls) - F.size(F.array_distinct(ls))).cast("bigint").alias("n_dup_lines"),
        repeated_words(w).alias("n_repeat_words"),
        F.size(ls).cast("bigint").alias("n_lines"),
        _left(text, r"\P{Lu}+").alias("n_upper"),
        _left(text, r"[^!?]+").alias("n_marks"),
        F.size(F.array_distinct(w)).cast("bigint").alias("n_distinct"))))


def votes() -> dict[str, Column]:
    """Each rule's vote from the measures. Most only ever object; a share with no base to it abstains.

    A rule whose good votes merely said that a text lacks its own kind of junk would outvote the one
    rule that sees another kind, so those abstain instead.
    """
    words, chars = F.col("n_words"), F.col("word_chars")

    def objects(*tests: Column) -> Column:
        bad = F.lit(False)
        for test in tests:
            bad = bad | F.coalesce(test, F.lit(False))
        return F.when((words >= 10) & bad, BAD).otherwise(ABSTAIN).cast("int")

    variety, mean_length = F.try_divide("n_distinct", words), F.try_divide(chars, words)
    return {
        "symbols": objects(F.try_divide("n_symbols", words) > 0.15),
        "shouting": objects(F.try_divide("n_upper", chars) > 0.4, F.try_divide("n_marks", words) > 0.25),
        "repeats": objects(F.try_divide("n_repeat_words", words) > 0.3),
        "lines": objects(F.try_divide("n_dup_lines", "n_lines") > 0.4),
        "variety": F.when((words >= 50) & (variety < 0.07), BAD).when((words >= 10) & (variety > 0.3), GOOD)
                    .otherwise(ABSTAIN).cast("int"),
        "length": F.when((words >= 10) & ((mean_length < 2) | (mean_length > 20)), BAD)
                   .when((words >= 10) & mean_length.between(3, 12), GOOD).otherwise(ABSTAIN).cast("int"),
    }


RULES = ("symbols", "shouting", "repeats", "lines", "variety", "length")


def expectation_maximisation(patterns: dict[tuple[int, ...], int], rules: int,
                             rounds: int = ROUNDS) -> tuple[float, list[dict[int, float]]]:
    """The prior log-odds of good, and each rule's log-odds by vote, from counts of vote patterns.

    Starts from: bad if any rule says so. Estimates how often a rule votes bad, good or not at all in
    each class. One imagined vote for each outcome keeps every estimate finite. How often a rule objects
    to good texts has a prior as heavy as the texts themselves, at ``FALSE_ALARMS``: where no two rules
    see the same text, nothing else in the votes tells a kind of junk from a careless rule.
    """
    chance = {p: (0.01 if BAD in p else 0.99) for p in patterns}
    prior, weights, outcomes = 0.0, [], (BAD, ABSTAIN, GOOD)
    for _ in range(rounds):
        good = 1.0 + sum(n * chance[p] for p, n in patterns.items())
        bad = 1.0 + sum(n * (1 - chance[p]) for p, n in patterns.items())
        prior, weights = math.log(good / bad), []
        for r in range(rules):
            held = {(v, c): 1.0 for v in outcomes for c in (0, 1)}
            held[BAD, 0] += 1.0  # a rule is imagined to be right more often than wrong
            held[GOOD, 1] += 1.0
            for p, n in patterns.items():
                held[p[r], 1] += n * chance[p]
                held[p[r], 0] += n * (1 - chance[p])
            totals = {c: sum(held[v, c] for v in outcomes) for c in (0, 1)}
            alarm = (held[BAD, 1] + FALSE_ALARMS * totals[1]) / (2 * totals[1])
            in_good = {v: (1 - alarm) * held[v, 1] / (held[ABSTAIN, 1] + held[GOOD, 1]) for v in outcomes} | {BAD: alarm}
            weights.append({v: math.log(in_good[v]) - math.log(held[v, 0] / totals[0]) for v in outcomes})
        chance = {p: _logistic(prior + sum(weights[r][v] for r, v in enumerate(p))) for p in patterns}
    return prior, weights


def _logistic(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def fit(voted: DataFrame) -> tuple[float, list[dict[int, float]]]:
    """Fits on the votes of all rows that the base rules leave open; the histogram that reaches the
    driver has 3^rules rows at most."""
    rows = voted.filter(~failed()).groupBy(*[f"vote_{r}" for r in RULES]).count().collect()
    return expectation_maximisation({tuple(r[:-1]): r[-1] for r in rows}, len(RULES))


def posterior(model: tuple[float, list[dict[int, float]]]) -> Column:
    prior, weights = model
    odds = F.lit(float(prior))
    for name, weight in zip(RULES, weights):
        vote = F.col(f"vote_{name}")
        odds = odds + F.when(vote == BAD, weight[BAD]).when(vote == GOOD, weight[GOOD]).otherwise(weight[ABSTAIN])
    return 1 / (1 + F.exp(-odds))


def voted(docs: DataFrame, text: str, *carried: str) -> DataFrame:
    """The carried columns, the measures and the votes of every row."""
    measured = (docs.select(*[F.col(c) for c in carried], measures(no_nulls(text)).alias("measures__")))
    flat = measured.select(*carried, "measures__.*")
    return flat.select("*", *[v.alias(f"vote_{r}") for r, v in votes().items()])


def failed() -> Column:
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)


def quality(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, quality``.

    Null counts as a text without words, which fails. Long texts are measured whole. Rows that repeat
    are answered one by one; no rows give no rows; other columns are not read.
    """
    table = stage(voted(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), "text", "doc_id"),
                  "votes")
    good = posterior(fit(table))
    return table.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        failed().alias("base_failed"), (~failed() & (good >= 0.5)).alias("kept"),
                        good.alias("quality"))


def good_rows(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    Votes are written beside the rows once, so that neither is computed again nor joined.
    """
    columns = [F.col(c) for c in docs.columns]
    packed = docs.select(F.struct(*columns).alias("row__"), F.col(text).alias("text__"))
    table = stage(voted(packed, "text__", "row__"), "voted-rows")
    return table.filter(~failed() & (posterior(fit(table)) >= 0.5)).select("row__.*")
