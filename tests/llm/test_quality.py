import re
from collections import Counter

from scoremill.llm.quality import ABSTAIN, BAD, GOOD, expectation_maximisation, good_rows, quality
from scoremill.llm.registered import op9_quality_rules
from scoremill_checks.compare import duck

from .conftest import AWKWARD

SF = "/root/testdata/sf0.001"


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    counts, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered.update(range(i, i + 5))
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


def check(frame, rows):
    got = [tuple(r) for r in frame.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                          "n_repeat_words", "base_failed", "kept").collect()]
    assert sorted(str(r[:7]) for r in got) == sorted(str((i, *base(t))) for i, t in rows)
    assert not any(r[6] and r[7] for r in got)


def test_awkward_texts(awkward, empty):
    more = [(i, t) for i, t in AWKWARD] + [(20, "a b c d e f a b c d e x y\nz\nz\n \nz"), (21, "a " * 12 + "b c d")]
    docs = awkward.select("doc_id", "text").unionByName(awkward.sparkSession.createDataFrame(more[-2:], "doc_id long, text string"))
    check(quality(docs), more)
    assert quality(empty).collect() == []
    assert good_rows(empty).collect() == [] and good_rows(awkward).columns == awkward.columns


def test_query_equals_brute_force_and_is_native(spark):
    frame = op9_quality_rules(spark, SF)
    check(frame, duck(SF).execute("SELECT doc_id, text FROM documents").fetchall())
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_verdicts_agree_with_the_labels(spark):
    kept = {r["doc_id"]: r["kept"] for r in op9_quality_rules(spark, "/root/testdata/sf0.01").collect()}
    labels = duck("/root/testdata/sf0.01").execute("SELECT doc_id, quality FROM labels").fetchall()
    texts = dict(duck("/root/testdata/sf0.01").execute("SELECT doc_id, text FROM documents").fetchall())
    long = [(i, q) for i, q in labels if not base(texts[i])[5]]
    assert sum(kept[i] == bool(q) for i, q in long) >= 0.95 * len(long)


def test_expectation_maximisation_weighs_the_rules():
    patterns = {(ABSTAIN, ABSTAIN, GOOD): 900, (BAD, ABSTAIN, GOOD): 40, (ABSTAIN, BAD, GOOD): 30, (BAD, BAD, ABSTAIN): 20}
    prior, weights = expectation_maximisation(patterns, 3)
    assert weights[0][BAD] < -2 and weights[1][BAD] < -2 and abs(weights[2][GOOD]) < 1 and prior > 0
    assert expectation_maximisation({}, 3)[1][0][BAD] < 0
