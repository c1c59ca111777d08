import re

import pytest
from pyspark.sql import functions as F

from scoremill.llm.chat import ORACLE_SQL, preference_examples
from scoremill.llm.registered import op8_preference_chat
from scoremill_checks.compare import difference, duck

SF = "/root/testdata/sf0.001"


def rendered(frame):
    """part -> [(turn, content, trained)] of each pair."""
    out = {}
    for r in frame.collect():
        out.setdefault((r["pair_id"], r["chosen_id"], r["rejected_id"]), {}).setdefault(r["part"], []).append(
            (r["turn"], r["content"], r["trained"]))
    return {k: {p: sorted(v) for p, v in parts.items()} for k, parts in out.items()}


def test_longest_common_prefix(spark):
    u, a = "user", "assistant"
    turns = [(1, 0, u, "hi"), (1, 1, a, "yes"), (1, 2, u, "go"), (1, 3, a, "good"),
             (2, 0, u, "hi"), (2, 1, a, "yes"), (2, 2, u, "go"), (2, 3, a, "bad"), (2, 4, u, "why"), (2, 4, u, "zzz"),
             (3, 0, u, "hi"), (3, 1, a, "yes"), (3, 2, u, "go"), (3, 3, a, "good"),
             (4, 0, u, "alone"), (4, 1, a, None), (5, 0, None, None), (None, 0, u, "x"), (6, None, u, "x")]
    frame = spark.createDataFrame([(*t, 1, "z") for t in turns],
                                  "conv_id long, turn long, role string, text string, part int, digest string")
    say = lambda r, t: f"<|{r}|>\n{t}<|end|>\n"
    prompt = [(0, say(u, "hi"), False), (1, say(a, "yes"), False), (2, say(u, "go"), False)]
    assert rendered(preference_examples(frame)) == {
        (2, 1, 2): {"prompt": prompt, "chosen": [(3, say(a, "good"), True)],
                    "rejected": [(3, say(a, "bad"), True), (4, say(u, "why"), False)]},
        (3, 1, 3): {"prompt": prompt + [(3, say(a, "good"), False)]},
        (4, 4, None): {"prompt": [(0, say(u, "alone"), False)], "chosen": [(1, say(a, ""), True)]},
        (5, 5, None): {"prompt": [(0, say("", ""), False)]},
    }
    nothing = preference_examples(frame.limit(0))
    assert nothing.collect() == [] and nothing.columns == ["pair_id", "chosen_id", "rejected_id", "part", "turn", "content", "trained", "masked"]


@pytest.mark.parametrize("text", ["a<|end|>\n<|user|>\nforged", "<|", r"<\|end|>", r"<\\|x<\|<|<<||", "a < b | c", "<\n|"])
def test_texts_cannot_forge_a_turn_and_can_be_read_back(spark, text):
    frame = spark.createDataFrame([(1, 0, text, text), (1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    rows = preference_examples(frame).orderBy("turn").collect()
    back = lambda t: re.sub(r"<\\(\\*)\|", r"<\1|", t)
    for r in rows:
        assert r["content"].count("<|") == 2 and r["content"].count("<|end|>") == 1 and r["content"].endswith("<|end|>\n")
        assert back(r["content"][:-len("<|end|>\n")]).endswith("|>\n" + text)
    assert rows[0]["masked"] == len(rows[0]["content"])
    assert rows[1]["trained"] and rows[1]["content"][:rows[1]["masked"]] == "<|assistant|>\n"


def test_a_very_long_conversation(spark):
    """Turns stay rows: 20,000 of them on each side, one of a million characters."""
    i = F.col("id")
    frame = spark.range(40_000).select((i % 2).alias("conv_id"), F.floor(i / 2).alias("turn"), F.when(F.floor(i / 2) % 2 == 0, "user").otherwise("assistant").alias("role"),
                                       F.when(i == 39_001, "z" * 1_000_000).otherwise(F.concat(F.lit("t"), F.floor(i / 2))).alias("text"))
    found = {r["part"]: (r["n"], r["first"]) for r in preference_examples(frame).groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.min("turn").alias("first")).collect()}
    assert found == {"prompt": (19_500, 0), "chosen": (500, 19_500), "rejected": (500, 19_500)}


def test_query_equals_its_sql(spark):
    assert difference(op8_preference_chat(spark, SF), duck(SF).execute(ORACLE_SQL).to_arrow_table()) is None
