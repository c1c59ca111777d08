"""Preference formatting of conversations.

A chosen and a rejected conversation share their longest common prefix of turns. It is rendered once, as the
prompt; what differs follows as two completions, in which only the assistant's turns are trained on.

Turns stay rows throughout: no conversation is gathered in a task, however long, and turns are compared by
digests. A rendered example is its rows in order of ``part`` and ``turn``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoremill.llm.common import stage

OPEN, CLOSE = "<|", "<|end|>\n"


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, digest``: each turn once; of repeated ones the least stays. A null
    role or text counts as empty; rows without a conversation or a turn number are no turns."""
    said = F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    once = (conversations.filter("conv_id IS NOT NULL AND turn IS NOT NULL")
            .select("conv_id", "turn", said.alias("said"))
            .groupBy("conv_id", "turn").agg(F.min("said").alias("said")))
    digest = F.sha2(F.concat_ws("\x00", "said.role", "said.text"), 256)
    return once.select("conv_id", "turn", "said.role", "said.text", digest.alias("digest"))


def pairs_by_opening(turns: DataFrame) -> DataFrame:
    """``pair_id, chosen_id, rejected_id``: conversations that open alike answer one prompt.

    Of those the shortest (then the lowest identifier) is taken as chosen and each other one as rejected
    against it, so there are fewer pairs than conversations. One that nobody shares its opening with has
    no rejected side.
    """
    opened = turns.groupBy("conv_id").agg(
        F.min_by("digest", "turn").alias("opening"), F.count(F.lit(1)).alias("n"))
    opened = stage(opened, "openings")
    first = opened.groupBy("opening").agg(
        F.min(F.struct("n", "conv_id")).alias("least"), F.count(F.lit(1)).alias("sharing"))
    return (opened.join(first, "opening")
            .filter((F.col("conv_id") != F.col("least.conv_id")) | (F.col("sharing") == 1))
            .select(F.col("conv_id").alias("pair_id"), F.col("least.conv_id").alias("chosen_id"),
                    F.when(F.col("sharing") > 1, F.col("conv_id")).alias("rejected_id")))


def _sides(turns: DataFrame, pairs: DataFrame, *columns: str) -> DataFrame:
    """Each pair's turns of both sides: ``pair_id, chosen_id, rejected_id, chosen (boolean), turn, ...``."""
    of = lambda side: (pairs.filter(F.col(side).isNotNull()).withColumn("conv_id", F.col(side))
                       .join(turns.select("conv_id", "turn", *columns), "conv_id").drop("conv_id")
                       .withColumn("chosen", F.lit(side == "chosen_id")))
    return of("chosen_id").unionByName(of("rejected_id"))


def prefixes(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """``pair_id, differs_at``: the first turn that is not the same on both sides. Where there is no
    rejected side, the last turn of the assistant; null if nothing differs."""
    side = lambda chosen: F.max(F.when(F.col("chosen") == chosen, F.col("digest")))
    same = (_sides(turns, pairs.filter("rejected_id IS NOT NULL"), "digest").groupBy("pair_id", "turn")
            .agg(side(True).eqNullSafe(side(False)).alias("same")))
    paired = same.groupBy("pair_id").agg(F.min(F.when(~F.col("same"), F.col("turn"))).alias("differs_at"))
    single = (_sides(turns, pairs.filter("rejected_id IS NULL"), "role").groupBy("pair_id")
              .agg(F.max(F.when(F.col("role") == "assistant", F.col("turn"))).alias("differs_at")))
    return paired.unionByName(single)


def escaped(text: Column) -> Column:
    """No marker: every ``<`` before a bar gets a backslash more in between, so taking one away gives the text back."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def header(role: Column) -> Column:
    return F.concat(F.lit(OPEN), escaped(role), F.lit("|>\n"))


def rendered(role: Column, text: Column) -> Column:
    return F.concat(header(role), escaped(text), F.lit(CLOSE))


def preference_examples(conversations: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """One row for each turn of each example: ``pair_id, chosen_id, rejected_id, part, turn, content, trained, masked``.

    ``part`` is prompt, chosen or rejected; the prompt's turns appear once. ``trained`` marks the assistant's
    turns of the completions; all else is masked. ``masked`` counts the characters of the content, from its start, that are: of
    a trained turn those of its header, of another turn all. Markers within roles and texts are ``escaped``. ``pairs`` (pair_id, chosen_id, rejected_id) defaults to
    conversations that open alike. Sides that are equal give a prompt alone; a side that ends where the
    prompt ends has no rows. Null texts render as empty turns; other columns are not read.
    """
    turns = stage(turns_of(conversations), "turns")
    pairs = stage(pairs if pairs is not None else pairs_by_opening(turns), "pairs")
    cut = pairs.join(prefixes(turns, pairs), "pair_id")
    shared = F.col("differs_at").isNull() | (F.col("turn") < F.col("differs_at"))
    part = F.when(shared, "prompt").when(F.col("chosen"), "chosen").otherwise("rejected")
    content, trained = rendered(F.col("role"), F.col("text")), (F.col("part") != "prompt") & (F.col("role") == "assistant")
    return (_sides(turns, cut, "role", "text").withColumn("part", part)
            .filter(F.col("chosen") | (F.col("part") != "prompt"))
            .select("pair_id", "chosen_id", "rejected_id", "part", "turn", content.alias("content"), trained.alias("trained"),
                    F.when(trained, F.length(header(F.col("role")))).otherwise(F.length(content)).cast("bigint").alias("masked")))


ORACLE_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  WHERE conv_id IS NOT NULL AND turn IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY coalesce(role, ''), coalesce(text, '')) = 1),
o AS (SELECT conv_id, arg_min(role || chr(1) || text, turn) AS opening, count(*) AS n FROM t GROUP BY 1),
r AS (SELECT conv_id, first_value(conv_id) OVER (PARTITION BY opening ORDER BY n, conv_id) AS hub,
             count(*) OVER (PARTITION BY opening) AS sharing FROM o),
p AS (SELECT conv_id AS pair_id, hub AS chosen_id, CASE WHEN sharing > 1 THEN conv_id END AS rejected_id
      FROM r WHERE conv_id <> hub OR sharing = 1),
c AS (SELECT pair_id, turn, role, text FROM p JOIN t ON conv_id = chosen_id WHERE rejected_id IS NOT NULL),
j AS (SELECT pair_id, turn, role, text FROM p JOIN t ON conv_id = rejected_id),
d AS (
  SELECT pair_id, min(CASE WHEN c.role || chr(1) || c.text IS DISTINCT FROM j.role || chr(1) || j.text
                           THEN turn END) AS cut
  FROM c FULL JOIN j USING (pair_id, turn) GROUP BY 1
  UNION ALL
  SELECT pair_id, max(CASE WHEN role = 'assistant' THEN turn END)
  FROM p JOIN t ON conv_id = chosen_id WHERE rejected_id IS NULL GROUP BY 1),
s AS (
  SELECT p.*, turn, role, text, cut, true AS chosen FROM p JOIN d USING (pair_id) JOIN t ON conv_id = chosen_id
  UNION ALL
  SELECT p.*, turn, role, text, cut, false FROM p JOIN d USING (pair_id) JOIN t ON conv_id = rejected_id
  WHERE turn >= cut)
SELECT pair_id, chosen_id, rejected_id, turn, part, head || body AS content, trained,
       length(CASE WHEN trained THEN head ELSE head || body END) AS masked
FROM (
  SELECT *, CASE WHEN cut IS NULL OR turn < cut THEN 'prompt' WHEN chosen THEN 'chosen' ELSE 'rejected' END AS part,
         '<|' || regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g') || '|>' || chr(10) AS head,
         regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') || '<|end|>' || chr(10) AS body,
         cut IS NOT NULL AND turn >= cut AND role = 'assistant' AS trained FROM s)
"""
