"""One query per operator, over its whole tables, and the SQL of those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from scoremill.llm import (
    bpe, chat, collocations, exact_dedup, html_text, licenses, near_dedup, packing, quality,
    ranked_search, suffix_tree, toxicity, vector_topk)
from scoremill.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

MULTI_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    return toxicity.severity(docs, toxicity.fit(docs, table(spark, sf, "labels")))


def op2_byte_bpe(spark, sf):
    return bpe.round_trip(table(spark, sf, "documents"), MULTI_RANKS, public_tokenizers.PATTERN)


def op3_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"), TOKENIZER, RANKS, public_tokenizers.PATTERN)


def op4_near_dedup(spark, sf):
    return near_dedup.near_duplicates(table(spark, sf, "documents"))


def op5_html_extraction(spark, sf):
    return html_text.extract(table(spark, sf, "pages"))


def op6_suffix_tree(spark, sf):
    return suffix_tree.score(table(spark, sf, "documents"))


def op7_license_scan(spark, sf):
    return licenses.licenses(table(spark, sf, "documents"))


def op8_preference_chat(spark, sf):
    return chat.preference_examples(table(spark, sf, "conversations"))


def op9_quality_rules(spark, sf):
    return quality.quality(table(spark, sf, "documents"))


def op10_exact_dedup(spark, sf):
    return exact_dedup.exact_duplicates(table(spark, sf, "documents"))


def op11_collocations(spark, sf):
    return collocations.collocations(table(spark, sf, "documents"))


def op12_vector_topk(spark, sf):
    return vector_topk.top_k(table(spark, sf, "embeddings"), lambda key: key % 50 == 0)


def op13_ranked_search(spark, sf):
    return ranked_search.ranked_search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def queries() -> dict[str, Query]:
    found = [op1_toxicity, op2_byte_bpe, op3_packing, op4_near_dedup, op5_html_extraction, op6_suffix_tree,
             op7_license_scan, op8_preference_chat, op9_quality_rules, op10_exact_dedup, op11_collocations, op12_vector_topk,
             op13_ranked_search]
    return {q.__name__: q for q in found}


def oracle_sql() -> dict[str, str]:
    return {"op4_near_dedup": near_dedup.ORACLE_SQL, "op5_html_extraction": html_text.ORACLE_SQL,
            "op8_preference_chat": chat.ORACLE_SQL, "op10_exact_dedup": exact_dedup.ORACLE_SQL,
            "op11_collocations": collocations.ORACLE_SQL, "op12_vector_topk": vector_topk.ORACLE_SQL,
            "op13_ranked_search": ranked_search.ORACLE_SQL}
