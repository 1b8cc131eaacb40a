"""The queries of this subpackage, one per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from creditspark.llm import (conversation_trie, decontam, jaccard_join, minhash_dedup, packing, pii, pseudo_likelihood, quality_classifier,
                             quality_rules, sharding, substring_dedup, token_alignment, url_filter)
from creditspark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": lambda spark, sf: url_filter.report(table(spark, sf, "pages")),
    "op2_packing": lambda spark, sf: packing.report(table(spark, sf, "documents")),
    "op3_decontam": lambda spark, sf: decontam.report(table(spark, sf, "documents"), table(spark, sf, "benchmark")),
    "op4_jaccard_join": lambda spark, sf: jaccard_join.report(table(spark, sf, "documents")),
    "op5_pii": lambda spark, sf: pii.report(table(spark, sf, "documents")),
    "op6_sharding": lambda spark, sf: sharding.report(table(spark, sf, "documents")),
    "op7_quality_classifier": lambda spark, sf: quality_classifier.report(table(spark, sf, "documents"), table(spark, sf, "labels")),
    "op8_quality_rules": lambda spark, sf: quality_rules.report(table(spark, sf, "documents")),
    "op9_substring_dedup": lambda spark, sf: substring_dedup.report(table(spark, sf, "documents")),
    "op10_pseudo_likelihood": lambda spark, sf: pseudo_likelihood.report(table(spark, sf, "documents")),
    "op11_conversation_trie": lambda spark, sf: conversation_trie.report(table(spark, sf, "conversations")),
    "op12_token_alignment": lambda spark, sf: token_alignment.report(table(spark, sf, "documents")),
    "op13_minhash_dedup": lambda spark, sf: minhash_dedup.report(table(spark, sf, "documents")),
}
ORACLES: dict[str, str] = {
    "op1_url_filter": url_filter.ORACLE,
    "op3_decontam": decontam.ORACLE,
    "op4_jaccard_join": jaccard_join.ORACLE,
    "op8_quality_rules": quality_rules.ORACLE,
    "op11_conversation_trie": conversation_trie.ORACLE,
    "op13_minhash_dedup": minhash_dedup.ORACLE,
}
