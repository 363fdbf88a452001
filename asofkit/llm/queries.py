"""The queries of this subpackage by name, and SQL twins of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from asofkit.llm import (
    bpe, exact_dedup, mixing, ngram_join, pii, prefix_trie, quality_classifier, quality_rules, repair, secret_scan, simhash, token_counts, url_filter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": secret_scan.op1_secret_scan,
    "op2_bpe": bpe.op2_bpe,
    "op3_url_filter": url_filter.op3_url_filter,
    "op4_quality_classifier": quality_classifier.op4_quality_classifier,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_pii": pii.op6_pii,
    "op7_token_counts": token_counts.op7_token_counts,
    "op8_mixing": mixing.op8_mixing,
    "op9_ngram_join": ngram_join.op9_ngram_join,
    "op10_quality_rules": quality_rules.op10_quality_rules,
    "op11_conversation_repair": repair.op11_conversation_repair,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_simhash_dedup": simhash.op13_simhash_dedup,
}

ORACLES: dict[str, str] = {
    "op5_exact_dedup": exact_dedup.OP5_SQL,
    "op11_conversation_repair": repair.OP11_SQL,
    "op12_prefix_trie": prefix_trie.OP12_SQL,
}
