"""Queries of this package and their SQL."""

from __future__ import annotations

from callcredit.llm import bpe, ctw, divergence, host_rules, itq, licences, mixing, ngram_join, prefix_trie, quality_net, repeats, sharding, toxicity

MODULES = (sharding, mixing, licences, host_rules, bpe, toxicity, repeats, ngram_join, ctw, itq, divergence, prefix_trie, quality_net)


def queries() -> dict:
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLE_SQL.items()}
