"""Imports every operator, so that all queries are registered."""

from lexigrid.llm import (  # noqa: F401
    hilbert,
    warc,
    chat,
    line_cleaning,
    line_dedup,
    bm25_packing,
    weak_toxicity,
    decontaminate,
    trie_join,
    attention_lm,
    phrase_mining,
    url_rules,
    hard_negatives,
)
from lexigrid.llm.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
