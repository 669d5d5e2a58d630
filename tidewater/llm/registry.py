"""Registered queries of the text operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import chat, cutting_stock, decontaminate, fingerprint, jaccard, langid, packing, prefix_trie, spelling, substring_dedup, token_files, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard": jaccard.op1_ngram_jaccard,
    "op2_language_id": langid.op2_language_id,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_suffix_array_dedup": substring_dedup.op4_suffix_array_dedup,
    "op5_warc": warc.op5_warc,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_chat_format": chat.op7_chat_format,
    "op8_best_fit_packing": packing.op8_best_fit_packing,
    "op9_fingerprints": fingerprint.op9_fingerprints,
    "op10_token_files": token_files.op10_token_files,
    "op11_prefix_trie": prefix_trie.op11_prefix_trie,
    "op12_cutting_stock": cutting_stock.op12_cutting_stock,
    "op13_spelling_variants": spelling.op13_spelling_variants,
}
ORACLES: dict[str, str] = {
    "op1_ngram_jaccard": jaccard.ORACLE_SQL,
    "op5_warc": warc.ORACLE_SQL,
    "op6_decontaminate": decontaminate.ORACLE_SQL,
    "op7_chat_format": chat.ORACLE_SQL,
    "op11_prefix_trie": prefix_trie.ORACLE_SQL,
    "op13_spelling_variants": spelling.ORACLE_SQL,
}
