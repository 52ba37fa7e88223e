"""Queries of this package by name, with DuckDB SQL where SQL can express them."""

from tallyspark.llm import chat, decontaminate, jaccard, mixing, packing, pii, prefixtrie, quality, runindex, substring, toxicity, urls, whitening

QUERIES = {
    "op3_benchmark_decontamination": decontaminate.query,
    "op5_pii": pii.query,
    "op6_toxicity": toxicity.query,
    "op10_ngram_jaccard_join": jaccard.query,
    "op1_substring_dedup": substring.query,
    "op7_suffix_array_dedup": runindex.query,
    "op2_chat_formatting": chat.query,
    "op4_quality_rules": quality.query,
    "op8_mixing": mixing.query,
    "op9_url_filters": urls.query,
    "op11_best_fit_packing": packing.query,
    "op12_conversation_prefix_trie": prefixtrie.query,
    "op13_embedding_whitening": whitening.query,
}

ORACLE = {
    "op10_ngram_jaccard_join": jaccard.SQL,
    "op1_substring_dedup": substring.SQL,
    "op2_chat_formatting": chat.SQL,
    "op4_quality_rules": quality.SQL,
    "op8_mixing": mixing.SQL,
    "op9_url_filters": urls.SQL,
    "op12_conversation_prefix_trie": prefixtrie.SQL,
}
