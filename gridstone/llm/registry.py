"""The queries of this subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

from . import best_fit, chat_format, decontaminate, dialog_repair, jaccard_join, lattice_lm, line_dedup, phrase_graph, piecewise_hash, pseudonyms, quality_rules, substring_dedup, suffix_dedup

QUERIES = {
    "op1_benchmark_decontamination": decontaminate.query,
    "op2_pii_pseudonyms": pseudonyms.query,
    "op3_lm_scoring": lattice_lm.query,
    "op4_substring_dedup": substring_dedup.query,
    "op5_ngram_jaccard_join": jaccard_join.query,
    "op6_line_dedup": line_dedup.query,
    "op7_chat_formatting": chat_format.query,
    "op8_best_fit_packing": best_fit.query,
    "op9_suffix_array_dedup": suffix_dedup.query,
    "op10_quality_rules": quality_rules.query,
    "op11_phrase_collocations": phrase_graph.query,
    "op12_conversation_repair": dialog_repair.query,
    "op13_document_fingerprints": piecewise_hash.query,
}

ORACLES = {
    "op6_line_dedup": line_dedup.ORACLE,
    "op7_chat_formatting": chat_format.ORACLE,
    "op10_quality_rules": quality_rules.ORACLE,
    "op11_phrase_collocations": phrase_graph.ORACLE,
}
