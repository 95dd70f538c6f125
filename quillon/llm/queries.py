"""The queries of this subpackage, by name, and SQL for those it can express."""

from __future__ import annotations

from quillon.llm import chat, codebooks, decontam, exact_top, langid, line_dedup, lm_score, mixing, ngram_join, periods, pii, quality, token_files

QUERIES = {
    "op1_pii": pii.query,
    "op2_mixing": mixing.query,
    "op3_ngram_jaccard": ngram_join.query,
    "op4_line_dedup": line_dedup.query,
    "op5_lm_scoring": lm_score.query,
    "op6_quality_rules": quality.query,
    "op7_decontamination": decontam.query,
    "op8_token_files": token_files.query,
    "op9_language_id": langid.query,
    "op10_chat_formatting": chat.query,
    "op11_vector_codes": codebooks.query,
    "op12_periodic_runs": periods.query,
    "op13_exact_top": exact_top.query,
}

ORACLES = {
    "op2_mixing": mixing.ORACLE_SQL,
    "op3_ngram_jaccard": ngram_join.ORACLE_SQL,
    "op4_line_dedup": line_dedup.ORACLE_SQL,
    "op6_quality_rules": quality.ORACLE_SQL,
    "op7_decontamination": decontam.ORACLE_SQL,
    "op10_chat_formatting": chat.ORACLE_SQL,
    "op11_vector_codes": codebooks.ORACLE_SQL,
    "op12_periodic_runs": periods.ORACLE_SQL,
    "op13_exact_top": exact_top.ORACLE_SQL,
}
