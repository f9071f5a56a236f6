"""Queries of the operators in this subpackage, and the SQL that checks them."""

from __future__ import annotations

from jobsluice.llm import bpe, chat, decontaminate, exact_dedup, fill_middle, filter_audit, jaccard_join, language, pii, secrets, substring_dedup, toxicity, url_filter

LLM_QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_chat_format": chat.op2_chat_format,
    "op3_jaccard_join": jaccard_join.op3_jaccard_join,
    "op4_url_filter": url_filter.op4_url_filter,
    "op5_bpe": bpe.op5_bpe,
    "op6_substring_dedup": substring_dedup.op6_substring_dedup,
    "op7_language": language.op7_language,
    "op8_secret_scan": secrets.op8_secret_scan,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_decontaminate": decontaminate.op10_decontaminate,
    "op11_fill_middle": fill_middle.op11_fill_middle,
    "op12_pii": pii.op12_pii,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}
LLM_ORACLES = {
    "op2_chat_format": chat.ORACLE,
    "op4_url_filter": url_filter.ORACLE,
    "op9_exact_dedup": exact_dedup.ORACLE,
    "op10_decontaminate": decontaminate.ORACLE,
    "op11_fill_middle": fill_middle.ORACLE,
    "op13_filter_audit": filter_audit.ORACLE,
}
