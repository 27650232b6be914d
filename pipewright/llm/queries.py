"""The queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from . import attention_lm, bpe, chat_format, decontaminate, divergence, importance, language_id, line_dedup, merkle, quality_rules, simhash, site_style, suffix_repeats

QUERIES = {f.__name__: f for f in (
    site_style.op1_site_style,
    bpe.op2_bpe,
    chat_format.op3_chat,
    attention_lm.op4_attention_lm,
    quality_rules.op5_quality_rules,
    suffix_repeats.op6_suffix_dedup,
    importance.op7_importance,
    simhash.op8_simhash,
    decontaminate.op9_decontamination,
    line_dedup.op10_line_dedup,
    merkle.op11_merkle,
    language_id.op12_language,
    divergence.op13_divergence,
)}
ORACLE = {
    "op3_chat": chat_format.SQL,
    "op6_suffix_dedup": suffix_repeats.SQL,
    "op9_decontamination": decontaminate.SQL,
    "op10_line_dedup": line_dedup.SQL,
    "op11_merkle": merkle.SQL,
    "op13_divergence": divergence.SQL,
}
