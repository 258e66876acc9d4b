"""The operators' queries and, where SQL can express them, their oracle statements."""

from __future__ import annotations

from . import bpe, chat, langid, line_dedup, mixing, quality_classifier, quality_rules, simhash, topk, toxicity


def queries() -> dict:
    return {
        "op1_quality_rules": quality_rules.op1_quality_rules,
        "op2_simhash": simhash.op2_simhash,
        "op3_mixing": mixing.op3_mixing,
        "op4_bpe": bpe.op4_bpe,
        "op5_line_dedup": line_dedup.op5_line_dedup,
        "op6_quality_classifier": quality_classifier.op6_quality_classifier,
        "op7_chat_format": chat.op7_chat_format,
        "op8_langid": langid.op8_langid,
        "op9_toxicity": toxicity.op9_toxicity,
        "op10_exact_topk": topk.op10_exact_topk,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quality_rules": quality_rules.OP1_SQL,
        "op5_line_dedup": line_dedup.OP5_SQL,
        "op7_chat_format": chat.OP7_SQL,
        "op10_exact_topk": topk.OP10_SQL,
    }
