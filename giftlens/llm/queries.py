"""The operators' registered queries and their SQL oracles."""

from __future__ import annotations

from giftlens.llm import (chat_format, conversation_trie, decontam, line_dedup, lm_score, mixing, near_dedup,
                          partition_search, quality_rules, secrets, toxicity, url_filter, whitening)


def queries() -> dict:
    return {
        "op1_chat_format": chat_format.op1,
        "op2_lm_score": lm_score.op2,
        "op3_decontaminate": decontam.op3,
        "op4_url_filter": url_filter.op4,
        "op5_mix": mixing.op5,
        "op6_secrets": secrets.op6,
        "op7_near_dedup": near_dedup.op7,
        "op8_toxicity": toxicity.op8,
        "op9_quality": quality_rules.op9,
        "op10_line_dedup": line_dedup.op10,
        "op11_conversation_trie": conversation_trie.op11,
        "op12_whitening": whitening.op12,
        "op13_partition_search": partition_search.op13,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_chat_format": chat_format.ORACLE,
        "op3_decontaminate": decontam.ORACLE,
        "op5_mix": mixing.ORACLE,
        "op7_near_dedup": near_dedup.ORACLE,
        "op9_quality": quality_rules.ORACLE,
        "op11_conversation_trie": conversation_trie.ORACLE,
    }
