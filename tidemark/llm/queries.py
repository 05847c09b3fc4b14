"""The registered queries of this subpackage, one per operator, and their SQL."""

from __future__ import annotations

from tidemark.llm import byte_pair, chat, discriminant, divergence, fill_middle, licences, mixing, near_copies, personal_data, quality_rules, sql, token_files, top_k, toxicity

QUERIES = {
    "op1_quality_rules": quality_rules.op1,
    "op2_quality_discriminant": discriminant.op2,
    "op3_pareto_mixing": mixing.op3,
    "op4_licence_scan": licences.op4,
    "op5_top_k": top_k.op5,
    "op6_toxicity": toxicity.op6,
    "op7_byte_pair": byte_pair.op7,
    "op8_chat_format": chat.op8,
    "op9_personal_data": personal_data.op9,
    "op10_near_copies": near_copies.op10,
    "op11_source_divergence": divergence.op11,
    "op12_fill_middle": fill_middle.op12,
    "op13_token_files": token_files.op13,
}
ORACLE = {
    "op1_quality_rules": sql.OP1,
    "op3_pareto_mixing": sql.OP3,
    "op4_licence_scan": sql.OP4,
    "op5_top_k": sql.OP5,
    "op8_chat_format": sql.OP8,
    "op10_near_copies": sql.OP10,
    "op11_source_divergence": sql.OP11,
    "op12_fill_middle": sql.OP12,
}
