"""Registered queries of this package and their SQL counterparts."""

from __future__ import annotations

from corpusloom.llm import byte_bpe, chat, class_model, fill_middle, fingerprint, language, mixing, near_dup, substring_dup, toxicity, turn_repair, url_filter, vector_dup

QUERIES = {
    "op1_url_filters": url_filter.op1_url_filters,
    "op2_class_model": class_model.op2_class_model,
    "op3_embedding_near_dedup": vector_dup.op3_embedding_near_dedup,
    "op4_minhash_near_dedup": near_dup.op4_minhash_near_dedup,
    "op5_document_fingerprints": fingerprint.op5_document_fingerprints,
    "op6_language_id": language.op6_language_id,
    "op7_byte_bpe": byte_bpe.op7_byte_bpe,
    "op8_mixing": mixing.op8_mixing,
    "op9_chat_formatting": chat.op9_chat_formatting,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_substring_dedup": substring_dup.op11_substring_dedup,
    "op12_conversation_repair": turn_repair.op12_conversation_repair,
    "op13_fill_in_middle": fill_middle.op13_fill_in_middle,
}
ORACLES = {
    "op1_url_filters": url_filter.SQL,
    "op8_mixing": mixing.SQL,
    "op9_chat_formatting": chat.SQL,
    "op11_substring_dedup": substring_dup.SQL,
    "op12_conversation_repair": turn_repair.SQL,
    "op13_fill_in_middle": fill_middle.SQL,
}
