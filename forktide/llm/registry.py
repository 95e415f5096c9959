"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import byte_dedup, chat, chunk_store, infill, language_id, near_dedup, ogg, packing, pieces, quality, resampling, sharding, substrings

QUERIES = {
    "op1_near_dedup": near_dedup.op1_near_dedup,
    "op2_sharding": sharding.op2_sharding,
    "op3_media_ogg": ogg.op3_media_ogg,
    "op5_substring_dedup": substrings.op5_substring_dedup,
    "op6_chunk_store": chunk_store.op6_chunk_store,
    "op7_chat_format": chat.op7_chat_format,
    "op8_sentencepiece": pieces.op8_sentencepiece,
    "op9_language_id": language_id.op9_language_id,
    "op4_packing": packing.op4_packing,
    "op10_quality_rules": quality.op10_quality_rules,
    "op11_importance_resampling": resampling.op11_importance_resampling,
    "op12_suffix_dedup": byte_dedup.op12_suffix_dedup,
    "op13_fill_in_middle": infill.op13_fill_in_middle,
}

ORACLE_SQL = {
    "op1_near_dedup": near_dedup.ORACLE_SQL,
    "op2_sharding": sharding.ORACLE_SQL,
    "op5_substring_dedup": substrings.ORACLE_SQL,
    "op7_chat_format": chat.ORACLE_SQL,
    "op11_importance_resampling": resampling.ORACLE_SQL,
    "op12_suffix_dedup": byte_dedup.ORACLE_SQL,
    "op13_fill_in_middle": infill.ORACLE_SQL,
}
