"""The registered queries of this subpackage and the DuckDB SQL of those that
SQL can express."""

from __future__ import annotations

from noema.llm import (
    conversation_repair, decontaminate, embedding_dedup, jaccard_join, language_id, license_scan, mixing,
    preference_format, sharding, suffix_dedup, token_counts, toxicity, whitening)

QUERIES = {
    "op1_language_id": language_id.op1,
    "op2_toxicity": toxicity.op2,
    "op3_embedding_dedup": embedding_dedup.op3,
    "op4_mix_sources": mixing.op4,
    "op5_jaccard_join": jaccard_join.op5,
    "op6_preference_format": preference_format.op6,
    "op7_token_counts": token_counts.op7,
    "op8_decontaminate": decontaminate.op8,
    "op9_license_scan": license_scan.op9,
    "op10_suffix_dedup": suffix_dedup.op10,
    "op11_shards": sharding.op11,
    "op12_conversation_repair": conversation_repair.op12,
    "op13_whitening": whitening.op13,
}

ORACLE: dict[str, str] = {
    "op3_embedding_dedup": embedding_dedup.OP3_SQL,
    "op4_mix_sources": mixing.OP4_SQL,
    "op5_jaccard_join": jaccard_join.OP5_SQL,
    "op6_preference_format": preference_format.OP6_SQL,
    "op8_decontaminate": decontaminate.OP8_SQL,
    "op9_license_scan": license_scan.OP9_SQL,
    "op12_conversation_repair": conversation_repair.OP12_SQL,
}
