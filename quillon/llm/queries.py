"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from quillon.llm import bpe, fingerprints, language_id, line_dedup, lm, mixing, near_dup, passages, sharding, vector_dedup

QUERIES = {
    "op1_repeated_passages": passages.op1_repeated_passages,
    "op2_vector_dedup": vector_dedup.op2_vector_dedup,
    "op3_line_dedup": line_dedup.op3_line_dedup,
    "op4_mix_sources": mixing.op4_mix_sources,
    "op5_lm_score": lm.op5_lm_score,
    "op6_near_dup": near_dup.op6_near_dup,
    "op7_shards": sharding.op7_shards,
    "op8_fingerprints": fingerprints.op8_fingerprints,
    "op9_language_id": language_id.op9_language_id,
    "op10_byte_bpe": bpe.op10_byte_bpe,
}
ORACLES = {"op2_vector_dedup": vector_dedup.ORACLE, "op3_line_dedup": line_dedup.ORACLE, "op6_near_dup": near_dup.ORACLE}
