"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import (conversation_repair, decontamination, exact_dedup, jaccard_join, language_id, lm_scoring, merkle, packing, pii, piece_encoding,
               quality_classifier, quality_rules, token_files)

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_quality_classifier": quality_classifier.op3_quality_classifier,
    "op4_piece_encoding": piece_encoding.op4_piece_encoding,
    "op5_quality_rules": quality_rules.op5_quality_rules,
    "op6_token_files": token_files.op6_token_files,
    "op7_pii": pii.op7_pii,
    "op8_language_id": language_id.op8_language_id,
    "op9_jaccard_join": jaccard_join.op9_jaccard_join,
    "op10_lm_scoring": lm_scoring.op10_lm_scoring,
    "op11_decontamination": decontamination.op11_decontamination,
    "op12_conversation_repair": conversation_repair.op12_conversation_repair,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
}
ORACLE_SQL = {
    "op2_exact_dedup": exact_dedup.ORACLE,
    "op11_decontamination": decontamination.ORACLE,
    "op12_conversation_repair": conversation_repair.ORACLE,
    "op13_merkle_manifest": merkle.ORACLE,
}
