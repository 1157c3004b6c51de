"""Queries of the training-data operators and, where SQL can express them, their oracles."""

from . import decontamination, language_id, lm_scoring, minhash_dedup, mixing, quality_classifier, quality_rules, substring_dedup, toxicity, warc

QUERIES = {f.__name__: f for f in (
    lm_scoring.op1_lm_scoring,
    minhash_dedup.op2_minhash_dedup,
    substring_dedup.op3_substring_dedup,
    mixing.op4_mixing,
    quality_rules.op5_quality_rules,
    warc.op6_warc,
    decontamination.op7_decontamination,
    quality_classifier.op8_quality_classifier,
    toxicity.op9_toxicity,
    language_id.op10_language_id,
)}

ORACLES = {"op4_mixing": mixing.ORACLE, "op5_quality_rules": quality_rules.ORACLE}
