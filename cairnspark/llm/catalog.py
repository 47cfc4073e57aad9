"""Queries of the training-data operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from . import exact_dedup, language_id, mixing, packing, pii, quality_classifier, quality_rules, secrets, simhash, warc

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_mixing": mixing.op2_mixing,
    "op3_simhash": simhash.op3_simhash,
    "op4_pii": pii.op4_pii,
    "op5_packing": packing.op5_packing,
    "op6_quality": quality_classifier.op6_quality,
    "op7_secrets": secrets.op7_secrets,
    "op8_language_id": language_id.op8_language_id,
    "op9_warc": warc.op9_warc,
    "op10_quality_rules": quality_rules.op10_quality_rules,
}

SQL = {
    "op1_exact_dedup": exact_dedup.OP1_SQL,
    "op2_mixing": mixing.OP2_SQL,
    "op9_warc": warc.OP9_SQL,
    "op10_quality_rules": quality_rules.OP10_SQL,
}
