"""The registered queries of the corpus operators and their DuckDB counterparts."""

from __future__ import annotations

from . import bpe, contamination, jaccard, langid, maxent, mixing, negatives, passages, phrases, pii, quality, sharding, suffix

QUERIES = {
    "op1_bpe": bpe.op1,
    "op2_quality_rules": quality.op2,
    "quality_ablations": quality.ablation_report,
    "op3_sharding": sharding.op3,
    "op4_lm_scores": maxent.op4,
    "op5_jaccard_join": jaccard.op5,
    "op6_decontamination": contamination.op6,
    "op7_compact_windows": passages.op7,
    "op8_language_id": langid.op8,
    "op9_pii_pseudonyms": pii.op9,
    "op10_suffix_dedup": suffix.op10,
    "op11_hard_negatives": negatives.op11,
    "op12_source_mix": mixing.op12,
    "op13_collocations": phrases.op13,
}

ORACLE_SQL = {"op2_quality_rules": quality.ORACLE, "quality_ablations": quality.ABLATION_ORACLE, "op5_jaccard_join": jaccard.ORACLE, "op6_decontamination": contamination.ORACLE, "op11_hard_negatives": negatives.ORACLE, "op13_collocations": phrases.ORACLE}
