"""The queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from lakeloom.llm import (
    decontaminate,
    language_id,
    lm_scoring,
    mixing,
    quality_knn,
    quality_rules,
    simhash,
    substring_dedup,
    toxicity,
    warc_zip,
)

QUERIES = {
    "op1_quality_rules": quality_rules.op1_quality_rules,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_lm": lm_scoring.op3_lm,
    "op4_language": language_id.op4_language,
    "op5_quality": quality_knn.op5_quality,
    "op6_substring_dedup": substring_dedup.op6_substring_dedup,
    "op7_warc": warc_zip.op7_warc,
    "op8_mixing": mixing.op8_mixing,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_simhash": simhash.op10_simhash,
    "quality_ablation": quality_rules.quality_ablation,
}
ORACLES = {
    "op1_quality_rules": quality_rules.ORACLE,
    "quality_ablation": quality_rules.ABLATION_ORACLE,
    "op2_decontaminate": decontaminate.ORACLE,
    "op6_substring_dedup": substring_dedup.ORACLE,
    "op7_warc": warc_zip.ORACLE,
    "op8_mixing": mixing.ORACLE,
}
