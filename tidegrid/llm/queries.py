"""The training-data queries by name, and SQL for those that SQL can express."""

from __future__ import annotations

from . import op4_near_dedup, op5_mixing, op6_quality_rules, op7_warc, op8_decontaminate, op9_sharding, op10_language_model
from .op1_toxicity import op1_toxicity
from .op2_substring_dedup import op2_substring_dedup
from .op3_quality_crf import op3_quality_crf
from .oracles import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_quality_crf": op3_quality_crf,
    "op4_near_dedup": op4_near_dedup.op4_near_dedup,
    "op5_mixing": op5_mixing.op5_mixing,
    "op6_quality_rules": op6_quality_rules.op6_quality_rules,
    "op7_warc": op7_warc.op7_warc,
    "op8_decontaminate": op8_decontaminate.op8_decontaminate,
    "op9_sharding": op9_sharding.op9_sharding,
    "op10_language_model": op10_language_model.op10_language_model,
}

