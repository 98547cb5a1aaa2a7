"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import bpe, class_lm, decontaminate, divergence, html_extract, language_id, near_dedup, packing, periodic, quality, sanitise, sharding, toxicity

QUERIES = {
    "op2_toxicity": toxicity.op2_toxicity,
    "op1_main_text": html_extract.op1_main_text,
    "op3_language_id": language_id.op3_language_id,
    "op6_sanitise": sanitise.op6_sanitise,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_near_dedup": near_dedup.op5_near_dedup,
    "op7_extendible_shards": sharding.op7_extendible_shards,
    "op8_class_lm": class_lm.op8_class_lm,
    "op9_bpe": bpe.op9_bpe,
    "op10_quality": quality.op10_quality,
    "op11_divergence": divergence.op11_divergence,
    "op12_periodic_runs": periodic.op12_periodic_runs,
    "op13_packing": packing.op13_packing,
}

SQL = {
    "op4_decontaminate": decontaminate.SQL,
    "op5_near_dedup": near_dedup.SQL,
    "op7_extendible_shards": sharding.SQL,
    "op11_divergence": divergence.SQL,
}
