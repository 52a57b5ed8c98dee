"""The registered queries of the corpus operators, (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from tavolo.llm import chat, codes, divergence, linededup, mixing, neighbours, packing, pii, quality, rules, simhash, toxicity, urlrules

QUERIES = {
    "op1_harmonic_packing": packing.op1_harmonic_packing,
    "op2_line_dedup": linededup.op2_line_dedup,
    "op3_adaptive_scan": neighbours.op3_adaptive_scan,
    "op4_simhash_golay": simhash.op4_simhash_golay,
    "op5_quality_gam": quality.op5_quality_gam,
    "op10_source_mixing": mixing.op10_source_mixing,
    "op11_orchard_codes": codes.op11_orchard_codes,
    "op12_source_divergence": divergence.op12_source_divergence,
    "op13_reply_trees": chat.op13_reply_trees,
    "op6_pii_disclosure": pii.op6_pii_disclosure,
    "op7_crf_rules": rules.op7_crf_rules,
    "op8_toxicity_subwords": toxicity.op8_toxicity_subwords,
    "op9_url_filters": urlrules.op9_url_filters,
}

#: DuckDB SQL where SQL can express the operator; the others are tested against brute force.
ORACLE = {**linededup.ORACLE, **urlrules.ORACLE, **divergence.ORACLE, **chat.ORACLE}
