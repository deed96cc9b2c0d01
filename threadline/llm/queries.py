"""Queries of the corpus operators: one per operator, over its whole table."""

from __future__ import annotations

from threadline.llm import (bpe, collocations, decontaminate, exact_dedup, html_text, jaccard_join, license_scan, lm_score, packing, phrase_automata, quality_knn,
                            spelling, suffix_dedup)

QUERIES = {
    "op1_license_scan": license_scan.op1_license_scan,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_jaccard_join": jaccard_join.op3_jaccard_join,
    "op4_html_template_removal": html_text.op4_html_template_removal,
    "op5_lm_score": lm_score.op5_lm_score,
    "op6_suffix_array_dedup": suffix_dedup.op6_suffix_array_dedup,
    "op7_benchmark_decontamination": decontaminate.op7_benchmark_decontamination,
    "op8_best_fit_packing": packing.op8_best_fit_packing,
    "op9_quality_knn": quality_knn.op9_quality_knn,
    "op10_phrase_automata": phrase_automata.op10_phrase_automata,
    "op11_collocations": collocations.op11_collocations,
    "op12_spelling_variants": spelling.op12_spelling_variants,
    "op13_bpe": bpe.op13_bpe,
}

ORACLE = {
    "op2_exact_dedup": exact_dedup.ORACLE_SQL,
    "op3_jaccard_join": jaccard_join.ORACLE_SQL,
    "op7_benchmark_decontamination": decontaminate.ORACLE_SQL,
    "op10_phrase_automata": phrase_automata.ORACLE_SQL,
    "op11_collocations": collocations.ORACLE_SQL,
}
