"""Queries of this subpackage and their DuckDB SQL."""

from . import (collocations, decontamination, exact_dedup, hard_negatives, html_extraction, huffman_output, line_dedup,
               packing, quality_classifier, simhash_dedup, substring_dedup, toxicity, url_filter)

QUERIES = {
    "op1_best_fit_packing": packing.op1_best_fit_packing,
    "op2_url_filters": url_filter.op2_url_filters,
    "op3_line_dedup": line_dedup.op3_line_dedup,
    "op4_huffman_output": huffman_output.op4_huffman_output,
    "op5_simhash_dedup": simhash_dedup.op5_simhash_dedup,
    "op6_benchmark_decontamination": decontamination.op6_benchmark_decontamination,
    "op7_quality_classifier": quality_classifier.op7_quality_classifier,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_html_extraction": html_extraction.op9_html_extraction,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_phrase_collocation_mining": collocations.op11_phrase_collocation_mining,
    "op12_substring_dedup": substring_dedup.op12_substring_dedup,
    "op13_hard_negative_mining": hard_negatives.op13_hard_negative_mining,
}

ORACLE_SQL = {
    "op3_line_dedup": line_dedup.ORACLE_SQL,
    "op6_benchmark_decontamination": decontamination.ORACLE_SQL,
    "op10_exact_dedup": exact_dedup.ORACLE_SQL,
    "op11_phrase_collocation_mining": collocations.ORACLE_SQL,
    "op12_substring_dedup": substring_dedup.ORACLE_SQL,
    "op13_hard_negative_mining": hard_negatives.ORACLE_SQL,
}
