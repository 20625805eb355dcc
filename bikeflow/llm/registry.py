"""The queries of this subpackage by name, and their SQL where SQL can express them."""

from __future__ import annotations

from bikeflow.llm import collocations, decontaminate, language_id, license_scan, line_dedup, ngram_join, packing, token_counts, token_files, topk_search, toxicity, url_filter, whitening

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_url_filters": url_filter.op2_url_filters,
    "op3_token_counts": token_counts.op3_token_counts,
    "op4_language_id": language_id.op4_language_id,
    "op5_benchmark_decontamination": decontaminate.op5_benchmark_decontamination,
    "op6_license_scans": license_scan.op6_license_scans,
    "op7_packing": packing.op7_packing,
    "op8_ngram_jaccard_join": ngram_join.op8_ngram_jaccard_join,
    "op9_line_dedup": line_dedup.op9_line_dedup,
    "op10_exact_topk_search": topk_search.op10_exact_topk_search,
    "op11_embedding_whitening": whitening.op11_embedding_whitening,
    "op12_token_binary": token_files.op12_token_binary,
    "op13_phrase_collocations": collocations.op13_phrase_collocations,
}

SQL = {
    "op2_url_filters": url_filter.OP2_SQL,
    "op5_benchmark_decontamination": decontaminate.OP5_SQL,
    "op6_license_scans": license_scan.OP6_SQL,
    "op8_ngram_jaccard_join": ngram_join.OP8_SQL,
    "op10_exact_topk_search": topk_search.OP10_SQL,
    "op13_phrase_collocations": collocations.OP13_SQL,
}
