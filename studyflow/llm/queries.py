"""Queries of this package, one for each numbered operator, and the pipeline; SQL where it can express them."""

from __future__ import annotations

import corpus_pipeline
from studyflow.llm import centroids, exact_dedup, html_main, importance, licences, minhash, packing, pieces, pii, quality, resampling, suffix_dedup, winnowing

QUERIES = {
    "op1_pii": pii.op1_pii,
    "op2_html_extraction": html_main.op2_html_extraction,
    "op3_license_scan": licences.op3_license_scan,
    "op4_quality_classifier": quality.op4_quality_classifier,
    "op5_best_fit_packing": packing.op5_best_fit_packing,
    "op6_sentencepiece": pieces.op6_sentencepiece,
    "op7_suffix_array_dedup": suffix_dedup.op7_suffix_array_dedup,
    "op8_minhash_near_dedup": minhash.op8_minhash_near_dedup,
    "op9_quality_rules": importance.op9_quality_rules,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_importance_resampling": resampling.op11_importance_resampling,
    "op12_centroid_clustering": centroids.op12_centroid_clustering,
    "op13_benchmark_decontamination": winnowing.op13_benchmark_decontamination,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {
    "op3_license_scan": licences.OP3_SQL,
    "op10_exact_dedup": exact_dedup.OP10_SQL,
    "op12_centroid_clustering": centroids.OP12_SQL,
    "op13_benchmark_decontamination": winnowing.OP13_SQL,
}
