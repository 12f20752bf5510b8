"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from . import ball_kmeans, divergence, exact_dedup, html_extraction, license_scan, lm_scoring, mixing, near_dedup, packing, quality_classifier, quality_rules, substring_dedup, warc


def queries() -> dict:
    return {
        "op1_quality_rules": quality_rules.query,
        "op2_quality_classifier": quality_classifier.query,
        "op3_hyperminhash_near_dedup": near_dedup.query,
        "op4_exact_dedup": exact_dedup.query,
        "op5_soft_mixing": mixing.query,
        "op6_license_scan": license_scan.query,
        "op7_recurrent_lm": lm_scoring.query,
        "op8_best_fit_packing": packing.query,
        "op9_html_extraction": html_extraction.query,
        "op10_fm_index_substring_dedup": substring_dedup.query,
        "op11_source_divergence": divergence.query,
        "op12_ball_kmeans": ball_kmeans.query,
        "op13_warc": warc.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_exact_dedup": exact_dedup.ORACLE_SQL,
        "op6_license_scan": license_scan.oracle_sql(),
        "op10_fm_index_substring_dedup": substring_dedup.ORACLE_SQL,
        "op11_source_divergence": divergence.ORACLE_SQL,
        "op12_ball_kmeans": ball_kmeans.oracle_sql(),
        "op13_warc": warc.ORACLE_SQL,
    }
