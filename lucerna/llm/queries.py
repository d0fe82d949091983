"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from importlib import import_module

MODULES = {
    "op1_minhash_near_dedup": "op1_minhash",
    "op2_language_id": "op2_language",
    "op3_fingerprints": "op3_fingerprint",
    "op4_substring_dedup": "op4_substring",
    "op5_quality_classifier": "op5_quality",
    "op6_pitman_yor_scores": "op6_pitman_yor",
    "op7_license_scan": "op7_license",
    "op8_suffix_array_dedup": "op8_suffix_array",
    "op9_benchmark_decontamination": "op9_decontamination",
    "op10_best_fit_packing": "op10_packing",
    "op11_filter_audit": "op11_filter_audit",
    "op12_spelling_variants": "op12_spelling",
    "op13_token_counts": "op13_token_counts",
}


def queries():
    return {name: import_module(f".{module}", __package__).query for name, module in MODULES.items()}


def oracle_sql():
    found = {name: getattr(import_module(f".{module}", __package__), "ORACLE", None) for name, module in MODULES.items()}
    return {k: v for k, v in found.items() if v}
