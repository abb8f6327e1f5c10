"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from faultline.llm import (
    decontamination, filter_audit, gam, language, licenses, merkle, mixing, near_duplicates, private_data, quality_rules, substring_dedup,
    suffix_dedup, token_files,
)

QUERIES = {
    f.__name__: f
    for f in (
        near_duplicates.op1_ngram_jaccard, language.op2_language_id, mixing.op3_source_mix, quality_rules.op4_quality_rules,
        licenses.op5_license_scan, substring_dedup.op6_substring_dedup, gam.op7_quality_gam, decontamination.op8_decontaminate,
        suffix_dedup.op9_suffix_dedup, token_files.op10_token_files,
        private_data.op11_private_data, filter_audit.op12_filter_audit, merkle.op13_merkle_manifest,
    )
}

ORACLE = {
    "op1_ngram_jaccard": near_duplicates.SQL,
    "op5_license_scan": licenses.SQL,
    "op6_substring_dedup": substring_dedup.SQL,
    "op9_suffix_dedup": suffix_dedup.SQL,
    "op12_filter_audit": filter_audit.SQL,
    "op13_merkle_manifest": merkle.SQL,
}
