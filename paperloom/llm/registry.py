"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import decontaminate, html_text, license_scan, line_dedup, near_dedup, pii, quality_rules, sentencepiece, source_audit, token_tables, toxicity, url_filters, vector_codes

QUERIES = {
    "op1_quality_rules": quality_rules.op1_quality_rules,
    "op2_sentencepiece": sentencepiece.op2_sentencepiece,
    "op3_license_scan": license_scan.op3_license_scan,
    "op4_pii": pii.op4_pii,
    "op5_line_dedup": line_dedup.op5_line_dedup,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_token_tables": token_tables.op7_token_tables,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_near_dedup": near_dedup.op9_near_dedup,
    "op10_html_text": html_text.op10_html_text,
    "op11_vector_codes": vector_codes.op11_vector_codes,
    "op12_source_audit": source_audit.op12_source_audit,
    "op13_url_filters": url_filters.op13_url_filters,
}

SQL = {
    "op1_quality_rules": quality_rules.SQL,
    "op3_license_scan": license_scan.SQL,
    "op4_pii": pii.SQL,
    "op6_decontaminate": decontaminate.SQL,
    "op11_vector_codes": vector_codes.SQL,
    "op12_source_audit": source_audit.SQL,
    "op13_url_filters": url_filters.SQL,
}
