"""Names of the corpus queries and their SQL twins."""

from __future__ import annotations

from strandline.llm import bpe, exact_dedup, exact_topk, filter_audit, html_text, license_scan, line_crf, ngram_join, packing, sharding, toxicity, url_filter, vector_codes

QUERIES = {
    "op1_url_filter": url_filter,
    "op2_toxicity": toxicity,
    "op3_exact_topk": exact_topk,
    "op4_html_text": html_text,
    "op5_ngram_join": ngram_join,
    "op6_line_crf": line_crf,
    "op7_bpe": bpe,
    "op8_sharding": sharding,
    "op9_packing": packing,
    "op10_exact_dedup": exact_dedup,
    "op11_filter_audit": filter_audit,
    "op12_license_scan": license_scan,
    "op13_vector_codes": vector_codes,
}


def queries() -> dict:
    return {name: module.query for name, module in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: module.ORACLE for name, module in QUERIES.items() if getattr(module, "ORACLE", None)}
