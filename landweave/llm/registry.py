"""Queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from landweave.llm import op1_url_filter, op2_topk, op3_mixing, op4_quality, op5_packing, op6_secrets, op7_token_files, op8_licenses, op9_jaccard, op10_substrings, op11_toxicity, op12_whitening, op13_merkle

QUERIES = {
    "op8_licenses": op8_licenses.op8_licenses,
    "op2_topk": op2_topk.op2_topk,
    "op6_secrets": op6_secrets.op6_secrets,
    "op9_jaccard": op9_jaccard.op9_jaccard,
    "op10_substrings": op10_substrings.op10_substrings,
    "op1_url_filter": op1_url_filter.op1_url_filter,
    "op3_mixing": op3_mixing.op3_mixing,
    "op4_quality": op4_quality.op4_quality,
    "op5_packing": op5_packing.op5_packing,
    "op7_token_files": op7_token_files.op7_token_files,
    "op11_toxicity": op11_toxicity.op11_toxicity,
    "op12_whitening": op12_whitening.op12_whitening,
    "op13_merkle": op13_merkle.op13_merkle,
}
ORACLES = {"op8_licenses": op8_licenses.SQL, "op2_topk": op2_topk.SQL, "op9_jaccard": op9_jaccard.SQL, "op10_substrings": op10_substrings.SQL, "op4_quality": op4_quality.SQL, "op13_merkle": op13_merkle.SQL}
