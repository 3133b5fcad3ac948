"""Registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from pageprism.llm import (
    alignment, hilbert, lang_id, line_rules, mixing, packing, pseudo_lm, records, secret_scan, simhash, spelling, token_counts, topk,
)

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_secret_scan": secret_scan.op2_secret_scan,
    "op3_packing": packing.op3_packing,
    "op4_simhash": simhash.op4_simhash,
    "op5_line_rules": line_rules.op5_line_rules,
    "op6_language": lang_id.op6_language,
    "op7_pseudo_likelihood": pseudo_lm.op7_pseudo_likelihood,
    "op8_topk": topk.op8_topk,
    "op9_hilbert_shards": hilbert.op9_hilbert_shards,
    "op10_token_records": records.op10_token_records,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_alignment": alignment.op12_alignment,
    "op13_token_counts": token_counts.op13_token_counts,
}

ORACLES = {
    "op1_mixing": mixing.OP1_SQL,
    "op5_line_rules": line_rules.OP5_SQL,
    "op8_topk": topk.OP8_SQL,
}
