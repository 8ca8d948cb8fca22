"""The queries of this subpackage by name, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from . import fingerprint, html_text, lines, mixing, near_dup, pii, segment, suffixes, topk, toxicity

QUERIES = {
    "op1_sentencepiece": segment.op1,
    "op2_suffix_dedup": suffixes.op2,
    "op3_pseudonyms": pii.op3,
    "op4_extract_html": html_text.op4,
    "op5_toxicity": toxicity.op5,
    "op6_mix_sources": mixing.op6,
    "op7_fingerprint": fingerprint.op7,
    "op8_top_k": topk.op8,
    "op9_near_duplicates": near_dup.op9,
    "op10_line_dedup": lines.op10,
    "op10_recurring_lines": lines.op10_all,
    "fingerprint_links": fingerprint.fingerprint_links,
}

ORACLES = {
    "op6_mix_sources": mixing.OP6_SQL,
    "op8_top_k": topk.OP8_SQL,
    "op10_line_dedup": lines.OP10_SQL,
}
