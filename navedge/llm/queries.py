"""Registered queries of this package, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from . import (bpe_chunks, decontaminate, exact_dedup, hard_negatives, html_extract, packing, prefix_trie, secret_scan, simhash,
               token_store, topk, toxicity, url_filter)

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_token_store": token_store.op2_token_store,
    "op3_simhash": simhash.op3_simhash,
    "op4_html": html_extract.op4_html,
    "op5_secrets": secret_scan.op5_secrets,
    "op6_topk": topk.op6_topk,
    "op7_exact_dedup": exact_dedup.op7_exact_dedup,
    "op8_byte_bpe": bpe_chunks.op8_byte_bpe,
    "op9_packing": packing.op9_packing,
    "op10_url_filter": url_filter.op10_url_filter,
    "op11_prefix_trie": prefix_trie.op11_prefix_trie,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_decontaminate": decontaminate.op13_decontaminate,
}

ORACLE = {
    "op6_topk": topk.SQL,
    "op7_exact_dedup": exact_dedup.SQL,
    "op11_prefix_trie": prefix_trie.SQL,
    "op12_hard_negatives": hard_negatives.SQL,
    "op13_decontaminate": decontaminate.SQL,
}
