"""Registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from tarmac.llm import (balanced_shards, bsi_topk, byte_bpe, decontaminate, hard_negatives, jaccard_tree, language_id, license_digest, packing,
                        revisits, suffix_dedup, toxicity, whitening)

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
    "op2_bsi_topk": bsi_topk.op2_bsi_topk,
    "op3_language_id": language_id.op3_language_id,
    "op4_balanced_shards": balanced_shards.op4_balanced_shards,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_revisits": revisits.op6_revisits,
    "op7_packing": packing.op7_packing,
    "op8_license_digest": license_digest.op8_license_digest,
    "op9_decontaminate": decontaminate.op9_decontaminate,
    "op10_jaccard_tree": jaccard_tree.op10_jaccard_tree,
    "op11_whitening": whitening.op11_whitening,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_byte_bpe": byte_bpe.op13_byte_bpe,
}

SQL = {
    "op2_bsi_topk": bsi_topk.SQL,
    "op6_revisits": revisits.SQL,
    "op8_license_digest": license_digest.SQL,
    "op9_decontaminate": decontaminate.SQL,
    "op12_hard_negatives": hard_negatives.SQL,
}
