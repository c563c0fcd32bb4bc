"""Registered queries of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

from tenorgrid.llm import (
    alignment,
    embeddings,
    html_cut,
    line_frequency,
    minhash,
    mixing,
    negatives,
    packing,
    pieces,
    secrets,
    substring,
    surrogates,
    token_files,
)

QUERIES = {
    "op1_near_vectors": embeddings.op1_near_vectors,
    "op2_html_cut": html_cut.op2_html_cut,
    "op3_minhash_groups": minhash.op3_minhash_groups,
    "op4_mixing": mixing.op4_mixing,
    "op5_pii_surrogates": surrogates.op5_pii_surrogates,
    "op6_substring_dedup": substring.op6_substring_dedup,
    "op7_secret_ledger": secrets.op7_secret_ledger,
    "op8_token_files": token_files.op8_token_files,
    "op9_quality_lines": line_frequency.op9_quality_lines,
    "op10_packing": packing.op10_packing,
    "op11_sentence_pieces": pieces.op11_sentence_pieces,
    "op12_hard_negatives": negatives.op12_hard_negatives,
    "op13_token_alignment": alignment.op13_token_alignment,
}

SQL = {
    "op1_near_vectors": embeddings.SQL,
    "op3_minhash_groups": minhash.SQL,
    "op6_substring_dedup": substring.SQL,
    "op9_quality_lines": line_frequency.SQL,
    "op12_hard_negatives": negatives.SQL,
}
