"""The queries of this subpackage and their oracles."""

from __future__ import annotations

from . import bpe, context_tree, exact_dedup, hilbert_search, language_id, mixing, ngram_join, page_blocks, preference, run_length_index

QUERIES = {
    "op1_ctw_scores": context_tree.op1_ctw_scores,
    "op2_run_length_index": run_length_index.op2_run_length_index,
    "op3_mixing": mixing.op3_mixing,
    "op4_ngram_join": ngram_join.op4_ngram_join,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_byte_bpe": bpe.op6_byte_bpe,
    "op7_page_text": page_blocks.op7_page_text,
    "op8_hilbert_search": hilbert_search.op8_hilbert_search,
    "op9_preference_pairs": preference.op9_preference_pairs,
    "op10_language_id": language_id.op10_language_id,
}
ORACLES = {
    "op2_run_length_index": run_length_index.OP2_SQL,
    "op4_ngram_join": ngram_join.OP4_SQL,
    "op5_exact_dedup": exact_dedup.OP5_SQL,
    "op8_hilbert_search": hilbert_search.OP8_SQL,
    "op9_preference_pairs": preference.OP9_SQL,
}
