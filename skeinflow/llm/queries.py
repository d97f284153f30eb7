"""Queries of this subpackage by name, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from . import html_layout, images, near_dup, packing, quality, repeats, topk, toxicity, wavelet, word_bpe

QUERIES = {
    "op1_wavelet_tokens": wavelet.op1_wavelet_tokens,
    "op2_best_fit_packing": packing.op2_best_fit_packing,
    "op3_norm_bucket_topk": topk.op3_norm_bucket_topk,
    "op4_picture_copies": images.op4_picture_copies,
    "op5_word_bpe": word_bpe.op5_word_bpe,
    "op6_additive_quality": quality.op6_additive_quality,
    "op7_run_length_repeats": repeats.op7_run_length_repeats,
    "op8_visible_text": html_layout.op8_visible_text,
    "op9_ftrl_toxicity": toxicity.op9_ftrl_toxicity,
    "op10_minhash_near_dedup": near_dup.op10_minhash_near_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op3_norm_bucket_topk": topk.OP3_SQL,
    "op7_run_length_repeats": repeats.OP7_SQL,
    "op10_minhash_near_dedup": near_dup.OP10_SQL,
}
