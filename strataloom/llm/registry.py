"""Queries of the corpus operators and their DuckDB SQL; the pipeline over them is registered beside them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strataloom.llm import bpe, chat, covertree, ctw, html_text, minhash, mixing, packed, quality, topk


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mix_to_weights": mixing.op1_mix_to_weights,
        "op2_cover_tree_near_dedup": covertree.op2_cover_tree_near_dedup,
        "op3_minhash_near_dedup": minhash.op3_minhash_near_dedup,
        "op4_token_id_files": packed.op4_token_id_files,
        "op5_main_text": html_text.op5_main_text,
        "op6_context_tree_score": ctw.op6_context_tree_score,
        "op7_chat_windows": chat.op7_chat_windows,
        "op8_exact_top_k": topk.op8_exact_top_k,
        "op9_quality_classifier": quality.op9_quality_classifier,
        "op10_bpe_encode_decode": bpe.op10_bpe_encode_decode,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_mix_to_weights": mixing.OP1_SQL, "op8_exact_top_k": topk.OP8_SQL}
