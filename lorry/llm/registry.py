"""Queries of the training-data operators and, where SQL can say it, their DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from lorry.llm import q_bpe, q_chat, q_fim, q_fm, q_imatch, q_interaction, q_minhash, q_order, q_pii, q_recompress, q_recount, q_repeats, q_tiling


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_imatch": q_imatch.op1_imatch,
        "op2_pii_surrogates": q_pii.op2_pii_surrogates,
        "op3_training_order": q_order.op3_training_order,
        "op4_string_tiling": q_tiling.op4_string_tiling,
        "op5_minhash_tensored": q_minhash.op5_minhash_tensored,
        "op6_byte_bpe": q_bpe.op6_byte_bpe,
        "op7_chat_formatting": q_chat.op7_chat_formatting,
        "op8_run_length_dedup": q_repeats.op8_run_length_dedup,
        "op9_quality_fm": q_fm.op9_quality_fm,
        "op10_edit_counts": q_recount.op10_edit_counts,
        "op11_filter_interaction": q_interaction.op11_filter_interaction,
        "op12_recompression": q_recompress.op12_recompression,
        "op13_fill_in_middle": q_fim.op13_fill_in_middle,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_minhash_tensored": q_minhash.SQL,
        "op7_chat_formatting": q_chat.SQL,
        "op8_run_length_dedup": q_repeats.SQL,
        "op11_filter_interaction": q_interaction.SQL,
        "op12_recompression": q_recompress.SQL,
        "op13_fill_in_middle": q_fim.SQL,
    }
