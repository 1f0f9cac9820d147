"""Registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from popspark.llm import (
    byte_bpe,
    chat_format,
    decontaminate,
    exact_dedup,
    fill_in_middle,
    language_id,
    language_model,
    license_scan,
    near_join,
    quality,
    source_audit,
    token_file,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": byte_bpe.op1_byte_bpe,
    "op2_quality": quality.op2_quality,
    "op3_chat_format": chat_format.op3_chat_format,
    "op4_token_file": token_file.op4_token_file,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_ngram_jaccard_join": near_join.op6_ngram_jaccard_join,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_license_scan": license_scan.op8_license_scan,
    "op9_decontamination": decontaminate.op9_decontamination,
    "op10_language_id": language_id.op10_language_id,
    "op11_language_model": language_model.op11_language_model,
    "op12_fill_in_middle": fill_in_middle.op12_fill_in_middle,
    "op13_source_audit": source_audit.op13_source_audit,
}

ORACLE_SQL: dict[str, str] = {
    "op5_exact_dedup": exact_dedup.ORACLE,
    "op6_ngram_jaccard_join": near_join.ORACLE,
    "op9_decontamination": decontaminate.ORACLE,
    "op12_fill_in_middle": fill_in_middle.ORACLE,
    "op13_source_audit": source_audit.ORACLE,
}
