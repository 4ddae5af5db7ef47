"""Queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidegate.llm import bpe, embeddings, html_extract, mixing, simhash_gray, simhash_native, token_counts, token_files, toxicity, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_html": html_extract.op1_html,
        "op2_warc": warc.op2_warc,
        "op3_fingerprints": simhash_native.op3_fingerprints,
        "op4_token_files": token_files.op4_token_files,
        "op5_token_counts": token_counts.op5_token_counts,
        "op6_toxicity": toxicity.op6_toxicity,
        "op7_mix": mixing.op7_mix,
        "op8_embeddings": embeddings.op8_embeddings,
        "op9_simhash": simhash_gray.op9_simhash,
        "op10_byte_bpe": bpe.op10_byte_bpe,
    }


def oracle_sql() -> dict[str, str]:
    return {"op7_mix": mixing.OP7_SQL}
