"""A corpus from documents to token ids: four stages, each written as Parquet and read again by the next.

Defined results: null texts count as empty ones; empty texts are one group of near copies, of which one document stays
(and is taken no times by the mix, as it has no words); rows without a doc_id, source or language are documents like any
others; repeated rows are copies; further columns are carried to the mix; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegate.llm import bpe, mixing, near_dedup, toxicity
from tidegate.llm.common import documents, table

def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity field, fitted on the labelled documents, doesn't reject."""
    return toxicity.without_toxic(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose runs of five words have a likeness of 0.8 or more: the one with the least doc_id."""
    return near_dedup.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.repeated(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, hashes of ids and decoded bytes, and ids (little-endian 32-bit) of each document taken."""
    return bpe.encode_documents(docs, with_ids=True)


STAGES = [("toxicity", drop_toxic), ("simhash_near_dedup", drop_near_copies), ("mixing", mix_sources), ("byte_bpe", encode)]

#: The toxicity field is fitted by gradients, so SQL cannot give the rows; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
