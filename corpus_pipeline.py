"""A corpus pipeline of five stages over documents; part of the corpus operators.

Each stage takes (spark, docs, sf_dir) and returns the documents that it keeps, or for the last their encodings.
What a stage returns is written and read again before the next one starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldloom.llm import bpe, common, decontamination, near_dedup, quality, secrets


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last stage: the number of ids of every document that is left, and the digests of its ids and of their decoding.

    A null or empty text has no ids; null ids and repeated rows give a row each; an empty docs gives an empty result."""
    return bpe.encode_documents(docs, digests=True)


STAGES = [
    ("quality", quality.quality_stage),
    ("near_dedup", near_dedup.near_dedup_stage),
    ("decontamination", decontamination.decontamination_stage),
    ("secrets", secrets.secrets_stage),
    ("encoding", encoding_stage),
]

#: The stages train models and walk at random, which SQL cannot express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each on what its predecessor wrote."""
    docs = common.table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = common.written(docs, f"stage-{name}")
    return docs
