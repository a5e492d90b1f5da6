"""From raw documents to token ids: rules, near copies, benchmark, personal data, encoding.

Each stage gets what the one before kept, written as parquet and read again, so a lost
executor costs no more than the stage at hand. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leaseload.llm import bpe, decontaminate, pii, quality_rules, simhash
from leaseload.llm.common import table, tuned, written

BYTE_RANKS = "byte_bpe_50k.tiktoken"


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    tuned(spark)
    return quality_rules.kept_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    tuned(spark)
    return simhash.drop_near_copies(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by the benchmark go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked in the texts."""
    tuned(spark)
    return pii.masked_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text and their number."""
    tuned(spark)
    path = public_tokenizers.path(BYTE_RANKS)
    coded = bpe.encoded(docs, path, public_tokenizers.PATTERN)
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", rules),
    ("simhash_near_dedup", near_copies),
    ("benchmark_decontamination", benchmark),
    ("pii", personal_data),
    ("byte_bpe", token_ids),
]

# Fingerprints and byte-pair ids have no SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
