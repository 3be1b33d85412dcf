"""Corpus pipeline: language, near copies, secrets, mix, packed sequences.

Each stage takes the documents that the one before it kept, has one operator decide, and returns the
columns of documents; the last returns packed pieces with their token ids.

Stages whose texts pass through Python set a smaller Arrow batch for the session, unless it has a number of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablework.llm import langid, mixing, neardup, packing, secrets
from tablework.llm.common import lean_batches, materialize, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter or with an ambiguous language."""
    lean_batches(spark)
    return langid.keep_known(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of smallest id of each near-duplicate group."""
    lean_batches(spark)
    return neardup.drop_near_duplicates(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by a mark; all documents stay."""
    lean_batches(spark)
    return secrets.redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources meet their target weights."""
    lean_batches(spark)
    return mixing.mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut documents into sequences beside their lexical neighbours."""
    lean_batches(spark)
    return packing.pack_documents(docs, with_ids=True)


STAGES = [
    ("language_id", language_id), ("near_dedup", near_dedup), ("secret_scan", secret_scan), ("mix_sources", mix_sources), ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each result written as Parquet to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Learned bits, hashed minhashes and tokenizer ids are not for SQL; the tests run the stages against brute force.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
