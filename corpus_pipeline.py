"""Corpus pipeline over the documents table: five stages, each one of the training-data operators.

A stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the columns of
documents; the last returns the token records read back. ``run`` writes each stage's result as
Parquet in the shared folder and reads it again for the next. A stage's folder is deleted once the
next one is written whole; the last one holds the result and stays, like the token files beside it.

Null texts and ids, repeated rows, empty tables and extra columns pass as each operator states.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lakepact.llm import qgram_decon, records, simhash, source_mix, toxicity_cnn
from lakepact.llm.common import checkpoint_root, read
from lakepact.operators.publish import delete_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (by their language's threshold) go."""
    return toxicity_cnn.drop_toxic(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return qgram_decon.drop_leaks(docs, read(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it (repeats are repeated rows)."""
    return source_mix.take(docs)


def token_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as binary token records, read back: doc_id, start, n_tokens, ids_crc32."""
    return records.encode_documents(docs).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_records", token_records),
]

# A trained classifier and XXH64 fingerprints have no SQL; tests/llm hold the rows to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        path = f"{checkpoint_root(spark)}/pipeline-{name}-{uuid.uuid4().hex[:12]}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            delete_path(spark, before)
        before = path
    return docs
