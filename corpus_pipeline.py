"""A training-data pipeline of five stages; each is written as Parquet and read again before the next one."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from docketry.llm import langid, mixing, ngramjoin, packing, secrets
from docketry.llm.queries import tokenizer_file
from docketry.operators.durable import delete, shared_folder
from docketry.session import let_workers_import


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; the rest (no letters, or hardly an n-gram of any known language) goes."""
    let_workers_import(spark)
    return langid.accepted(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of smallest doc_id."""
    let_workers_import(spark)
    return ngramjoin.deduplicated(docs, n=5, threshold=0.8)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    let_workers_import(spark)
    return secrets.redact(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: copies of documents as the targets of their sources ask for, in order of virtual finish time."""
    let_workers_import(spark)
    return mixing.mixed_documents(docs, weights=(3, 1, 2), share=1.5, repeats=2)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    let_workers_import(spark)
    return packing.pack_documents(docs, tokenizer_file(), window=1024, end_id=0)


STAGES = [
    ("language_id", language_id),
    ("ngram_join", ngram_join),
    ("secret_scan", secret_scan),
    ("source_mixing", source_mixing),
    ("sequence_packing", sequence_packing),
]

#: SQL has no form of the tokenizer or of the learned language profiles; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.

    Stage outputs go to the shared folder of ``spark.checkpoint.dir``; each is removed once the next one is written, so that only
    the last stage's, which the result reads, is left.
    """
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
        if before:
            delete(spark, before)
        before = f"{folder}/{k}-{name}"
    return docs
