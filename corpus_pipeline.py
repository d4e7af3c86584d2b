"""A training-data pipeline over ``documents``: five stages, each written as Parquet and read again.

Each stage works on all that the one before it kept. A null or empty text is not toxic, is no copy of
another, holds no secret, is never taken by the mix (it has no words) and so ends there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from driftlog.llm import mixing, neardup, pieces, secrets, toxicity
from driftlog.llm.common import Scratch, ready, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold. Learns from the labelled among ``docs``."""
    columns = docs.columns
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.where(scored["score"] < toxicity.THRESHOLD).select(columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return neardup.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, or the parts of them, that the mix takes; once for each time it takes them."""
    return mixing.mixed_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document."""
    return pieces.encode_checked(docs.select("doc_id", "source", "text")).select("doc_id", "source", "n_pieces", "ids_crc32", "lossless", "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_neardup", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: Learned weights, hashed sampling and components are not SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over the documents of ``sf_dir``."""
    ready(spark)
    docs = table(spark, sf_dir, "documents")
    written = Scratch(spark)
    for name, stage in STAGES:
        docs = written.table(stage(spark, docs, sf_dir), f"pipeline-{name}")
        written.remove(but_last=1)  # what the stages before have left is read by nothing any more
    return docs
