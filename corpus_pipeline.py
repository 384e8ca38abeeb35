"""Corpus preparation: five stages of operators from ``callcredit.llm``.

Each stage takes (spark, docs, sf_dir) and works on all rows the stage before
kept; its result is written as Parquet and read again. Toxic documents go, one
document of each class of near copies stays, passages repeated across documents
go, sources are mixed to their weights, and what is left is encoded.

Rows are as ``documents``; nulls, empty texts, repeated rows, empty tables and
more columns are handled as the operators say, and further columns are kept
until the last stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callcredit.llm import bpe, mixing, ngram_join, repeats, toxicity
from callcredit.llm.storage import documents
from callcredit.session import ensure_checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned on this input, doesn't reject."""
    return toxicity.without_toxic(docs, toxicity.learn(docs, toxicity.read_labels(spark, sf_dir)))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of every class of near copies."""
    return ngram_join.one_of_class(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of passages that occur twice or more."""
    return repeats.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The blocks of each source that its target takes, once or twice."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the digest of the text they decode to."""
    return bpe.encode_and_decode(docs.select("doc_id", "source", "text"), bpe.tokenizer_path()).select(
        "doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("source_mix", mix_sources),
    ("bpe", encode),
]

# Toxicity, near-copy classes and BPE have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline_{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
