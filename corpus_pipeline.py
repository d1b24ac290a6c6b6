"""From raw documents to packed training sequences: five stages, each written and read again.

Quality rules reject repetitive documents, exact and near copies leave one
document of each group, secrets are replaced in the texts, and what is left is
packed. Every stage but the last returns the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import exact_dedup, jaccard, packing, repetition, secrets
from corpusflow.operators.scale import bound_batches, written

#: Near copies: Jaccard similarity in percent, words in a shingle.
NEAR_PERCENT, NEAR_SHINGLE = 80, 5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the limits on repetition."""
    bound_batches(spark)
    return repetition.reject(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id."""
    return exact_dedup.deduplicate(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar texts the document with the smallest id.

    Similar are texts whose sets of five-word shingles have a Jaccard similarity
    of at least 0.8; the contract of ``op3`` (three words, 0.9) is that query's own.
    """
    bound_batches(spark)
    return jaccard.one_of_each(docs, percent=NEAR_PERCENT, shingle=NEAR_SHINGLE)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; ``n_chars`` follows the text."""
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("bigint"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and places."""
    bound_batches(spark)
    return packing.pack(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("secret scans", secret_scan),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs


#: SQL has no tokenizer; the tests compare the stages with brute force.
ORACLE_SQL = None
