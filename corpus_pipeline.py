"""Corpus pipeline: toxic documents out, exact and near copies out, personal data replaced, the rest packed."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from aljibe.llm import exact_dedup, packing, pii, simhash, toxicity
from aljibe.llm.workers import with_package
from aljibe.session import staged

#: Workers hold what other stages have cached too.
CACHED_WORDS = 100_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; the classifier learns from the labels of ``sf_dir``."""
    return toxicity.without_toxic(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id."""
    with exact_dedup.fresh_index(spark) as index:
        return exact_dedup.without_copies(docs, index)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints, the document with the smallest id."""
    return simhash.one_of_each(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each span of personal data replaced by its kind."""
    return pii.redacted(docs, pii.train(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their ids."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"), cache_words=CACHED_WORDS)


STAGES = [(name, with_package(stage)) for name, stage in [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("personal_data", replace_personal_data),
    ("packing", pack),
]]

ORACLE_SQL = None  # the classifiers and the hashes are beyond SQL; tests/llm compares the stages with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents of ``sf_dir``, each on what the one before it wrote. Runs jobs."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = staged(docs)
    return docs
