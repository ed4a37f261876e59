"""A corpus made ready for training: filtered, deduplicated, decontaminated, mixed
and encoded, each stage on what its predecessor kept.

Every stage but the last returns the columns of ``documents``. ``run`` writes each
stage's rows as Parquet to the shared folder and reads them again; what a stage stored
for itself goes when it ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ragtables.llm.base import small_batches, table
from ragtables.llm.decontaminate import clean_documents
from ragtables.llm.fair_queue import mixed_documents
from ragtables.llm.ngram_join import one_of_each
from ragtables.llm.queries import learnable, tokenizer_path
from ragtables.llm.token_store import read_tokens, write_tokens
from ragtables.llm.toxicity import acceptable, learn_lexicon
from ragtables.sources.storage import fresh_path, materialize, scratch


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not judged toxic."""
    lexicon = learn_lexicon(docs, learnable(table(spark, sf_dir, "labels")))
    return acceptable(docs, lexicon)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, number and checksum of each document's ids, read from the written store."""
    path = fresh_path(spark, "token_stores")
    write_tokens(docs, path, tokenizer_path())
    return read_tokens(spark, path)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_ids", token_ids),
]

# The stages score and code in ways that SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        with scratch(spark), small_batches(spark):
            docs = materialize(stage(spark, docs, sf_dir), keep=True)
    return docs
