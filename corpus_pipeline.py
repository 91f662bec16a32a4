"""From raw documents to packed training sequences: five stages, each written as a table and read by the next.

Stages keep the columns of documents until the last. Rows may have nulls in any column and further columns; an empty table goes
through all stages and gives no sequences.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from arrivalmart.llm import cotraining, packing, pii, rules, similar
from arrivalmart.llm.texts import table_of

VOCABULARY = "word_bpe_49k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy of quality rules keeps."""
    return rules.kept_rows(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier takes for good.

    It is fitted on the labelled documents of the whole table: those left here are nearly all good, which teaches little.
    """
    known = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = cotraining.fit(known, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return cotraining.kept_rows(docs, model)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies by 5-word shingles, the one with the smallest id."""
    return similar.first_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their personal data replaced by its kind."""
    return pii.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, in sequences of 2048 ids."""
    return packing.pack(docs, public_tokenizers.path(VOCABULARY))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_copies", near_copies),
    ("personal_data", personal_data),
    ("packing", pack),
]

# SQL can't express the fitted classifier, the similarity of texts or the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over documents, each stage before it written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = table_of(docs, f"pipeline-{number}-{name}")
    return docs
