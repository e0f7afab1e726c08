"""A cleaning pipeline over documents: toxicity, near-duplicates, personal data, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its
predecessor kept; all but the last return the columns of ``documents``, further
columns of their input included.  Stages keep rows with a null id or a null
text (a null counts as an empty text, and stays null), treat equal rows alike, take
texts of any length whole, and turn an empty table into an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pitchlake.llm import jaccard, packing, pii, toxicity
from pitchlake.llm.common import written


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity model rejects (a score of one half or more) go; it learns from the labels of the documents at hand.

    Without labels the model's seed list decides.  Repeated rows go or stay together.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels))


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays: the one of the least id.

    Of rows that repeat an id with the same text all stay or go together; texts
    without words and rows without an id are in no class and stay.
    """
    return jaccard.keep_one(docs)


def personal_data_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to the name of its kind; no row goes.  Of overlapping finds the first one's kind is named."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences; an empty or null text is one piece that holds the end id."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", toxic_out), ("near_duplicates", near_duplicates_out), ("personal_data", personal_data_out), ("packing", packed)]

#: SQL can't express the stages; tests/llm/test_pipeline.py holds each of them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
