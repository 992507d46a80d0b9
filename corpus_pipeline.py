"""From raw documents to packed training sequences.

Each stage gets what the stage before it kept, decides on whole texts, and returns documents
(doc_id, text, lang, source, n_chars and whatever other columns there are); the last
returns the places of all pieces in their sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapledger.llm import langid, neardup, packing, substrings, toxicity
from gapledger.llm.queries import find_package, read, vocabulary
from gapledger.sources.shared import write_once


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised with confidence; null texts and texts without letters go."""
    find_package(spark)
    return langid.keep_accepted(docs, langid.fit(docs))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic, as the labels that there are for them teach."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of near duplicates the document with the smallest id."""
    find_package(spark)
    return neardup.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that a document of smaller id has; n_chars follows the text."""
    find_package(spark)
    kept = substrings.remove_repeats(docs).select(*docs.columns)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents and their places in sequences of 4096 tokens."""
    find_package(spark)
    return packing.pack_documents(docs, vocabulary())


STAGES = [
    ("language", language),
    ("toxicity", clean),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", pack),
]

#: SQL cannot express the learned stages; tests/llm/test_pipeline.py holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_once(name, stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
