"""From raw documents to training sequences: what is good, unique and packed.

Every stage works on all rows its predecessor kept. Null text is empty text and fails the quality rules; a null lang is
not judged by divergence; null doc_ids are kept, and lose to any other row in the choice among copies, except that of
near-copies and of repeated passages the smallest doc_id wins. Repeated rows leave one row. An empty table runs through as
an empty table. Extra columns pass through every stage but the last.

Work files of a stage are deleted when the next stage begins: by then its result has to be written.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendmill.llm import exact_dedup, line_dedup, packing, quality_rules, simhash
from trendmill.llm.common import free_names, recording, stage, table, vocabulary
from trendmill.session import remove_folder

END = 1

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_left_over: dict[str, list[str]] = {}


def _tidy(function: Stage) -> Stage:
    @wraps(function)
    def tidied(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        for path in _left_over.pop(application, []):
            remove_folder(spark, path)
        with recording() as made:
            result = function(spark, docs, sf_dir)
        _left_over[application] = made
        return result

    return tidied


@_tidy
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie close enough to their language."""
    return quality_rules.keep_good(docs)


@_tidy
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    return exact_dedup.keep_one(docs)


@_tidy
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts whose fingerprints differ in three bits at most, and what they connect, the row with the smallest doc_id."""
    return simhash.keep_one(docs)


@_tidy
def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that an earlier document has; n_chars counts what is left."""
    [removed] = free_names(docs.columns, "removed")
    cut = line_dedup.remove_repeated_passages(docs, into=removed, inside=True).drop(removed)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


@_tidy
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in the training sequences."""
    placed = packing.pack_documents(docs, vocabulary("word_bpe_49k.json"), END)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("near-dedup", near),
    ("substring dedup", substrings),
    ("best-fit packing", pack),
]

# Fingerprints, chains of links and packing are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
