"""The corpus pipeline: quality rules, near copies, benchmark passages, personal data, packing.

Every stage takes all its predecessor kept and returns the columns of documents; the last returns packed token pieces.
Stages handle null ids and texts, empty texts, repeated rows and empty tables as their operators' docstrings define.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import neardup, packing, pii, quality, templates
from riskloom.session import stage
from riskloom.sources.tables import table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep(docs)


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return neardup.keep_one(docs)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return templates.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by marks."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", keep_good),
    ("near duplicates", keep_one),
    ("decontamination", keep_clean),
    ("personal data", redact),
    ("packing", pack),
]

#: Weighted samples, boosted trees and packing have no SQL form; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs, name.replace(" ", "-"))
    return docs
