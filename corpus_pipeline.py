"""From raw documents to packed training sequences, stage by stage.

Every stage is written as Parquet and read again as the next one's documents. All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tiercast.llm import exact_dedup, near_dedup, quality, secret_scans
from tiercast.llm.queries import pack_documents
from tiercast.llm.tables import read
from tiercast.plans.staging import scratch, stage_folder


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep(docs, read(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one stays."""
    return exact_dedup.keep(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates one document stays."""
    return near_dedup.keep(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking credentials are blanked; every document stays."""
    return secret_scans.redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows, as in the packing query."""
    return pack_documents(docs)


STAGES = [
    ("quality_classifier", good),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("secret_scans", secrets),
    ("packing", packing),
]

# A fitted classifier, weighted sampling and token ids have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage wrote on its way is removed when its result is whole."""
    docs = read(spark, sf_dir, "documents")
    folder = f"{stage_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, step in STAGES:
        with scratch(spark):
            step(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
