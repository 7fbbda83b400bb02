"""Corpus preparation in stages, each written as Parquet and read again by the next.

A stage takes ``(spark, docs, sf_dir)``; all but the last return the columns of
``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegate.llm import language
from lakegate.llm.common import read_table
from lakegate.llm.exact_dedup import drop_copies
from lakegate.llm.minhash import drop_near_duplicates
from lakegate.llm.mixing import mixed_documents
from lakegate.llm.packing import pack
from lakegate.session import checkpoint_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; the identifier learns from all labelled documents."""
    return language.keep_identified(docs, language.train(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, cut or left out so that the sources reach their targets."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids placed in training sequences."""
    return pack(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

ORACLE_SQL = None  # compression, MinHash and token ids have no SQL; the tests use brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what is between them is kept in the shared folder."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
