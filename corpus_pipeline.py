"""Documents to packed training sequences, each stage on all that the one before it kept.

toxicity: documents predicted toxic go. exact: one document of equal texts stays.
near: one document of each near-duplicate component stays. pii: personal data becomes
surrogates. pack: pieces of the documents in sequences of 1024 ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from accountwatch.llm import exact, packing, pii, simhash, toxicity
from accountwatch.llm.queries import surrogate_key, table
from accountwatch.session import shared_folder


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.drop_exact_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_copies(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.replace_entities(docs, surrogate_key(spark)).withColumn("n_chars", F.length("text").cast("bigint"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("pii", without_personal_data),
    ("packing", packed),
]

#: No SQL: scores, components and differencing are iterative. tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written and read again, which cuts the lineage."""
    docs = table(spark, sf_dir, "documents")
    root = shared_folder(spark, "pipeline")
    for name, stage in STAGES:
        path = f"{root}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
