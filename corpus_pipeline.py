"""The corpus pipeline: five operators over ``documents``, each on what the last one kept.

Language ID drops rows in no known language; exact dedup keeps one row of every
text; near-dedup keeps one document of every group of near copies (five-word
shingles, similarity 0.8); mixing takes rows as often as the sources' target
weights ask, so a row can occur twice or not at all; packing cuts what is left
into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardline.llm import exact, langid, mix, neardup, pack
from wardline.llm.common import fresh


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accepted_rows(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.kept_rows(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.kept_rows(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix.mixed_rows(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack.pack(docs)


STAGES = [
    ("language", language),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixture", mixture),
    ("packed", packed),
]

# The stages fit models, sample and pack, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        path = fresh(spark, f"pipeline-{name}")
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
