"""The training-corpus pipeline: five stages over ``documents``, each on all that the one before kept.

Every stage's result is written as Parquet in the shared folder and read back, so a lost
executor repeats part of one stage only. All stages but the last return the columns of
``documents``; the last one returns packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from walletscope.llm import exact_dedup, jaccard, packing, pii, toxicity
from walletscope.llm.queries import toxicity_model
from walletscope.plans.settle import settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity chain rejects go."""
    model = toxicity_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model, "toxic")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest id stays."""
    return exact_dedup.drop_duplicates(docs, keep="largest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that five-word shingles link at a similarity of 0.8, the one with the least id stays."""
    return jaccard.keep_one(docs, jaccard.Similarity(words=5, percent=80))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes its kind in angle brackets; ``n_chars`` follows the text."""
    masked = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(
        F.char_length("text").cast(docs.schema["n_chars"].dataType)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 2048 tokens, mixed by source."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies),
    ("personal_data", mask_personal_data), ("packing", pack)]

#: Trained models take part, which SQL cannot express; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
