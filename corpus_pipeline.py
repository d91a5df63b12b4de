"""A corpus pipeline of five stages; each stage gets what the one before it kept.

Toxic documents go, then documents in no learned language, then all but one document of each group of
near duplicates. What is left is mixed to the target weights of its sources, documents repeated or left
out, and packed into sequences. Every stage but the last returns the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedloom.llm import langid, minhash, mixing, packing, toxicity
from feedloom.session import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.kept(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.kept(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs).drop("ids")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("language_id", keep_languages),
    ("near_duplicates", drop_near_duplicates),
    ("mix_sources", mix_sources),
    ("pack", pack_sequences),
]

#: SQL has neither trained classifiers nor tokenizers; the tests compare with a plain version instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
