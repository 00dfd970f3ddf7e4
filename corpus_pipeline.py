"""The corpus pipeline: toxic and poor documents go, copies go, the rest is packed.

``run`` writes every stage as Parquet below the shared scratch folder and reads it
back for the next one. Every stage works on all that its predecessor kept.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailflow.llm import packing, quality, simhash, toxicity
from retailflow.llm.common import materialise, read

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity stays below the threshold, whole rows."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), modulus=3, held_out=1)
    return docs.filter(toxicity.score(F.col("text"), model, spark) < toxicity.THRESHOLD)


def remove_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality reaches the threshold, whole rows."""
    model = quality.train(docs, read(spark, sf_dir, "labels"), modulus=5, held_out=0)
    return docs.filter(quality.score(F.col("text"), model, spark) >= quality.THRESHOLD)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, the one with the smallest id."""
    return simhash.deduplicate(docs, words=3, max_bits=2)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", remove_toxic),
    ("quality", remove_poor),
    ("simhash_near_dedup", remove_near_copies),
    ("best_fit_packing", pack_sequences),
]

#: Models, hashes and tokenizers are beyond SQL; the tests hold the stages against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
