"""A corpus pipeline: quality filter, exact and near deduplication, mixing of sources, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sleevework.llm import exact_dedup, minhash_dedup, mixing, packing, rule_quality
from sleevework.llm.queries import TOKENIZER
from sleevework.llm.shared import saved


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, learnt from the labels of the corpus, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = rule_quality.learn(docs, labels, F.lit(True))
    return rule_quality.scored(docs, model).where(F.col("quality_score") >= rule_quality.THRESHOLD).drop("quality_score")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates: four fifths of the five-word shingles in common."""
    return minhash_dedup.near_dedup(docs, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix of sources takes it."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 1024 tokens."""
    return packing.pack(docs, TOKENIZER, 1024)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Learnt rules, sketches and tokenizers are beyond SQL; tests compare both dedup stages with a plain computation, and the
#: others with what must hold of their rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
