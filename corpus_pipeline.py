"""The corpus pipeline: documents in, a shard manifest of the training mix out.

Each stage reads the table that the one before wrote, works on all of it, and passes on what it keeps, with the columns
of documents; the last returns the manifest. ORACLE_SQL is None: language identification has no SQL counterpart, and
tests compare the stages with brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wireloom.llm import decontamination, jaccard_join, language_id, mixing, sharding
from wireloom.llm.text import held_out
from wireloom.plans.staging import new_folder, remove_folder

#: Shards of the manifest.
SHARDS = 16

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is learned; texts without a letter or in none of the languages go."""
    filters = language_id.fit(docs.filter(~held_out(5, 0)).select("doc_id", "text", "lang"))
    return language_id.recognised(docs, filters)


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest doc_id of each group of near copies."""
    return jaccard_join.first_of_each(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of ten words of a benchmark item."""
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, size, tokens, text_crc32, shard and slot of every document of the mix."""
    return sharding.shard_manifest(docs, SHARDS, "source")


STAGES: list[tuple[str, Stage]] = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", join_near_copies),
    ("benchmark decontamination", remove_benchmark),
    ("mixing", mix_sources),
    ("sharding", deal_shards),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents. A stage's table goes when the next is written; the manifest's table stays."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        path = new_folder(spark, "corpus")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove_folder(spark, before)
        before = path
    return docs
