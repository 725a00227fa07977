"""The registered query of each operator, over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wireloom.llm import decontamination, importance_resampling, jaccard_join, language_id, lexical_search, mixing, quality_classifier, quality_rules, secret_scan, sharding, suffix_dedup, token_counts, toxicity
from wireloom.llm.oracles import ORACLE_SQL
from wireloom.llm.text import held_out, kept


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels")
    index = toxicity.fit(docs, labels, ~held_out(5, 0))
    rows = toxicity.score(docs.withColumn("held_out", held_out(5, 0)), index)
    return rows.select("doc_id", "held_out", "score", "predicted", "neighbours", "evidence")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontamination.hit_digest(decontamination.find_hits(docs.select("doc_id", "text"), benchmark))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", held_out(5, 0))
    filters = language_id.fit(docs.filter(~F.col("held_out")).select("doc_id", "text", "lang"))
    found = language_id.identify(docs.select("doc_id", "held_out", "text"), filters)
    return found.select("doc_id", "held_out", "lang_pred", "score", "coverage")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = kept(mixing.document_sizes(_table(spark, sf_dir, "documents")))
    return mixing.mix(sizes, mixing.mix_plan(sizes))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels")
    space = quality_classifier.fit(docs, labels, ~held_out(4, 2))
    rows = quality_classifier.score(docs.withColumn("held_out", held_out(4, 2)), space)
    return rows.select("doc_id", "held_out", "score", "predicted")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard_manifest(_table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "tokens",
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.find_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.col("failed_rules").bitwiseAND(F.lit(quality_rules.mask_of("base"))) != 0
    return quality_rules.apply_policy(rows, "v1").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept"
    )


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that score highest for each benchmark item."""
    return lexical_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets: those of the patterns, and what looks like them."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.digest(secret_scan.find_secrets(docs, secret_scan.fit(docs)))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight towards the benchmark's texts, and the rank of those drawn."""
    docs, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    rows = importance_resampling.resample(docs.select("doc_id", "text"), benchmark)
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_decontamination": op2_decontamination,
    "op3_language_id": op3_language_id,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_mixing": op5_mixing,
    "op6_quality": op6_quality,
    "op7_sharding": op7_sharding,
    "op8_token_counts": op8_token_counts,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_lexical_search": op11_lexical_search,
    "op12_secret_scan": op12_secret_scan,
    "op13_importance_resampling": op13_importance_resampling,
}
