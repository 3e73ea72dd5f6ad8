"""The registered queries opN_<name> and the SQL that some can be tested by."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.llm import (collocations, decontamination, hard_negatives, language_id, mixing, near_dedup, oracle,
                           pii, quality, sharding, substring_dedup, suffix_dedup, url_filter, warc)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_rules(_table(spark, sf_dir, "documents").select("doc_id", "text"), carry=["doc_id"])
    return judged.select(F.col("_in0").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept", "posterior")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.round_trip(_table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(_table(spark, sf_dir, "documents").select("doc_id", "text"), carry=["doc_id"])
    return out.select(F.col("_in0").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"),
                      "shard", "slot", "grown_shard")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    rows = placed.select(
        F.col("_id").alias("doc_id"), "size", "source_size", "target",
        F.expr("aggregate(takes, 0L, (s, x) -> s + x.taken)").alias("taken"),
        F.expr("try_element_at(transform(takes, x -> x.position), 1)").alias("first_position"))
    return rows.repartitionByRange("first_position", "doc_id").sortWithinPartitions("first_position", "doc_id")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), percent=85)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontamination.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(_table(spark, sf_dir, "documents"))
    counts = [F.expr(f"cast(size(filter(spans, s -> s.by_pattern AND s.kind = '{k}')) AS long)").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"),
                        F.col("all_spans").alias("spans"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents")).drop("before", "behind")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_url_filter": op2_url_filter,
    "op3_warc": op3_warc,
    "op4_sharding": op4_sharding,
    "op5_language_id": op5_language_id,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_mixing": op7_mixing,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_personal_data": op11_personal_data,
    "op12_collocations": op12_collocations,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE_SQL: dict[str, str] = oracle.SQL
