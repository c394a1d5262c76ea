"""Registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm import decontamination, exact_dedup, html_text, mixing, ngram_join, oracles, packing, sharding, source_audit, token_counts, toxicity, url_filter, vector_codes, vector_dedup

#: Production targets in thousandths: the largest source is held to 16 %.
TARGETS = {"src0": 164} | {f"src{i}": 44 for i in range(1, 20)}
BLOCK_BYTES = 1 << 16
#: (host, path, verdict)
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"), TARGETS, block_bytes=BLOCK_BYTES)
    return mixed.select("doc_id", "pool", "block", "slot", "release", "deadline", "block_offset", "balanced")


def op8_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_groups(table(spark, sf_dir, "documents"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(vector_codes.codebooks_sha256(books)).alias("codebooks_sha256"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.source_divergence(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_sharding, op2_token_counts, op3_html_extraction, op4_exact_dedup, op5_toxicity,
        op6_packing, op7_mixing, op8_vector_dedup, op9_url_filter, op10_ngram_join,
        op11_decontamination, op12_vector_codes, op13_source_divergence,
    )
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return {
        "op4_exact_dedup": exact_dedup.ORACLE,
        "op7_mixing": mixing.mixing_oracle(TARGETS, BLOCK_BYTES),
        "op8_vector_dedup": oracles.NEAR_VECTORS,
        "op9_url_filter": url_filter.url_oracle(URL_RULES),
        "op10_ngram_join": oracles.NGRAM_JOIN,
        "op11_decontamination": decontamination.ORACLE,
        "op12_vector_codes": vector_codes.ORACLE,
        "op13_source_divergence": source_audit.ORACLE,
    }
