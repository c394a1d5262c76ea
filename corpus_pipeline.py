"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; its result is written as Parquet and read back as the next one's input.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm import exact_dedup, mixing, ngram_join, packing, toxicity
from ledgerspark.llm.queries import BLOCK_BYTES, TARGETS
from ledgerspark.operators.lineage import discard, scratch, stage

#: Ids that are packed together: 256 windows, about a megabyte of text.
GROUP_IDS = 1 << 18
#: A classifier's scores can't be expressed in SQL; tests hold the stages against plain loops.
ORACLE_SQL = None


def toxic_documents_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.3 or more are dropped."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space the smallest id stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def near_copies_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents tied by five-word shingles at Jaccard 0.8 or more the smallest id stays."""
    return ngram_join.drop_near_duplicates(docs)


def sources_are_mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which sources keep to their target weights: that of files by number, and of rows in a file."""
    mixed = mixing.mix_sources(docs, TARGETS, block_bytes=BLOCK_BYTES)
    return mixing.in_mixed_order(mixed, docs.columns)


def _as_they_stand(docs: DataFrame) -> DataFrame:
    """The rows with the number of their file and their place in it; of a frame that isn't files, of their partition."""
    try:
        docs.select("_metadata.file_name")  # raises where there are no files
    except AnalysisException:
        return docs.select("*", F.spark_partition_id().cast("long").alias("__part"), F.monotonically_increasing_id().alias("__row"))
    part = F.coalesce(F.expr("try_cast(regexp_extract(_metadata.file_name, 'part-([0-9]+)', 1) AS bigint)"), F.lit(0).cast("long"))
    return docs.select("*", part.alias("__part"), F.col("_metadata.row_index").alias("__row"))


def documents_are_packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token streams in windows of 1024 ids, numbered in the order in which the mixing stage has left the documents.

    Stretches of GROUP_IDS ids are packed together, so a window's documents
    stand near each other in the mix.
    """
    return packing.pack_in_order(_as_they_stand(docs), public_tokenizers.path("byte_bpe_50k.json"), "__part", ["__row"], group_ids=GROUP_IDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic_documents_go),
    ("exact_dedup", exact_copies_go),
    ("ngram_jaccard_join", near_copies_go),
    ("mix_sources", sources_are_mixed),
    ("packing", documents_are_packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; of the other stages' copies only the one that it reads is left."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, step) in enumerate(STAGES):
        if k == len(STAGES) - 1:
            return step(spark, docs, sf_dir)
        with scratch() as own:
            done = own.keep(stage(step(spark, docs, sf_dir), name))
        discard(docs)
        docs = done
