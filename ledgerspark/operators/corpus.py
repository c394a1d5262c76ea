"""Metrics of document and configuration corpora."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.functions.columns import sum0

LINK = r"\[\[([^\]]+)\]\]"


def measured(pages: DataFrame, text: str = "text", links: str = LINK, sources: str = r"(?m)^## Sources", marker: str = "AI-inferred") -> DataFrame:
    """Pages with words, lines, markers and links counted."""
    c = F.coalesce(F.col(text), F.lit(""))
    words = F.size(F.filter(F.split(c, r"\s+"), lambda w: w != ""))
    return pages.withColumns({
        "words": words, "lines": F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit(""))), "bytes": F.octet_length(c), "has_sources": c.rlike(sources),
        "markers": F.regexp_count(c, F.lit(marker)), "links": F.regexp_extract_all(c, F.lit(links), F.lit(1)),
    })


def corpus_summary(pages: DataFrame) -> DataFrame:
    """One row of totals over measured pages."""
    n = F.count(F.lit(1))
    sourced, ai = F.col("has_sources"), F.col("markers") > 0
    one = pages.agg(
        n.alias("pages"), sum0("words").alias("words"), sum0("lines").alias("lines"), F.count_if(sourced).alias("with_sources"), F.floor(F.try_divide(100 * F.count_if(sourced), n)).alias("provenance_pct"),
        F.count_if(ai).alias("marked_pages"), sum0("markers").alias("markers"), sum0(F.size("links")).alias("links"), F.count_if(F.size("links") == 0).alias("isolated"),
        F.count_if(sourced & ~ai).alias("fully_sourced"), F.count_if(sourced & ai).alias("partial"), F.count_if(~sourced).alias("unsourced"),
    )
    unique = pages.select(F.explode("links").alias("l")).agg(F.count_distinct("l").alias("links_unique"))
    return one.crossJoin(unique)


def link_edges(pages: DataFrame, name: str) -> DataFrame:
    return pages.select(F.col(name).alias("source"), F.explode("links").alias("target"))


def longest(pages: DataFrame, name: str, by: str = "words", k: int = 10) -> DataFrame:
    return pages.select(name, by).orderBy(F.desc(by), name).limit(k)


def stale(pages: DataFrame, changed: str, now: str, days: int = 30) -> DataFrame:
    return pages.agg(F.count_if(F.col(changed) < F.lit(now).cast("timestamp") - F.make_dt_interval(F.lit(days))).alias("n_stale"))


def config_summary(files: DataFrame, category: str, front: str = r"(?m)^---$", limit: int = 150) -> DataFrame:
    """Per category: files, lines, bytes, tokens (a quarter of the bytes), mean lines, long files, front matter."""
    c = F.coalesce(F.col("text"), F.lit(""))
    return files.groupBy(category).agg(
        F.count(F.lit(1)).alias("files"), sum0("lines").alias("lines"), sum0("bytes").alias("bytes"), F.floor(sum0("bytes") / 4).alias("tokens"), F.floor(sum0("lines") / F.count(F.lit(1))).alias("avg_lines"),
        F.count_if(F.col("lines") > limit).alias("long_files"), F.count_if(c.rlike(front)).alias("with_front_matter"),
    )


def largest_per_category(files: DataFrame, category: str, name: str, by: str = "lines", k: int = 10) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(category).orderBy(F.desc(by), name))
    return files.withColumn("i", place).where(F.col("i") <= k).select(category, name, by)


def staleness_view(items: DataFrame, kind: str | None = None) -> DataFrame:
    """Items in order, hooks that were never used relabelled as not instrumented."""
    v = items.where(F.col("item_type") == kind) if kind else items
    status = F.when((F.col("item_type") == "hook") & (F.col("staleness_status") == "never_used"), "not instrumented").otherwise(F.col("staleness_status"))
    return v.withColumn("staleness_status", status).orderBy("item_type", "name")


def staleness_counts(view: DataFrame) -> DataFrame:
    return view.groupBy("staleness_status").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "staleness_status")
