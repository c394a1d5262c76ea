"""Dumps of git logs: a header ``hash|date|message``, then lines of numbers of changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerspark.functions.columns import sum0
from ledgerspark.sources.lines import few, placed_lines


def read_dumps(spark: SparkSession, path: str) -> DataFrame:
    """One row per line of a dump: (project, entry, full_hash, date, message, line).

    A file's name is its project.  Files are read in splits; ``entry`` is the
    line number of the header that a line stands under.
    """
    lines = placed_lines(spark, path).select(F.regexp_extract("name", r"^([^.]*)", 1).alias("project"), "file", "block", F.col("line").alias("n"), F.col("value").alias("line"))
    return under_headers(lines)


def under_headers(lines: DataFrame) -> DataFrame:
    """Each line of (project, file, block, n, line) under the last header before it; lines before the first one go.

    The last header is sought within a block, a split of a file; lines at a
    block's begin take the last header of the blocks before it, of which there
    is one row a block.
    """
    head = F.col("line").rlike(r"^[0-9a-f]{40}\|")
    date = F.to_date(F.regexp_extract("line", r"^[^|]*\|(\d{4}-\d{2}-\d{2})", 1))
    made = F.struct(F.col("n").alias("entry"), F.substring("line", 1, 40).alias("full_hash"), date.alias("date"), F.regexp_extract("line", r"^[^|]*\|[^|]*\|(.*)$", 1).alias("message"))
    rows = lines.withColumn("head", F.when(head, made))
    inside = Window.partitionBy("file", "block").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("own", F.last("head", ignorenulls=True).over(inside))
    blocks = lines.withColumn("head", F.when(head, made)).groupBy("file", "block").agg(F.max_by("head", F.when(head, F.col("n"))).alias("last"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select(F.col("file").alias("__f"), F.col("block").alias("__b"), F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    rows = rows.join(few(carried), (F.col("file") == F.col("__f")) & (F.col("block") == F.col("__b")))
    rows = rows.withColumn("of", F.coalesce("own", "carried")).where(F.col("of").isNotNull())
    return rows.select("project", "of.*", "line")


def _stats() -> tuple[Column, Column, Column, Column]:
    """(is a line of numbers, added, deleted, file) of a line; binary files have no numbers."""
    p = F.split("line", "\t", 3)
    number = lambda k: F.try_to_number(F.get(p, F.lit(k)), F.lit("9999999999")).cast("long")
    return F.col("line").rlike(r"^(\d+|-)\t(\d+|-)\t"), number(0), number(1), F.get(p, F.lit(2))


def commits(dumps: DataFrame) -> DataFrame:
    """One row per commit; binary files count as files but have no lines; messages may hold pipes."""
    counts, added, deleted, _ = _stats()
    g = dumps.groupBy("project", "entry", "full_hash", "date", "message")
    one = g.agg(sum0(F.when(counts, added)).alias("lines_added"), sum0(F.when(counts, deleted)).alias("lines_deleted"), F.count_if(counts).cast("int").alias("files_changed"))
    return one.select("project", F.substring("full_hash", 1, 7).alias("hash"), "date", "message", "lines_added", "lines_deleted", "files_changed")


def file_touches(dumps: DataFrame, since: str | None = None) -> DataFrame:
    """One row per commit and file with known numbers."""
    d = dumps.where(F.col("date") >= F.lit(since).cast("date")) if since else dumps
    counts, added, deleted, file = _stats()
    out = d.where(counts).select("project", F.substring("full_hash", 1, 7).alias("hash"), "date", file.alias("file"), added.alias("added"), deleted.alias("deleted"))
    return out.where(F.col("added").isNotNull() & F.col("deleted").isNotNull())
