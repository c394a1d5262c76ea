"""Lines of text files with their numbers, from one scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerspark.operators.lineage import stage


#: Frames of one row for each split or file are sent to the lines up to this many rows.
SPLITS = 1 << 16


def few(df: DataFrame) -> DataFrame:
    """A frame of one row for each split or file, to be sent to the lines: they then stay where they were read, however few files there are."""
    df = stage(df, "splits")
    return F.broadcast(df) if df.count() <= SPLITS else df


def placed_lines(spark: SparkSession, paths: str | list[str], line_sep: str | None = None) -> DataFrame:
    """(value, file, name, size, block, line): each line of the files, numbered from 1 in its file.

    The files are scanned once and written with the split that each line was
    read in; a split's lines follow each other in it, and what the splits before it
    hold is a running sum over one row each.  So however the scan was cut, a
    line has one number, and every use of the frame sees the same.
    """
    reader = spark.read.option("lineSep", line_sep) if line_sep else spark.read
    raw = reader.text(paths).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"),
    )
    raw = stage(raw, "lines")
    blocks = raw.groupBy("file", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return raw.join(few(blocks), ["file", "block"]).select("value", "file", "name", "size", "block", (F.col("before") + F.col("at") - F.col("first") + 1).alias("line"))
