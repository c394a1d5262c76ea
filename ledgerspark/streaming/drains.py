"""Streaming drains of staged events, streaming usage blocks and log tails."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark import schemas as S
from ledgerspark.operators import merges as M
from ledgerspark.operators import sinks
from ledgerspark.operators.lineage import discard, scratch, stage
from ledgerspark.sources.lines import few, placed_lines
from ledgerspark.sources.logs import EVENT_FILES, parse_events, parse_turns

#: The stored tables: name -> (schema, the rows of staged events that are not stored, what holds for all stored rows)
TABLES: dict[str, tuple[str, Callable, tuple[sinks.Rule, ...]]] = {
    "sessions": (S.SESSIONS, M.new_sessions, M.SESSION_RULES),
    "costs": (S.COSTS, M.new_costs, ()),
    "commits": (S.COMMITS, M.new_commits, ()),
}
#: Parts and versions that are no longer needed stay so long, for readers that began with them.
KEEP_HOURS = 24.0
TURNS = "thread_id string, model string, n_turns bigint, total_tokens bigint, first_at timestamp, last_at timestamp"


def event_lines(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """Stream of the lines of all event files, with their file."""
    raw = spark.readStream.option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", EVENT_FILES).text(folder)
    return raw.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def drain_batch(events: DataFrame, root: str, now: str, keep_hours: float = KEEP_HOURS) -> dict[str, int]:
    """Append a batch of events to each stored table; returns the tables' rows.

    Stored parts that lack one of the table's rules are brought under it first:
    once, since each part's rules are stored with it.  Then only rows whose keys are
    not stored are written, as a part of their own: of what is stored the keys
    are read.  So a batch that is run again after a failure adds nothing.  Parts
    of like size are merged, and those that nobody needs are deleted after
    ``keep_hours``.
    """
    spark, out = events.sparkSession, {}
    with scratch():
        events = stage(events, "batch")
        for name, (ddl, new_rows, rules) in TABLES.items():
            path = f"{root}/{name}"
            sinks.migrate_table(spark, path, ddl, rules)
            out[name] = sinks.append_table(new_rows(sinks.read_table(spark, path, ddl), events, now), path, rules=[r.name for r in rules])
            sinks.merge_tiers(spark, path, ddl)
            sinks.vacuum_table(spark, path, keep_hours)
    return out


def drain(spark: SparkSession, folder: str, root: str, checkpoint: str, now: str, files_per_batch: int = 100, keep_hours: float = KEEP_HOURS):
    """Drain what is there and stop: a query with an available-now trigger.

    Late events are always taken: there is no watermark, the stored keys are the
    only state.
    """

    def one(lines: DataFrame, _batch: int) -> None:
        placed = lines.withColumn("line", F.struct("block", F.monotonically_increasing_id().alias("n"))).drop("block")
        drain_batch(parse_events(placed), root, now, keep_hours)

    return (
        event_lines(spark, folder, files_per_batch).writeStream.foreachBatch(one)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def distinct_events(stream: DataFrame, keys: list[str], at: str, late: str) -> DataFrame:
    """Append-only deduplication by key: repeats within ``late`` of the newest time are dropped."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def usage_blocks(stream: DataFrame, at: str = "ts", late: str | None = None) -> DataFrame:
    """Tokens and cost by 5-hour calendar block (0, 5, 10, 15, 20 h); for update mode.

    A watermark, where given, bounds the state to blocks that may still change.
    """
    s = stream.withWatermark(at, late) if late else stream
    return s.groupBy(block_of(at).alias("block_start")).agg(F.sum("total_tokens").alias("tokens"), F.sum("cost").alias("cost"), F.count(F.lit(1)).alias("n"))


BLOCKS = "block_start timestamp, late boolean, tokens bigint, cost double, n bigint"


def block_of(at: str):
    """Start of the 5-hour calendar block (0, 5, 10, 15, 20 h)."""
    return F.date_trunc("day", F.col(at)) + F.make_dt_interval(F.lit(0), (F.floor(F.hour(at) / 5) * 5).cast("int"))


def drain_blocks(stream: DataFrame, table: str, checkpoint: str, at: str = "ts", late_hours: float = 24.0, keep_hours: float = KEEP_HOURS):
    """Tokens and cost by block in a stored table, to which each batch adds its own sums; a query with an available-now trigger.

    The stream keeps no state: what was is in the table, in parts that are added up
    when they are merged by size.  The watermark, the newest time seen less
    ``late_hours``, stands in the table's version beside the number of the batch, so
    a batch that is run again adds nothing.  Rows behind it are never lost:
    they go to rows of their own, marked late, which ``blocks_of`` adds and
    ``late_corrections`` lists.  Rows without a time are a block without a start.
    """
    micros = F.unix_micros(at)

    def add(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        version = sinks.version_of(spark, table)
        notes = version.notes if version else {}
        if batch <= notes.get("batch", -1):
            return
        mark = notes.get("watermark")
        late = F.lit(False) if mark is None else F.coalesce(micros < mark, F.lit(False))
        sums = rows.groupBy(block_of(at).alias("block_start"), late.alias("late")).agg(F.sum("total_tokens").alias("tokens"), F.sum("cost").alias("cost"), F.count(F.lit(1)).alias("n"), F.max(micros).alias("newest"))
        sums = stage(sums, "blocks")
        newest = sums.agg(F.max("newest")).first()[0]
        seen = [m for m in (mark, None if newest is None else newest - int(late_hours * 3_600_000_000)) if m is not None]
        sinks.append_table(S.conform(sums, BLOCKS), table, {"batch": batch, "watermark": max(seen, default=None)})
        discard(sums)
        sinks.merge_tiers(spark, table, BLOCKS, combine=lambda parts: _blocks_added(parts, ["block_start", "late"]))
        sinks.vacuum_table(spark, table, keep_hours)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _blocks_added(parts: DataFrame, keys: list[str]) -> DataFrame:
    return parts.groupBy(*keys).agg(F.sum("tokens").alias("tokens"), F.sum("cost").alias("cost"), F.sum("n").alias("n"))


def blocks_of(spark: SparkSession, table: str) -> DataFrame:
    """Tokens, cost and rows by block, late ones included."""
    return _blocks_added(sinks.read_table(spark, table, BLOCKS), ["block_start"])


def late_corrections(spark: SparkSession, table: str) -> DataFrame:
    """What late rows have added to blocks."""
    return _blocks_added(sinks.read_table(spark, table, BLOCKS).where("late"), ["block_start"])


#: What is known of a log file: its first line, how many of its lines are counted, and a hash of these.
TAILED = "path string, length bigint, modified timestamp, head bigint, lines bigint, content decimal(38,0)"


def tail_turns(spark: SparkSession, folder: str, table: str, files_per_batch: int = 100, unfinished: bool = False, keep_hours: float = KEEP_HOURS) -> int:
    """Count the turns of agent logs that are not counted yet; returns the number of turns in the table.

    Files are known by their content: by the first line, and a hash of all lines
    that were counted with their numbers.  A file that was renamed is the file
    that it was; one that has grown gives its new lines; one whose counted
    lines have changed is another file.  Files of unchanged name, size and time
    are not opened.  The last line of a file waits until it is ended, unless
    ``unfinished`` lines are wanted.

    What is known of the files is named in the version that the turns of a batch
    are stored with, so that both change at once and a batch that is run again
    adds nothing.  ``files_per_batch`` files are read at a time, oldest first.
    """
    while True:
        version = sinks.version_of(spark, table)
        at = version.notes.get("tailed") if version else None
        known = spark.read.schema(TAILED).parquet(f"{table}-tailed/{at}") if at else S.empty(spark, TAILED)
        listed = spark.read.format("binaryFile").load(folder).select("path", "length", F.col("modificationTime").alias("modified"))
        changed = listed.where("length > 0").join(known, ["path", "length", "modified"], "left_anti")
        batch = [r["path"] for r in changed.orderBy("modified", "path").limit(files_per_batch).collect()]
        if not batch:
            break
        lines = _tailed_lines(spark, batch, unfinished)
        new, seen = _uncounted(lines, known)
        seen = listed.join(seen, "path")  # by path: what the listing says of the file that was read
        told = uuid.uuid4().hex
        # what was known stays until all changed files are read: one of them may have had another name
        known.unionByName(seen.select(*known.columns)).write.parquet(f"{table}-tailed/{told}")
        turns = parse_turns(new).groupBy("thread_id", "model").agg(F.count(F.lit(1)).alias("n_turns"), F.sum("total_tokens").alias("total_tokens"), F.min("ts").alias("first_at"), F.max("ts").alias("last_at"))
        sinks.append_table(S.conform(turns, TURNS), table, {"tailed": told})
        discard(lines)
    if at:
        current = known.join(listed, ["path", "length", "modified"], "left_semi").dropDuplicates(["path"])
        if current.count() < known.count():
            told = uuid.uuid4().hex
            current.write.parquet(f"{table}-tailed/{told}")
            sinks.append_table(S.empty(spark, TURNS), table, {"tailed": told})
        sinks.merge_tiers(spark, table, TURNS, combine=_added_up)
        sinks.vacuum_table(spark, table, keep_hours)
        sinks.keep_only(spark, f"{table}-tailed", {sinks.version_of(spark, table).notes["tailed"]}, keep_hours)
    return turn_rollup(spark, table).agg(F.coalesce(F.sum("n_turns"), F.lit(0)).alias("n")).first()["n"]


def _tailed_lines(spark: SparkSession, paths: list[str], unfinished: bool) -> DataFrame:
    """(path, line, value, h) of the files' lines; a last line without an end is left out."""
    placed = placed_lines(spark, paths, line_sep="\n")
    if not unfinished:
        ends = placed.groupBy("file").agg(F.sum(F.octet_length("value") + 1).alias("bytes"), F.max("line").alias("last"), F.max("size").alias("size"))
        open_ = ends.where(F.col("bytes") > F.col("size")).select("file", F.col("last").alias("line"))
        placed = placed.join(few(open_), ["file", "line"], "left_anti")
    return stage(placed.select(F.col("file").alias("path"), "line", "value", F.xxhash64("line", "value").alias("h")), "tailed-lines")


def _uncounted(lines: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lines that no known file has counted, and what is to be known of the files now."""
    total = lambda when: F.coalesce(F.sum(F.when(when, F.col("h").cast("decimal(38,0)"))), F.lit(0).cast("decimal(38,0)"))
    heads = lines.where("line = 1").select("path", F.col("h").alias("head"))
    maybe = known.where("lines > 0").select("head", F.col("lines").alias("n"), "content").distinct().join(heads, "head").select("path", "n", "content")
    within = F.col("line") <= F.col("n")
    same = lines.join(few(maybe), "path").groupBy("path", "n", "content").agg(total(within).alias("sum"), F.count_if(within).alias("have"))
    counted = same.where((F.col("sum") == F.col("content")) & (F.col("have") == F.col("n"))).groupBy("path").agg(F.max("n").alias("done"))
    new = lines.join(few(counted), "path", "left").where(F.col("line") > F.coalesce("done", F.lit(0)))
    seen = lines.groupBy("path").agg(F.max(F.when(F.col("line") == 1, F.col("h"))).alias("head"), F.max("line").alias("lines"), total(F.lit(True)).alias("content"))
    return new, seen


def _added_up(parts: DataFrame) -> DataFrame:
    return parts.groupBy("thread_id", "model").agg(F.sum("n_turns").alias("n_turns"), F.sum("total_tokens").alias("total_tokens"), F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"))


def turn_rollup(spark: SparkSession, table: str) -> DataFrame:
    """Turns and tokens per thread and model over all batches that ``tail_turns`` has stored."""
    return _added_up(sinks.read_table(spark, table, TURNS))
