"""Streaming queries X-01..X-05: available-now runs over files that Spark derives from the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ledgerspark import schemas as S
from ledgerspark.functions.columns import micros
from ledgerspark.operators import sinks
from ledgerspark.operators.lineage import shared_dir
from ledgerspark.plans import files, merges
from ledgerspark.plans.registry import query
from ledgerspark.streaming import drains


def _folder(t, name: str) -> str:
    return f"{shared_dir(t.spark)}/streams/{name}-{uuid.uuid4().hex}"


def _run(q) -> None:
    q.awaitTermination()
    if q.exception():
        raise q.exception()


@query("x01_drain_sessions", f"""
SELECT session_id, value AS duration_min, 'unknown' AS trigger, NULL AS working_dir FROM {merges._last('session_id', 'true', 'event_id % 3 = 0 AND session_id IS NOT NULL')}
UNION ALL SELECT concat('stored', CAST(event_id AS STRING)), value, 'unknown', CASE WHEN event_id % 2 = 0 THEN concat('code/r', CAST(user_id AS STRING)) ELSE 'notes' END FROM events WHERE event_id % 3 = 1""")
def _(t):
    """A store of before the rules, without triggers and with home folders, and events drained into it twice."""
    lines, root, marks = (_folder(t, x) for x in ("events", "store", "marks"))
    folder = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("/home/u"), (F.col("user_id") % 9).cast("string"), F.lit("/code/r"), F.col("user_id").cast("string"))).otherwise(F.lit("notes"))
    stored = t("events").where("event_id % 3 = 1").select(F.concat(F.lit("stored"), F.col("event_id").cast("string")).alias("session_id"), F.col("value").alias("duration_min"), folder.alias("working_dir"))
    sinks.write_table(stored, f"{root}/sessions")
    # files and lines follow time and then the event's number: of equal times the later line is the last
    at = F.date_trunc("second", F.get_json_object("value", "$.ts").cast("timestamp"))
    files.event_files(merges.staged(t, "true").repartitionByRange(8, at, "line").sortWithinPartitions(at, "line").select("value"), lines)
    for _round in range(2):  # the second run finds nothing new
        _run(drains.drain(t.spark, lines, root, marks, merges.NOW))
    return sinks.read_table(t.spark, f"{root}/sessions", S.SESSIONS).select("session_id", "duration_min", "trigger", "working_dir")


@query("x03_late_events", f"""
WITH e AS (SELECT o.way, concat('s', CAST(event_id AS STRING)) AS session_id, value AS duration_min, epoch_us(date_trunc('second', ts)) AS started_us FROM {merges._E.format(w='event_id % 3 = 0')} CROSS JOIN (VALUES ('in order'), ('late')) o(way)) SELECT * FROM e""")
def _(t):
    """Events of two halves of time, drained in order and with the older half long after the newer: the same store."""
    half = t("events").agg(F.expr("percentile_approx(unix_micros(CAST(ts AS TIMESTAMP)), 0.5)").alias("half"))
    e = t("events").where("event_id % 3 = 0").crossJoin(F.broadcast(half)).withColumn("old", F.unix_micros(F.col("ts").cast("timestamp")) < F.col("half"))
    payload = F.struct(
        F.lit("session_stop").alias("event_type"), F.concat(F.lit("s"), F.col("event_id").cast("string")).alias("session_id"), F.lit("q").alias("project"),
        F.date_format("ts", merges._ISO).alias("started_at"), F.col("value").alias("duration_min"),
    )
    lines = e.select("old", F.to_json(F.struct(F.date_format("ts", merges._ISO).alias("ts"), payload.alias("payload"))).alias("value"))
    out = None
    for way, order in (("in order", (True, False)), ("late", (False, True))):
        root, marks, staging = (_folder(t, x) for x in ("store", "marks", "staging"))
        for k, old in enumerate(order):
            files.event_files(lines.where(F.col("old") == old).select("value"), f"{staging}/{k}")
            _run(drains.drain(t.spark, f"{staging}/*", root, marks, merges.NOW))
        got = sinks.read_table(t.spark, f"{root}/sessions", S.SESSIONS).select(F.lit(way).alias("way"), "session_id", "duration_min", micros("started_at").alias("started_us"))
        out = got if out is None else out.unionByName(got)
    return out


@query("x02_streaming_distinct", "SELECT user_id, event_type FROM events GROUP BY 1, 2")
def _(t):
    src, out, marks = (_folder(t, x) for x in ("src", "out", "marks"))
    rows = t("events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    rows.write.parquet(src)
    stream = t.spark.readStream.schema(rows.schema).parquet(src)
    q = drains.distinct_events(stream, ["user_id", "event_type"], "ts", "60 days").select("user_id", "event_type")
    _run(q.writeStream.format("parquet").option("path", out).option("checkpointLocation", marks).trigger(availableNow=True).start())
    return t.spark.read.parquet(out)


@query("x04_streaming_blocks", """
SELECT epoch_us(date_trunc('day', ts) + to_hours(CAST(hour(ts) // 5 * 5 AS INT))) AS block_us, sum(total_tokens) AS tokens, round(sum(cost), 6) AS cost, count(*) AS n FROM usage GROUP BY 1""")
def _(t):
    """The later half of time comes first, so that most of the earlier one is late."""
    src, table, marks = (_folder(t, x) for x in ("src", "blocks", "marks"))
    rows = t("usage").select(F.col("ts").cast("timestamp").alias("ts"), "total_tokens", "cost")
    half = F.broadcast(rows.agg(F.expr("percentile_approx(unix_micros(ts), 0.5)").alias("half")))
    halves = rows.crossJoin(half).withColumn("old", F.unix_micros("ts") < F.col("half")).drop("half")
    for old in (False, True):
        halves.where(F.col("old") == old).drop("old").repartition(2).write.mode("append").parquet(src)
        stream = t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(src)
        _run(drains.drain_blocks(stream, table, marks, late_hours=12.0))
    return drains.blocks_of(t.spark, table).select(micros("block_start").alias("block_us"), "tokens", F.round("cost", 6).alias("cost"), "n")


@query("x05_log_tail", """
SELECT concat(substr(md5(CAST(user_id AS STRING)), 1, 8), '-0000-0000-0000-000000000000') AS thread_id, event_type AS model, count(*) AS n_turns, sum(event_id) AS total_tokens, epoch_us(date_trunc('second', min(ts))) AS first_us
FROM events WHERE event_id % 7 <> 0 AND event_id % 11 <> 0 GROUP BY 1, 2""")
def _(t):
    """Logs tailed in batches; then one is renamed, and tailing again counts nothing twice."""
    logs, table = (_folder(t, x) for x in ("logs", "rollup"))
    files._turn_lines(t).repartition(4).write.text(logs)
    drains.tail_turns(t.spark, logs, table, files_per_batch=2)
    fs, p = sinks._fs(t.spark, logs)
    chunk = next(s.getPath() for s in fs.listStatus(p) if s.getPath().getName().startswith("part-"))
    fs.rename(chunk, chunk.suffix(".1"))
    drains.tail_turns(t.spark, logs, table, files_per_batch=2)
    return drains.turn_rollup(t.spark, table).select("thread_id", "model", "n_turns", "total_tokens", micros("first_at").alias("first_us"))
