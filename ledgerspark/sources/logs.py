"""Staged events, chat logs, agent logs, predictions, snapshots and text dumps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark import schemas as S
from ledgerspark.functions.columns import CHECKS, computed, parse_time, rank_in

_ENVELOPE = f"ts string, host string, pid string, payload struct<{', '.join(f'{a}: {b}' for a, b in (x.split() for x in S.PAYLOAD.split(', ')))}>"


def parse_events(lines: DataFrame) -> DataFrame:
    """Event envelopes of JSON lines; blank and unparsable lines are dropped, bad times are NULL.

    Works on batch and streaming frames; ``file`` and ``line`` are kept where given.
    """
    have = [c for c in ("file", "line") if c in lines.columns]
    e = computed(lines.where(F.trim("value") != "").select(*have, "value"), ok=F.try_parse_json("value").isNotNull(), e=F.from_json("value", _ENVELOPE))
    return e.where(F.col("ok") & F.col("e").isNotNull()).select(parse_time("e.ts").alias("ts"), "e.host", "e.pid", "e.payload", *have)


#: Names of the files that hold staged events; others beside them are not read.
EVENT_FILES = "events-*.jsonl"


def read_staged_events(spark: SparkSession, path: str) -> DataFrame:
    """All events-*.jsonl of a folder, with file and place in it; no folder gives no rows."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return parse_events(S.empty(spark, "value string, file string, line struct<file_block_start: bigint, n: bigint>"))
    lines = (
        spark.read.option("pathGlobFilter", EVENT_FILES).text(path)
        .select("value", F.col("_metadata.file_path").alias("file"), F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("n")).alias("line"))
    )
    return parse_events(lines)


def read_chat_logs(spark: SparkSession, path: str, newer_than: str | None = None, default_model: str = "unknown") -> DataFrame:
    """Messages of session-<id>.json files: an object with ``messages`` or a bare array; messages without tokens are skipped."""
    msg = "array<struct<timestamp: string, model: string, tokens: struct<input: bigint, output: bigint, cached: bigint>>>"
    raw = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_modification_time").alias("modified"))
    if newer_than:
        raw = raw.where(F.col("modified") > F.lit(newer_than).cast("timestamp"))
    bare = F.trim("value").startswith("[")
    messages = F.when(bare, F.from_json("value", msg)).otherwise(F.from_json("value", f"struct<messages: {msg}>")["messages"])
    m = raw.select(F.regexp_extract("name", r"session-(.*)\.json", 1).alias("session_id"), F.explode(messages).alias("m")).where(F.col("m.tokens").isNotNull())
    zero = lambda c: F.coalesce(F.col(f"m.tokens.{c}"), F.lit(0))
    return m.select("session_id", parse_time("m.timestamp").alias("ts"), F.coalesce("m.model", F.lit(default_model)).alias("model"), zero("input").alias("input_tokens"), zero("output").alias("output_tokens"), zero("cached").alias("cached_tokens"))


def parse_turns(lines: DataFrame, text: str = "value") -> DataFrame:
    """Turns of agent log lines that report total tokens; thread and total are required."""
    got = lambda pattern: F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
    usage = lambda f: got(rf"codex\.turn\.token_usage\.{f}=(\d+)").cast("long")
    t = lines.where(F.col(text).contains("codex.turn.token_usage.total_tokens=")).select(
        parse_time(F.regexp_replace(got(r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d+Z)"), r"\.\d+Z$", "Z")).alias("ts"), got(r"thread\.id=([0-9a-f-]{36})").alias("thread_id"),
        got(r"model=([^ }]+)").alias("model"), got(r"codex\.turn\.reasoning_effort=([^ }]+)").alias("reasoning_effort"),
        *(usage(f).alias(f) for f in ("input_tokens", "cached_input_tokens", "non_cached_input_tokens", "output_tokens", "reasoning_output_tokens", "total_tokens")),
    )
    t = t.where(F.col("thread_id").isNotNull() & F.col("total_tokens").isNotNull())
    return t.withColumn("non_cached_input_tokens", F.coalesce("non_cached_input_tokens", F.col("input_tokens") - F.col("cached_input_tokens")))


def read_turns(spark: SparkSession, path: str) -> DataFrame:
    return parse_turns(spark.read.text(path))


def read_snapshots(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """Long-form metrics partitioned by snapshot_date; ``since`` prunes partitions."""
    df = spark.read.schema("project string, period string, period_label string, metric string, value double, snapshot_date date").parquet(path)
    return df.where(F.col("snapshot_date") >= F.lit(since).cast("date")) if since else df


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of predictions; bad lines are dropped."""
    return spark.read.schema(S.PREDICTIONS).option("mode", "DROPMALFORMED").json(path)


def read_issue_events(spark: SparkSession, path: str, since: str) -> DataFrame:
    """Issue events flattened, from a date on."""
    raw = spark.read.schema("id bigint, project string, event string, created_at string, issue struct<number: int, title: string>, actor struct<login: string>").json(path)
    e = raw.select(F.col("id").alias("event_id"), "project", F.col("event").alias("event_type"), F.col("issue.number").alias("issue_number"), F.col("issue.title").alias("issue_title"), parse_time("created_at").alias("created_at"), F.col("actor.login").alias("actor"))
    return e.where(F.col("created_at") >= F.lit(since).cast("timestamp"))


def read_packages(spark: SparkSession, path: str) -> DataFrame:
    row = "Package string, Version string, _status string, _published string, _downloads struct<count: bigint>, _jobs array<struct<job: bigint, time: int, config: string, r: string, check: string>>"
    return spark.read.schema(row.replace("Package string", "Package string")).json(path)


def package_rows(packages: DataFrame) -> DataFrame:
    return packages.select(F.col("Package").alias("package"), F.col("Version").alias("version"), F.col("_status").alias("status"), parse_time("_published").alias("published"), F.col("_downloads.count").alias("downloads"), F.coalesce(F.size("_jobs"), F.lit(0)).alias("n_jobs"))


def package_checks(packages: DataFrame) -> DataFrame:
    """One row per package and build configuration, with its system and the check's rank from good to bad."""
    j = packages.select(F.col("Package").alias("package"), F.explode("_jobs").alias("j"))
    os = F.when(F.col("j.config").startswith("linux"), "linux").when(F.col("j.config").startswith("windows"), "windows").when(F.col("j.config").startswith("macos"), "macos").when(F.col("j.config").startswith("wasm"), "wasm").otherwise("other")
    return j.select("package", F.col("j.config").alias("config"), os.alias("os"), F.col("j.check").alias("check"), rank_in(F.col("j.check"), CHECKS).alias("check_rank"))
