"""Source and sink queries S-01..S-20, K-01..K-07: files that Spark derives from the tables, read back by the readers."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.columns import micros
from ledgerspark.operators import sinks
from ledgerspark.operators.lineage import shared_dir
from ledgerspark.plans.registry import query
from ledgerspark.sources import git, logs, reviews, usage


def _folder(df: DataFrame, name: str) -> str:
    return f"{shared_dir(df.sparkSession)}/derived/{name}-{uuid.uuid4().hex}"


def _text(df: DataFrame, name: str) -> str:
    """One-column text frame as files."""
    path = _folder(df, name)
    df.write.text(path)
    return path


def _json(df: DataFrame, name: str) -> str:
    path = _folder(df, name)
    df.write.option("ignoreNullFields", "true").json(path)
    return path


def _documents(df: DataFrame, name: str) -> str:
    """One file per row, the whole document as its only line."""
    path = _folder(df, name)
    df.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return path


def chunk_of(df: DataFrame, *keys: str, rows: int = 2000) -> Column:
    """Number of a chunk of about ``rows`` rows, so that a document made of a chunk does not grow with the table."""
    return F.pmod(F.xxhash64(*keys), F.lit(max(1, -(-df.count() // rows))))


def event_files(df: DataFrame, path: str) -> str:
    """Lines as files named as staged events are, and beside them one that is none."""
    df.write.text(path)
    spark = df.sparkSession
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = p(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in fs.listStatus(p(path)))
    for k, part in enumerate(n for n in names if n.startswith("part-")):
        fs.rename(p(f"{path}/{part}"), p(f"{path}/events-{k:05d}.jsonl"))
    out = fs.create(p(f"{path}/notes.txt"), True)
    out.write(bytearray(b'{"ts": "2024-01-01T00:00:00Z", "host": "no event", "pid": "-1", "payload": {"event_type": "session_stop", "session_id": "none", "project": "none"}}'))
    out.close()
    return path


_ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


@query("s01_staged_events", """
SELECT event_id, CASE WHEN event_id % 9 = 0 THEN NULL ELSE epoch_us(date_trunc('second', ts)) END AS ts_us, event_type, value AS cost FROM events WHERE event_id % 10 <> 0""")
def _(t):
    ts = F.when(F.col("event_id") % 9 == 0, F.lit("bad")).otherwise(F.date_format("ts", _ISO))
    body = F.to_json(F.struct(ts.alias("ts"), F.lit("h").alias("host"), F.col("event_id").cast("string").alias("pid"), F.struct("event_type", F.col("value").alias("daily_cost_usd")).alias("payload")))
    line = F.when(F.col("event_id") % 20 == 0, F.lit("  ")).when(F.col("event_id") % 10 == 0, F.lit('{"ts": broken')).otherwise(body)
    assert logs.read_staged_events(t.spark, _folder(t("events"), "absent")).isEmpty()
    e = logs.read_staged_events(t.spark, event_files(t("events").select(line.alias("value")), _folder(t("events"), "events")))
    return e.select(F.col("pid").cast("long").alias("event_id"), micros("ts").alias("ts_us"), F.col("payload.event_type").alias("event_type"), F.col("payload.daily_cost_usd").alias("cost"))


def _usage_rows(t) -> DataFrame:
    models = F.when(F.col("event_id") % 3 == 0, F.array("model"))
    row = F.struct(
        F.col("date").cast("string").alias("date"), F.col("input_tokens").alias("inputTokens"), F.col("output_tokens").alias("outputTokens"), F.col("cache_creation_tokens").alias("cacheCreationTokens"),
        F.col("cache_read_tokens").alias("cacheReadTokens"), F.col("total_tokens").alias("totalTokens"), F.col("cost").alias("totalCost"), models.alias("modelsUsed"),
    )
    return t("usage").withColumn("row", row)


@query("s02_daily_usage", """
SELECT project, date, round(sum(cost), 6) AS cost, sum(total_tokens) AS tokens, count(*) AS n, count(*) FILTER (event_id % 3 = 0) AS n_models FROM usage WHERE project LIKE '%1%' GROUP BY 1, 2""")
def _(t):
    rows = _usage_rows(t)
    docs = rows.groupBy("project", chunk_of(rows, "event_id").alias("chunk")).agg(F.collect_list("row").alias("rows"))
    body = F.to_json(F.struct(F.create_map("project", "rows").alias("projects")))
    got = usage.read_daily_usage(t.spark, _documents(docs.select(body.alias("value")), "daily"), "1")
    return got.groupBy("project", "date").agg(F.round(F.sum("totalCost"), 6).alias("cost"), F.sum("totalTokens").alias("tokens"), F.count(F.lit(1)).alias("n"), F.sum(F.size("modelsUsed")).alias("n_models"))


@query("s03_usage_sessions", "SELECT session_id, duration_min AS cost, date FROM sessions")
def _(t):
    s = t("sessions").select("date", F.struct(F.col("session_id").alias("sessionId"), F.col("duration_min").alias("totalCost"), F.col("date").cast("string").alias("lastActivity")).alias("s"))
    docs = s.groupBy(chunk_of(s, "s.sessionId")).agg(F.collect_list("s").alias("sessions")).select(F.to_json(F.struct("sessions")).alias("value"))
    return usage.read_usage_sessions(t.spark, _documents(docs, "sessions")).select(F.col("sessionId").alias("session_id"), F.col("totalCost").alias("cost"), F.col("lastActivity").alias("date"))


@query("s04_usage_blocks", "SELECT block_id AS input_tokens, cost, total_tokens, model AS models FROM blocks WHERE NOT is_gap AND actual_end IS NOT NULL AND cost > 0")
def _(t):
    iso = lambda c: F.date_format(c, _ISO)
    b = F.struct(
        iso("start_time").alias("startTime"), iso("planned_end").alias("endTime"), iso("actual_end").alias("actualEndTime"), F.col("is_gap").alias("isGap"), F.col("cost").alias("costUSD"),
        F.col("total_tokens").alias("totalTokens"), F.array("model").alias("models"), F.struct(F.col("block_id").alias("inputTokens")).alias("tokenCounts"),
    )
    rows = t("blocks")
    docs = rows.groupBy(chunk_of(rows, "block_id")).agg(F.collect_list(b).alias("blocks")).select(F.to_json(F.struct("blocks")).alias("value"))
    return usage.read_blocks(t.spark, _documents(docs, "blocks"), for_report=True).select("input_tokens", "cost", "total_tokens", "models")


@query("s05_rate_limits", """
SELECT CAST(event_id AS STRING) AS provider, w AS limit_window, value AS used_pct, CASE WHEN w = 'secondary' THEN 60 ELSE 300 END AS window_minutes FROM events CROSS JOIN (VALUES ('primary'), ('secondary')) v(w)
WHERE NOT (w = 'secondary' AND event_id % 3 = 0) AND NOT (w = 'primary' AND event_id % 4 = 0)""")
def _(t):
    win = lambda m, at: F.struct(F.col("value").alias("usedPercent"), F.lit(m).alias("windowMinutes"), at.alias("resetsAt"))
    reset = F.when(F.col("event_id") % 4 == 0, F.lit("1970-01-01T00:00:00Z")).otherwise(F.lit("2024-02-01T00:00:00Z"))
    u = F.struct(win(300, reset).alias("primary"), F.when(F.col("event_id") % 3 != 0, win(60, F.lit("2024-02-01T00:00:00Z"))).alias("secondary"), F.lit("2024-01-31T00:00:00Z").alias("updatedAt"))
    got = usage.read_rate_limits(t.spark, _json(t("events").select(F.col("event_id").cast("string").alias("provider"), u.alias("usage")), "limits"))
    return got.select("provider", "limit_window", "used_pct", "window_minutes")


@query("s06_provider_costs", "SELECT project AS provider, date, model, round(sum(cost), 6) AS cost, sum(total_tokens) AS total_tokens, count(*) AS n FROM usage WHERE model <> 'view' GROUP BY 1, 2, 3")
def _(t):
    camel = F.col("event_id") % 2 == 0
    m = F.struct(F.col("model").alias("modelName"), "cost", F.when(camel, F.col("total_tokens")).alias("totalTokens"), F.when(~camel, F.col("total_tokens")).alias("total_tokens"))
    rows = t("usage").withColumn("chunk", chunk_of(t("usage"), "event_id"))
    day = rows.groupBy("project", "chunk", "date").agg(F.collect_list(F.when(F.col("model") != "view", m)).alias("modelBreakdowns"))
    docs = day.groupBy(F.col("project").alias("provider"), "chunk").agg(F.collect_list(F.struct(F.col("date").cast("string").alias("date"), "modelBreakdowns")).alias("daily")).drop("chunk")
    got = usage.read_provider_costs(t.spark, _json(docs, "costs"))
    return got.groupBy("provider", "date", "model").agg(F.round(F.sum("cost"), 6).alias("cost"), F.sum("total_tokens").alias("total_tokens"), F.count(F.lit(1)).alias("n"))


@query("s07_monitor_blocks", "SELECT CAST(block_id AS STRING) AS id, epoch_us(date_trunc('second', start_time)) AS start_us, cost, block_id + 2 AS total_tokens FROM blocks WHERE NOT is_gap")
def _(t):
    at = "start_time"
    start = F.array(F.year(at), F.dayofyear(at), F.hour(at), F.minute(at), F.second(at).cast("int"))
    rows = t("blocks").select(F.col("block_id").cast("string").alias("id"), "is_gap", start.alias("start"), "cost", F.struct(F.col("block_id").alias("inputTokens"), F.lit(2).alias("outputTokens")).alias("stats"))
    return usage.read_monitor_blocks(t.spark, _json(rows, "monitor")).select("id", micros("start_time").alias("start_us"), "cost", "total_tokens")


@query("s08_chat_logs", """
SELECT CASE WHEN user_id % 4 = 0 THEN 'unknown' ELSE event_type END AS model, count(*) AS n, sum(event_id) AS input_tokens FROM events WHERE event_id % 5 <> 0 GROUP BY 1""")
def _(t):
    m = F.struct(F.date_format("ts", _ISO).alias("timestamp"), F.when(F.col("user_id") % 4 != 0, F.col("event_type")).alias("model"), F.when(F.col("event_id") % 5 != 0, F.struct(F.col("event_id").alias("input"))).alias("tokens"))
    rows = t("events")
    # a chunk is dealt to 20 users, so that a file of one user's share of it holds about as many messages as a chunk elsewhere holds rows
    g = rows.groupBy(F.pmod("user_id", F.lit(20)).alias("user_id"), chunk_of(rows, "event_id", rows=20 * 2000)).agg(F.collect_list(m).alias("messages"))
    body = F.when(F.col("user_id") % 2 == 0, F.to_json("messages")).otherwise(F.to_json(F.struct("messages")))
    got = logs.read_chat_logs(t.spark, _documents(g.select(body.alias("value")), "chat"))
    return got.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.sum("input_tokens").alias("input_tokens"))


_SESSION = "concat('u', CAST(user_id % 5 AS STRING), '-', CAST(CAST(ts AS DATE) AS STRING))"


@query("s08_chat_sessions", f"""
SELECT {_SESSION} AS session_id, count(*) AS n, sum(event_id) AS input_tokens, epoch_us(date_trunc('second', min(ts))) AS first_us FROM events WHERE event_id % 5 <> 0 AND ts >= TIMESTAMP '2024-01-15' GROUP BY 1""")
def _(t):
    """Session files by name; those of the first half of the month were written long ago and are not read again."""
    m = F.struct(F.date_format("ts", _ISO).alias("timestamp"), F.when(F.col("event_id") % 5 != 0, F.struct(F.col("event_id").alias("input"))).alias("tokens"))
    g = t("events").groupBy(F.expr(_SESSION).alias("session")).agg(F.collect_list(m).alias("messages"))
    path = _folder(g, "sessions")
    g.select("session", F.to_json(F.struct("messages")).alias("value")).write.partitionBy("session").text(path)
    spark = t.spark
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = p(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(p(f"{path}-named"))
    for folder in fs.listStatus(p(path)):  # five sessions a day
        name = folder.getPath().getName()
        if name.startswith("session="):
            part = next(s.getPath() for s in fs.listStatus(folder.getPath()) if s.getPath().getName().startswith("part-"))
            to = p(f"{path}-named/session-{name[8:]}.json")
            fs.rename(part, to)
            if name[-10:] < "2024-01-15":
                fs.setTimes(to, 1_577_836_800_000, -1)
    got = logs.read_chat_logs(spark, f"{path}-named", newer_than="2021-01-01 00:00:00")
    return got.groupBy("session_id").agg(F.count(F.lit(1)).alias("n"), F.sum("input_tokens").alias("input_tokens"), micros(F.min("ts")).alias("first_us"))


def _turn_lines(t) -> DataFrame:
    thread = F.concat(F.substring(F.md5(F.col("user_id").cast("string")), 1, 8), F.lit("-0000-0000-0000-000000000000"))
    k = F.col("event_id")
    return t("events").select(F.concat(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".123456Z INFO turn{"), F.when(k % 7 != 0, F.concat(F.lit("thread.id="), thread)).otherwise(F.lit("no.thread")),
        F.lit(" model="), F.col("event_type"), F.lit("}: codex.turn.token_usage.input_tokens="), k.cast("string"), F.lit(" codex.turn.token_usage.cached_input_tokens="), (k % 10).cast("string"),
        F.when(k % 2 == 0, F.concat(F.lit(" codex.turn.token_usage.non_cached_input_tokens="), F.lit("5"))).otherwise(F.lit("")), F.lit(" codex.turn.token_usage.output_tokens=3"),
        F.when(k % 11 != 0, F.concat(F.lit(" codex.turn.token_usage.total_tokens="), k.cast("string"))).otherwise(F.lit("")),
    ).alias("value"))


@query("s09_agent_turns", """
SELECT concat(substr(md5(CAST(user_id AS STRING)), 1, 8), '-0000-0000-0000-000000000000') AS thread_id, event_type AS model, epoch_us(date_trunc('second', ts)) AS ts_us,
 event_id AS total_tokens, CASE WHEN event_id % 2 = 0 THEN 5 ELSE event_id - event_id % 10 END AS non_cached FROM events WHERE event_id % 7 <> 0 AND event_id % 11 <> 0""")
def _(t):
    got = logs.read_turns(t.spark, _text(_turn_lines(t), "turns"))
    return got.select("thread_id", "model", micros("ts").alias("ts_us"), "total_tokens", F.col("non_cached_input_tokens").alias("non_cached"))


@query("s10_snapshots", "SELECT project, model AS metric, date AS snapshot_date, round(sum(cost), 6) AS value FROM usage WHERE date >= DATE '2024-01-20' GROUP BY 1, 2, 3")
def _(t):
    path = _folder(t("usage"), "snapshots")
    m = t("usage").groupBy("project", F.col("model").alias("metric"), F.col("date").alias("snapshot_date")).agg(F.round(F.sum("cost"), 6).alias("value"))
    m.select("project", F.lit("day").alias("period"), F.lit("").alias("period_label"), "metric", "value", "snapshot_date").write.partitionBy("snapshot_date").parquet(path)
    return logs.read_snapshots(t.spark, path, "2024-01-20").select("project", "metric", "snapshot_date", "value")


@query("s11_catalog_readers", "SELECT count(*) AS n_sessions, 0 AS n_runs, count(*) FILTER (trigger = 'cron') AS n_cron FROM sessions")
def _(t):
    from ledgerspark.schemas import SESSIONS

    path = _folder(t("sessions"), "catalog")
    sinks.write_table(t("sessions").select("session_id", "project", "started_at", "trigger"), path)
    s = sinks.read_table(t.spark, path, SESSIONS)
    runs = sinks.read_table(t.spark, path + "-absent", "session_id string")
    return s.agg(F.count(F.lit(1)).alias("n_sessions"), F.count_if(F.col("trigger") == "cron").alias("n_cron")).crossJoin(runs.agg(F.count(F.lit(1)).alias("n_runs")))


def _dump_path(t, name: str) -> str:
    """Git logs of several files: an order is a commit, its items are the files."""
    binary = F.col("l_linenumber") == 7
    number = lambda c: F.when(binary, F.lit("-")).otherwise(c.cast("int").cast("string"))
    line = F.concat_ws("\t", number(F.col("l_quantity")), number(F.col("l_linenumber")), F.concat(F.lit("f"), (F.col("l_partkey") % 50).cast("string")))
    c = t("lineitem").groupBy("l_orderkey").agg(F.min(F.to_date("l_shipdate")).alias("d"), F.collect_list(line).alias("lines"))  # an order has seven items at most
    head = F.concat(F.sha1(F.col("l_orderkey").cast("string")), F.lit("|"), F.col("d").cast("string"), F.lit("|fix: a|b\n\n"))
    return _text(c.select(F.concat(head, F.array_join("lines", "\n")).alias("value")), name)


@query("s13_git_commits", """
SELECT substr(sha1(CAST(l_orderkey AS STRING)), 1, 7) AS hash, min(CAST(l_shipdate AS DATE)) AS date, 'fix: a|b' AS message, sum(CASE WHEN l_linenumber = 7 THEN 0 ELSE CAST(l_quantity AS INT) END) AS lines_added,
 sum(CASE WHEN l_linenumber = 7 THEN 0 ELSE l_linenumber END) AS lines_deleted, count(*) AS files_changed FROM lineitem GROUP BY l_orderkey""")
def _(t):
    return git.commits(git.read_dumps(t.spark, _dump_path(t, "gitlog"))).drop("project")


@query("s14_git_files", "SELECT substr(sha1(CAST(l_orderkey AS STRING)), 1, 7) AS hash, concat('f', CAST(l_partkey % 50 AS STRING)) AS file, CAST(l_quantity AS INT) AS added, l_linenumber AS deleted FROM lineitem WHERE l_linenumber <> 7")
def _(t):
    return git.file_touches(git.read_dumps(t.spark, _dump_path(t, "gitfiles"))).select("hash", "file", "added", "deleted")


@query("s15_issue_events", "SELECT event_id, event_type, CAST(user_id AS INT) AS issue_number, 'u' || CAST(user_id AS STRING) AS actor FROM events WHERE date_trunc('second', ts) >= TIMESTAMP '2024-01-10'")
def _(t):
    u = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    rows = t("events").select(F.col("event_id").alias("id"), F.lit("p").alias("project"), F.col("event_type").alias("event"), F.date_format("ts", _ISO).alias("created_at"), F.struct(F.col("user_id").cast("int").alias("number"), F.lit("t").alias("title")).alias("issue"), F.struct(u.alias("login")).alias("actor"))
    return logs.read_issue_events(t.spark, _json(rows, "issues"), "2024-01-10").select("event_id", "event_type", "issue_number", "actor")


def _reports(t) -> DataFrame:
    """Two findings per document, the second without location; every fifth has no severity."""
    k = F.col("doc_id")
    one = F.concat(
        F.when(k % 5 != 0, F.lit("- **Severity**: High\n")).otherwise(F.lit("")), F.lit("- **Location**: `src/a"), (k % 9).cast("string"), F.lit(".py:"), k.cast("string"), F.when(k % 2 == 0, F.lit("-99")).otherwise(F.lit("")),
        F.lit("`; other.py\n- **Problem**: bad "), F.col("lang"), F.lit(" thing"), F.when(k % 4 == 0, F.lit("\n  on two lines")).otherwise(F.lit("")), F.lit("\n- **Fix**: mend it\n"),
    )
    return t("documents").select(k.alias("job_id"), F.col("source").alias("repo"), F.concat(one, F.lit("\n---\n**Severity**: low\n**Problem**: other\n")).alias("output"))


@query("s16_review_findings", """
SELECT doc_id AS job_id, 'high' AS severity, concat('src/a', CAST(doc_id % 9 AS STRING), '.py') AS primary_file, concat('bad ', lang, ' thing', CASE WHEN doc_id % 4 = 0 THEN concat(chr(10), '  on two lines') ELSE '' END) AS problem_text, 'mend it' AS fix_text FROM documents WHERE doc_id % 5 <> 0
UNION ALL SELECT doc_id, 'low', NULL, 'other', NULL FROM documents""")
def _(t):
    return reviews.parse_findings(_reports(t)).drop("full_location")


@query("s17_review_listing", """
SELECT doc_id AS job_id, 'high' AS severity, CASE WHEN doc_id % 3 = 0 THEN 'pass' ELSE 'unknown' END AS verdict FROM documents WHERE doc_id % 5 <> 0 AND doc_id >= 24
UNION ALL SELECT doc_id, 'low', CASE WHEN doc_id % 3 = 0 THEN 'pass' ELSE 'unknown' END FROM documents WHERE doc_id >= 24""")
def _(t):
    at = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(F.lit(0), F.col("doc_id").cast("int"))
    jobs = t("documents").select(F.col("doc_id").alias("job_id"), F.col("source").alias("project"), F.lit("a").alias("agent"), F.when(F.col("doc_id") % 3 == 0, "PASS").otherwise("odd").alias("verdict"), F.when(F.col("doc_id") % 2 == 0, at).alias("reviewed_at"), at.alias("created_at"))
    return reviews.review_listing(reviews.parse_findings(_reports(t)), jobs, "2024-01-02").select("job_id", "severity", "verdict")


@query("s18_review_locations", "SELECT doc_id AS job_id, source AS repo, concat('src/a', CAST(doc_id % 9 AS STRING), '.py') AS file_path, CASE WHEN doc_id % 2 = 1 THEN CAST(doc_id AS INT) END AS line FROM documents")
def _(t):
    return reviews.review_locations(_reports(t), ["job_id", "repo"])


@query("s19_predictions", "SELECT prediction_id, p AS p_success, outcome FROM predictions WHERE line_no % 4 <> 3")
def _(t):
    good = F.to_json(F.struct("prediction_id", F.col("p").alias("p_success"), "outcome"))
    lines = t("predictions").select(F.when(F.col("line_no") % 4 == 3, F.lit("{bad")).otherwise(good).alias("value"))
    return logs.read_predictions(t.spark, _text(lines, "predictions")).select("prediction_id", "p_success", "outcome")


_CONFIG = "CASE o_orderkey % 4 WHEN 0 THEN 'linux' WHEN 1 THEN 'windows' WHEN 2 THEN 'macos' ELSE 'other' END"
_CHECK = "CASE o_orderkey % 3 WHEN 0 THEN 'OK' WHEN 1 THEN 'WARNING' ELSE 'odd' END"


@query("s20_package_checks", f"SELECT CAST(o_custkey AS STRING) AS package, {_CONFIG} AS os, {_CHECK} AS check, CASE o_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 3 END AS check_rank, count(*) AS n FROM orders GROUP BY ALL")
def _(t):
    job = F.struct(F.concat(F.expr(_CONFIG.replace("'other'", "'solaris'")), F.lit("-x")).alias("config"), F.expr(_CHECK).alias("check"))
    docs = t("orders").groupBy(F.col("o_custkey").cast("string").alias("Package")).agg(F.collect_list(job).alias("_jobs"))
    got = logs.package_checks(logs.read_packages(t.spark, _json(docs, "packages")))
    return got.groupBy("package", "os", "check", "check_rank").agg(F.count(F.lit(1)).alias("n"))


@query("s20_packages", "SELECT CAST(o_custkey AS STRING) AS package, count(*) AS n_jobs FROM orders GROUP BY 1")
def _(t):
    docs = t("orders").groupBy(F.col("o_custkey").cast("string").alias("Package")).agg(F.collect_list(F.struct(F.lit("linux").alias("config"))).alias("_jobs"))
    return logs.package_rows(logs.read_packages(t.spark, _json(docs, "packages"))).select("package", "n_jobs")


# sinks --------------------------------------------------------------------


@query("k01_atomic_write", "SELECT o_orderkey, o_totalprice FROM orders")
def _(t):
    path = _folder(t("orders"), "table")
    sinks.write_table(t("orders").limit(0), path)
    sinks.write_table(t("orders"), path)
    return sinks.read_table(t.spark, path, "o_orderkey long, o_totalprice double")


@query("k02_guarded_rewrite", "SELECT count(*) AS n, true AS refused FROM orders")
def _(t):
    path = _folder(t("orders"), "guarded")
    sinks.write_table(t("orders"), path)
    try:
        sinks.write_table(t("orders").where("o_orderkey % 2 = 0"), path, allow_shrink=False)
        refused = False
    except sinks.GateError:
        refused = True
    return sinks.read_table(t.spark, path, "o_orderkey long").agg(F.count(F.lit(1)).alias("n"), F.lit(refused).alias("refused"))


@query("k03_append_fetch", "SELECT event_type, count(*) * 2 AS n, count(*) AS n_latest FROM events GROUP BY event_type")
def _(t):
    from ledgerspark.operators.usage import latest_fetch

    path = _folder(t("events"), "fetches")
    for at in ("2024-02-01 00:00:00", "2024-02-02 00:00:00"):
        sinks.append_fetch(t("events").select("event_id", "event_type"), path, at)
    both = t.spark.read.parquet(path)
    n = latest_fetch(both, "fetch_timestamp").groupBy("event_type").agg(F.count(F.lit(1)).alias("n_latest"))
    return both.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).join(n, "event_type")


@query("k04_publish_gate", "SELECT 'names.parquet' AS file, count(*) AS n_rows, true AS refused FROM raw_names WHERE name IS NULL OR NOT (lower(name) IN ('secret_lab', 'p3') OR starts_with(lower(name), 'private_') OR starts_with(lower(name), 'p1'))")
def _(t):
    from ledgerspark.functions.identifiers import drop_confidential

    rows = t("raw_names")
    try:
        sinks.publish_gate(rows, ["name"])
        refused = False
    except sinks.GateError:
        refused = True
    clean = sinks.publish_gate(drop_confidential(rows, ["name"]), ["name"])
    assert "cwd" not in clean.columns
    return sinks.manifest({"names": clean}).withColumn("refused", F.lit(refused))


@query("k05_completeness", "SELECT 'orders' AS table_name, count(*) AS n, count(*) > 0 AS ok FROM orders UNION ALL SELECT 'none', 0, false UNION ALL SELECT 'optional', 0, true")
def _(t):
    none = t("orders").where(F.lit(False))
    return sinks.completeness({"orders": t("orders"), "none": none}, {"optional": (none, ["o_orderkey"])})


@query("k06_run_log", "SELECT o_orderkey AS run_id, 'done' AS status FROM orders UNION ALL SELECT max(o_orderkey) + 1, 'new' FROM orders")
def _(t):
    runs = t("orders").select(F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").cast("timestamp").alias("started_at"), F.col("o_orderdate").cast("timestamp").alias("ended_at"), F.lit(1).cast("long").alias("reviews_seen"), F.lit(0).cast("long").alias("new_findings"), F.lit(0).cast("long").alias("loops_active"), F.lit("done").alias("status"))
    return sinks.log_run(runs, "2024-01-01 00:00:00", "2024-01-01 00:01:00", 5, 2, 1, "new").select("run_id", "status")


@query("k07_result_json", "SELECT c_custkey, c_mktsegment FROM customer")
def _(t):
    path = _folder(t("customer"), "json")
    sinks.write_json(t("customer").select("c_custkey", "c_mktsegment"), path)
    return t.spark.read.schema("c_custkey long, c_mktsegment string").json(path)
