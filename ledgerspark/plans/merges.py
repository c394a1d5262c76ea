"""Append, upsert and merge queries U-01..U-11, U-14, A-05."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark import schemas as S
from ledgerspark.operators import merges as M
from ledgerspark.operators import sinks
from ledgerspark.operators.lineage import shared_dir, stage
from ledgerspark.plans.registry import query
from ledgerspark.sources.logs import parse_events

NOW = "2024-02-01 00:00:00"
_ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def staged(t, where: str) -> DataFrame:
    """Events as staged envelopes of three kinds; repeats of a key differ in time."""
    k = F.col("event_id")
    payload = F.struct(
        F.when(k % 3 == 0, "session_stop").when(k % 3 == 1, "cost_emitted").otherwise("git_commit").alias("event_type"),
        F.when(k % 15 != 0, F.concat(F.lit("s"), (k % 900).cast("string"))).alias("session_id"), F.concat(F.lit("q"), (F.col("user_id") % 20).cast("string")).alias("project"),
        F.date_format("ts", _ISO).alias("started_at"), F.date_format("ts", _ISO).alias("ended_at"), F.col("value").alias("duration_min"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"), F.when(k % 5 != 0, F.lit("hook")).alias("source"), F.col("value").alias("daily_cost_usd"),
        F.concat(F.lit("h"), (k % 700).cast("string")).alias("hash"), F.lit(3).alias("lines_added"), F.lit(4).alias("lines_deleted"),
    )
    line = F.to_json(F.struct(F.date_format("ts", _ISO).alias("ts"), F.lit("h").alias("host"), payload.alias("payload")))
    return t("events").where(where).select(line.alias("value"), F.lit("f").alias("file"), k.alias("line"))


_E = "(SELECT *, concat('q', CAST(user_id % 20 AS STRING)) AS project, CASE WHEN event_id % 15 <> 0 THEN concat('s', CAST(event_id % 900 AS STRING)) END AS session_id, date_trunc('second', ts) AS sec, CASE WHEN event_id % 5 <> 0 THEN 'hook' END AS src FROM events WHERE {w})"
_OLD, _NEW = "event_id < 5000", "event_id >= 4000"


def _twice(append, t, ddl) -> DataFrame:
    """The old events, then an overlapping batch of new ones."""
    first = stage(append(S.empty(t.spark, ddl), parse_events(staged(t, _OLD)), NOW), "stored")  # what is stored is a table
    return append(first, parse_events(staged(t, _NEW)), NOW)


def _last(keys: str, where: str, only: str) -> str:
    return f"(SELECT * FROM {_E.format(w=where)} WHERE {only} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY sec DESC, event_id DESC) = 1)"


def _appended(keys: str, only: str, cols: str) -> str:
    k = keys.split(", ")
    same = " AND ".join(f"o.{c} = n.{c}" for c in k)
    return f"WITH o AS {_last(keys, _OLD, only)}, n AS {_last(keys, _NEW, only)} SELECT {cols} FROM o UNION ALL SELECT {cols} FROM n WHERE NOT EXISTS (SELECT 1 FROM o WHERE {same})"


@query("u01_append_sessions", _appended("session_id", "event_id % 3 = 0 AND session_id IS NOT NULL", "session_id, project, value AS duration_min, 'unknown' AS trigger"))
def _(t):
    return _twice(M.append_sessions, t, S.SESSIONS).select("session_id", "project", "duration_min", "trigger")


@query("u02_append_costs", _appended("project, day, src", "event_id % 3 = 1 AND src IS NOT NULL", "concat(project, '|', CAST(day AS STRING), '|', src) AS cost_id, value AS daily_cost_usd").replace("SELECT *, concat('q'", "SELECT *, CAST(ts AS DATE) AS day, concat('q'"))
def _(t):
    return _twice(M.append_costs, t, S.COSTS).select("cost_id", "daily_cost_usd")


@query("u03_append_commits", _appended("project, hash", "event_id % 3 = 2", "concat(project, '|', hash) AS commit_pk, CAST(ts AS DATE) AS date, 7 AS lines_changed").replace("SELECT *, concat('q'", "SELECT *, concat('h', CAST(event_id % 700 AS STRING)) AS hash, concat('q'"))
def _(t):
    return _twice(M.append_commits, t, S.COMMITS).select("commit_pk", "date", "lines_changed")


@query("a05_sessions_rollup", "SELECT session_id, project AS canonical_project, duration_min, coalesce(trigger, 'unknown') AS trigger FROM sessions WHERE project <> 'p3' AND NOT starts_with(project, 'p1')")
def _(t):
    from ledgerspark.functions.identifiers import canonical_project, drop_confidential

    s = S.conform(M.normal_sessions(t("sessions")).withColumn("trigger", F.coalesce("trigger", F.lit("unknown"))), S.SESSIONS)
    s = s.withColumn("canonical_project", canonical_project("project")).where(F.col("canonical_project").isNotNull())
    return drop_confidential(s, ["project", "canonical_project"]).select("session_id", "canonical_project", "duration_min", "trigger")


@query("u04_upsert_findings", """
WITH k AS (SELECT doc_id % 300 AS job_id, md5(lang) AS content_hash, max(doc_id) AS seen FROM documents GROUP BY 1, 2), old AS (SELECT * FROM k WHERE job_id < 200), new AS (SELECT * FROM k WHERE job_id >= 100)
SELECT job_id, content_hash, CASE WHEN job_id < 100 THEN 0 ELSE seen END AS scraped_at, job_id >= 200 AS fresh FROM (SELECT * FROM old WHERE job_id < 100 UNION ALL SELECT * FROM new)""")
def _(t):
    d = t("documents").select((F.col("doc_id") % 300).alias("job_id"), F.md5("lang").alias("content_hash"), F.lit("low").alias("severity"), F.col("doc_id").alias("scraped_at"))
    base = S.empty(t.spark, "job_id long, content_hash string, severity string, scraped_at long, finding_id long")
    old = M.upsert_findings(base, d.where("job_id < 200").withColumn("scraped_at", F.lit(0).cast("long")))
    out = M.upsert_findings(old, d.where("job_id >= 100"))
    n_old = F.broadcast(old.agg(F.max("finding_id").alias("m")))
    return out.crossJoin(n_old).select("job_id", "content_hash", "scraped_at", (F.col("finding_id") > F.col("m")).alias("fresh"))


def _loops(t, where: str, ack: str):
    k = F.col("o_orderkey")
    rows = t("orders").where(where).select(
        F.md5(k.cast("string")).alias("content_hash"), F.col("o_orderpriority").alias("severity"), F.lit("f").alias("primary_file"), F.lit("s").alias("summary"), (k % 17).cast("int").alias("cycles"),
        F.when(k % 2 == 0, "block").otherwise("watch").alias("tier"), F.when(k % 3 == 0, F.lit(ack)).alias("ack_by"), F.when(k % 6 == 0, F.lit("2024-01-15").cast("timestamp")).alias("ack_until"), F.lit(ack).alias("fix_commit_shas"),
    )
    return S.conform(rows, S.LOOPS)


@query("u05_upsert_loops", """
SELECT md5(CAST(o_orderkey AS STRING)) AS content_hash, CASE WHEN o_orderkey % 3 = 0 THEN CASE WHEN o_orderkey < 9000 THEN 'old' ELSE 'new' END END AS ack_by, CASE WHEN o_orderkey >= 6000 THEN 'new' ELSE 'old' END AS fix_commit_shas FROM orders""")
def _(t):
    return M.upsert_loops(_loops(t, "o_orderkey < 9000", "old"), _loops(t, "o_orderkey >= 6000", "new")).select("content_hash", "ack_by", "fix_commit_shas")


@query("u06_upsert_family_costs", """
SELECT date, round(sum(CASE WHEN date >= DATE '2024-01-10' THEN cost * 2 ELSE cost END), 4) AS cost FROM usage WHERE date <> DATE '2024-01-09' OR true GROUP BY date""")
def _(t):
    day = t("usage").groupBy("date").agg(F.sum("cost").alias("cost"))
    new = day.where("date >= DATE'2024-01-10'").withColumn("cost", F.col("cost") * 2)
    return M.replace_by_key(day.where("date < DATE'2024-01-20'"), new, ["date"]).select("date", F.round("cost", 4).alias("cost"))


_HIST = "SELECT project, date, round(sum(cost), 4) AS cost, {n} AS origin FROM usage WHERE {w} GROUP BY 1, 2"


def _hist(t, where: str, n: int):
    return t("usage").where(where).groupBy("project", "date").agg(F.round(F.sum("cost"), 4).alias("cost")).withColumn("origin", F.lit(n))


@query("u07_upsert_history", f"WITH o AS ({_HIST.format(n=1, w='event_id < 6000')}), n AS ({_HIST.format(n=2, w='event_id >= 4000')}) SELECT * FROM n UNION ALL SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.project = o.project AND n.date = o.date)")
def _(t):
    return M.replace_by_key(_hist(t, "event_id < 6000", 1), _hist(t, "event_id >= 4000", 2), ["project", "date"])


@query("u07_stored_history", f"WITH o AS ({_HIST.format(n=1, w='event_id < 6000')}), n AS ({_HIST.format(n=2, w='event_id >= 4000')}) SELECT * FROM n UNION ALL SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.project = o.project AND n.date = o.date)")
def _(t):
    """The history as a stored table in buckets, into which the newer rows are merged."""
    path, ddl = f"{shared_dir(t.spark)}/derived/history-{uuid.uuid4().hex}", "project string, date date, cost double, origin int"
    keys = ["project", "date"]
    for where, origin in (("event_id < 6000", 1), ("event_id >= 4000", 2)):
        sinks.upsert_table(_hist(t, where, origin), path, ddl, keys, lambda old, new: M.replace_by_key(old, new, keys), buckets=8)
    return sinks.read_table(t.spark, path, ddl)


@query("u08_upsert_chat_rollups", "SELECT user_id, count(*) AS n_messages, sum(input_tokens + output_tokens + cache_read_tokens) AS tokens FROM usage GROUP BY user_id")
def _(t):
    from ledgerspark.operators.usage import chat_rollup

    old = chat_rollup(t("usage").where("event_id < 5000"), ["user_id"])
    touched = t("usage").where("event_id >= 5000").select("user_id").distinct()
    new = chat_rollup(t("usage").join(touched, "user_id", "left_semi"), ["user_id"])
    return M.replace_by_key(old, new, ["user_id"]).select("user_id", "n_messages", "tokens")


_PART = "SELECT project, CASE WHEN model = 'view' THEN NULL ELSE model END AS model, sum(total_tokens) AS tokens, round(sum(CASE WHEN model = 'click' OR event_id % 3 = 0 THEN NULL ELSE cost END), 6) AS cost, min(event_id) AS lo, max(event_id) AS hi FROM usage WHERE {w} GROUP BY 1, 2"


def _part(t, where: str):
    u = t("usage").where(where).withColumn("cost", F.when((F.col("model") != "click") & (F.col("event_id") % 3 != 0), F.col("cost")))
    u = u.withColumn("model", F.when(F.col("model") != "view", F.col("model")))
    return u.groupBy("project", "model").agg(F.sum("total_tokens").alias("tokens"), F.sum("cost").alias("cost"), F.min("event_id").alias("lo"), F.max("event_id").alias("hi"))


@query("u09_additive_merge", _PART.format(w="true"))
def _(t):
    both = M.additive_merge(_part(t, "event_id < 300"), _part(t, "event_id >= 300"), ["project", "model"], ["tokens"], low=["lo"], high=["hi"], nullable=["cost"])
    return both.withColumn("cost", F.round("cost", 6))


@query("u09_stored_rollup", _PART.format(w="true"))
def _(t):
    """The rollup as a stored table in buckets, to which three batches are added."""
    path, ddl = f"{shared_dir(t.spark)}/derived/rollup-{uuid.uuid4().hex}", "project string, model string, tokens bigint, cost double, lo bigint, hi bigint"
    add = lambda old, new: M.additive_merge(old, new, ["project", "model"], ["tokens"], low=["lo"], high=["hi"], nullable=["cost"])
    for where in ("event_id < 300", "event_id >= 300 AND event_id < 700", "event_id >= 700"):
        sinks.upsert_table(_part(t, where), path, ddl, ["project", "model"], add, buckets=8)
    return sinks.read_table(t.spark, path, ddl).withColumn("cost", F.round("cost", 6))


@query("u10_blocklist", """
SELECT md5(CAST(o_orderkey AS STRING)) AS content_hash, 'block' AS tier FROM orders WHERE o_orderkey % 2 = 0 AND (o_orderkey % 3 <> 0 OR o_orderkey % 6 = 0)""")
def _(t):
    return M.blocklist(_loops(t, "true", "me"), NOW).select("content_hash", "tier")


@query("u11_acknowledge", "SELECT md5(CAST(o_orderkey AS STRING)) AS content_hash, CASE WHEN o_orderkey = 7 THEN 'you' WHEN o_orderkey % 3 = 0 THEN 'me' END AS ack_by FROM orders")
def _(t):
    from hashlib import md5

    return M.acknowledge(_loops(t, "true", "me"), md5(b"7").hexdigest(), "you", "known", NOW).select("content_hash", "ack_by")


@query("u14_backfill", f"""
WITH c AS ({_HIST.format(n=1, w='event_id >= 4000')}), o AS ({_HIST.format(n=2, w='event_id < 6000')}), m AS (SELECT project, date FROM c UNION SELECT project, date FROM o)
SELECT 'before' AS state, count(*) AS n, min(date) AS first, max(date) AS last FROM c UNION ALL SELECT 'after', count(*), min(date), max(date) FROM m""")
def _(t):
    return M.backfill(_hist(t, "event_id >= 4000", 1), _hist(t, "event_id < 6000", 2), ["project", "date"], "date")[1]
