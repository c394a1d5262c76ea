"""Git queries: A-06, A-14..A-23, A-52, J-22, W-02, W-03, W-05, W-07."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerspark.operators import gitlog as G
from ledgerspark.operators import joins as J
from ledgerspark.operators import usage as U
from ledgerspark.plans.registry import query

_M = "round((added + deleted), 6)"


@query("a06_commits_rollup", """
SELECT concat(CAST(project AS STRING), '|', hash) AS commit_pk, max(date) AS date, count(*) > 0 AS present FROM commits GROUP BY project, hash""")
def _(t):
    return G.commits_rollup(t("commits")).select("commit_pk", "date", F.lit(True).alias("present"))


@query("a14_weekly_commits", """
SELECT project, strftime(date, '%G-%V') AS iso_week, CAST(date_trunc('week', date) AS DATE) AS week_start, count(*) AS n_commits, sum(lines_added) AS lines_added, sum(lines_deleted) AS lines_deleted FROM commits GROUP BY 1, 2, 3""")
def _(t):
    return U.weekly_commits(t("commits"))


@query("a15_file_churn", """
WITH g AS (SELECT project, file, count(DISTINCT hash) AS n_commits, sum(added) AS added, sum(deleted) AS deleted, sum(added + deleted) AS changed, max(date) AS last_date FROM commit_files GROUP BY 1, 2)
SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY project ORDER BY n_commits DESC, changed DESC, file) <= 10""")
def _(t):
    return G.file_churn(t("commit_files"), 10)


@query("a16_contributors", """
WITH g AS (SELECT project, author, count(*) AS n_commits, count(*) FILTER (date > (SELECT max(date) FROM commits) - INTERVAL 6 MONTH) AS n_recent FROM commits GROUP BY 1, 2),
k AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY project ORDER BY n_commits DESC, author) <= 10 THEN n_commits END AS lead_n FROM g)
SELECT project, author, n_commits, n_recent, round(lead_n / sum(lead_n) OVER (PARTITION BY project), 6) AS share FROM k""")
def _(t):
    return G.contributors(t("commits"))


@query("a17_velocity", "SELECT project, strftime(date, '%Y-%m') AS month, count(*) AS n_commits FROM commits GROUP BY 1, 2")
def _(t):
    return G.velocity(t("commits"))


@query("a17_timing", """
WITH r AS (SELECT isodow(ts) - 1 AS weekday, hour(ts) AS hour FROM events), n AS (SELECT weekday, hour, count(*) AS n FROM r GROUP BY 1, 2)
SELECT a.weekday, b.hour, coalesce(n.n, 0) AS n FROM (SELECT DISTINCT weekday FROM r) a CROSS JOIN (SELECT DISTINCT hour FROM r) b LEFT JOIN n ON n.weekday = a.weekday AND n.hour = b.hour""")
def _(t):
    return G.timing(t("events"), "ts")


@query("a18_crisis_commits", "SELECT project, count(*) AS n FROM commits WHERE regexp_matches(message, '(?i)(revert|hotfix|urgent)') GROUP BY project")
def _(t):
    return G.message_matches(t("commits"), "(revert|hotfix|urgent)", ["project"])


@query("a18_hotspots", """
SELECT file, count(*) AS n FROM commit_files WHERE date > (SELECT max(date) FROM commit_files) - INTERVAL 6 MONTH GROUP BY file ORDER BY n DESC, file LIMIT 20""")
def _(t):
    return G.hotspots(t("commit_files"), 6, 20)


@query("a19_debt_markers", """
SELECT source, count(*) AS n FROM (SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE regexp_matches(line, '(TODO|FIXME|HACK|XXX|Th)') GROUP BY source ORDER BY n DESC, source LIMIT 20""")
def _(t):
    lines = t("documents").select("source", F.explode(F.split("text", "\n")).alias("line"))
    return G.debt_markers(lines, "source", "line", markers=("TODO", "FIXME", "HACK", "XXX", "Th"))


@query("a20_project_metrics", """
WITH rf AS (SELECT * FROM commit_files WHERE date > (SELECT max(date) FROM commit_files) - INTERVAL 6 MONTH), h AS (SELECT project, file, count(*) AS n, count(DISTINCT hash) AS hashes FROM rf GROUP BY 1, 2)
SELECT project, 'day' AS period, CAST(date AS STRING) AS period_label, 'commits' AS metric, CAST(count(*) AS DOUBLE) AS value FROM commits GROUP BY project, date
UNION ALL SELECT project, 'week', strftime(date, '%G-%V') AS l, 'commits', count(*) FROM commits GROUP BY project, l
UNION ALL SELECT project, 'month', strftime(date, '%Y-%m') AS l, 'commits', count(*) FROM commits GROUP BY project, l
UNION ALL SELECT project, 'total', 'all', 'commits_total', count(*) FROM commits GROUP BY project
UNION ALL SELECT project, 'total', 'all', 'contributors', count(DISTINCT author) FROM commits GROUP BY project
UNION ALL SELECT project, 'author', author, 'commits_by_author', count(*) FROM commits GROUP BY project, author
UNION ALL SELECT project, 'total', 'all', 'firefighting', count(*) FROM commits WHERE regexp_matches(message, '(?i)fix|revert|hotfix') GROUP BY project
UNION ALL SELECT project, 'total', 'all', 'message_length', round(avg(length(message)), 4) FROM commits GROUP BY project
UNION ALL SELECT project, 'total', 'all', 'lines_changed', sum(lines_changed) FROM commits GROUP BY project
UNION ALL SELECT project, 'total', 'all', 'last_commit', date_diff('day', DATE '1970-01-01', max(date)) FROM commits GROUP BY project
UNION ALL SELECT project, 'total', 'all', 'commits_last_week', count(*) FROM commits WHERE date > (SELECT max(date) FROM commits) - 7 GROUP BY project
UNION ALL SELECT project, 'file', file, 'churn', count(*) FROM commit_files GROUP BY project, file
UNION ALL SELECT project, '6m', 'all', 'active_files', count(DISTINCT file) FROM rf GROUP BY project
UNION ALL SELECT project, '6m', 'growth', 'files_added', count(*) FILTER (added > deleted) FROM rf GROUP BY project
UNION ALL SELECT project, '6m', 'cleanup', 'files_deleted', count(*) FILTER (added <= deleted) FROM rf GROUP BY project
UNION ALL SELECT project, '6m', 'net', 'files_net', count(*) FILTER (added > deleted) - count(*) FILTER (added <= deleted) FROM rf GROUP BY project
UNION ALL SELECT project, '6m', file, 'hotspot', max(n) FROM h GROUP BY project, file
UNION ALL SELECT project, '6m', file, 'commits_per_hot_file', max(hashes) FROM h GROUP BY project, file
UNION ALL SELECT project, 'total', split_part(file, '#', 1) AS l, 'lines_by_kind', sum(added + deleted) FROM commit_files GROUP BY project, l
UNION ALL SELECT project, 'total', 'all', 'lines_of_code', sum(added) - sum(deleted) FROM commit_files GROUP BY project""")
def _(t):
    return G.project_metrics(t("commits"), t("commit_files"))


@query("a21_project_list", """
WITH r AS (SELECT 'usage' AS source, project, date FROM usage UNION ALL SELECT 'sessions', project, date FROM sessions WHERE project <> 'p5' UNION ALL SELECT 'provider', project, date FROM provider)
SELECT project, count(DISTINCT source) AS n_sources, min(date) AS first_date, max(date) AS last_date FROM r WHERE project NOT IN ('p3') GROUP BY project""")
def _(t):
    return G.project_list({"usage": t("usage"), "sessions": t("sessions").where(F.col("project") != "p5"), "provider": t("provider")}, ("P3",))


_SNAP = "SELECT project, date_trunc('month', date) AS snapshot, 'm' || CAST(lines_deleted % 3 AS STRING) AS metric, CAST(sum(lines_added) AS DOUBLE) AS value FROM commits GROUP BY ALL"


def _snapshots(t):
    c = t("commits").groupBy("project", F.trunc("date", "month").alias("snapshot"), F.concat(F.lit("m"), (F.col("lines_deleted") % 3).cast("string")).alias("metric"))
    return c.agg(F.sum("lines_added").cast("double").alias("value"))


@query("w02_latest_snapshot", f"WITH s AS ({_SNAP}) SELECT project, metric, value FROM s QUALIFY rank() OVER (PARTITION BY project, metric ORDER BY snapshot DESC) = 1")
def _(t):
    return G.latest_per_key(_snapshots(t), ["project", "metric"], "snapshot").select("project", "metric", "value")


@query("w03_last_per_key", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def _(t):
    return G.last_per_key(t("orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("a22_project_health", f"""
WITH s AS ({_SNAP}), l AS (SELECT * FROM s WHERE snapshot = (SELECT max(snapshot) FROM s))
SELECT project, max(CASE WHEN metric = 'm0' THEN value END) AS m0, max(CASE WHEN metric = 'm1' THEN value END) AS m1, max(CASE WHEN metric = 'm2' THEN value END) AS m2 FROM l GROUP BY project""")
def _(t):
    return G.pivot_metrics(U.latest_fetch(_snapshots(t), "snapshot"), ["project"], "metric", ["m0", "m1", "m2"])


@query("a23_file_growth", """
WITH rf AS (SELECT * FROM commit_files WHERE date > (SELECT max(date) FROM commit_files) - INTERVAL 6 MONTH AND project <> 2)
SELECT project, CAST(count(*) FILTER (added > deleted) AS DOUBLE) AS growth, CAST(count(*) FILTER (added <= deleted) AS DOUBLE) AS cleanup, 0.0 AS net FROM rf GROUP BY project""")
def _(t):
    m = G.project_metrics(t("commits"), t("commit_files").where(F.col("project") != 2)).where(F.col("metric").isin("files_added", "files_deleted"))
    return G.pivot_metrics(m, ["project"], "period_label", ["growth", "cleanup", "net"], 0.0)


@query("a52_commits_by_project", """
SELECT project, count(*) AS n_commits, median(lines_changed) AS median_lines, round(avg(lines_changed), 6) AS mean_lines, sum(lines_added) AS added, sum(lines_deleted) AS deleted FROM commits GROUP BY project""")
def _(t):
    return G.commits_by_project(t("commits"))


@query("w05_rolling_growth", """
WITH a AS (SELECT CAST(unnest(generate_series(date_trunc('month', min(date)), date_trunc('month', max(date)), INTERVAL 1 MONTH)) AS DATE) AS anchor FROM commits)
SELECT anchor, sum(lines_added) AS added, sum(lines_deleted) AS deleted FROM a JOIN commits ON date > anchor - INTERVAL 6 MONTH AND date <= anchor GROUP BY anchor""")
def _(t):
    return G.rolling_growth(t("commits"))


@query("j22_change_coupling", """
WITH d AS (SELECT DISTINCT project, hash, file FROM commit_files), k AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY project, hash ORDER BY file) <= 20),
n AS (SELECT a.project, a.file AS file_a, b.file AS file_b, count(*) AS n FROM k a JOIN k b ON a.project = b.project AND a.hash = b.hash AND a.file < b.file GROUP BY ALL HAVING count(*) >= 3)
SELECT project, file_a, file_b, n, round(n / max(n) OVER (PARTITION BY project), 4) AS weight FROM n QUALIFY row_number() OVER (PARTITION BY project ORDER BY n DESC, file_a, file_b) <= 100""")
def _(t):
    return J.change_coupling(t("commit_files"))


@query("w07_normalised_weight", "WITH n AS (SELECT project, file, count(*) AS n FROM commit_files GROUP BY 1, 2) SELECT project, file, round(n / max(n) OVER (PARTITION BY project), 6) AS weight FROM n")
def _(t):
    from pyspark.sql import Window

    n = t("commit_files").groupBy("project", "file").agg(F.count(F.lit(1)).alias("n"))
    return n.select("project", "file", F.round(F.col("n") / F.max("n").over(Window.partitionBy("project")), 6).alias("weight"))
