"""Review queries: A-24..A-42, A-59..A-65, P-20, J-15."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerspark.operators import joins as J
from ledgerspark.operators import reviews as R
from ledgerspark.plans.registry import query

NOW = "1999-06-15 12:00:00"
_NOW = f"TIMESTAMP '{NOW}'"
_RES = "coalesce(close_reason <> '', false)"
_AGE = f"(epoch_us({_NOW}) - epoch_us(created_at)) / 3.6E9"
_TTC = "(epoch_us(closed_at) - epoch_us(created_at)) / 3.6E9"
_SEV = ("low", "medium", "high", "critical")
_LOOPS = "(SELECT md5(CAST(o_orderkey AS STRING)) AS content_hash, o_orderpriority AS severity, concat('f', CAST(o_custkey % 9 AS STRING)) AS primary_file, CASE o_orderkey % 4 WHEN 0 THEN 'escalate' WHEN 1 THEN 'block' ELSE 'watch' END AS tier, CAST(o_orderkey % 17 AS INT) AS cycles, CASE WHEN o_orderkey % 8 = 0 THEN 'me' END AS ack_by, o_totalprice AS wasted FROM orders)"


def _loops(t):
    k = F.col("o_orderkey")
    return t("orders").select(
        F.md5(k.cast("string")).alias("content_hash"), F.col("o_orderpriority").alias("severity"), F.concat(F.lit("f"), (F.col("o_custkey") % 9).cast("string")).alias("primary_file"),
        F.when(k % 4 == 0, "escalate").when(k % 4 == 1, "block").otherwise("watch").alias("tier"), (k % 17).cast("int").alias("cycles"), F.when(k % 8 == 0, F.lit("me")).alias("ack_by"),
        F.col("o_totalprice").alias("estimated_wasted_usd"), F.concat(F.lit("s"), k.cast("string")).alias("summary"),
    )


_FIND = """(SELECT review_id AS finding_id, repo, coalesce(severity, 'unknown') AS severity, CASE verdict WHEN 'P' THEN 'pass' WHEN 'F' THEN 'fail' ELSE 'unknown' END AS verdict,
  concat('review ', CAST(review_id AS STRING), ' on ', repo) AS summary, created_at AS found_at, closed_at AS resolved_at FROM lifecycle)"""


@query("p20_findings_view", f"SELECT finding_id, repo, severity, verdict, summary, epoch_us(found_at) AS found_us, epoch_us(resolved_at) AS resolved_us FROM {_FIND}")
def _(t):
    from ledgerspark.functions.columns import micros

    return R.findings_view(t("lifecycle")).select("finding_id", "repo", "severity", "verdict", "summary", micros("found_at").alias("found_us"), micros("resolved_at").alias("resolved_us"))


@query("a24_review_pulse", f"""
SELECT count(*) FILTER (NOT {_RES}) AS n_open, count(*) FILTER ({_RES}) AS n_resolved, {", ".join(f"count(*) FILTER (NOT {_RES} AND severity = '{s}') AS n_{s}" for s in _SEV)},
  count(*) FILTER (created_at BETWEEN {_NOW} - INTERVAL 24 HOUR AND {_NOW}) AS new_24h, count(*) FILTER (fix_commit_at BETWEEN {_NOW} - INTERVAL 24 HOUR AND {_NOW}) AS fix_linked_24h,
  count(*) FILTER (closed_at BETWEEN {_NOW} - INTERVAL 24 HOUR AND {_NOW}) AS closed_24h, any_value(n_loops) AS n_loops, any_value(n_escalated) AS n_escalated, any_value(wasted_usd) AS wasted_usd
FROM lifecycle CROSS JOIN (SELECT count(*) AS n_loops, count(*) FILTER (tier = 'escalate') AS n_escalated, round(sum(wasted), 4) AS wasted_usd FROM {_LOOPS})""")
def _(t):
    return R.pulse(t("lifecycle"), _loops(t), NOW).withColumn("wasted_usd", F.round("wasted_usd", 4))


@query("a25_reviews_by_repo", f"""
SELECT CASE repo WHEN 'MACHINERY' THEN 'BUILDING' ELSE repo END AS repo, count(*) AS total, count(*) FILTER (severity IN ('high', 'critical')) AS high_critical, count(*) FILTER ({_RES}) AS resolved, count(*) FILTER (NOT {_RES}) AS open FROM lifecycle GROUP BY 1""")
def _(t):
    return R.by_repo(t("lifecycle"), (("MACHINERY", "BUILDING"),))


@query("a26_resolution_rate", f"""
SELECT CAST(date_trunc('week', created_at) AS DATE) AS week, count(*) AS total, count(*) FILTER ({_RES}) AS resolved, round(count(*) FILTER ({_RES}) / count(*), 6) AS rate FROM lifecycle GROUP BY 1
UNION ALL SELECT NULL, count(*), count(*) FILTER ({_RES}), round(count(*) FILTER ({_RES}) / count(*), 6) FROM lifecycle""")
def _(t):
    return R.resolution_rate(t("lifecycle"))


@query("a27_agent_performance", """
WITH g AS (SELECT agent, sum(n_runs) AS n_runs, sum(pass_count) AS passed, sum(fail_count) AS failed, sum(error_count) AS errors, coalesce(sum(total_cost), 0) AS cost FROM performance GROUP BY agent)
SELECT agent, n_runs, passed, failed, errors, round(cost, 6) AS cost, round(passed / n_runs, 6) AS pass_rate, round(CASE WHEN cost > 0 THEN cost / n_runs END, 6) AS cost_per_review FROM g""")
def _(t):
    return R.agent_performance(t("performance"))


@query("a28_backlog_age", f"""
SELECT count(*) AS n, round(median({_AGE}), 6) AS median_h, round(quantile_cont({_AGE}, 0.9), 6) AS p90_h, round(max({_AGE}), 6) AS max_h FROM lifecycle WHERE NOT {_RES}""")
def _(t):
    return R.backlog_age(t("lifecycle"), NOW)


_BUCKET = f"CASE WHEN {_AGE} < 24 THEN '<24h' WHEN {_AGE} < 72 THEN '1-3d' WHEN {_AGE} < 168 THEN '3-7d' WHEN {_AGE} < 336 THEN '7-14d' ELSE '14d+' END"


@query("a28_backlog_buckets", f"""
WITH b(age) AS (VALUES ('<24h'), ('1-3d'), ('3-7d'), ('7-14d'), ('14d+')), n AS (SELECT {_BUCKET} AS age, count(*) AS n FROM lifecycle WHERE NOT {_RES} GROUP BY 1) SELECT age, coalesce(n, 0) AS n FROM b LEFT JOIN n USING (age)""")
def _(t):
    return R.backlog_buckets(t("lifecycle"), NOW)


@query("a28_oldest_open", f"SELECT review_id, repo, round({_AGE}, 4) AS hours_open FROM lifecycle WHERE NOT {_RES} ORDER BY round({_AGE}, 4) DESC, review_id LIMIT 10")
def _(t):
    return R.oldest_open(t("lifecycle"), NOW)


_WINDOWS = (30, 90, 365, 1500)
_IN = f"WITH w(window_days) AS (VALUES {', '.join(f'({d})' for d in _WINDOWS)}), r AS (SELECT * FROM lifecycle JOIN w ON {_AGE} / 24 >= 0 AND {_AGE} / 24 <= window_days)"


@query("a29_window_metrics", f"""
{_IN} SELECT window_days, count(*) AS total, count(*) FILTER ({_RES}) AS resolved, round(count(*) FILTER ({_RES}) / count(*), 6) AS rate, {", ".join(f"count(*) FILTER (severity = '{s}') AS n_{s}" for s in _SEV)},
  count(*) FILTER (close_reason = 'fix_linked') AS n_fixed, count(*) FILTER ({_RES} AND close_reason <> 'fix_linked') AS n_wontfix, count(*) FILTER (NOT {_RES}) AS n_open,
  {", ".join(f"round(quantile_cont(CASE WHEN {_TTC} >= 0 THEN {_TTC} END, {p}), 6) AS p{int(p * 100)}_h" for p in (0.5, 0.9, 0.99))} FROM r GROUP BY window_days""")
def _(t):
    return R.window_metrics(t("lifecycle"), NOW, _WINDOWS)


@query("a29_window_outliers", f"{_IN} SELECT window_days, row_number() OVER (PARTITION BY window_days ORDER BY created_at, review_id) AS place, review_id FROM r WHERE NOT {_RES} QUALIFY place <= 10")
def _(t):
    return R.window_outliers(t("lifecycle"), NOW, _WINDOWS)


def _delta(tag: str, a: int, b: int) -> str:
    inside = f"{_AGE} / 24 >= {a} AND {_AGE} / 24 < {b}"
    return f"""round(count(*) FILTER ({inside} AND {_RES}) / nullif(count(*) FILTER ({inside}), 0), 6) AS rate_{tag}, round(median(CASE WHEN {inside} AND {_TTC} >= 0 THEN {_TTC} END), 6) AS median_h_{tag},
  count(*) FILTER ({inside} AND severity = 'critical') AS critical_{tag}, count(*) FILTER ({inside} AND severity = 'high') AS high_{tag}"""


@query("a30_period_deltas", f"""
WITH o AS (SELECT {_delta("now", 0, 90)}, {_delta("before", 90, 180)} FROM lifecycle)
SELECT *, {", ".join(f"round({m}_now - {m}_before, 6) AS {m}_delta" for m in ("rate", "median_h", "critical", "high"))} FROM o""")
def _(t):
    return R.period_deltas(t("lifecycle"), NOW, 90)


def _odd_closings(t):
    """Reviews of which some are closed before they were made, some without a reason, some with an empty one."""
    k = F.col("review_id")
    early = F.when(k % 11 == 0, F.col("created_at") - F.expr("INTERVAL 3 DAYS")).otherwise(F.col("closed_at"))
    return t("lifecycle").withColumns({"closed_at": early, "close_reason": F.when(k % 7 == 0, F.lit("")).otherwise(F.col("close_reason"))})


_ODD = "(SELECT * REPLACE (CASE WHEN review_id % 11 = 0 THEN created_at - INTERVAL 3 DAY ELSE closed_at END AS closed_at, CASE WHEN review_id % 7 = 0 THEN '' ELSE close_reason END AS close_reason) FROM lifecycle)"


@query("a31_open_trend", f"""
WITH s AS (SELECT CAST(unnest(generate_series(DATE '1999-06-02', DATE '1999-06-15', INTERVAL 1 DAY)) AS DATE) AS date),
r AS (SELECT CAST(created_at AS DATE) AS c, CASE WHEN close_reason IS NOT NULL AND length(close_reason) > 0 THEN CAST(closed_at AS DATE) END AS x FROM {_ODD})
SELECT date, (SELECT count(*) FROM r WHERE c = date) AS opened, (SELECT count(*) FROM r WHERE x = date) AS closed, (SELECT count(*) FROM r WHERE c <= date AND (x IS NULL OR x > date)) AS open_at_end FROM s""")
def _(t):
    return R.open_trend(_odd_closings(t), "1999-06-15", 14, reason="close_reason")


@query("a59_open_trend_by_severity", f"""
WITH s AS (SELECT CAST(unnest(generate_series(DATE '1999-05-17', DATE '1999-06-15', INTERVAL 1 DAY)) AS DATE) AS date), r AS (SELECT coalesce(severity, 'unknown') AS severity, CAST(created_at AS DATE) AS c, CAST(closed_at AS DATE) AS x FROM lifecycle),
k AS (SELECT DISTINCT severity FROM r)
SELECT k.severity, date, (SELECT count(*) FROM r WHERE c = date AND r.severity = k.severity) AS opened, (SELECT count(*) FROM r WHERE x = date AND r.severity = k.severity) AS closed,
  (SELECT count(*) FROM r WHERE c <= date AND (x IS NULL OR x > date) AND r.severity = k.severity) AS open_at_end FROM s CROSS JOIN k""")
def _(t):
    return R.open_trend(t("lifecycle").withColumn("severity", F.coalesce("severity", F.lit("unknown"))), "1999-06-15", 30, "severity")


@query("a32_signal_noise", """
SELECT repo, sum(created) AS created, sum(passed) AS passed, sum(failed) AS failed, round(sum(passed) / greatest(1, sum(created)), 6) AS signal, round(sum(failed) / greatest(1, sum(created)), 6) AS noise FROM review_daily GROUP BY repo""")
def _(t):
    return R.signal_noise(t("review_daily"))


@query("a33_noise_split", """
WITH g AS (SELECT date, sum(passed) AS passed, sum(greatest(0, failed - autoclosed_severity - autoclosed_age - parse_fail)) AS actioned, sum(autoclosed_severity + autoclosed_age) AS autoclosed, sum(parse_fail) AS parse_fail FROM review_daily GROUP BY date)
SELECT *, sum(passed) OVER w AS passed_total, sum(actioned) OVER w AS actioned_total, sum(autoclosed) OVER w AS autoclosed_total, sum(parse_fail) OVER w AS parse_fail_total FROM g WINDOW w AS (ORDER BY date)""")
def _(t):
    return R.noise_split(t("review_daily"))


@query("a34_suppression", """
SELECT repo, sum(autoclosed_severity + autoclosed_age) AS suppressed, sum(created) AS created, round(sum(autoclosed_severity + autoclosed_age) / greatest(1, sum(created)), 6) AS ratio
FROM review_daily WHERE date >= DATE '2024-01-10' GROUP BY repo ORDER BY suppressed DESC, repo LIMIT 5""")
def _(t):
    return R.suppression(t("review_daily"), "2024-01-10")


@query("a35_before_after", """
SELECT CASE WHEN date < DATE '2024-01-15' THEN 'before' ELSE 'after' END AS period, count(DISTINCT date) AS days, sum(created) AS created, sum(passed) AS passed, sum(failed) AS failed,
  round(sum(created) / count(DISTINCT date), 6) AS created_per_day, round(sum(passed) / sum(created), 6) AS pass_rate FROM review_daily GROUP BY 1""")
def _(t):
    return R.before_after(t("review_daily"), "2024-01-15")


@query("a36_threshold_history", """
WITH c AS (SELECT date, CASE WHEN user_id % 5 = 0 THEN '' ELSE concat('t', CAST(event_id % 3 AS STRING)) END AS new_threshold FROM usage WHERE event_id % 40 = 0),
n AS (SELECT date, new_threshold, count(*) AS n FROM c WHERE new_threshold <> '' GROUP BY 1, 2), k AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY date ORDER BY n DESC, new_threshold) = 1),
a AS (SELECT date, sum(autoclosed_severity + autoclosed_age) AS autoclosed FROM review_daily GROUP BY date) SELECT date, new_threshold, autoclosed FROM a LEFT JOIN k USING (date)""")
def _(t):
    changes = t("usage").where(F.col("event_id") % 40 == 0).select("date", F.when(F.col("user_id") % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("t"), (F.col("event_id") % 3).cast("string"))).alias("new_threshold"))
    return R.threshold_history(changes, t("review_daily"))


@query("a37_findings_per_commit", """
SELECT commit_sha, repo, count(*) AS n, epoch_us(max(created_at)) AS last_us, arg_min(message, (created_at, message)) AS message FROM (SELECT CASE WHEN review_id % 50 = 0 THEN '' ELSE CAST(review_id % 700 AS STRING) END AS commit_sha, repo, created_at, concat('m', CAST(review_id AS STRING)) AS message FROM lifecycle) WHERE commit_sha <> ''
GROUP BY 1, 2 ORDER BY n DESC, commit_sha, repo LIMIT 10""")
def _(t):
    from ledgerspark.functions.columns import micros

    rows = t("lifecycle").withColumn("commit_sha", F.when(F.col("review_id") % 50 == 0, F.lit("")).otherwise((F.col("review_id") % 700).cast("string")))
    rows = rows.withColumn("message", F.concat(F.lit("m"), F.col("review_id").cast("string")))
    return R.findings_per_commit(rows).select("commit_sha", "repo", "n", micros("last_at").alias("last_us"), "message")


@query("a38_findings_per_file", """
SELECT file_path, count(*) AS n, count(DISTINCT repo) AS n_repos, max(seen) AS last_seen, count(*) FILTER (severity = 'high') AS n_high, count(*) FILTER (severity = 'medium') AS n_medium, count(*) FILTER (severity = 'low') AS n_low
FROM (SELECT CASE WHEN job_id % 10 = 0 THEN '/abs/x.py' WHEN job_id % 10 = 1 THEN 'src/Users/x.py' ELSE primary_file END AS file_path, project AS repo, job_id AS seen, severity FROM findings) WHERE NOT starts_with(file_path, '/') AND NOT regexp_matches(file_path, '/(Users|home)/[A-Za-z0-9]+')
GROUP BY file_path ORDER BY n DESC, file_path LIMIT 50""")
def _(t):
    from ledgerspark.rules.projects import SENSITIVE

    k = F.col("job_id") % 10
    path = F.when(k == 0, F.lit("/abs/x.py")).when(k == 1, F.lit("src/Users/x.py")).otherwise(F.col("primary_file"))
    return R.findings_per_file(t("findings").select(path.alias("file_path"), F.col("project").alias("repo"), F.col("job_id").alias("seen"), "severity"), SENSITIVE)


_FIXH = "round((epoch_us(fix_commit_at) - epoch_us(created_at)) / 3.6E9, 2)"


@query("a39_time_to_fix", f"""
SELECT review_id, fix_method, {_FIXH} AS hours, CASE WHEN {_FIXH} < 2 THEN '<2' WHEN {_FIXH} < 4 THEN '2-4' WHEN {_FIXH} < 8 THEN '4-8' WHEN {_FIXH} < 16 THEN '8-16' ELSE '16+' END AS bucket
FROM lifecycle WHERE fix_method IN ('commit_reference', 'time_window') AND fix_commit_at IS NOT NULL""")
def _(t):
    return R.time_to_fix(t("lifecycle"))


@query("a40_closure_breakdown", """
WITH c AS (SELECT CASE review_id % 6 WHEN 0 THEN 'manual' WHEN 1 THEN 'autoclose_severity' WHEN 2 THEN 'unknown' WHEN 3 THEN NULL ELSE fix_method END AS m FROM lifecycle WHERE closed_at IS NOT NULL),
n AS (SELECT count(*) AS n, count(*) FILTER (m IN ('manual', 'commit_reference')) AS linked, count(*) FILTER (m = 'autoclose_severity') AS auto, count(*) FILTER (m IS NULL OR m = 'unknown') AS unknown FROM c)
SELECT reason, k AS n, round(100 * k / n, 1) AS pct FROM (SELECT 'fix_linked' AS reason, linked AS k, n FROM n UNION ALL SELECT 'autoclose', auto, n FROM n UNION ALL SELECT 'unknown', unknown, n FROM n)""")
def _(t):
    k = F.col("review_id") % 6
    method = F.when(k == 0, F.lit("manual")).when(k == 1, F.lit("autoclose_severity")).when(k == 2, F.lit("unknown")).when(k != 3, F.col("fix_method"))
    return R.closure_breakdown(t("lifecycle").withColumn("fix_method", method))


@query("a41_closing_funnel", """
SELECT 'created' AS stage, count(*) AS n FROM lifecycle UNION ALL SELECT 'closed', count(closed_at) FROM lifecycle UNION ALL SELECT 'fix_linked', count(fix_commit_sha) FROM lifecycle
UNION ALL SELECT 'commit_reference', count(*) FROM lifecycle WHERE fix_method = 'commit_reference'""")
def _(t):
    return R.closing_funnel(t("lifecycle"))


for _name, _by in (("type_severity", ["severity", "repo"]), ("type_date", ["date", "repo"]), ("type", ["repo"])):

    @query(f"a42_self_review_by_{_name}", f"SELECT {', '.join(_by)}, count(*) AS n FROM (SELECT repo, severity, CAST(created_at AS DATE) AS date FROM lifecycle) GROUP BY ALL")
    def _(t, by=_by):
        return R.self_review_counts(t("lifecycle").withColumn("date", F.to_date("created_at")), by)


@query("a60_top_files", """
SELECT primary_file, count(*) AS n, CASE max(CASE severity WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3 WHEN 'critical' THEN 4 END) WHEN 1 THEN 'low' WHEN 2 THEN 'medium' WHEN 3 THEN 'high' WHEN 4 THEN 'critical' END AS worst
FROM findings WHERE job_id % 3 <> 0 GROUP BY primary_file ORDER BY n DESC, primary_file LIMIT 12""")
def _(t):
    return R.top_files(t("findings").withColumn("resolved_at", F.when(F.col("job_id") % 3 == 0, F.col("reviewed_at"))), 12)


@query("a61_inflow_outflow", f"""
WITH f AS (SELECT CAST(date_trunc('week', found_at) AS DATE) AS week, count(*) AS found FROM {_FIND} WHERE found_at >= TIMESTAMP '1999-01-01' GROUP BY 1), r AS (SELECT CAST(date_trunc('week', resolved_at) AS DATE) AS week, count(*) AS resolved FROM {_FIND} WHERE resolved_at >= TIMESTAMP '1999-01-01' GROUP BY 1),
b AS (SELECT * FROM f FULL JOIN r USING (week)), s AS (SELECT CAST(unnest(generate_series(min(week), max(week), INTERVAL 7 DAY)) AS DATE) AS week FROM b)
SELECT week, coalesce(found, 0) AS found, coalesce(resolved, 0) AS resolved FROM s LEFT JOIN b USING (week)""")
def _(t):
    return R.inflow_outflow(R.findings_view(t("lifecycle")), "1999-01-01")


@query("a62_resolution_time", f"SELECT severity, count(*) AS n, round(median((epoch_us(resolved_at) - epoch_us(found_at)) / 3.6E9), 6) AS median_h FROM {_FIND} WHERE resolved_at IS NOT NULL GROUP BY severity")
def _(t):
    return R.resolution_time(R.findings_view(t("lifecycle")))


_P9 = [("total", "true"), ("open", "resolved_at IS NULL"), ("resolved", "resolved_at IS NOT NULL"), *((f"open_{s}", f"resolved_at IS NULL AND severity = '{s}'") for s in _SEV)]


@query("a63_pulse_table", " UNION ALL ".join(f"SELECT '{n}' AS metric, count(*) FILTER ({c}) AS value FROM {_FIND}" for n, c in _P9) + f" UNION ALL SELECT 'loops', count(*) FROM {_LOOPS} UNION ALL SELECT 'escalated', count(*) FROM {_LOOPS} WHERE tier = 'escalate'")
def _(t):
    return R.pulse_table(R.findings_view(t("lifecycle")), _loops(t))


@query("a64_recent_activity", f"SELECT finding_id, severity FROM {_FIND} WHERE found_at >= TIMESTAMP '2001-06-01' OR resolved_at >= TIMESTAMP '2001-06-01'")
def _(t):
    return R.recent_activity(R.findings_view(t("lifecycle")), "2001-06-01").select("finding_id", "severity")


@query("a65_loop_table", f"SELECT content_hash, severity, primary_file, tier, cycles FROM {_LOOPS}")
def _(t):
    return R.loop_table(_loops(t)).drop("summary")


@query("j15_stuck_chains", f"""
SELECT content_hash, primary_file, cycles, coalesce(n, 0) AS n_findings, concat('stuck-loop-', substr(content_hash, 1, 12)) AS issue_key FROM {_LOOPS}
LEFT JOIN (SELECT concat('f', CAST(job_id % 11 AS STRING)) AS primary_file, count(*) AS n FROM findings GROUP BY 1) USING (primary_file) WHERE tier = 'escalate' AND ack_by IS NULL""")
def _(t):
    return J.stuck_chains(_loops(t), t("findings").withColumn("primary_file", F.concat(F.lit("f"), (F.col("job_id") % 11).cast("string"))))
