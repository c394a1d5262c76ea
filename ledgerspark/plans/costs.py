"""Cost and session joins: J-01..J-12, J-16..J-20, S-12, A-54, A-55."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerspark.operators import joins as J
from ledgerspark.plans.registry import query


@query("j01_session_commits", """
SELECT s.session_id, c.hash, c.date FROM order_sessions s JOIN commits c ON c.project = s.project AND c.date BETWEEN s.start_date AND s.end_date""")
def _(t):
    sessions, commits = t("order_sessions").select("session_id", "project", "start_date", "end_date"), t("commits").select("hash", "project", "date")
    return J.session_commits(sessions, commits).select("session_id", "hash", "date")


@query("j02_findings_per_session", """
WITH c AS (SELECT DISTINCT project, date, CAST(order_key AS STRING) AS commit_sha FROM commits),
l AS (SELECT s.session_id, s.duration_min, c.commit_sha FROM order_sessions s JOIN c ON c.project = s.project AND c.date BETWEEN s.start_date AND s.end_date WHERE s.duration_min > 0)
SELECT session_id, round(duration_min / 60, 3) AS hours, count(r.review_id) AS n_findings FROM l LEFT JOIN lifecycle r USING (commit_sha) GROUP BY session_id, duration_min HAVING count(r.review_id) > 0""")
def _(t):
    return J.findings_per_session(t("order_sessions"), t("commits").withColumn("commit_sha", F.col("order_key").cast("string")), t("lifecycle"))


@query("j03_cost_per_commit_day", """
WITH c AS (SELECT project, date, sum(cost) AS cost FROM order_costs GROUP BY 1, 2), n AS (SELECT project, date, count(*) AS n_commits FROM commits GROUP BY 1, 2)
SELECT project, date, round(cost, 4) AS cost, n_commits, round(cost / n_commits, 4) AS cost_per_commit FROM c JOIN n USING (project, date)""")
def _(t):
    return J.cost_per_commit_day(t("order_costs"), t("commits"))


for _grain, _label in (("daily", "CAST(date AS STRING)"), ("weekly", "strftime(date, '%Y-W%W')"), ("monthly", "strftime(date, '%Y-%m')")):

    @query(f"j04_cost_per_commit_{_grain}", f"""
WITH c AS (SELECT {_label} AS period, sum(cost) AS cost FROM order_costs WHERE date >= DATE '1996-03-01' AND project IN (1, 2, 3) GROUP BY 1), n AS (SELECT {_label} AS period, count(*) AS n_commits FROM commits WHERE project IN (1, 2, 3) GROUP BY 1)
SELECT period, round(cost, 6) AS cost, n_commits, round(cost / n_commits, 6) AS cost_per_commit FROM c JOIN n USING (period)""")
    def _(t, grain=_grain):
        return J.cost_per_commit_period(t("order_costs"), t("commits"), grain, [1, 2, 3], "1996-03-01", 6)


_RECON = """r AS (SELECT date, p, c, coalesce(p, c) AS prim FROM (SELECT date, sum(cost) AS p FROM provider WHERE date < DATE '2024-01-25' GROUP BY date)
  FULL JOIN (SELECT date, sum(cost) AS c FROM crosscheck WHERE date > DATE '2024-01-05' GROUP BY date) USING (date))"""


def _provider(t):
    return t("provider").where(F.col("date") < F.lit("2024-01-25").cast("date"))


def _cross(t):
    return t("crosscheck").where(F.col("date") > F.lit("2024-01-05").cast("date"))


@query("j05_reconcile", f"""
WITH {_RECON} SELECT date, round(prim, 4) AS primary_cost, round(CASE WHEN p IS NOT NULL THEN c END, 4) AS cross_check,
  round(CASE WHEN p IS NOT NULL AND c <> 0 THEN (p - c) / c * 100 END, 1) AS deficit_pct FROM r""")
def _(t):
    return J.reconcile(_provider(t), _cross(t))


_SHARE = """s AS (SELECT date, project, sum(duration_min) AS minutes FROM sessions WHERE duration_min IS NOT NULL GROUP BY 1, 2),
h AS (SELECT *, minutes / nullif(sum(minutes) OVER (PARTITION BY date), 0) AS share FROM s)"""
_FOLD = "concat('c', CAST(CAST(substr(project, 2) AS INT) % 6 AS STRING))"


def _fold():
    return F.concat(F.lit("c"), (F.substring("project", 2, 9).cast("int") % 6).cast("string"))


@query("j06_cost_attribution", f"""
WITH {_SHARE}, d AS (SELECT date, sum(cost) AS cost FROM provider GROUP BY date)
SELECT date, {_FOLD} AS project, round(sum(round(cost * share, 4)), 4) AS est_cost, round(sum(minutes), 4) AS minutes, round(sum(share), 6) AS share
FROM h JOIN d USING (date) WHERE share IS NOT NULL GROUP BY 1, 2""")
def _(t):
    return J.attribute(t("provider").groupBy("date").agg(F.sum("cost").alias("cost")), t("sessions"), ["cost"], 4, _fold())


_FIVE = ["input_tokens", "output_tokens", "cache_creation_tokens", "cache_read_tokens", "total_tokens"]


@query("j07_token_attribution", f"""
WITH {_SHARE}, d AS (SELECT date, {", ".join(f"sum({c}) AS {c}" for c in _FIVE)} FROM usage GROUP BY date)
SELECT date, {_FOLD} AS project, {", ".join(f"sum(round({c} * share, 0)) AS est_{c}" for c in _FIVE)}, round(sum(minutes), 4) AS minutes, round(sum(share), 6) AS share
FROM h JOIN d USING (date) WHERE share IS NOT NULL GROUP BY 1, 2""")
def _(t):
    return J.attribute(t("usage").groupBy("date").agg(*(F.sum(c).alias(c) for c in _FIVE)), t("sessions"), _FIVE, 0, _fold())


@query("j08_provider_attribution", f"""
WITH {_SHARE}, {_RECON}
SELECT date, project, round(sum(round(round(prim, 4) * share, 4)), 4) AS est_cost, round(sum(minutes), 4) AS minutes, round(sum(share), 6) AS share
FROM h JOIN r USING (date) WHERE share IS NOT NULL GROUP BY 1, 2""")
def _(t):
    totals = J.reconcile(_provider(t), _cross(t)).select("date", F.col("primary_cost").alias("cost"))
    return J.attribute(totals, t("sessions"), ["cost"], 4)


@query("j09_tag_by_review", """
SELECT event_id, j.repo, CASE WHEN j.user_id IS NULL THEN 'interactive' ELSE 'review' END AS source FROM usage u
LEFT JOIN (SELECT user_id, min(CASE WHEN user_id % 6 = 0 THEN NULL ELSE project END) AS repo FROM usage WHERE model = 'signup' AND user_id % 3 = 0 GROUP BY user_id) j ON j.user_id = u.user_id""")
def _(t):
    u = t("usage")
    jobs = u.where((F.col("model") == "signup") & (F.col("user_id") % 3 == 0)).select("user_id", F.when(F.col("user_id") % 6 != 0, F.col("project")).alias("repo"))
    return J.tag_by_review(u, jobs, "user_id").select("event_id", "repo", "source")


@query("j10_first_directory", """
SELECT n.event_id, f.cwd FROM raw_names n LEFT JOIN (SELECT user_id, arg_min(cwd, event_id) AS cwd FROM raw_names WHERE cwd IS NOT NULL GROUP BY user_id) f ON f.user_id = n.user_id""")
def _(t):
    return J.first_directory(t("raw_names").select("event_id", "user_id"), t("raw_names").select("user_id", "event_id", "cwd"), "user_id", "event_id").select("event_id", "cwd")


_PRICES = [("purchase", 3.0, 0.3, 15.0), ("signup", 1.0, 0.1, 5.0), ("view", 0.25, 0.025, 1.25)]


@query("j11_price_turns", f"""
WITH p(m, i, c, o) AS (VALUES {", ".join(map(str, _PRICES))})
SELECT event_id, round((input_tokens * i + cache_read_tokens * c + output_tokens * o) / 1e6, 8) AS est_cost FROM usage LEFT JOIN p ON model = m""")
def _(t):
    prices = t.spark.createDataFrame(_PRICES, "model string, input_per_mtok double, cached_per_mtok double, output_per_mtok double")
    return J.price_turns(t("usage"), prices).select("event_id", "est_cost")


@query("j12_price_messages", """
SELECT event_id, round((input_tokens * CASE WHEN model LIKE '%ur%' THEN 3.0 WHEN model LIKE '%r%' THEN 2.0 ELSE 0.5 END + output_tokens * CASE WHEN model LIKE '%ur%' THEN 9.0 WHEN model LIKE '%r%' THEN 4.0 ELSE 1.5 END) / 1e6, 8) AS est_cost FROM usage""")
def _(t):
    return J.price_messages(t("usage"), [("ur", 3.0, 9.0), ("r", 2.0, 4.0)], (0.5, 1.5)).select("event_id", "est_cost")


@query("j16_session_vs_review", """
WITH s AS (SELECT date, sum(cost) AS a FROM usage GROUP BY date), r AS (SELECT date, sum(cost) AS b FROM provider WHERE event_day % 3 <> 0 GROUP BY date)
SELECT date, round(a, 6) AS session_cost, round(coalesce(b, 0), 6) AS review_cost, round(coalesce(100 * coalesce(b, 0) / nullif(a, 0), 0), 4) AS review_pct FROM s LEFT JOIN r USING (date)""".replace("event_day", "day(date)"))
def _(t):
    return J.session_vs_review_cost(t("usage"), t("provider").where(F.dayofmonth("date") % 3 != 0))


def _addressed(t):
    return t("usage").where((F.col("model") == "view") & (F.col("user_id") % 4 != 2)).select("date", F.concat(F.lit("agent"), (F.col("user_id") % 4).cast("string")).alias("agent"))


_ADDRESSED = "(SELECT date, concat('agent', CAST(user_id % 4 AS STRING)) AS agent FROM usage WHERE model = 'view' AND user_id % 4 <> 2)"


@query("j17_cost_per_resolved_day", f"""
WITH p AS (SELECT date, agent, sum(total_cost) AS cost, sum(n_runs) AS n_runs FROM performance GROUP BY 1, 2), a AS (SELECT date, agent, count(*) AS n FROM {_ADDRESSED} GROUP BY 1, 2)
SELECT date, agent, round(cost, 6) AS cost, n_runs, coalesce(n, 0) AS n_addressed, round(CASE WHEN cost > 0 AND n > 0 THEN cost / n END, 6) AS cost_per_resolved FROM p LEFT JOIN a USING (date, agent)""")
def _(t):
    return J.cost_per_resolved(t("performance"), _addressed(t), ["date", "agent"])


@query("j18_cost_per_resolved_agent", f"""
WITH p AS (SELECT agent, sum(total_cost) AS cost, sum(n_runs) AS n_runs FROM performance GROUP BY 1), a AS (SELECT agent, count(*) AS n FROM {_ADDRESSED} GROUP BY 1)
SELECT agent, round(cost, 6) AS cost, n_runs, coalesce(n, 0) AS n_addressed, round(CASE WHEN cost > 0 AND n > 0 THEN cost / n END, 6) AS cost_per_resolved FROM p LEFT JOIN a USING (agent)""")
def _(t):
    return J.cost_per_resolved(t("performance"), _addressed(t), ["agent"]).orderBy(F.asc_nulls_last("cost_per_resolved"), "agent")


@query("j19_agent_noise", """
SELECT agent, count(*) AS n_reviews, count(*) FILTER (close_reason = 'manual') AS n_addressed, count(*) FILTER (verdict = 'P') AS n_passed,
  round(greatest(0, count(*) - count(*) FILTER (close_reason = 'manual') - count(*) FILTER (verdict = 'P')) / greatest(1, count(*)), 6) AS noise_rate FROM lifecycle GROUP BY agent""")
def _(t):
    return J.agent_noise(t("lifecycle"))


@query("j20_cross_delta", """
SELECT round(p, 6) AS provider_cost, round(o, 6) AS other_cost, round(100 * (o - p) / p, 4) AS delta_pct
FROM (SELECT sum(cost) AS p FROM usage WHERE model LIKE '%purch%') CROSS JOIN (SELECT sum(cost) AS o FROM crosscheck)""")
def _(t):
    return J.cross_delta(t("usage"), t("crosscheck"), "purch")


@query("a54_validation_health", f"""
WITH {_RECON}, d AS (SELECT date, round(CASE WHEN p IS NOT NULL AND c <> 0 THEN (p - c) / c * 100 END, 1) AS x FROM r)
SELECT round(median(x), 4) AS median_pct, round(avg(x), 4) AS mean_pct, arg_max(x, CASE WHEN x IS NOT NULL THEN date END) AS last_pct, count(*) FILTER (x < 0) AS n_negative FROM d""")
def _(t):
    d = J.reconcile(_provider(t), _cross(t))
    x = F.col("deficit_pct")
    return d.agg(F.round(F.median(x), 4).alias("median_pct"), F.round(F.avg(x), 4).alias("mean_pct"), F.max_by(x, F.when(x.isNotNull(), F.col("date"))).alias("last_pct"), F.count_if(x < 0).alias("n_negative"))


@query("a55_findings_by_length", """
WITH c AS (SELECT DISTINCT project, date, CAST(order_key AS STRING) AS commit_sha FROM commits),
l AS (SELECT s.session_id, s.duration_min, c.commit_sha FROM order_sessions s JOIN c ON c.project = s.project AND c.date BETWEEN s.start_date AND s.end_date WHERE s.duration_min > 0),
f AS (SELECT session_id, round(duration_min / 60, 3) AS h, count(r.review_id) AS n FROM l LEFT JOIN lifecycle r USING (commit_sha) GROUP BY session_id, duration_min HAVING count(r.review_id) > 0)
SELECT CASE WHEN h < 1 THEN '<1' WHEN h < 3 THEN '1-3' WHEN h < 8 THEN '3-8' ELSE '>8' END AS length, count(*) AS n_sessions, median(n) AS median_findings FROM f GROUP BY 1""")
def _(t):
    f = J.findings_per_session(t("order_sessions"), t("commits").withColumn("commit_sha", F.col("order_key").cast("string")), t("lifecycle"))
    return J.findings_by_length(f)


@query("s12_catalog_summary", "SELECT 'orders' AS table_name, count(*) AS n FROM orders UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'lineitem', count(*) FROM lineitem")
def _(t):
    from ledgerspark.operators.sinks import catalog_summary

    return catalog_summary({n: t(n) for n in ("orders", "events", "lineitem")})
