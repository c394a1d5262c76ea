"""Usage queries: A-01..A-13, A-45..A-51, A-53, A-56..A-58, P-13, P-14, P-18, P-19, P-21, W-01, W-04, W-06, W-08, T-01..T-04."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerspark.functions.columns import sum0
from ledgerspark.operators import joins as J
from ledgerspark.operators import usage as U
from ledgerspark.plans.registry import query

WINDOWS = [(0, 7)]
_END = "coalesce(actual_end, planned_end)"
_HOUR = "(hour({0}) + minute({0}) / 60.0 + second({0}) / 3600.0)"
_SCHED = f"({_HOUR.format('start_time')} >= 0 AND {_HOUR.format(_END)} < 7 AND CAST(start_time AS DATE) = CAST({_END} AS DATE))"


@query("a01_usage_summary", """
WITH one AS (SELECT round(sum(cost), 6) AS total_cost, sum(total_tokens) AS total_tokens, count(DISTINCT date) AS active_days, min(date) AS first_date,
  max(date) AS last_date, round(avg(cost), 4) AS avg_cost_per_row, round(sum(cost) / count(DISTINCT date), 4) AS avg_cost_per_day FROM usage)
SELECT 'total_cost' AS metric, CAST(total_cost AS DOUBLE) AS value FROM one UNION ALL SELECT 'total_tokens', total_tokens FROM one UNION ALL SELECT 'active_days', active_days FROM one
UNION ALL SELECT 'avg_cost_per_row', avg_cost_per_row FROM one UNION ALL SELECT 'avg_cost_per_day', avg_cost_per_day FROM one""")
def _(t):
    long = U.usage_summary(t("usage")).where(~F.col("metric").isin("first_date", "last_date"))
    value = F.col("value").cast("double")
    return long.select("metric", F.when(F.col("metric").startswith("avg"), F.round(value, 4)).otherwise(value).alias("value"))


@query("a02_model_breakdown", """
SELECT model, round(sum(cost), 6) AS cost, sum(input_tokens) AS input_tokens, sum(output_tokens) AS output_tokens,
  sum(cache_creation_tokens) AS cache_creation_tokens, sum(cache_read_tokens) AS cache_read_tokens, count(DISTINCT date) AS days FROM usage GROUP BY model""")
def _(t):
    return U.model_breakdown(t("usage"))


@query("a03_sessions_by_trigger", """
SELECT coalesce(trigger, 'unknown') AS trigger, count(*) AS n_sessions, round(sum(duration_min), 4) AS minutes FROM sessions
WHERE date BETWEEN DATE '2024-01-03' AND DATE '2024-01-20' GROUP BY 1""")
def _(t):
    return U.by_trigger(t("sessions"), "2024-01-03", "2024-01-20")


@query("a04_costs_rollup", """
SELECT c AS canonical_project, date, min(project) AS project, round(sum(cost), 6) AS daily_cost, count(*) AS n_rows, concat(c, '|', CAST(date AS STRING), '|usage') AS cost_id
FROM (SELECT *, concat('c', CAST(CAST(substr(project, 2) AS INT) % 6 AS STRING)) AS c FROM usage) GROUP BY c, date""")
def _(t):
    return U.costs_rollup(t("usage"), F.concat(F.lit("c"), (F.substring("project", 2, 9).cast("int") % 6).cast("string")))


@query("a07_daily_from_blocks", """
SELECT CAST(start_time AS DATE) AS date, count(*) AS entries, sum(total_tokens) AS total_tokens, round(sum(cost), 4) AS cost,
  string_agg(DISTINCT model, ',' ORDER BY model) AS models FROM blocks GROUP BY 1""")
def _(t):
    return U.daily_from_blocks(t("blocks"))


@query("a08_cost_by_model_day", "SELECT date, model, round(sum(cost), 6) AS cost, sum(total_tokens) AS total_tokens FROM usage GROUP BY 1, 2")
def _(t):
    return U.cost_by_model_day(t("usage"))


@query("a09_family_costs", """
WITH d AS (SELECT date, round(coalesce(sum(CASE WHEN model LIKE '%purch%' THEN cost END), 0), 6) AS purch_cost, round(coalesce(sum(CASE WHEN model LIKE '%sign%' AND model NOT LIKE '%purch%' THEN cost END), 0), 6) AS sign_cost,
  round(coalesce(sum(CASE WHEN model NOT LIKE '%sign%' AND model NOT LIKE '%purch%' THEN cost END), 0), 6) AS rest_cost, round(sum(cost), 6) AS total_cost FROM usage GROUP BY date)
SELECT *, round(100 * purch_cost / nullif(total_cost, 0), 4) AS purch_pct, round(100 * sign_cost / nullif(total_cost, 0), 4) AS sign_pct, round(100 * rest_cost / nullif(total_cost, 0), 4) AS rest_pct FROM d""")
def _(t):
    return U.family_costs(t("usage"), ("purch", "sign"), "rest")


@query("a10_grand_summary", """
SELECT round(sum(cost), 6) AS total_cost, sum(total_tokens) AS total_tokens, count(*) AS entries, count(DISTINCT project) AS projects, min(date) AS first_date, max(date) AS last_date FROM usage""")
def _(t):
    return U.grand_summary(t("usage"))


_CHAT = "sum(input_tokens + output_tokens + cache_read_tokens) AS tokens, round(sum(cost), 6) AS cost, epoch_us(min(ts)) AS first_at, epoch_us(max(ts)) AS last_at, count(*) AS n_messages"


def _as_micros(df, *columns):
    from ledgerspark.functions.columns import micros

    return df.withColumns({c: micros(c) for c in columns})


@query("a11_chat_sessions", f"SELECT user_id, {_CHAT} FROM usage GROUP BY user_id")
def _(t):
    return _as_micros(U.chat_rollup(t("usage"), ["user_id"]), "first_at", "last_at")


@query("a11_chat_daily", f"SELECT date, {_CHAT} FROM usage GROUP BY date")
def _(t):
    return _as_micros(U.chat_rollup(t("usage"), ["date"]), "first_at", "last_at")


_TURNS = "SELECT date, CASE WHEN event_id % 11 = 0 THEN NULL ELSE project END AS project, model, CASE WHEN user_id % 2 = 0 THEN 'review' ELSE 'interactive' END AS source, input_tokens, output_tokens, total_tokens, CASE WHEN model = 'click' THEN NULL ELSE cost END AS cost, user_id, ts, event_id FROM usage"


def _turns(t):
    u = t("usage")
    return u.withColumns({
        "project": F.when(F.col("event_id") % 11 != 0, F.col("project")), "source": F.when(F.col("user_id") % 2 == 0, F.lit("review")).otherwise(F.lit("interactive")),
        "cost": F.when(F.col("model") != "click", F.col("cost")),
    })


@query("a12_turn_daily", f"""
SELECT date, project, model, source, sum(input_tokens) AS input_tokens, sum(output_tokens) AS output_tokens, round(sum(cost), 6) AS cost, count(*) AS n_turns FROM ({_TURNS}) GROUP BY 1, 2, 3, 4""")
def _(t):
    return U.turn_daily(_turns(t))


@query("a13_thread_sessions", f"""
SELECT user_id, epoch_us(min(ts)) AS first_at, epoch_us(max(ts)) AS last_at, arg_min(project, CASE WHEN project IS NOT NULL THEN event_id END) AS project, arg_min(model, event_id) AS model,
  sum(total_tokens) AS total_tokens, round(sum(cost), 6) AS cost, count(*) AS n_turns FROM ({_TURNS}) GROUP BY user_id""")
def _(t):
    return _as_micros(U.thread_sessions(_turns(t)), "first_at", "last_at")


@query("w01_activity_gaps", """
WITH d AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS date FROM orders), n AS (SELECT *, lead(date) OVER (PARTITION BY o_custkey ORDER BY date) AS nxt FROM d)
SELECT o_custkey, CAST(date + 1 AS DATE) AS gap_start, CAST(nxt - 1 AS DATE) AS gap_end, date_diff('day', date, nxt) - 1 AS days FROM n WHERE date_diff('day', date, nxt) > 1""")
def _(t):
    return U.gaps_by(t("orders").select("o_custkey", F.to_date("o_orderdate").alias("date")), ["o_custkey"])


@query("w04_cumulative_cost", """
WITH d AS (SELECT date, sum(cost) AS cost FROM usage GROUP BY date) SELECT date, round(cost, 6) AS cost, round(sum(cost) OVER (ORDER BY date), 6) AS running_cost FROM d""")
def _(t):
    return U.cumulative_cost(t("usage"))


@query("w04_cumulative_by_project", """
WITH top AS (SELECT project FROM usage GROUP BY project ORDER BY round(sum(cost), 6) DESC, project LIMIT 8),
spine AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM usage),
d AS (SELECT project, date, sum(cost) AS cost FROM usage GROUP BY 1, 2),
f AS (SELECT top.project, spine.date, coalesce(d.cost, 0) AS cost FROM top CROSS JOIN spine LEFT JOIN d ON d.project = top.project AND d.date = spine.date)
SELECT project, date, round(cost, 6) AS cost, round(sum(cost) OVER (PARTITION BY project ORDER BY date), 6) AS running_cost FROM f""")
def _(t):
    return U.cumulative_by_project(t("usage"))


@query("w06_share_heatmap", """
WITH s AS (SELECT date, project, sum(duration_min) AS minutes FROM sessions GROUP BY 1, 2), h AS (SELECT *, minutes / nullif(sum(minutes) OVER (PARTITION BY date), 0) AS share FROM s),
top AS (SELECT project FROM sessions GROUP BY project ORDER BY round(sum(duration_min), 6) DESC, project LIMIT 10)
SELECT date, project, round(100 * share, 4) AS share_pct FROM h WHERE project IN (SELECT project FROM top)""")
def _(t):
    s = t("sessions")
    day = s.groupBy("date", "project").agg(F.sum("duration_min").alias("minutes"))
    share = F.try_divide(F.col("minutes"), F.sum("minutes").over(Window.partitionBy("date")))
    top = U.top_keys(s, "project", "duration_min", 10).select("project")
    return day.withColumn("share", share).join(F.broadcast(top), "project", "left_semi").select("date", "project", F.round(100 * F.col("share"), 4).alias("share_pct"))


@query("w08_latest_fetch", "SELECT event_id, model, cost FROM usage WHERE date = (SELECT max(date) FROM usage)")
def _(t):
    return U.latest_fetch(t("usage"), "date").select("event_id", "model", "cost")


def _sources(t):
    return {"usage": t("usage"), "provider": t("provider"), "crosscheck": t("crosscheck")}


def _union(body: str) -> str:
    return " UNION ALL ".join(body.format(s=s) for s in ("usage", "provider", "crosscheck"))


@query("a45_source_overview", _union("""
SELECT '{s}' AS source, round(sum(cost), 6) AS cost, round(sum(cost) / count(DISTINCT date), 6) AS cost_per_day, sum(total_tokens) AS total_tokens,
  count(DISTINCT date) AS days, count(*) AS entries, min(date) AS first_date, max(date) AS last_date FROM {s}"""))
def _(t):
    return U.source_overview(_sources(t))


@query("a46_weekly_by_source", f"""
WITH w AS (SELECT source, CAST(date - CAST(dayofweek(date) AS INT) AS DATE) AS week, cost, total_tokens FROM ({_union("SELECT '{s}' AS source, date, cost, total_tokens FROM {s}")})),
g AS (SELECT source, week, sum(cost) AS cost, sum(total_tokens) AS total_tokens FROM w GROUP BY 1, 2)
SELECT a.source, b.week, round(coalesce(g.cost, 0), 6) AS cost, coalesce(g.total_tokens, 0) AS total_tokens
FROM (SELECT DISTINCT source FROM g) a CROSS JOIN (SELECT DISTINCT week FROM g) b LEFT JOIN g ON g.source = a.source AND g.week = b.week""")
def _(t):
    return U.weekly_by_source(_sources(t))


@query("a47_weekly_by_model", "SELECT CAST(date_trunc('week', date) AS DATE) AS week, model, round(sum(cost), 6) AS cost FROM usage GROUP BY 1, 2")
def _(t):
    return U.weekly_by_model(t("usage"))


_MODELS = "CASE WHEN event_id % 2 = 0 THEN concat(model, ',other') ELSE model END"


@query("a47_weekly_by_models_used", f"""
SELECT CAST(date_trunc('week', date) AS DATE) AS week, m AS model, round(sum(cost), 6) AS cost
FROM (SELECT date, cost, unnest(string_split({_MODELS}, ',')) AS m FROM usage) GROUP BY 1, 2""")
def _(t):
    return U.weekly_by_model(t("usage").withColumn("models", F.expr(_MODELS)), models="models")


@query("a47_weekly_by_models_split", f"""
SELECT CAST(date_trunc('week', date) AS DATE) AS week, m AS model, round(sum(cost / n), 6) AS cost
FROM (SELECT date, cost, unnest(string_split({_MODELS}, ',')) AS m, len(string_split({_MODELS}, ',')) AS n FROM usage) GROUP BY 1, 2""")
def _(t):
    return U.weekly_by_model(t("usage").withColumn("models", F.expr(_MODELS)), models="models", split=True)


@query("a48_token_composition", "WITH d AS (SELECT date, CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens, CAST(sum(cache_creation_tokens) AS BIGINT) AS cache_creation_tokens, CAST(sum(cache_read_tokens) AS BIGINT) AS cache_read_tokens FROM usage GROUP BY date) SELECT date, kind, tokens FROM d UNPIVOT (tokens FOR kind IN (input_tokens, output_tokens, cache_creation_tokens, cache_read_tokens))")
def _(t):
    return U.token_composition(t("usage"))


@query("a49_session_statistics", """
SELECT project, count(*) AS n_sessions, round(sum(duration_min), 4) AS minutes, round(avg(duration_min), 6) AS mean_minutes,
  count(*) FILTER (date > (SELECT max(date) FROM sessions) - 30) AS n_recent FROM sessions GROUP BY project""")
def _(t):
    return U.session_statistics(t("sessions"))


@query("a49_sessions_by_day", "SELECT date, count(*) AS n_sessions, round(sum(duration_min), 4) AS minutes FROM sessions GROUP BY date")
def _(t):
    return U.sessions_by_day(t("sessions"))


@query("a50_block_heatmap", """
WITH g AS (SELECT CAST(unnest(range(168)) AS INT) AS id), c AS (SELECT (isodow(ts) - 1) AS weekday, hour(ts) AS hour, sum(cost) AS cost, count(*) AS n FROM usage GROUP BY 1, 2)
SELECT id // 24 AS weekday, id % 24 AS hour, round(coalesce(cost, 0), 6) AS cost, coalesce(n, 0) AS n FROM g LEFT JOIN c ON c.weekday = id // 24 AND c.hour = id % 24""")
def _(t):
    return U.heatmap(t("usage"))


@query("a50_block_days", f"""
SELECT CAST(start_time AS DATE) AS date, count(*) AS blocks, round(sum((epoch_us({_END}) - epoch_us(start_time)) / 6.0E7), 4) AS minutes, round(sum(cost), 6) AS cost, sum(total_tokens) AS total_tokens,
  count(*) FILTER ({_SCHED}) AS n_scheduled, round(coalesce(sum(CASE WHEN {_SCHED} THEN cost END), 0), 6) AS scheduled_cost, round(coalesce(sum(CASE WHEN NOT {_SCHED} THEN cost END), 0), 6) AS interactive_cost
FROM blocks WHERE NOT is_gap GROUP BY 1""")
def _(t):
    return U.block_days(t("blocks"), WINDOWS)


@query("p18_block_trigger", f"SELECT block_id, CASE WHEN {_SCHED} THEN 'scheduled' ELSE 'interactive' END AS trigger FROM blocks")
def _(t):
    return U.block_trigger(t("blocks"), WINDOWS).select("block_id", "trigger")


@query("p19_block_metrics", f"""
WITH b AS (SELECT *, (epoch_us({_END}) - epoch_us(start_time)) / 3.6E9 AS h FROM blocks WHERE NOT is_gap)
SELECT block_id, round(h, 4) AS hours, cost, total_tokens, round(CASE WHEN h > 0 THEN cost / h END, 6) AS cost_per_hour, round(CASE WHEN h > 0 THEN total_tokens / h END, 6) AS tokens_per_hour FROM b""")
def _(t):
    return U.block_metrics(t("blocks")).drop("start_time", "effective_end")


@query("a51_five_hour_blocks", """
WITH b AS (SELECT date_trunc('day', ts) + to_hours(CAST(hour(ts) // 5 * 5 AS INT)) AS block_start, total_tokens, cost FROM usage),
g AS (SELECT block_start, sum(total_tokens) AS tokens, round(sum(cost), 6) AS cost, count(*) AS n FROM b GROUP BY 1)
SELECT epoch_us(block_start) AS block_start, tokens, cost, n, round(least(100.0, 100 * tokens / 20000.0), 4) AS pct,
  CASE WHEN least(100.0, tokens / 200.0) < 75 THEN 'ok' WHEN least(100.0, tokens / 200.0) < 90 THEN 'warn' ELSE 'critical' END AS status FROM g""")
def _(t):
    return _as_micros(U.five_hour_blocks(t("usage")), "block_start")


@query("a53_event_counts", """
WITH s AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM usage), k AS (SELECT DISTINCT model FROM usage), n AS (SELECT date, model, count(*) AS n FROM usage GROUP BY 1, 2)
SELECT s.date, k.model, coalesce(n.n, 0) AS n FROM s CROSS JOIN k LEFT JOIN n ON n.date = s.date AND n.model = k.model""")
def _(t):
    return U.event_counts(t("usage"))


@query("a56_trailing_weeks", """
SELECT date_diff('day', date, (SELECT max(date) FROM usage)) // 7 AS weeks_back, round(sum(cost), 6) AS cost, sum(total_tokens) AS total_tokens FROM usage
WHERE date_diff('day', date, (SELECT max(date) FROM usage)) // 7 < 4 GROUP BY 1""")
def _(t):
    return U.trailing_weeks(t("usage"))


@query("a57_project_days", """
SELECT project, date, round(sum(cost), 6) AS cost, sum(input_tokens) AS input_tokens, sum(output_tokens) AS output_tokens, sum(cache_creation_tokens) AS cache_creation_tokens,
  sum(cache_read_tokens) AS cache_read_tokens, string_agg(DISTINCT model, ',' ORDER BY model) AS models FROM usage GROUP BY 1, 2""")
def _(t):
    return U.project_days(t("usage"))


@query("a58_cost_per_million", """
SELECT date, model, round(sum(cost), 6) AS cost, sum(total_tokens) AS total_tokens, round(CASE WHEN sum(total_tokens) > 0 THEN sum(cost) / sum(total_tokens) * 1e6 END, 6) AS cost_per_mtok FROM usage GROUP BY 1, 2""")
def _(t):
    return U.cost_per_million(t("usage"))


@query("p13_within_horizon", "SELECT event_id, date FROM usage WHERE date >= (SELECT max(date) FROM usage) - 7")
def _(t):
    return U.within_horizon(t("usage"), 7).select("event_id", "date")


@query("p14_select_projects", "SELECT event_id, project FROM usage WHERE project IN ('p1', 'p4')")
def _(t):
    return U.select_projects(t("usage"), ["p1", "p4"]).select("event_id", "project")


@query("p21_budget_progress", """
WITH one AS (SELECT coalesce(sum(CASE WHEN date = m THEN cost END), 0) AS a, coalesce(sum(CASE WHEN date_trunc('week', date) = date_trunc('week', m) THEN cost END), 0) AS b, coalesce(sum(CASE WHEN date = m THEN total_tokens END), 0) AS c
  FROM usage CROSS JOIN (SELECT max(date) AS m FROM usage)),
r AS (SELECT 'daily_cost' AS budget, CAST(a AS DOUBLE) AS used, 10000.0::DOUBLE AS "limit" FROM one UNION ALL SELECT 'weekly_cost', b, 30000.0 FROM one UNION ALL SELECT 'daily_tokens', c, 200000.0 FROM one),
p AS (SELECT *, least(100.0, 100 * round(used, 6) / "limit") AS x FROM r)
SELECT budget, round(used, 6) AS used, "limit", round(x, 4) AS pct, CASE WHEN round(x, 4) < 75 THEN 'ok' WHEN round(x, 4) < 90 THEN 'warn' ELSE 'critical' END AS status FROM p""")
def _(t):
    return U.budget_progress(t("usage"), 10_000, 30_000, 200_000)


@query("t01_top_users", "SELECT user_id, round(sum(cost), 6) AS total FROM usage GROUP BY user_id ORDER BY 2 DESC, user_id LIMIT 10")
def _(t):
    return U.top_keys(t("usage"), "user_id", "cost", 10).select("user_id", F.round("total", 6).alias("total"))


@query("t02_top_users_per_project", """
WITH g AS (SELECT project, user_id, round(sum(cost), 6) AS total FROM usage GROUP BY 1, 2)
SELECT project, user_id, total FROM g QUALIFY row_number() OVER (PARTITION BY project ORDER BY total DESC, user_id) <= 3""")
def _(t):
    g = t("usage").groupBy("project", "user_id").agg(F.round(F.sum("cost"), 6).alias("total"))
    place = F.row_number().over(Window.partitionBy("project").orderBy(F.desc("total"), "user_id"))
    return g.withColumn("i", place).where(F.col("i") <= 3).drop("i")


@query("t03_top_then_detail", """
WITH top AS (SELECT project FROM usage GROUP BY project ORDER BY round(sum(cost), 6) DESC, project LIMIT 5)
SELECT project, date, round(sum(cost), 6) AS cost FROM usage WHERE project IN (SELECT project FROM top) GROUP BY 1, 2""")
def _(t):
    top = U.top_keys(t("usage"), "project", "cost", 5)
    return t("usage").join(F.broadcast(top), "project", "left_semi").groupBy("project", "date").agg(F.round(sum0("cost"), 6).alias("cost"))


@query("t04_histogram", """
WITH e AS (SELECT CAST(min(cost) AS DOUBLE) AS lo, CAST(max(cost) AS DOUBLE) AS hi FROM usage)
SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(19, floor((cost - lo) / ((hi - lo) / 20))) END AS INT) AS bin, count(*) AS n FROM usage CROSS JOIN e GROUP BY 1""")
def _(t):
    return U.histogram(t("usage"), "cost", 20)


@query("j21_source_date_spine", """
WITH s AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM usage), k AS (SELECT DISTINCT project FROM usage), g AS (SELECT project, date, sum(cost) AS cost FROM provider GROUP BY 1, 2)
SELECT k.project, s.date, round(coalesce(g.cost, 0), 6) AS cost FROM k CROSS JOIN s LEFT JOIN g ON g.project = k.project AND g.date = s.date""")
def _(t):
    spine = t("usage").select("project").distinct().crossJoin(U.date_spine(t("usage")))
    return J.spine_fill(t("provider"), spine, ["project", "date"], ["cost"])
