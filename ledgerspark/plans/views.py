"""The telemetry tables as views over the given ones, in Spark's and DuckDB's SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass


@dataclass(frozen=True)
class Dialect:
    duck: bool

    def t(self, name: str) -> str:
        return name if self.duck else "{" + name + "}"

    def us(self, x: str) -> str:
        return f"epoch_us({x})" if self.duck else f"unix_micros(CAST({x} AS TIMESTAMP))"

    def plus_days(self, d: str, n: str) -> str:
        return f"CAST({d} + CAST({n} AS INT) AS DATE)" if self.duck else f"date_add({d}, CAST({n} AS INT))"


SPARK, DUCK = Dialect(False), Dialect(True)


def tables_of(sql: str) -> set[str]:
    return set(re.findall(r"\{(\w+)\}", sql))


def _usage(d: Dialect) -> str:
    return f"""
SELECT event_id, concat('p', CAST(user_id % 20 AS STRING)) AS project, CAST(ts AS DATE) AS date, ts, user_id,
  event_type AS model, value AS cost, CAST(event_id % 1000 AS BIGINT) AS input_tokens, CAST(event_id % 300 AS BIGINT) AS output_tokens,
  CAST(event_id % 70 AS BIGINT) AS cache_creation_tokens, CAST(event_id % 50 AS BIGINT) AS cache_read_tokens,
  CAST(event_id % 1000 + event_id % 300 + event_id % 70 + event_id % 50 AS BIGINT) AS total_tokens
FROM {d.t("events")}"""


def _sessions(d: Dialect) -> str:
    return f"""
SELECT session_id, project, date, started_at, ended_at, round(({d.us("ended_at")} - {d.us("started_at")}) / 6.0E7, 1) AS duration_min, agent, trigger
FROM (SELECT concat(CAST(user_id AS STRING), '/', CAST(CAST(ts AS DATE) AS STRING)) AS session_id, concat('p', CAST(user_id % 20 AS STRING)) AS project,
    CAST(ts AS DATE) AS date, min(ts) AS started_at, max(ts) AS ended_at, concat('agent', CAST(user_id % 4 AS STRING)) AS agent,
    CASE user_id % 3 WHEN 0 THEN 'cron' WHEN 1 THEN 'interactive' END AS trigger
  FROM {d.t("events")} GROUP BY user_id, CAST(ts AS DATE)) s"""


def _provider(d: Dialect) -> str:
    return f"SELECT date, project, model, cost, input_tokens, output_tokens, total_tokens FROM {d.t('usage')} WHERE model = 'purchase'"


def _crosscheck(d: Dialect) -> str:
    return f"SELECT date, project, model, cost, input_tokens, output_tokens, total_tokens FROM {d.t('usage')} WHERE model = 'signup' AND event_id % 7 > 2"


def _blocks(d: Dialect) -> str:
    return f"""
SELECT event_id AS block_id, ts AS start_time, CASE WHEN event_id % 5 = 0 THEN NULL ELSE ts + INTERVAL 2 HOUR END AS actual_end,
  ts + INTERVAL 5 HOUR AS planned_end, event_type = 'error' AS is_gap, total_tokens, cost, model
FROM (SELECT *, model AS event_type FROM {d.t("usage")}) u"""


def _order_sessions(d: Dialect) -> str:
    start = "CAST(o_orderdate AS DATE)"
    return f"""
SELECT o_orderkey AS session_id, c_nationkey AS project, {start} AS start_date, {d.plus_days(start, "o_orderkey % 4")} AS end_date,
  CAST(o_orderkey % 600 AS DOUBLE) AS duration_min, concat('agent', CAST(o_custkey % 4 AS STRING)) AS agent
FROM {d.t("orders")} o JOIN {d.t("customer")} c ON o.o_custkey = c.c_custkey"""


def _commits(d: Dialect) -> str:
    return f"""
SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-', CAST(l_partkey AS STRING)) AS hash, l_orderkey AS order_key,
  CAST(l_shipdate AS DATE) AS date, s_nationkey AS project, concat('author', CAST(s_suppkey % 37 AS STRING)) AS author,
  CASE l_linenumber % 6 WHEN 0 THEN 'fix: revert bug' WHEN 1 THEN 'feat: add' WHEN 2 THEN 'hotfix urgent' ELSE 'docs: text' END AS message,
  CAST(l_quantity AS BIGINT) AS lines_added, CAST(l_linenumber AS BIGINT) AS lines_deleted, CAST(l_quantity + l_linenumber AS BIGINT) AS lines_changed
FROM {d.t("lineitem")} l JOIN {d.t("supplier")} s ON l.l_suppkey = s.s_suppkey"""


def _commit_files(d: Dialect) -> str:
    return f"""
SELECT l_orderkey AS hash, l_orderkey % 5 AS project, CAST(l_shipdate AS DATE) AS date, p_brand AS file,
  CAST(l_quantity AS BIGINT) AS added, CAST(l_linenumber AS BIGINT) AS deleted
FROM {d.t("lineitem")} l JOIN {d.t("part")} p ON l.l_partkey = p.p_partkey"""


def _order_costs(d: Dialect) -> str:
    return f"SELECT c_nationkey AS project, CAST(o_orderdate AS DATE) AS date, o_totalprice AS cost FROM {d.t('orders')} o JOIN {d.t('customer')} c ON o.o_custkey = c.c_custkey"


def _lifecycle(d: Dialect) -> str:
    return f"""
SELECT o_orderkey AS review_id, c_mktsegment AS repo, concat('agent', CAST(o_custkey % 4 AS STRING)) AS agent, CAST(o_orderkey AS STRING) AS commit_sha,
  CAST(o_orderdate AS TIMESTAMP) AS created_at, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(shipped AS TIMESTAMP) END AS closed_at,
  CASE o_orderstatus WHEN 'F' THEN 'fix_linked' WHEN 'P' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'autoclose' ELSE 'manual' END END AS close_reason,
  CASE WHEN o_orderkey % 3 = 0 THEN 'P' ELSE 'F' END AS verdict,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'critical' WHEN '2-HIGH' THEN 'high' WHEN '3-MEDIUM' THEN 'medium' WHEN '5-LOW' THEN 'low' END AS severity,
  CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey AS STRING) END AS fix_commit_sha,
  CASE WHEN o_orderstatus = 'F' THEN CAST(shipped AS TIMESTAMP) END AS fix_commit_at,
  CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_orderkey % 5 = 0 THEN 'commit_reference' ELSE 'time_window' END END AS fix_method
FROM {d.t("orders")} o JOIN {d.t("customer")} c ON o.o_custkey = c.c_custkey
LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS shipped FROM {d.t("lineitem")} GROUP BY l_orderkey) m ON m.l_orderkey = o.o_orderkey"""


def _review_daily(d: Dialect) -> str:
    count = lambda c: f"CAST(sum(CASE WHEN {c} THEN 1 ELSE 0 END) AS BIGINT)"
    return f"""
SELECT date, project AS repo, CAST(count(*) AS BIGINT) AS created, {count("model = 'purchase'")} AS passed, {count("model IN ('error', 'view')")} AS failed,
  {count("model = 'signup'")} AS autoclosed_severity, {count("model = 'click'")} AS autoclosed_age, {count("model = 'error' AND event_id % 2 = 0")} AS parse_fail
FROM {d.t("usage")} GROUP BY date, project"""


def _performance(d: Dialect) -> str:
    count = lambda c: f"CAST(sum(CASE WHEN {c} THEN 1 ELSE 0 END) AS BIGINT)"
    return f"""
SELECT date, concat('agent', CAST(user_id % 4 AS STRING)) AS agent, model, CAST(count(*) AS BIGINT) AS n_runs, {count("event_id % 3 = 0")} AS pass_count,
  {count("event_id % 3 = 1")} AS fail_count, {count("event_id % 3 = 2")} AS error_count, sum(CASE WHEN user_id % 4 = 3 THEN NULL ELSE cost END) AS total_cost
FROM {d.t("usage")} GROUP BY date, user_id % 4, model"""


def _predictions(d: Dialect) -> str:
    return f"""
SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber % 4 AS STRING)) AS prediction_id, l_shipdate AS recorded_at,
  concat('n', CAST(l_suppkey % 25 AS STRING)) AS project, l_linestatus AS task_type, round(l_discount * 10, 1) AS p,
  CASE l_returnflag WHEN 'R' THEN 'TRUE' WHEN 'A' THEN 'partial' ELSE CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE 'FALSE' END END AS outcome,
  l_partkey AS tie, l_linenumber AS line_no, l_extendedprice AS price
FROM {d.t("lineitem")}"""


def _findings(d: Dialect) -> str:
    return f"""
SELECT doc_id AS job_id, source AS project, concat('src/', lang, '/f', CAST(doc_id % 4 AS STRING), '.py') AS primary_file,
  CASE doc_id % 5 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN 'low' WHEN 3 THEN 'critical' ELSE 'odd' END AS severity,
  text AS problem_text, CAST(TIMESTAMP '2024-01-01 00:00:00' AS TIMESTAMP) + doc_id * INTERVAL 1 HOUR AS reviewed_at
FROM {d.t("documents")}"""


def _raw_names(d: Dialect) -> str:
    """Project names as tools write them: a place, a project and a tail, or one of the odd names; and working directories."""
    user = "CAST(user_id AS STRING)"
    place = "CASE event_id % 5 WHEN 0 THEN '' WHEN 1 THEN '-srv-me-git-team-' WHEN 2 THEN '/srv_me_git_' WHEN 3 THEN 'europe/alps/' ELSE 'asia-' END"
    tail = "CASE event_id % 7 WHEN 0 THEN '-feat-x-1' WHEN 1 THEN '-DOCS' WHEN 2 THEN '/src' WHEN 3 THEN '_sub' WHEN 4 THEN '-fixed' ELSE '' END"
    odd = f"""CASE user_id % 13 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'europe' WHEN 3 THEN 'left-over' WHEN 4 THEN 'holland' WHEN 5 THEN 'polar-north-station' WHEN 6 THEN '0f3a9c55d2e17b'
  WHEN 7 THEN 'spain/.wt/7' WHEN 8 THEN concat('2024-', {user}) WHEN 9 THEN 'abcdefgh1/repo/asia/japan' WHEN 10 THEN concat('private_', {user})
  WHEN 11 THEN CASE event_id % 4 WHEN 0 THEN 'secret_lab' WHEN 1 THEN 'Secret_Lab-feat-z' WHEN 2 THEN 'p3-test-2' ELSE 'P11' END
  ELSE CASE event_id % 3 WHEN 0 THEN 'Cash-FIX-y' WHEN 1 THEN 'CASH-book-docs-x' ELSE 'cash-book' END END"""
    return f"""
SELECT event_id, user_id, ts, CASE WHEN event_id % 3 = 1 THEN {odd} ELSE concat({place}, 'p', {user}, {tail}) END AS name,
  CASE event_id % 6 WHEN 0 THEN concat('/srv/me/git/europe/p', {user}, '/src/git/x') WHEN 1 THEN concat('/opt/w/x', {user})
    WHEN 2 THEN '/srv/me/git/2024/.git' WHEN 3 THEN NULL WHEN 4 THEN concat('/tmp/mail me', {user}, '@site.org') ELSE '/home/me/notes' END AS cwd
FROM {d.t("events")}"""


VIEWS: dict[str, Callable[[Dialect], str]] = {
    "usage": _usage, "sessions": _sessions, "provider": _provider, "crosscheck": _crosscheck, "blocks": _blocks, "order_sessions": _order_sessions,
    "commits": _commits, "commit_files": _commit_files, "order_costs": _order_costs, "lifecycle": _lifecycle, "review_daily": _review_daily,
    "performance": _performance, "predictions": _predictions, "findings": _findings, "raw_names": _raw_names,
}
