"""Schemas of the tables, and conforming of frames that drift from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SESSIONS = "session_id string, project string, canonical_project string, started_at timestamp, ended_at timestamp, duration_min double, agent string, source string, working_dir string, valid_from timestamp, trigger string"
COSTS = "cost_id string, project string, canonical_project string, date date, source string, daily_cost_usd double, n_sessions int, duration_min double, valid_from timestamp"
COMMITS = "commit_pk string, project string, canonical_project string, hash string, date date, message string, lines_added int, lines_deleted int, files_changed int, lines_changed int, valid_from timestamp"
PAYLOAD = "event_type string, session_id string, project string, started_at string, ended_at string, duration_min double, agent string, source string, working_dir string, trigger string, date string, daily_cost_usd double, n_sessions int, hash string, message string, lines_added int, lines_deleted int, files_changed int, lines_changed int"
USAGE_ROW = "date string, inputTokens bigint, outputTokens bigint, cacheCreationTokens bigint, cacheReadTokens bigint, totalTokens bigint, totalCost double, modelsUsed array<string>, modelBreakdowns array<struct<modelName string, cost double, inputTokens bigint, outputTokens bigint, cacheCreationTokens bigint, cacheReadTokens bigint>>"
FINDINGS = "job_id bigint, severity string, primary_file string, full_location string, problem_text string, fix_text string"
LOOPS = "content_hash string, severity string, primary_file string, summary string, first_seen timestamp, last_seen timestamp, cycles int, tier string, fix_commit_shas string, estimated_wasted_usd double, ack_by string, ack_at timestamp, ack_reason string, ack_until timestamp"
PREDICTIONS = "prediction_id string, recorded_at timestamp, project_name string, task_type string, p_success double, outcome string, outcome_recorded_at timestamp, outcome_notes string"


def schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def empty(spark: SparkSession, ddl: str) -> DataFrame:
    return spark.createDataFrame([], ddl)


def conform(df: DataFrame, ddl: str, defaults: dict | None = None) -> DataFrame:
    """The schema's columns in its order and types: missing ones NULL or their default, others dropped."""
    defaults = defaults or {}
    out = []
    for f in schema(ddl).fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(defaults.get(f.name))
        out.append(c.cast(f.dataType).alias(f.name))
    return df.select(*out)
