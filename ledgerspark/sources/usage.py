"""Usage, rate-limit and cost documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark import schemas as S
from ledgerspark.functions.columns import hours_between, parse_time, sum0, year_day

_TOKENS = ("inputTokens", "outputTokens", "cacheCreationTokens", "cacheReadTokens", "totalTokens")


def as_list(c: Column | str) -> Column:
    """JSON text that is null, a string or an array, as an array of strings."""
    c = F.col(c) if isinstance(c, str) else c
    plain = F.array(F.regexp_replace(c, '^"|"$', ""))
    return F.when(c.isNull() | (c == "null"), F.array().cast("array<string>")).when(c.startswith("["), F.from_json(c, "array<string>")).otherwise(plain)


def read_daily_usage(spark: SparkSession, path: str, project: str | None = None) -> DataFrame:
    """``{projects: {name: [rows]}}`` files as rows with their project; a filter is a literal part of the name."""
    # modelsUsed is read as text: it may be null, a string or an array
    row = T.StructType([T.StructField(f.name, T.StringType() if f.name == "modelsUsed" else f.dataType) for f in S.schema(S.USAGE_ROW).fields])
    doc = T.StructType([T.StructField("projects", T.MapType(T.StringType(), T.ArrayType(row)))])
    raw = spark.read.schema(doc).json(path, multiLine=True)
    rows = raw.select(F.explode("projects").alias("project", "rows")).select("project", F.explode("rows").alias("r"))
    if project is not None:
        rows = rows.where(F.col("project").contains(project))
    return rows.select("project", F.to_date("r.date").alias("date"), *(F.col(f"r.{c}") for c in _TOKENS), F.col("r.totalCost"), as_list("r.modelsUsed").alias("modelsUsed"), F.col("r.modelBreakdowns"))


def read_usage_sessions(spark: SparkSession, path: str) -> DataFrame:
    """The ``sessions`` array of each document as rows."""
    row = f"sessionId string, projectPath string, {', '.join(f'{c} bigint' for c in _TOKENS)}, totalCost double, lastActivity string, modelsUsed array<string>"
    raw = spark.read.schema(f"sessions array<struct<{row.replace(' bigint', ': bigint').replace(' double', ': double').replace(' string', ': string').replace(' array', ': array')}>>").json(path, multiLine=True)
    return raw.select(F.explode("sessions").alias("s")).select("s.*").withColumn("lastActivity", F.to_date("lastActivity"))


def read_blocks(spark: SparkSession, path: str, for_report: bool = False) -> DataFrame:
    """Usage blocks without gaps, token kinds lifted, models as text; reports leave out open and free ones."""
    row = "startTime: string, endTime: string, actualEndTime: string, isGap: boolean, entries: int, costUSD: double, totalTokens: bigint, models: array<string>, tokenCounts: struct<inputTokens: bigint, outputTokens: bigint, cacheCreationInputTokens: bigint, cacheReadInputTokens: bigint>"
    raw = spark.read.schema(f"blocks array<struct<{row}>>").json(path, multiLine=True)
    b = raw.select(F.explode("blocks").alias("b")).select("b.*").where(~F.coalesce("isGap", F.lit(False)))
    out = b.select(
        parse_time("startTime").alias("start_time"), parse_time("endTime").alias("planned_end"), parse_time("actualEndTime").alias("actual_end"), F.col("costUSD").alias("cost"), F.col("totalTokens").alias("total_tokens"),
        F.array_join("models", ", ").alias("models"), F.col("tokenCounts.inputTokens").alias("input_tokens"), F.col("tokenCounts.outputTokens").alias("output_tokens"),
        F.col("tokenCounts.cacheCreationInputTokens").alias("cache_creation_tokens"), F.col("tokenCounts.cacheReadInputTokens").alias("cache_read_tokens"),
    )
    return out.where(F.col("actual_end").isNotNull() & (F.col("cost") > 0)) if for_report else out


def read_rate_limits(spark: SparkSession, path: str) -> DataFrame:
    """One row per provider and window; absent windows and those that reset before 2000 are left out."""
    win = "struct<usedPercent: double, windowMinutes: int, resetsAt: string>"
    row = f"provider string, source string, usage struct<primary: {win}, secondary: {win}, tertiary: {win}, updatedAt: string>, credits struct<remaining: double, updatedAt: string>"
    raw = spark.read.schema(row).json(path)
    wins = F.array(*(F.struct(F.lit(w).alias("limit_window"), F.col(f"usage.{w}").alias("w")) for w in ("primary", "secondary", "tertiary")))
    r = raw.select("provider", "source", F.col("credits.remaining").alias("credits_remaining"), parse_time("usage.updatedAt").alias("updated_at"), F.explode(wins).alias("x"))
    r = r.where(F.col("x.w").isNotNull()).select(
        "provider", "x.limit_window", F.col("x.w.usedPercent").alias("used_pct"), F.col("x.w.windowMinutes").alias("window_minutes"), parse_time("x.w.resetsAt").alias("resets_at"), "credits_remaining", "source", "updated_at"
    )
    return r.where(F.col("resets_at").isNull() | (F.col("resets_at") >= F.lit("2000-01-01").cast("timestamp")))


def read_provider_costs(spark: SparkSession, path: str) -> DataFrame:
    """One row per provider, day and model; token names in camel or snake case, 0 where absent."""
    names = {"total_tokens": "totalTokens", "input_tokens": "inputTokens", "output_tokens": "outputTokens", "cache_read_tokens": "cacheReadTokens", "cache_creation_tokens": "cacheCreationTokens"}
    row = "modelName: string, cost: double, " + ", ".join(f"{a}: bigint, {b}: bigint" for a, b in names.items())
    raw = spark.read.schema(f"provider string, daily array<struct<date: string, modelBreakdowns: array<struct<{row}>>>>").json(path)
    d = raw.select("provider", F.explode("daily").alias("d")).select("provider", F.to_date("d.date").alias("date"), F.explode("d.modelBreakdowns").alias("m"))
    return d.select("provider", "date", F.col("m.modelName").alias("model"), F.coalesce("m.cost", F.lit(0.0)).alias("cost"), *(F.coalesce(f"m.{a}", f"m.{b}", F.lit(0)).alias(a) for a, b in names.items()))


def read_monitor_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Monitor blocks: times are [year, day of year, hour, minute, second]; tokens are summed from their parts."""
    parts = "inputTokens: bigint, outputTokens: bigint, cacheCreationTokens: bigint, cacheReadTokens: bigint"
    raw = spark.read.schema(f"id string, is_gap boolean, start array<int>, cost double, stats struct<{parts}>").json(path)
    at = F.make_timestamp(F.year(d := year_day(F.get("start", F.lit(0)), F.get("start", F.lit(1)))), F.month(d), F.dayofmonth(d), F.get("start", F.lit(2)), F.get("start", F.lit(3)), F.get("start", F.lit(4)))
    tokens = sum((F.coalesce(f"stats.{p.split(':')[0].strip()}", F.lit(0)) for p in parts.split(",")), F.lit(0))
    return raw.where(~F.coalesce("is_gap", F.lit(False))).select("id", at.alias("start_time"), "cost", tokens.alias("total_tokens"))


def strip_fields(df: DataFrame, struct: str, fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """The frame without these fields of a struct, and a one-row frame with how many values went."""
    have = [f for f in fields if f in df.schema[struct].dataType.names]
    n = sum((F.count_if(F.col(f"{struct}.{f}").isNotNull()) for f in have), F.lit(0))
    return df.withColumn(struct, F.col(struct).dropFields(*have)) if have else df, df.agg(n.cast("long").alias("n_removed"))


def keep_keys(text: Column | str, keys: list[str]) -> Column:
    """JSON object text with only these keys; ``{}`` for none or for text that is no object."""
    m = F.from_json(text, "map<string,string>")
    kept = F.map_filter(m, lambda k, _: k.isin(*keys))
    return F.coalesce(F.to_json(kept), F.lit("{}"))


def hygienic(df: DataFrame, name: str, junk: str) -> DataFrame:
    """Rows with a real name: not NULL, not ``*``, not of the junk pattern."""
    return df.where(F.col(name).isNotNull() & (F.col(name) != "*") & ~F.col(name).rlike(junk))


def block_hours(blocks: DataFrame) -> DataFrame:
    end = F.coalesce("actual_end", "planned_end")
    return blocks.agg(F.round(sum0(hours_between("start_time", end)), 6).alias("hours"))
