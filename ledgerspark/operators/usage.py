"""Usage and cost aggregates over daily usage, sessions, blocks, turns and messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.functions.columns import bucket, iso_week, micros, model_family, monday, ratio, sum0, sunday

TOKENS = ("input_tokens", "output_tokens", "cache_creation_tokens", "cache_read_tokens")


def long_form(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: (metric, value as text)."""
    pairs = ", ".join(f"'{c}', CAST({c} AS STRING)" for c in columns)
    return df.selectExpr(f"stack({len(columns)}, {pairs}) AS (metric, value)")


def usage_summary(daily: DataFrame) -> DataFrame:
    """Totals, date range and averages of daily usage in long form.

    ``avg_cost_per_row`` is the mean over rows; ``avg_cost_per_day`` over active days.
    """
    one = daily.agg(
        F.round(sum0("cost"), 6).alias("total_cost"), sum0("total_tokens").alias("total_tokens"), F.count_distinct("date").alias("active_days"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.round(F.avg("cost"), 6).alias("avg_cost_per_row"),
        F.round(ratio(F.sum("cost"), F.count_distinct("date")), 6).alias("avg_cost_per_day"),
    )
    names = one.columns
    return long_form(one, names)


def model_breakdown(rows: DataFrame) -> DataFrame:
    """Cost, token kinds and days by model."""
    return rows.groupBy("model").agg(F.round(sum0("cost"), 6).alias("cost"), *(sum0(t).alias(t) for t in TOKENS), F.count_distinct("date").alias("days"))


def by_trigger(sessions: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Sessions and minutes by trigger; NULL is ``unknown``; bounds are inclusive."""
    s = sessions
    if start:
        s = s.where(F.col("date") >= F.lit(start).cast("date"))
    if end:
        s = s.where(F.col("date") <= F.lit(end).cast("date"))
    return s.groupBy(F.coalesce("trigger", F.lit("unknown")).alias("trigger")).agg(F.count(F.lit(1)).alias("n_sessions"), F.round(sum0("duration_min"), 4).alias("minutes"))


def costs_rollup(rows: DataFrame, project: Column | None = None) -> DataFrame:
    """Cost per (canonical project, date), the first raw project by name, and the row's key."""
    canonical = project if project is not None else F.col("project")
    out = rows.withColumn("canonical_project", canonical).where(F.col("canonical_project").isNotNull()).groupBy("canonical_project", "date").agg(
        F.min("project").alias("project"), F.round(sum0("cost"), 6).alias("daily_cost"), F.count(F.lit(1)).alias("n_rows")
    )
    return out.withColumn("cost_id", F.concat_ws("|", "canonical_project", F.col("date").cast("string"), F.lit("usage")))


def daily_from_blocks(blocks: DataFrame) -> DataFrame:
    """Sums and models of a day's blocks."""
    models = F.array_join(F.array_sort(F.collect_set("model")), ",")
    return blocks.groupBy(F.to_date("start_time").alias("date")).agg(
        F.count(F.lit(1)).alias("entries"), sum0("total_tokens").alias("total_tokens"), F.round(sum0("cost"), 4).alias("cost"), models.alias("models")
    )


def cost_by_model_day(rows: DataFrame) -> DataFrame:
    return rows.groupBy("date", "model").agg(F.round(sum0("cost"), 6).alias("cost"), sum0("total_tokens").alias("total_tokens"))


def family_costs(rows: DataFrame, families: tuple[str, ...], other: str) -> DataFrame:
    """A day's cost by model family, its total and each family's percentage (NULL if the total is 0)."""
    fam = model_family("model", families, other)
    names = [*families, other]
    sums = [F.round(sum0(F.when(fam == f, F.col("cost"))), 6).alias(f"{f}_cost") for f in names]
    day = rows.groupBy("date").agg(*sums, F.round(sum0("cost"), 6).alias("total_cost"))
    return day.select("*", *(F.round(100 * ratio(f"{f}_cost", "total_cost"), 4).alias(f"{f}_pct") for f in names))


def grand_summary(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.round(sum0("cost"), 6).alias("total_cost"), sum0("total_tokens").alias("total_tokens"), F.count(F.lit(1)).alias("entries"),
        F.count_distinct("project").alias("projects"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
    )


def chat_rollup(messages: DataFrame, keys: list[str], at: str = "ts") -> DataFrame:
    """Tokens, cost, time range and count of messages by session or by day."""
    tokens = F.col("input_tokens") + F.col("output_tokens") + F.col("cache_read_tokens")
    return messages.groupBy(*keys).agg(
        sum0(tokens).alias("tokens"), F.round(sum0("cost"), 6).alias("cost"), F.min(at).alias("first_at"), F.max(at).alias("last_at"), F.count(F.lit(1)).alias("n_messages")
    )


def turn_daily(turns: DataFrame) -> DataFrame:
    """By date, project, model and source; NULL projects are a group; all-NULL cost stays NULL."""
    return turns.groupBy("date", "project", "model", "source").agg(
        F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"), F.round(F.sum("cost"), 6).alias("cost"), F.count(F.lit(1)).alias("n_turns")
    )


def thread_sessions(turns: DataFrame, thread: str = "user_id", at: str = "ts", order: str = "event_id") -> DataFrame:
    """One row per thread: time range, first non-NULL project, first model, sums, turns."""
    has = F.col("project").isNotNull()
    return turns.groupBy(thread).agg(
        F.min(at).alias("first_at"), F.max(at).alias("last_at"), F.min_by("project", F.when(has, F.col(order))).alias("project"),
        F.min_by("model", order).alias("model"), sum0("total_tokens").alias("total_tokens"), F.round(F.sum("cost"), 6).alias("cost"), F.count(F.lit(1)).alias("n_turns"),
    )


def activity_gaps(days: DataFrame) -> DataFrame:
    """Maximal runs of missing dates between active ones: gap_start, gap_end, days.

    The dates of one table are few (one per day); per-key gaps use ``keys``.
    """
    return gaps_by(days.select(F.lit(0).alias("__k"), "date"), ["__k"]).drop("__k")


def gaps_by(days: DataFrame, keys: list[str]) -> DataFrame:
    d = days.select(*keys, "date").distinct()
    nxt = F.lead("date").over(Window.partitionBy(*keys).orderBy("date"))
    gaps = d.withColumn("nxt", nxt).where(F.datediff("nxt", "date") > 1)
    return gaps.select(*keys, F.date_add("date", 1).alias("gap_start"), F.date_sub("nxt", 1).alias("gap_end"), (F.datediff("nxt", "date") - 1).alias("days"))


def cumulative_cost(rows: DataFrame) -> DataFrame:
    """Daily cost and its running total; one row per date."""
    day = rows.groupBy("date").agg(F.sum("cost").alias("cost"))
    run = F.sum("cost").over(Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0))
    return day.select("date", F.round("cost", 6).alias("cost"), F.round(run, 6).alias("running_cost"))


def top_keys(rows: DataFrame, key: str, value: str, k: int) -> DataFrame:
    """The k keys with the largest sums, ties by key."""
    return rows.groupBy(key).agg(F.sum(value).alias("total")).orderBy(F.round("total", 6).desc(), key).limit(k)


def date_spine(rows: DataFrame, date: str = "date") -> DataFrame:
    """Every date from the first to the last one."""
    ends = rows.agg(F.min(date).alias("a"), F.max(date).alias("b")).where(F.col("a").isNotNull())
    return ends.select(F.explode(F.sequence("a", "b")).alias(date))


def cumulative_by_project(rows: DataFrame, k: int = 8) -> DataFrame:
    """Running cost of the k largest projects on a zero-filled date spine."""
    top = top_keys(rows, "project", "cost", k).select("project")
    day = rows.join(F.broadcast(top), "project", "left_semi").groupBy("project", "date").agg(F.sum("cost").alias("cost"))
    full = F.broadcast(top).crossJoin(date_spine(rows)).join(day, ["project", "date"], "left").withColumn("cost", F.coalesce("cost", F.lit(0.0)))
    run = F.sum("cost").over(Window.partitionBy("project").orderBy("date").rowsBetween(Window.unboundedPreceding, 0))
    return full.select("project", "date", F.round("cost", 6).alias("cost"), F.round(run, 6).alias("running_cost"))


def source_overview(sources: dict[str, DataFrame]) -> DataFrame:
    """One row per source: cost, cost a day, tokens, days, rows and range."""
    parts = [
        rows.agg(
            F.lit(name).alias("source"), F.round(sum0("cost"), 6).alias("cost"), F.round(ratio(F.sum("cost"), F.count_distinct("date")), 6).alias("cost_per_day"),
            sum0("total_tokens").alias("total_tokens"), F.count_distinct("date").alias("days"), F.count(F.lit(1)).alias("entries"),
            F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        )
        for name, rows in sources.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def weekly_by_source(sources: dict[str, DataFrame]) -> DataFrame:
    """Cost and tokens by Sunday week and source, zero-filled over the weeks and sources seen."""
    out = None
    for name, rows in sources.items():
        part = rows.select(F.lit(name).alias("source"), sunday("date").alias("week"), "cost", "total_tokens")
        out = part if out is None else out.unionByName(part)
    sums = out.groupBy("source", "week").agg(F.sum("cost").alias("cost"), F.sum("total_tokens").alias("total_tokens"))
    full = sums.select("source").distinct().crossJoin(sums.select("week").distinct()).join(sums, ["source", "week"], "left")
    return full.select("source", "week", F.round(F.coalesce("cost", F.lit(0.0)), 6).alias("cost"), F.coalesce("total_tokens", F.lit(0)).alias("total_tokens"))


def weekly_by_model(rows: DataFrame, models: str | None = None, split: bool = False) -> DataFrame:
    """Weekly (Monday) cost by model.

    With ``models``, a comma-separated column is exploded and each model gets
    the row's whole cost, or an equal share of it with ``split``.
    """
    if models:
        names = F.split(models, ",")
        cost = F.col("cost") / F.size(names) if split else F.col("cost")
        rows = rows.select("date", cost.alias("cost"), F.explode(names).alias("model"))
    return rows.groupBy(monday("date").alias("week"), "model").agg(F.round(F.sum("cost"), 6).alias("cost"))


def token_composition(rows: DataFrame) -> DataFrame:
    """Daily sums of the token kinds, long."""
    day = rows.groupBy("date").agg(*(sum0(t).alias(t) for t in TOKENS))
    return day.unpivot(["date"], list(TOKENS), "kind", "tokens")


def session_statistics(sessions: DataFrame) -> DataFrame:
    """Per project: sessions, minutes, mean minutes, and those of the last 30 days of the data."""
    last = sessions.agg(F.max("date").alias("last"))
    s = sessions.crossJoin(F.broadcast(last))
    return s.groupBy("project").agg(
        F.count(F.lit(1)).alias("n_sessions"), F.round(sum0("duration_min"), 4).alias("minutes"), F.round(F.avg("duration_min"), 6).alias("mean_minutes"),
        F.count_if(F.col("date") > F.date_sub("last", 30)).alias("n_recent"),
    )


def sessions_by_day(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("date").agg(F.count(F.lit(1)).alias("n_sessions"), F.round(sum0("duration_min"), 4).alias("minutes"))


def block_metrics(blocks: DataFrame) -> DataFrame:
    """Effective end, hours, cost an hour and tokens an hour (NULL unless the hours are positive); gaps dropped."""
    end = F.coalesce("actual_end", "planned_end")
    hours = (micros(end) - micros("start_time")) / F.lit(3.6e9)
    b = blocks.where(~F.col("is_gap")).withColumns({"effective_end": end, "hours": hours})
    per = lambda c: F.round(F.when(F.col("hours") > 0, F.col(c) / F.col("hours")), 6)
    return b.select("block_id", "start_time", "effective_end", F.round("hours", 4).alias("hours"), "cost", "total_tokens", per("cost").alias("cost_per_hour"), per("total_tokens").alias("tokens_per_hour"))


def block_trigger(blocks: DataFrame, windows: list[tuple[int, int]]) -> DataFrame:
    """``scheduled`` where start and end lie in one daily window of hours [a, b), else ``interactive``."""
    end = F.coalesce("actual_end", "planned_end")
    hour = lambda c: F.hour(c) + F.minute(c) / 60 + F.second(c) / 3600
    inside = F.lit(False)
    for a, b in windows:
        inside = inside | ((hour("start_time") >= a) & (hour(end) < b) & (F.to_date("start_time") == F.to_date(end)))
    return blocks.withColumn("trigger", F.when(inside, F.lit("scheduled")).otherwise(F.lit("interactive")))


def heatmap(rows: DataFrame, at: str = "ts") -> DataFrame:
    """Cost by weekday (0 Monday) and hour, all 168 cells."""
    cells = rows.groupBy(F.weekday(at).alias("weekday"), F.hour(at).alias("hour")).agg(F.sum("cost").alias("cost"), F.count(F.lit(1)).alias("n"))
    spark = rows.sparkSession
    grid = spark.range(168).select((F.col("id") / 24).cast("int").alias("weekday"), (F.col("id") % 24).cast("int").alias("hour"))
    return F.broadcast(grid).join(cells, ["weekday", "hour"], "left").select("weekday", "hour", F.round(F.coalesce("cost", F.lit(0.0)), 6).alias("cost"), F.coalesce("n", F.lit(0)).alias("n"))


def block_days(blocks: DataFrame, windows: list[tuple[int, int]]) -> DataFrame:
    """Per day: blocks, minutes, cost, tokens, and the split into scheduled and interactive."""
    end = F.coalesce("actual_end", "planned_end")
    b = block_trigger(blocks.where(~F.col("is_gap")), windows).withColumn("minutes", (micros(end) - micros("start_time")) / F.lit(6e7))
    sched = F.col("trigger") == "scheduled"
    return b.groupBy(F.to_date("start_time").alias("date")).agg(
        F.count(F.lit(1)).alias("blocks"), F.round(sum0("minutes"), 4).alias("minutes"), F.round(sum0("cost"), 6).alias("cost"), sum0("total_tokens").alias("total_tokens"),
        F.count_if(sched).alias("n_scheduled"), F.round(sum0(F.when(sched, F.col("cost"))), 6).alias("scheduled_cost"), F.round(sum0(F.when(~sched, F.col("cost"))), 6).alias("interactive_cost"),
    )


def five_hour_blocks(rows: DataFrame, at: str = "ts", limit: float = 20_000) -> DataFrame:
    """Tokens in calendar blocks that start at 0, 5, 10, 15 and 20 h (the last is 4 h), with a status."""
    start = F.date_trunc("day", F.col(at)) + F.make_dt_interval(F.lit(0), (F.floor(F.hour(at) / 5) * 5).cast("int"))
    b = rows.groupBy(start.alias("block_start")).agg(sum0("total_tokens").alias("tokens"), F.round(sum0("cost"), 6).alias("cost"), F.count(F.lit(1)).alias("n"))
    pct = F.least(F.lit(100.0), 100 * F.col("tokens") / F.lit(float(limit)))
    return b.withColumn("pct", F.round(pct, 4)).withColumn("status", bucket("pct", [75.0, 90.0], ["ok", "warn", "critical"]))


def event_counts(rows: DataFrame, kind: str = "model") -> DataFrame:
    """Counts by date and kind, zero-filled."""
    n = rows.groupBy("date", kind).agg(F.count(F.lit(1)).alias("n"))
    full = date_spine(rows).crossJoin(rows.select(kind).distinct()).join(n, ["date", kind], "left")
    return full.select("date", kind, F.coalesce("n", F.lit(0)).alias("n"))


def trailing_weeks(rows: DataFrame, weeks: int = 4) -> DataFrame:
    """Cost and tokens of the last ``weeks`` 7-day windows, counted back from the last date."""
    last = F.broadcast(rows.agg(F.max("date").alias("last")))
    back = F.floor(F.datediff("last", "date") / 7)
    return rows.crossJoin(last).withColumn("weeks_back", back).where(F.col("weeks_back") < weeks).groupBy("weeks_back").agg(F.round(F.sum("cost"), 6).alias("cost"), F.sum("total_tokens").alias("total_tokens"))


def project_days(rows: DataFrame) -> DataFrame:
    """Sums of a project's day and the union of its models."""
    return rows.groupBy("project", "date").agg(
        F.round(sum0("cost"), 6).alias("cost"), *(sum0(t).alias(t) for t in TOKENS), F.array_join(F.array_sort(F.collect_set("model")), ",").alias("models")
    )


def cost_per_million(rows: DataFrame) -> DataFrame:
    """Cost per million tokens by date and model; NULL without tokens."""
    g = rows.groupBy("date", "model").agg(F.sum("cost").alias("cost"), F.sum("total_tokens").alias("total_tokens"))
    return g.select("date", "model", F.round("cost", 6).alias("cost"), "total_tokens", F.round(F.when(F.col("total_tokens") > 0, F.col("cost") / F.col("total_tokens") * 1e6), 6).alias("cost_per_mtok"))


def budget_progress(rows: DataFrame, daily: float, weekly: float, tokens: int) -> DataFrame:
    """Percentages of three limits on the last date of the data, capped at 100, with a colour class."""
    last = F.broadcast(rows.agg(F.max("date").alias("last")))
    r = rows.crossJoin(last)
    today = F.col("date") == F.col("last")
    one = r.agg(
        sum0(F.when(today, F.col("cost"))).alias("day_cost"), sum0(F.when(monday("date") == monday("last"), F.col("cost"))).alias("week_cost"),
        sum0(F.when(today, F.col("total_tokens"))).alias("day_tokens"),
    )
    limits = [("daily_cost", "day_cost", daily), ("weekly_cost", "week_cost", weekly), ("daily_tokens", "day_tokens", tokens)]
    rows_ = F.array(*(F.struct(F.lit(n).alias("budget"), F.round(F.col(c).cast("double"), 6).alias("used"), F.lit(float(x)).alias("limit")) for n, c, x in limits))
    out = one.select(F.inline(rows_))
    out = out.withColumn("pct", F.round(F.least(F.lit(100.0), 100 * F.col("used") / F.col("limit")), 4))
    return out.withColumn("status", bucket("pct", [75.0, 90.0], ["ok", "warn", "critical"]))


def latest_fetch(rows: DataFrame, at: str) -> DataFrame:
    """Rows of the newest fetch."""
    newest = rows.agg(F.max(at).alias("__newest"))
    return rows.join(F.broadcast(newest), F.col(at) == F.col("__newest"), "left_semi")


def within_horizon(rows: DataFrame, days: int, date: str = "date") -> DataFrame:
    """Rows of the last ``days`` days before the newest date of the data."""
    newest = rows.agg(F.max(date).alias("__newest"))
    return rows.join(F.broadcast(newest), F.col(date) >= F.date_sub("__newest", days), "left_semi")


def select_projects(rows: DataFrame, chosen: list[str] | str, project: str = "project") -> DataFrame:
    """``ALL`` keeps every row, ``NONE`` no row, a list its projects."""
    if chosen == "ALL":
        return rows
    if chosen == "NONE":
        return rows.where(F.lit(False))
    return rows.where(F.col(project).isin(*chosen))


def histogram(rows: DataFrame, value: str, bins: int) -> DataFrame:
    """Counts in ``bins`` equal intervals between the smallest and the largest value."""
    ends = F.broadcast(rows.agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi")))
    width = (F.col("hi") - F.col("lo")) / bins
    cell = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(F.least(F.lit(bins - 1), F.floor((F.col(value) - F.col("lo")) / width)))
    return rows.where(F.col(value).isNotNull()).crossJoin(ends).groupBy(cell.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def weekly_commits(commits: DataFrame) -> DataFrame:
    return commits.groupBy("project", iso_week("date").alias("iso_week"), monday("date").alias("week_start")).agg(
        F.count(F.lit(1)).alias("n_commits"), F.sum("lines_added").alias("lines_added"), F.sum("lines_deleted").alias("lines_deleted")
    )
