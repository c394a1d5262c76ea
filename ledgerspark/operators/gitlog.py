"""Commit analytics: churn, contributors, velocity, hotspots, growth, snapshots and project lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.functions.columns import iso_week, ratio, sum0
from ledgerspark.operators.quantiles import quantiles, with_columns_of


def latest_per_key(rows: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Rows of each key's newest snapshot; ties stay."""
    return rows.withColumn("__r", F.rank().over(Window.partitionBy(*keys).orderBy(F.desc(at)))).where(F.col("__r") == 1).drop("__r")


def last_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the last in file order."""
    w = Window.partitionBy(*keys).orderBy(*(F.desc_nulls_last(c) for c in order))
    return rows.withColumn("__r", F.row_number().over(w)).where(F.col("__r") == 1).drop("__r")


def commits_rollup(commits: DataFrame) -> DataFrame:
    """One row per (project, hash), its key built from both."""
    key = F.concat_ws("|", F.coalesce(F.col("project").cast("string"), F.lit("NA")), "hash")
    return last_per_key(commits.withColumn("commit_pk", key), ["commit_pk"], ["date", "lines_changed"])


def file_churn(files: DataFrame, top: int = 50) -> DataFrame:
    """Per project the files with the most commits: counts, lines, last date."""
    g = files.groupBy("project", "file").agg(
        F.count_distinct("hash").alias("n_commits"), sum0("added").alias("added"), sum0("deleted").alias("deleted"), sum0(F.col("added") + F.col("deleted")).alias("changed"), F.max("date").alias("last_date")
    )
    place = F.row_number().over(Window.partitionBy("project").orderBy(F.desc("n_commits"), F.desc("changed"), "file"))
    return g.withColumn("i", place).where(F.col("i") <= top).drop("i")


def contributors(commits: DataFrame, months: int = 6, top: int = 10) -> DataFrame:
    """Per project and author: commits ever and in the last months; the ``top`` authors have their share among themselves."""
    last = F.broadcast(commits.agg(F.max("date").alias("last")))
    c = commits.crossJoin(last)
    g = c.groupBy("project", "author").agg(F.count(F.lit(1)).alias("n_commits"), F.count_if(F.col("date") > F.add_months("last", -months)).alias("n_recent"))
    place = F.row_number().over(Window.partitionBy("project").orderBy(F.desc("n_commits"), "author"))
    leading = F.when(F.col("i") <= top, F.col("n_commits"))
    return g.withColumn("i", place).withColumn("share", F.round(leading / F.sum(leading).over(Window.partitionBy("project")), 6)).drop("i")


def velocity(commits: DataFrame) -> DataFrame:
    return commits.groupBy("project", F.date_format("date", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n_commits"))


def timing(rows: DataFrame, at: str) -> DataFrame:
    """Counts by (weekday, hour) over all pairs of observed levels."""
    r = rows.select(F.weekday(at).alias("weekday"), F.hour(at).alias("hour"))
    n = r.groupBy("weekday", "hour").agg(F.count(F.lit(1)).alias("n"))
    full = r.select("weekday").distinct().crossJoin(r.select("hour").distinct()).join(n, ["weekday", "hour"], "left")
    return full.select("weekday", "hour", F.coalesce("n", F.lit(0)).alias("n"))


def message_matches(commits: DataFrame, pattern: str, by: list[str], top: int | None = None) -> DataFrame:
    """Commits whose message fits a regular expression, counted by the given columns."""
    g = commits.where(F.col("message").rlike(f"(?i){pattern}")).groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    return g.orderBy(F.desc("n"), *by).limit(top) if top else g


def hotspots(files: DataFrame, months: int, top: int) -> DataFrame:
    """Files touched most in the last months of the data."""
    last = F.broadcast(files.agg(F.max("date").alias("last")))
    recent = files.join(last, F.col("date") > F.add_months("last", -months), "left_semi")
    return recent.groupBy("file").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "file").limit(top)


def debt_markers(lines: DataFrame, path: str, text: str, top: int = 20, markers: tuple[str, ...] = ("TODO", "FIXME", "HACK", "XXX")) -> DataFrame:
    """Lines that hold a marker, by file."""
    return lines.where(F.col(text).rlike(f"({'|'.join(markers)})")).groupBy(path).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), path).limit(top)


def commits_by_project(commits: DataFrame) -> DataFrame:
    one = commits.groupBy("project").agg(
        F.count(F.lit(1)).alias("n_commits"), F.round(F.avg("lines_changed"), 6).alias("mean_lines"), sum0("lines_added").alias("added"), sum0("lines_deleted").alias("deleted"),
    )
    q = quantiles(commits, ["project"], "lines_changed", [0.5])
    return with_columns_of(one, q, ["project"]).select("project", "n_commits", F.col("q")[0].alias("median_lines"), "mean_lines", "added", "deleted")


def rolling_growth(commits: DataFrame, months: int = 6) -> DataFrame:
    """At each month's start A: lines added and deleted in (A - months, A].

    Each commit belongs to ``months`` anchors at most, so it is exploded into
    these and summed: no range join.
    """
    ends = F.broadcast(commits.agg(F.trunc(F.min("date"), "month").alias("lo"), F.trunc(F.max("date"), "month").alias("hi")))
    first = F.when(F.col("date") == F.trunc("date", "month"), F.trunc("date", "month")).otherwise(F.add_months(F.trunc("date", "month"), 1))
    c = commits.crossJoin(ends).withColumn("anchor", F.explode(F.transform(F.sequence(F.lit(0), F.lit(months)), lambda k: F.add_months(first, k))))
    c = c.where((F.col("anchor") >= F.col("lo")) & (F.col("anchor") <= F.col("hi")) & (F.col("date") > F.add_months("anchor", -months)) & (F.col("date") <= F.col("anchor")))
    return c.groupBy("anchor").agg(sum0("lines_added").alias("added"), sum0("lines_deleted").alias("deleted"))


def project_metrics(commits: DataFrame, files: DataFrame) -> DataFrame:
    """Metrics of each project in long form: (project, period, period_label, metric, value).

    Each table is aggregated once to narrow groups, commits to (author, date)
    and files to (file, hash).  Every group names the metrics that it counts
    for, and these rows are summed.
    """
    all_ = F.lit("all")

    def entry(period: str, label, metric: str, value, when=None):
        row = F.struct(F.lit(period).alias("period"), label.cast("string").alias("period_label"), F.lit(metric).alias("metric"), value.cast("double").alias("v"))
        return row if when is None else F.when(when, row)

    def entries(df: DataFrame, *rows) -> DataFrame:
        return df.select("project", F.inline(F.filter(F.array(*rows), lambda r: r.isNotNull())))

    fix = F.col("message").rlike("(?i)fix|revert|hotfix")
    by_day = commits.groupBy("project", "author", "date").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(fix).alias("fixes"), F.sum(F.length("message")).alias("chars"), F.count("message").alias("messages"), sum0("lines_changed").alias("changed"),
    )
    newest = F.broadcast(commits.agg(F.max("date").alias("last")))
    c = entries(
        by_day.join(newest),
        entry("day", F.col("date"), "commits", F.col("n")), entry("week", iso_week("date"), "commits", F.col("n")), entry("month", F.date_format("date", "yyyy-MM"), "commits", F.col("n")),
        entry("total", all_, "commits_total", F.col("n")), entry("author", F.col("author"), "commits_by_author", F.col("n")), entry("total", all_, "firefighting", F.col("fixes"), F.col("fixes") > 0),
        entry("total", all_, "message_length", F.col("chars")), entry("total", all_, "messages", F.col("messages")), entry("total", all_, "lines_changed", F.col("changed")),
        entry("total", all_, "last_commit", F.datediff("date", F.lit("1970-01-01").cast("date"))), entry("total", all_, "commits_last_week", F.col("n"), F.col("date") > F.date_sub("last", 7)),
    )
    newest_file = F.broadcast(files.agg(F.max("date").alias("last")))
    recent = F.col("date") > F.add_months("last", -6)
    grown = F.col("added") > F.col("deleted")
    touched = files.join(newest_file).groupBy("project", "file", "hash").agg(
        F.count(F.lit(1)).alias("n"), sum0("added").alias("added"), sum0("deleted").alias("deleted"), F.count_if(recent).alias("recent"),
        F.count_if(recent & grown).alias("grown"), F.count_if(recent & ~grown).alias("shrunk"), sum0(F.col("added") + F.col("deleted")).alias("both"),
    )
    lately = F.col("recent") > 0
    f = entries(
        touched,
        entry("file", F.col("file"), "churn", F.col("n")), entry("6m", F.lit("growth"), "files_added", F.col("grown"), lately), entry("6m", F.lit("cleanup"), "files_deleted", F.col("shrunk"), lately),
        entry("6m", F.lit("net"), "files_net", F.col("grown") - F.col("shrunk"), lately), entry("6m", F.col("file"), "hotspot", F.col("recent"), lately), entry("6m", F.col("file"), "commits_per_hot_file", F.lit(1), lately),
        entry("total", F.substring_index("file", "#", 1), "lines_by_kind", F.col("both")), entry("total", all_, "lines_of_code", F.col("added") - F.col("deleted")),
    )
    keys = ["project", "period", "period_label", "metric"]
    summed = c.unionByName(f).groupBy(*keys).agg(F.sum("v").alias("v"), F.max("v").alias("top"))
    # one row per project, author or file: what is counted or divided over these
    project = summed.groupBy("project").agg(
        F.count(F.when(F.col("metric") == "commits_by_author", F.col("period_label"))).alias("authors"), F.count(F.when(F.col("metric") == "hotspot", F.col("period_label"))).alias("active"),
        *(F.max(F.when(F.col("metric") == m, F.col("v"))).alias(m) for m in ("message_length", "messages", "commits_total")),
    ).select("project", F.inline(F.filter(F.array(
        entry("total", all_, "contributors", F.col("authors"), F.col("commits_total").isNotNull()), entry("6m", all_, "active_files", F.col("active"), F.col("active") > 0),
        entry("total", all_, "message_length", F.round(F.try_divide("message_length", "messages"), 4), F.col("commits_total").isNotNull()),
    ), lambda r: r.isNotNull())))
    value = F.when(F.col("metric") == "last_commit", F.col("top")).otherwise(F.col("v"))
    rows = summed.where(~F.col("metric").isin("message_length", "messages")).select(*keys, value.alias("value"))
    return rows.unionByName(project.withColumnRenamed("v", "value"))


def pivot_metrics(long: DataFrame, keys: list[str], by: str, names: list[str], fill: float | None = None) -> DataFrame:
    """Long metrics of the given names as columns."""
    out = long.groupBy(*keys).pivot(by, names).agg(F.max("value"))
    return out.na.fill(fill, names) if fill is not None else out


def project_list(sources: dict[str, DataFrame], denied: tuple[str, ...] = ()) -> DataFrame:
    """Projects of all sources with how many know them and the first and last date."""
    rows = reduce(DataFrame.unionByName, [df.select(F.lit(n).alias("source"), F.col("project").cast("string").alias("project"), "date") for n, df in sources.items()])
    g = rows.where(F.col("project").isNotNull() & ~F.lower("project").isin(*(d.lower() for d in denied) if denied else [""]))
    return g.groupBy("project").agg(F.count_distinct("source").alias("n_sources"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def share_of(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.round(ratio(F.sum(value), F.count(F.lit(1))), 6).alias("share"))
