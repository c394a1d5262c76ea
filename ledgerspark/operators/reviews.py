"""Review lifecycle analytics: backlog, resolution, noise, trends, hotspots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.functions.columns import SEVERITIES, any_regex, bucket, hours_between, is_in, monday, one_of, rank_in, ratio, ratio1, sum0
from ledgerspark.operators.quantiles import quantiles, with_columns_of
from ledgerspark.operators.usage import long_form

AGES = ([24.0, 72.0, 168.0, 336.0], ["<24h", "1-3d", "3-7d", "7-14d", "14d+"])
FIX_HOURS = ([2.0, 4.0, 8.0, 16.0], ["<2", "2-4", "4-8", "8-16", "16+"])


def resolved() -> Column:
    """A non-empty close reason."""
    return F.coalesce(F.col("close_reason") != "", F.lit(False))


def now_of(now: str) -> Column:
    return F.lit(now).cast("timestamp")


def findings_view(lifecycle: DataFrame) -> DataFrame:
    """Lifecycle rows as findings: severity and verdict normalised, resolved_at from closed_at."""
    verdict = F.when(F.col("verdict") == "P", "pass").when(F.col("verdict") == "F", "fail").otherwise("unknown")
    return lifecycle.select(
        F.col("review_id").alias("finding_id"), "repo", one_of("severity", SEVERITIES).alias("severity"), verdict.alias("verdict"),
        F.concat_ws(" ", F.lit("review"), F.col("review_id").cast("string"), F.lit("on"), "repo").alias("summary"), F.col("created_at").alias("found_at"), F.col("closed_at").alias("resolved_at"),
    )


def pulse(lifecycle: DataFrame, loops: DataFrame, now: str) -> DataFrame:
    """One row: open and resolved reviews, severities among the open, the last 24 hours, loops."""
    day = lambda c: F.col(c).between(now_of(now) - F.expr("INTERVAL 24 HOURS"), now_of(now))
    one = lifecycle.agg(
        F.count_if(~resolved()).alias("n_open"), F.count_if(resolved()).alias("n_resolved"),
        *(F.count_if(~resolved() & (F.col("severity") == s)).alias(f"n_{s}") for s in SEVERITIES),
        F.count_if(day("created_at")).alias("new_24h"), F.count_if(day("fix_commit_at")).alias("fix_linked_24h"), F.count_if(day("closed_at")).alias("closed_24h"),
    )
    l = loops.agg(F.count(F.lit(1)).alias("n_loops"), F.count_if(F.col("tier") == "escalate").alias("n_escalated"), F.round(sum0("estimated_wasted_usd"), 6).alias("wasted_usd"))
    return one.crossJoin(l)


def by_repo(lifecycle: DataFrame, aliases: tuple[tuple[str, str], ...] = ()) -> DataFrame:
    """Reviews per repository after folding aliases."""
    repo = F.col("repo")
    for a, b in aliases:
        repo = F.when(repo == a, F.lit(b)).otherwise(repo)
    return lifecycle.groupBy(repo.alias("repo")).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("severity").isin("high", "critical")).alias("high_critical"), F.count_if(resolved()).alias("resolved"), F.count_if(~resolved()).alias("open")
    )


def resolution_rate(lifecycle: DataFrame) -> DataFrame:
    """Share of resolved reviews, overall (week NULL) and by Monday week of creation."""
    aggs = [F.count(F.lit(1)).alias("total"), F.count_if(resolved()).alias("resolved")]
    weekly = lifecycle.groupBy(monday("created_at").alias("week")).agg(*aggs)
    out = weekly.unionByName(lifecycle.agg(F.lit(None).cast("date").alias("week"), *aggs))
    return out.withColumn("rate", F.round(ratio("resolved", "total"), 6))


def agent_performance(performance: DataFrame) -> DataFrame:
    """Sums per agent, pass rate, and cost per review where any cost is known."""
    g = performance.groupBy("agent").agg(sum0("n_runs").alias("n_runs"), sum0("pass_count").alias("passed"), sum0("fail_count").alias("failed"), sum0("error_count").alias("errors"), sum0("total_cost").alias("cost"))
    return g.select("agent", "n_runs", "passed", "failed", "errors", F.round("cost", 6).alias("cost"), F.round(ratio("passed", "n_runs"), 6).alias("pass_rate"), F.round(F.when(F.col("cost") > 0, F.col("cost") / F.col("n_runs")), 6).alias("cost_per_review"))


def backlog_age(lifecycle: DataFrame, now: str) -> DataFrame:
    """Hours open of unresolved reviews: median, p90, largest."""
    open_ = lifecycle.where(~resolved()).select(hours_between("created_at", now_of(now)).alias("hours"))
    q = F.broadcast(quantiles(open_, [], "hours", [0.5, 0.9]))  # one row
    one = open_.agg(F.count(F.lit(1)).alias("n"), F.max("hours").alias("most")).crossJoin(q)
    return one.select("n", F.round(F.col("q")[0], 6).alias("median_h"), F.round(F.col("q")[1], 6).alias("p90_h"), F.round("most", 6).alias("max_h"))


def backlog_buckets(lifecycle: DataFrame, now: str) -> DataFrame:
    """Unresolved reviews by age; every bucket is listed."""
    age = bucket(hours_between("created_at", now_of(now)), *AGES)
    n = lifecycle.where(~resolved()).groupBy(age.alias("age")).agg(F.count(F.lit(1)).alias("n"))
    spine = lifecycle.sparkSession.createDataFrame([(x,) for x in AGES[1]], "age string")
    return F.broadcast(spine).join(n, "age", "left").select("age", F.coalesce("n", F.lit(0)).alias("n"))


def oldest_open(lifecycle: DataFrame, now: str, k: int = 10) -> DataFrame:
    hours = F.round(hours_between("created_at", now_of(now)), 4)
    return lifecycle.where(~resolved()).select("review_id", "repo", hours.alias("hours_open")).orderBy(F.desc("hours_open"), "review_id").limit(k)


def window_metrics(lifecycle: DataFrame, now: str, days: tuple[int, ...] = (1, 3, 7, 14)) -> DataFrame:
    """Per window of days before ``now``: totals, rate, severities, verdict split, hours to close.

    Each row is exploded into the windows it belongs to and grouped once.
    Hours count only where the review closed at or after its creation.
    """
    age = hours_between("created_at", now_of(now)) / 24
    spans = F.filter(F.array(*map(F.lit, days)), lambda d: (age >= 0) & (age <= d))
    r = lifecycle.withColumn("window_days", F.explode(spans))
    h = hours_between("created_at", "closed_at")
    h = F.when(h >= 0, h)
    fixed = F.col("close_reason") == "fix_linked"
    q = quantiles(r, ["window_days"], h, [0.5, 0.9, 0.99])
    one = r.groupBy("window_days").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(resolved()).alias("resolved"), F.round(ratio(F.count_if(resolved()), F.count(F.lit(1))), 6).alias("rate"),
        *(F.count_if(F.col("severity") == s).alias(f"n_{s}") for s in SEVERITIES),
        F.count_if(fixed).alias("n_fixed"), F.count_if(resolved() & ~fixed).alias("n_wontfix"), F.count_if(~resolved()).alias("n_open"),
    )
    return with_columns_of(one, q, ["window_days"]).withColumns({f"p{p}_h": F.round(F.col("q")[k], 6) for k, p in enumerate((50, 90, 99))}).drop("q")


def window_outliers(lifecycle: DataFrame, now: str, days: tuple[int, ...] = (1, 3, 7, 14), k: int = 10) -> DataFrame:
    """The k oldest open reviews of each window."""
    age = hours_between("created_at", now_of(now)) / 24
    r = lifecycle.where(~resolved()).withColumn("window_days", F.explode(F.filter(F.array(*map(F.lit, days)), lambda d: (age >= 0) & (age <= d))))
    place = F.row_number().over(Window.partitionBy("window_days").orderBy("created_at", "review_id"))
    return r.withColumn("place", place).where(F.col("place") <= k).select("window_days", "place", "review_id")


def period_deltas(lifecycle: DataFrame, now: str, days: int = 7) -> DataFrame:
    """This period, the one before, and their differences."""
    age = hours_between("created_at", now_of(now)) / 24
    h = hours_between("created_at", "closed_at")

    periods = {"now": (age >= 0) & (age < days), "before": (age >= days) & (age < 2 * days)}

    def metrics(inside: Column, tag: str) -> list[Column]:
        return [
            F.round(ratio(F.count_if(inside & resolved()), F.count_if(inside)), 6).alias(f"rate_{tag}"),
            F.count_if(inside & (F.col("severity") == "critical")).alias(f"critical_{tag}"), F.count_if(inside & (F.col("severity") == "high")).alias(f"high_{tag}"),
        ]

    one = lifecycle.agg(*(m for tag, inside in periods.items() for m in metrics(inside, tag)))
    of = F.when(periods["now"], "now").when(periods["before"], "before")
    q = quantiles(lifecycle.where(of.isNotNull()).select(of.alias("tag"), F.when(h >= 0, h).alias("h")), ["tag"], "h", [0.5])
    medians = q.agg(*(F.round(F.max(F.when(F.col("tag") == tag, F.col("q")[0])), 6).alias(f"median_h_{tag}") for tag in periods))
    one = one.crossJoin(F.broadcast(medians)).select(*(f"{m}_{tag}" for tag in periods for m in ("rate", "median_h", "critical", "high")))
    return one.select("*", *(F.round(F.col(f"{m}_now") - F.col(f"{m}_before"), 6).alias(f"{m}_delta") for m in ("rate", "median_h", "critical", "high")))


def open_trend(lifecycle: DataFrame, last: str, days: int, by: str | None = None, reason: str | None = None) -> DataFrame:
    """Per day (and key): opened, closed, and open at the day's end, on a spine of ``days`` days.

    Every row opens on the day of its creation and closes on that of its
    closing, where a ``reason`` column is named only if that is not empty.  A row
    is open at the end of the days from the one to the day before the other:
    +1 and -1 in a running sum over daily counts, never a join of days to rows.
    """
    keys = [by] if by else []
    shut = F.col("closed_at").isNotNull()
    if reason:
        shut = shut & F.coalesce(F.col(reason) != "", F.lit(False))
    r = lifecycle.select(*keys, F.to_date("created_at").alias("c"), F.when(shut, F.to_date("closed_at")).alias("x"))
    spans = (F.col("c").isNotNull() & (F.col("x").isNull() | (F.col("x") > F.col("c")))).cast("int")
    day = lambda date, opened, closed, net: F.struct(date.alias("date"), F.lit(opened).alias("opened"), F.lit(closed).alias("closed"), net.alias("net"))
    ends = r.select(*keys, F.inline(F.array(day(F.col("c"), 1, 0, spans), day(F.col("x"), 0, 1, -spans)))).where(F.col("date").isNotNull())
    daily = ends.groupBy(*keys, "date").agg(F.sum("opened").alias("opened"), F.sum("closed").alias("closed"), F.sum("net").alias("net"))
    spine = lifecycle.sparkSession.range(1).select(F.explode(F.sequence(F.date_sub(F.lit(last).cast("date"), days - 1), F.lit(last).cast("date"))).alias("date"))
    if by:
        spine = spine.crossJoin(lifecycle.select(by).distinct())
    daily = daily.join(spine.withColumn("__in", F.lit(True)), [*keys, "date"], "full")
    run = Window.partitionBy(*keys) if by else Window.partitionBy()
    daily = daily.withColumn("open_at_end", F.sum(F.coalesce("net", F.lit(0))).over(run.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)))
    return daily.where("__in").select(*keys, "date", F.coalesce("opened", F.lit(0)).alias("opened"), F.coalesce("closed", F.lit(0)).alias("closed"), "open_at_end")


def signal_noise(daily: DataFrame) -> DataFrame:
    """Per repository: passed and failed over created."""
    g = daily.groupBy("repo").agg(sum0("created").alias("created"), sum0("passed").alias("passed"), sum0("failed").alias("failed"))
    return g.select("*", F.round(ratio1("passed", "created"), 6).alias("signal"), F.round(ratio1("failed", "created"), 6).alias("noise"))


def noise_split(daily: DataFrame) -> DataFrame:
    """Per day, with running totals: passed, actioned failures, automatic closures, parse failures."""
    auto = F.col("autoclosed_severity") + F.col("autoclosed_age")
    actioned = F.greatest(F.lit(0), F.col("failed") - auto - F.col("parse_fail"))
    g = daily.groupBy("date").agg(sum0("passed").alias("passed"), sum0(actioned).alias("actioned"), sum0(auto).alias("autoclosed"), sum0("parse_fail").alias("parse_fail"))
    run = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return g.select("*", *(F.sum(c).over(run).alias(f"{c}_total") for c in ("passed", "actioned", "autoclosed", "parse_fail")))


def suppression(daily: DataFrame, since: str, k: int = 5) -> DataFrame:
    """The k repositories with the most automatic closures since a date, against their created reviews (may exceed 1)."""
    g = daily.where(F.col("date") >= F.lit(since).cast("date")).groupBy("repo").agg(sum0(F.col("autoclosed_severity") + F.col("autoclosed_age")).alias("suppressed"), sum0("created").alias("created"))
    return g.orderBy(F.desc("suppressed"), "repo").limit(k).withColumn("ratio", F.round(ratio1("suppressed", "created"), 6))


def before_after(daily: DataFrame, split: str) -> DataFrame:
    """Daily metrics summed before and after a date, with means a day."""
    side = F.when(F.col("date") < F.lit(split).cast("date"), F.lit("before")).otherwise(F.lit("after"))
    g = daily.groupBy(side.alias("period")).agg(F.count_distinct("date").alias("days"), *(sum0(c).alias(c) for c in ("created", "passed", "failed")))
    return g.select("*", F.round(ratio("created", "days"), 6).alias("created_per_day"), F.round(ratio("passed", "created"), 6).alias("pass_rate"))


def threshold_history(changes: DataFrame, daily: DataFrame) -> DataFrame:
    """Per date the most common new threshold (ties: the smallest), with the day's automatic closures."""
    n = changes.where(F.coalesce(F.col("new_threshold") != "", F.lit(False))).groupBy("date", "new_threshold").agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy("date").orderBy(F.desc("n"), "new_threshold"))
    top = n.withColumn("i", place).where(F.col("i") == 1).select("date", "new_threshold")
    auto = daily.groupBy("date").agg(sum0(F.col("autoclosed_severity") + F.col("autoclosed_age")).alias("autoclosed"))
    return auto.join(top, "date", "left").select("date", "new_threshold", "autoclosed")


def findings_per_commit(rows: DataFrame, k: int = 10) -> DataFrame:
    """The k (commit, repo) pairs with the most findings, with their first message; empty shas are left out first."""
    r = rows.where(F.coalesce(F.col("commit_sha") != "", F.lit(False)))
    first = F.min(F.struct("created_at", "message"))["message"] if "message" in rows.columns else F.lit(None).cast("string")
    g = r.groupBy("commit_sha", "repo").agg(F.count(F.lit(1)).alias("n"), F.max("created_at").alias("last_at"), first.alias("message"))
    return g.orderBy(F.desc("n"), "commit_sha", "repo").limit(k)


def findings_per_file(locations: DataFrame, sensitive: tuple[str, ...], k: int = 50) -> DataFrame:
    """The k files with the most findings: repositories, last seen, severities; private and absolute paths are left out."""
    r = locations.where(F.col("file_path").isNotNull() & ~F.col("file_path").startswith("/") & ~any_regex("file_path", sensitive))
    g = r.groupBy("file_path").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("repo").alias("n_repos"), F.max("seen").alias("last_seen"), *(F.count_if(F.col("severity") == s).alias(f"n_{s}") for s in ("high", "medium", "low")))
    return g.orderBy(F.desc("n"), "file_path").limit(k)


def time_to_fix(lifecycle: DataFrame, methods: tuple[str, ...] = ("commit_reference", "time_window")) -> DataFrame:
    """Hours from creation to the fixing commit."""
    r = lifecycle.where(is_in("fix_method", methods) & F.col("created_at").isNotNull() & F.col("fix_commit_at").isNotNull())
    h = F.round(hours_between("created_at", "fix_commit_at"), 2)
    return r.select("review_id", "fix_method", h.alias("hours"), bucket(h, *FIX_HOURS).alias("bucket"))


#: The fix methods of each kind of closing; ``unknown`` is also no method at all.
CLOSURES = {"fix_linked": ("manual", "commit_reference"), "autoclose": ("autoclose_severity",), "unknown": ("unknown",)}


def closure_breakdown(lifecycle: DataFrame) -> DataFrame:
    """Closed reviews by kind of closing, as percentages of all closed ones; other methods count for none."""
    closed = lifecycle.where(F.col("closed_at").isNotNull())
    method = F.coalesce("fix_method", F.lit("unknown"))
    one = closed.agg(*(F.count_if(method.isin(*m)).alias(k) for k, m in CLOSURES.items()), F.count(F.lit(1)).alias("__n"))
    rows = F.array(*(F.struct(F.lit(k).alias("reason"), F.col(k).alias("n")) for k in CLOSURES))
    return one.select("__n", F.inline(rows)).select("reason", "n", F.round(F.coalesce(100 * ratio("n", "__n"), F.lit(0.0)), 1).alias("pct"))


def closing_funnel(lifecycle: DataFrame) -> DataFrame:
    """Created, closed, linked to a fix, linked by a commit's reference."""
    one = lifecycle.agg(
        F.count(F.lit(1)).alias("created"), F.count_if(F.col("closed_at").isNotNull()).alias("closed"), F.count_if(F.col("fix_commit_sha").isNotNull()).alias("fix_linked"),
        F.count_if(F.col("fix_method") == "commit_reference").alias("commit_reference"),
    )
    return long_form(one, ["created", "closed", "fix_linked", "commit_reference"]).select(F.col("metric").alias("stage"), F.col("value").cast("long").alias("n"))


def self_review_counts(findings: DataFrame, by: list[str]) -> DataFrame:
    return findings.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def top_files(findings: DataFrame, n: int) -> DataFrame:
    """Files with the most open findings and their worst severity; all findings if none is open."""
    any_open = F.broadcast(findings.agg(F.count_if(F.col("resolved_at").isNull()).alias("__open")))
    r = findings.crossJoin(any_open).where((F.col("__open") == 0) | F.col("resolved_at").isNull())
    g = r.groupBy("primary_file").agg(F.count(F.lit(1)).alias("n"), F.max(rank_in("severity", SEVERITIES)).alias("worst"))
    name = F.element_at(F.array(*map(F.lit, SEVERITIES)), F.col("worst"))
    return g.orderBy(F.desc("n"), "primary_file").limit(n).select("primary_file", "n", F.when(F.col("worst").isNotNull(), name).alias("worst"))


def inflow_outflow(findings: DataFrame, since: str) -> DataFrame:
    """Found and resolved by Monday week from a date on; every week between is listed."""
    f = findings.where(F.col("found_at") >= F.lit(since).cast("timestamp")).groupBy(monday("found_at").alias("week")).agg(F.count(F.lit(1)).alias("found"))
    r = findings.where(F.col("resolved_at") >= F.lit(since).cast("timestamp")).groupBy(monday("resolved_at").alias("week")).agg(F.count(F.lit(1)).alias("resolved"))
    both = f.join(r, "week", "full")
    spine = both.agg(F.min("week").alias("a"), F.max("week").alias("b")).where(F.col("a").isNotNull()).select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 7 DAYS"))).alias("week"))
    return spine.join(both, "week", "left").select("week", F.coalesce("found", F.lit(0)).alias("found"), F.coalesce("resolved", F.lit(0)).alias("resolved"))


def resolution_time(findings: DataFrame) -> DataFrame:
    """Median hours to resolve by severity."""
    done = findings.where(F.col("resolved_at").isNotNull()).select("severity", hours_between("found_at", "resolved_at").alias("h"))
    q = quantiles(done, ["severity"], "h", [0.5])
    return with_columns_of(done.groupBy("severity").agg(F.count(F.lit(1)).alias("n")), q, ["severity"]).select("severity", "n", F.round(F.col("q")[0], 6).alias("median_h"))


def pulse_table(findings: DataFrame, loops: DataFrame) -> DataFrame:
    """Nine metrics in long form."""
    f = findings.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("resolved_at").isNull()).alias("open"), F.count_if(F.col("resolved_at").isNotNull()).alias("resolved"),
        *(F.count_if(F.col("resolved_at").isNull() & (F.col("severity") == s)).alias(f"open_{s}") for s in SEVERITIES),
    )
    l = loops.agg(F.count(F.lit(1)).alias("loops"), F.count_if(F.col("tier") == "escalate").alias("escalated"))
    names = ["total", "open", "resolved", *(f"open_{s}" for s in SEVERITIES), "loops", "escalated"]
    return long_form(f.crossJoin(l), names).select("metric", F.col("value").cast("long").alias("value"))


def recent_activity(findings: DataFrame, since: str) -> DataFrame:
    """Findings found or resolved since a time, newest first."""
    at = F.greatest("found_at", "resolved_at")
    hit = lambda c: F.coalesce(F.col(c) >= F.lit(since).cast("timestamp"), F.lit(False))
    return findings.where(hit("found_at") | hit("resolved_at")).withColumn("at", at).orderBy(F.desc("at"), "finding_id")


def loop_table(loops: DataFrame) -> DataFrame:
    return loops.select("content_hash", "severity", "primary_file", "summary", "cycles", "tier").orderBy(F.desc("cycles"), "content_hash")


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
