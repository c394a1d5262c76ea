"""Joins of sessions, costs, commits, turns and reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.functions.columns import bucket, jaccard, period, ratio, sum0, token_set
from ledgerspark.functions.identifiers import canonical_project  # noqa: F401
from ledgerspark.operators.lineage import stage
from ledgerspark.operators.quantiles import quantiles, with_columns_of


#: Commits, and sessions, of a project and day that meet in one block; a task makes about SIDE * SIDE rows, beyond TASKS tasks more.
SIDE, TASKS = 2**13, 2**15


def session_commits(sessions: DataFrame, commits: DataFrame) -> DataFrame:
    """Commits of a session's project on its days, both ends included; NULL ends exclude a session.

    An equi-join on project and day: every pair that meets is a row of the
    result, and a session has a row for each of its days between the first and
    the last commit.  The result grows with the product of a day's sessions and
    commits, so these are counted first.  Tasks are as many as the result's rows
    ask for, and a busy day is cut into blocks of about ``SIDE`` commits by
    ``SIDE`` sessions that different tasks take: one holds a block's sessions,
    and a row is repeated once for ``SIDE`` rows of the result at most.  Rows
    that are equal in all columns stay in one block.
    """
    c = commits.where(F.col("project").isNotNull() & F.col("date").isNotNull())
    made = stage(c.groupBy("project", "date").agg(F.count(F.lit(1)).alias("c")), "commit-days")
    first, last = (F.lit(d).cast("date") for d in made.agg(F.min("date"), F.max("date")).first())
    s = sessions.where((F.col("end_date") >= F.col("start_date")) & (F.col("start_date") <= last) & (F.col("end_date") >= first))
    s = s.withColumn("__d", F.explode(F.sequence(F.greatest("start_date", first), F.least("end_date", last)))).withColumnRenamed("project", "__p")
    met = made.join(s.groupBy(F.col("__p").alias("project"), F.col("__d").alias("date")).agg(F.count(F.lit(1)).alias("s")), ["project", "date"])
    parts = lambda n: F.ceil(F.col(n) / SIDE)
    met = stage(met.select("project", "date", "c", "s", parts("c").alias("__a"), parts("s").alias("__b")), "session-commit-days")
    rows, most = met.agg(F.sum(F.col("c") * F.col("s")), F.sum("c")).first()
    # few commits a task leave few names in a file's dictionary
    tasks = min(-(-max(rows or 0, (most or 0) * SIDE // 4) // SIDE**2), TASKS)
    busy = F.broadcast(met.where((F.col("__a") > 1) | (F.col("__b") > 1)).select(F.col("project").alias("__q"), F.col("date").alias("__e"), "__a", "__b"))  # one for SIDE rows at most

    def dealt(x: DataFrame, project: str, day: str, own: str, blocks) -> DataFrame:
        part = F.pmod(F.xxhash64(*x.columns), F.coalesce(own, F.lit(1)))
        x = x.join(busy, (F.col(project) == F.col("__q")) & (F.col(day) == F.col("__e")), "left").withColumn("__i", part)
        x = x.withColumn("__k", F.explode(blocks(F.col("__i"), F.coalesce("__a", F.lit(1)), F.coalesce("__b", F.lit(1))))).drop("__q", "__e", "__a", "__b", "__i")
        return x.repartition(tasks, project, day, "__k") if tasks > 1 else x

    c = dealt(c, "project", "date", "__a", lambda i, a, b: F.sequence(i * b, i * b + b - 1))
    s = dealt(s, "__p", "__d", "__b", lambda j, a, b: F.sequence(j, (a - 1) * b + j, b)).withColumnRenamed("__k", "__m")
    on = (F.col("project") == F.col("__p")) & (F.col("date") == F.col("__d")) & (F.col("__k") == F.col("__m"))
    return c.join(s.hint("merge"), on).drop("__p", "__d", "__k", "__m")


#: Widths in days of the blocks by which counts are summed.
WIDTHS = (1, 32, 1024)


def _blocks_of(a: Column, b: Column, widths: tuple[int, ...] = WIDTHS) -> Column:
    """The days from number a to b as an array of (w, k), block k of w days: whole blocks inside, narrower ones at the ends."""
    w, *wider = widths
    none = F.array().cast("array<struct<w:int,k:bigint>>")
    each = lambda lo, hi: F.when(lo <= hi, F.transform(F.sequence(lo, hi), lambda k: F.struct(F.lit(w).alias("w"), k.alias("k")))).otherwise(none)
    if not wider:
        return each(a, b)
    step = wider[0] // w
    lo, hi = F.ceil(a / step), F.floor((b + 1) / step) - 1
    return F.when(lo <= hi, F.concat(each(a, lo * step - 1), _blocks_of(lo, hi, tuple(wider)), each((hi + 1) * step, b))).otherwise(each(a, b))


def findings_per_session(sessions: DataFrame, commits: DataFrame, reviews: DataFrame) -> DataFrame:
    """Reviews of the commits in each session of positive length; sessions without any are left out.

    A commit counts once a day, so a session's number is the sum of its days'
    numbers.  These are counted first, by project and block of days; a session
    meets the few blocks that it consists of, and never a commit.
    """
    number = lambda d: F.datediff(F.col(d), F.lit("1970-01-01").cast("date")).cast("long")
    r = reviews.groupBy(F.col("commit_sha").alias("__sha")).agg(F.count("review_id").alias("n"))
    c = commits.select("project", "date", "commit_sha").distinct()
    days = c.join(r, F.col("commit_sha") == F.col("__sha")).groupBy("project", number("date").alias("d")).agg(F.sum("n").alias("n"))
    of = F.array(*(F.struct(F.lit(w).alias("w"), F.floor(F.col("d") / w).alias("k")) for w in WIDTHS))
    blocks = days.select("project", F.inline(of), "n").groupBy("project", "w", "k").agg(F.sum("n").alias("n"))
    s = sessions.where((F.col("duration_min") > 0) & (F.col("end_date") >= F.col("start_date")))
    s = s.select("session_id", "duration_min", "project", F.inline(_blocks_of(number("start_date"), number("end_date"))))
    out = s.join(blocks, ["project", "w", "k"]).groupBy("session_id", "duration_min").agg(F.sum("n").alias("n_findings"))
    return out.where(F.col("n_findings") > 0).select("session_id", F.round(F.col("duration_min") / 60, 3).alias("hours"), "n_findings")


def cost_per_commit_day(costs: DataFrame, commits: DataFrame) -> DataFrame:
    """Cost over commits per project and day that has both."""
    c = costs.groupBy("project", "date").agg(F.sum("cost").alias("cost"))
    n = commits.groupBy("project", "date").agg(F.count(F.lit(1)).alias("n_commits"))
    out = c.join(n, ["project", "date"]).where((F.col("n_commits") > 0) & F.col("cost").isNotNull())
    return out.select("project", "date", F.round("cost", 4).alias("cost"), "n_commits", F.round(F.col("cost") / F.col("n_commits"), 4).alias("cost_per_commit"))


def cost_per_commit_period(costs: DataFrame, commits: DataFrame, grain: str, projects: list | None = None, since: str | None = None, digits: int = 2) -> DataFrame:
    """Cost per commit by day, week or month; the start date limits the cost side only."""
    if projects is not None:
        costs, commits = (x.where(F.col("project").isin(*projects)) for x in (costs, commits))
    if since:
        costs = costs.where(F.col("date") >= F.lit(since).cast("date"))
    c = costs.groupBy(period("date", grain).alias("period")).agg(F.sum("cost").alias("cost"))
    n = commits.groupBy(period("date", grain).alias("period")).agg(F.count(F.lit(1)).alias("n_commits"))
    return c.join(n, "period").select("period", F.round("cost", digits).alias("cost"), "n_commits", F.round(ratio("cost", "n_commits"), digits).alias("cost_per_commit"))


def reconcile(provider: DataFrame, other: DataFrame) -> DataFrame:
    """Daily totals of two sources: primary is the provider's where it has the day; the deficit is relative to the other."""
    p = provider.groupBy("date").agg(F.sum("cost").alias("p"))
    c = other.groupBy("date").agg(F.sum("cost").alias("c"))
    both = p.join(c, "date", "full")
    cross = F.when(F.col("p").isNotNull(), F.col("c"))
    return both.select(
        "date", F.round(F.coalesce("p", "c"), 4).alias("primary_cost"), F.round(cross, 4).alias("cross_check"),
        F.round(F.when(cross != 0, (F.col("p") - F.col("c")) / F.col("c") * 100), 1).alias("deficit_pct"),
    )


def attribute(day_totals: DataFrame, sessions: DataFrame, values: list[str], digits: int, project="project") -> DataFrame:
    """Day totals shared among projects by their sessions' minutes, summed per (date, project).

    Sessions without minutes do not count; NULL projects are dropped after the
    shares are taken.
    """
    s = sessions.where(F.col("duration_min").isNotNull()).groupBy("date", "project").agg(F.sum("duration_min").alias("minutes"))
    s = s.withColumn("share", ratio("minutes", F.sum("minutes").over(Window.partitionBy("date"))))
    j = s.join(day_totals, "date").where(F.col("share").isNotNull())
    est = {f"est_{v}": F.round(F.col(v) * F.col("share"), digits) for v in values}
    key = project if not isinstance(project, str) else F.col(project)
    out = j.withColumns(est).withColumn("project", key).where(F.col("project").isNotNull()).groupBy("date", "project")
    return out.agg(*(F.round(F.sum(f"est_{v}"), max(digits, 4)).alias(f"est_{v}") for v in values), F.round(F.sum("minutes"), 4).alias("minutes"), F.round(F.sum("share"), 6).alias("share"))


def tag_by_review(turns: DataFrame, jobs: DataFrame, session: str) -> DataFrame:
    """Turns of a session with a review job are ``review``, others ``interactive``; the match decides, not the job's repo."""
    first = jobs.groupBy(session).agg(F.min("repo").alias("repo")).withColumn("__match", F.lit(True))
    return turns.join(first, session, "left").withColumn("source", F.when(F.col("__match"), F.lit("review")).otherwise(F.lit("interactive"))).drop("__match")


def first_directory(turns: DataFrame, lines: DataFrame, thread: str, order: str) -> DataFrame:
    """Each turn with the first directory that its thread's log names."""
    first = lines.where(F.col("cwd").isNotNull()).groupBy(thread).agg(F.min_by("cwd", order).alias("cwd"))
    return turns.join(first, thread, "left")


def price_turns(turns: DataFrame, prices: DataFrame) -> DataFrame:
    """Cost from an exact model match; NULL for unknown models.  Prices are one row per model."""
    p = prices.select(F.col("model").alias("__m"), "input_per_mtok", "cached_per_mtok", "output_per_mtok")
    cost = (F.col("input_tokens") * F.col("input_per_mtok") + F.col("cache_read_tokens") * F.col("cached_per_mtok") + F.col("output_tokens") * F.col("output_per_mtok")) / 1e6
    return turns.join(F.broadcast(p), F.col("model") == F.col("__m"), "left").withColumn("est_cost", F.round(cost, 8)).drop("__m", "input_per_mtok", "cached_per_mtok", "output_per_mtok")


def price_messages(messages: DataFrame, prices: list[tuple[str, float, float]], default: tuple[float, float]) -> DataFrame:
    """Rates of the first price key that the model name contains, else the default ones."""
    rate_in, rate_out = F.lit(float(default[0])), F.lit(float(default[1]))
    for key, i, o in reversed(prices):
        has = F.coalesce(F.col("model").contains(key), F.lit(False))
        rate_in, rate_out = F.when(has, F.lit(float(i))).otherwise(rate_in), F.when(has, F.lit(float(o))).otherwise(rate_out)
    return messages.withColumn("est_cost", F.round((F.col("input_tokens") * rate_in + F.col("output_tokens") * rate_out) / 1e6, 8))


def blocklist_matches(prompts: DataFrame, blocklist: DataFrame, limit: float = 0.5) -> DataFrame:
    """(prompt_id, content_hash) where a file is blocked or the texts' token Jaccard reaches ``limit``.

    Prompts have ``files`` and ``text``, the blocklist ``primary_file`` and
    ``summary``.  Equal token sets are compared once, and only sets of a size that
    the blocklist's sizes allow.  Candidates share a token of their prefixes in one
    global token order (rarest first in the blocklist), so no prompt meets every
    entry; of a prompt's tokens only those that the blocklist has are sorted, one narrow
    row each.  Texts without tokens are equal: they have the empty token.
    """
    by_file = prompts.select("prompt_id", F.explode("files").alias("primary_file")).join(blocklist.select("content_hash", "primary_file"), "primary_file")
    least = lambda n: F.ceil(F.lit(limit) * n - 1e-9)  # noqa: E731 - what a set of n tokens must share at least

    def sets(x: DataFrame, key: str, text: str) -> DataFrame:
        t = x.select(key, token_set(text).alias("tok")).where(F.col("tok").isNotNull())
        return t.select(key, "tok", F.size("tok").alias("n"), F.md5(F.concat_ws(" ", F.array_sort("tok"))).alias("set"))

    def words(x: DataFrame) -> DataFrame:
        return x.select("set", "n", F.explode(F.when(F.col("n") == 0, F.array(F.lit(""))).otherwise(F.col("tok"))).alias("t"))

    b = stage(sets(blocklist, "content_hash", "summary"), "blocklist-sets")
    sizes = F.broadcast(b.agg(F.min("n").alias("lo"), F.max("n").alias("hi")))
    p = sets(prompts, "prompt_id", "text").crossJoin(sizes).where((F.col("n") >= least(F.col("lo"))) & (least(F.col("n")) <= F.col("hi")))
    p = stage(p.drop("lo", "hi"), "prompt-sets")
    ps, bs = p.drop("prompt_id").dropDuplicates(["set"]), b.drop("content_hash").dropDuplicates(["set"])
    df = words(bs).groupBy("t").agg(F.count(F.lit(1)).alias("df"))

    def prefix(x: DataFrame) -> DataFrame:
        own = Window.partitionBy("set")
        known = words(x).join(df, "t").withColumn("known", F.count(F.lit(1)).over(own))
        unknown = F.greatest(F.lit(1), F.col("n")) - F.col("known")  # come first: none has them
        known = known.withColumn("i", unknown + F.row_number().over(own.orderBy("df", "t")))
        return known.where((F.col("i") <= F.col("n") - least(F.col("n")) + 1) & (F.col("known") >= least(F.col("n")))).select("set", "n", "t")

    entry = lambda x, *more: x.select(F.col("set").alias("entry"), F.col("n").alias("m"), *more)
    near = (F.col("n") >= least(F.col("m"))) & (F.col("m") >= least(F.col("n")))
    cand = prefix(ps).join(entry(prefix(bs), "t"), "t").where(near).select("set", "entry").distinct()
    sim = cand.join(ps.select("set", "tok"), "set").join(entry(bs, F.col("tok").alias("of")).drop("m"), "entry").where(jaccard("tok", "of") >= limit)
    sim = sim.select("set", "entry").join(p.select("prompt_id", "set"), "set").join(b.select("content_hash", F.col("set").alias("entry")), "entry")
    return by_file.select("prompt_id", "content_hash").unionByName(sim.select("prompt_id", "content_hash")).distinct()


def stuck_chains(loops: DataFrame, findings: DataFrame) -> DataFrame:
    """Escalated loops without acknowledgement, with the findings of their file and an issue key."""
    f = findings.groupBy("primary_file").agg(F.count(F.lit(1)).alias("n_findings"))
    open_ = loops.where((F.col("tier") == "escalate") & F.col("ack_by").isNull())
    key = F.concat(F.lit("stuck-loop-"), F.substring("content_hash", 1, 12))
    return open_.join(f, "primary_file", "left").select("content_hash", "primary_file", "cycles", F.coalesce("n_findings", F.lit(0)).alias("n_findings"), key.alias("issue_key"))


def session_vs_review_cost(session_cost: DataFrame, review_cost: DataFrame) -> DataFrame:
    """Daily session cost beside review cost, with the share of the review."""
    s = session_cost.groupBy("date").agg(F.sum("cost").alias("session_cost"))
    r = review_cost.groupBy("date").agg(F.sum("cost").alias("review_cost"))
    out = s.join(r, "date", "left").withColumn("review_cost", F.coalesce("review_cost", F.lit(0.0)))
    return out.select("date", F.round("session_cost", 6).alias("session_cost"), F.round("review_cost", 6).alias("review_cost"), F.round(F.coalesce(100 * ratio("review_cost", "session_cost"), F.lit(0.0)), 4).alias("review_pct"))


def cost_per_resolved(performance: DataFrame, addressed: DataFrame, keys: list[str]) -> DataFrame:
    """Cost per addressed review by agent (and day): NULL unless both are positive."""
    p = performance.groupBy(*keys).agg(F.sum("total_cost").alias("cost"), F.sum("n_runs").alias("n_runs"))
    a = addressed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_addressed"))
    out = p.join(a, keys, "left").withColumn("n_addressed", F.coalesce("n_addressed", F.lit(0)))
    good = (F.col("cost") > 0) & (F.col("n_addressed") > 0)
    return out.select(*keys, F.round("cost", 6).alias("cost"), "n_runs", "n_addressed", F.round(F.when(good, F.col("cost") / F.col("n_addressed")), 6).alias("cost_per_resolved"))


def agent_noise(reviews: DataFrame) -> DataFrame:
    """Per agent: reviews, addressed, passed, and the share that was neither."""
    g = reviews.groupBy("agent").agg(F.count(F.lit(1)).alias("n_reviews"), F.count_if(F.col("close_reason") == "manual").alias("n_addressed"), F.count_if(F.col("verdict") == "P").alias("n_passed"))
    noise = F.greatest(F.lit(0), F.col("n_reviews") - F.col("n_addressed") - F.col("n_passed"))
    return g.withColumn("noise_rate", F.round(noise / F.greatest(F.lit(1), F.col("n_reviews")), 6))


def cross_delta(provider: DataFrame, other: DataFrame, family: str) -> DataFrame:
    """Percentage by which the other source exceeds the provider's rows of one model family."""
    p = provider.where(F.col("model").contains(family)).agg(sum0("cost").alias("provider_cost"))
    o = other.agg(sum0("cost").alias("other_cost"))
    return p.crossJoin(o).select(F.round("provider_cost", 6).alias("provider_cost"), F.round("other_cost", 6).alias("other_cost"), F.round(100 * ratio(F.col("other_cost") - F.col("provider_cost"), "provider_cost"), 4).alias("delta_pct"))


def findings_by_length(sessions: DataFrame) -> DataFrame:
    """Sessions and the median of their findings by length in hours."""
    f = sessions.select(bucket("hours", [1.0, 3.0, 8.0], ["<1", "1-3", "3-8", ">8"]).alias("length"), "n_findings")
    f = stage(f, "session-findings")  # read for the median and for the counts
    q = quantiles(f, ["length"], "n_findings", [0.5])
    return with_columns_of(f.groupBy("length").agg(F.count(F.lit(1)).alias("n_sessions")), q, ["length"]).select("length", "n_sessions", F.col("q")[0].alias("median_findings"))


def spine_fill(rows: DataFrame, spine: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Sums of the values on every cell of the spine, 0 where there are no rows."""
    sums = rows.groupBy(*keys).agg(*(F.sum(v).alias(v) for v in values))
    return spine.join(sums, keys, "left").select(*keys, *(F.round(F.coalesce(v, F.lit(0)), 6).alias(v) for v in values))


def change_coupling(files: DataFrame, per_commit: int = 20, least: int = 3, top: int = 100) -> DataFrame:
    """Pairs of files changed together: counts, weight against the project's strongest pair.

    A commit gives its first ``per_commit`` files in byte order, so at most
    per_commit * (per_commit - 1) / 2 pairs; pairs below ``least`` commits go and
    ``top`` stay per project.
    """
    first = F.row_number().over(Window.partitionBy("project", "hash").orderBy("file"))
    # the rank limit is applied below the exchange as well: a task sends no more than per_commit files of a commit
    few = files.select("project", "hash", "file").distinct().withColumn("__r", first).where(F.col("__r") <= per_commit)
    c = few.groupBy("project", "hash").agg(F.sort_array(F.collect_list("file")).alias("fs")).where(F.size("fs") >= 2)
    a = c.select("project", "hash", "fs", F.posexplode("fs").alias("i", "file_a"))
    pairs = a.select("project", "file_a", F.explode(F.slice("fs", F.col("i") + 2, per_commit)).alias("file_b"))
    n = pairs.groupBy("project", "file_a", "file_b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    by = Window.partitionBy("project")
    n = n.withColumns({"__i": F.row_number().over(by.orderBy(F.desc("n"), "file_a", "file_b")), "__m": F.max("n").over(by)})
    return n.where(F.col("__i") <= top).select("project", "file_a", "file_b", "n", F.round(F.col("n") / F.col("__m"), 4).alias("weight"))
