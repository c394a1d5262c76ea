"""Idempotent appends, upserts and additive merges of stored tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark import schemas as S
from ledgerspark.functions.columns import col, computed, hours_between, parse_time
from ledgerspark.functions.identifiers import canonical_project, drop_confidential, redact_directory, sanitize_session_id
from ledgerspark.operators.gitlog import last_per_key
from ledgerspark.operators.lineage import stage
from ledgerspark.operators.sinks import Rule


def merge_daily(rows: DataFrame) -> DataFrame:
    """One row per (project, date): numbers summed, models united, breakdowns joined end to end."""
    numbers = [c for c, kind in rows.dtypes if kind in ("double", "bigint", "int") and c not in ("project", "date")]
    return rows.groupBy("project", "date").agg(
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in numbers),
        F.array_distinct(F.flatten(F.collect_list("models"))).alias("models"), F.flatten(F.collect_list("breakdowns")).alias("breakdowns"),
    )


def normal_sessions(sessions: DataFrame) -> DataFrame:
    """End not before the start, minutes not negative; an open session keeps its NULL end."""
    end = F.when(F.col("ended_at").isNotNull(), F.greatest("ended_at", "started_at"))
    minutes = F.when(F.col("duration_min").isNotNull(), F.greatest(F.lit(0.0), F.round("duration_min", 1)))
    return sessions.withColumns({"ended_at": end, "duration_min": minutes})


def is_stale(updated: Column | str, now: str, hours: float) -> Column:
    """True where the time is older than the threshold; unknown times are fresh."""
    age = hours_between(parse_time(updated), F.lit(now).cast("timestamp"))
    return F.coalesce(age > hours, F.lit(False))


# appends of staged events ---------------------------------------------------


def not_stored(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The new rows whose key no old row has; of the old ones only the keys are read.

    The stored keys that the batch has are found first: where the batch is
    small, it is sent to the stored keys, which then are not shuffled.  The new
    rows are read for their keys and for themselves, so they are staged.
    """
    new = stage(new, "new-rows")
    stored = old.select(*keys).join(new.select(*keys), keys, "left_semi")
    return new.join(stored, keys, "left_anti")


def append_new(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Old rows, and the new ones whose key no old row has."""
    return old.unionByName(not_stored(old, new, keys))


def _payload(events: DataFrame, kind: str) -> DataFrame:
    return events.where(F.col("payload.event_type") == kind).select("ts", "file", "line", "payload.*")


def sessions_from_events(events: DataFrame, now: str, rules=None) -> DataFrame:
    """session_stop events as session rows: last per id, defaults, sanitised ids, private rows dropped."""
    e = _payload(events, "session_stop").where(F.coalesce(F.col("session_id") != "", F.lit(False)))
    canonical = canonical_project("project") if rules is None else canonical_project("project", rules)
    e = drop_confidential(computed(e, canonical_project=canonical, started_at=parse_time("started_at")), ["project", "canonical_project"])
    e = e.withColumns({
        "ended_at": parse_time("ended_at"),
        "source": F.coalesce("source", F.lit("hook")), "trigger": F.coalesce("trigger", F.lit("unknown")), "valid_from": F.lit(now).cast("timestamp"),
    })
    e = e.withColumn("session_id", sanitize_session_id("session_id", "canonical_project", "started_at"))
    return S.conform(last_per_key(e, ["session_id"], ["ts", "file", "line"]), S.SESSIONS)


def new_sessions(old: DataFrame, events: DataFrame, now: str) -> DataFrame:
    """Sessions that are not stored; old spellings of a sanitised id, without its hash, count as stored."""
    new = stage(sessions_from_events(events, now), "new-sessions")  # read for its keys and for itself
    short = F.regexp_replace("session_id", "@h[0-9a-f]{12}$", "")
    spellings = new.select("session_id", F.explode(F.array_distinct(F.array("session_id", short))).alias("__key"))
    stored = old.select(F.col("session_id").alias("__key")).join(spellings.select("__key"), "__key", "left_semi")
    new = new.join(spellings.join(stored, "__key", "left_semi").select("session_id"), "session_id", "left_anti")
    return with_rules(S.conform(new, S.SESSIONS), SESSION_RULES)


def append_sessions(old: DataFrame, events: DataFrame, now: str) -> DataFrame:
    """Stored sessions, with a trigger and without private directories, and the new ones."""
    old = with_rules(S.conform(old, S.SESSIONS), SESSION_RULES)
    return old.unionByName(new_sessions(old, events, now))


#: What holds for every stored session, also for rows that were stored before the rule was made.
SESSION_RULES = (
    Rule("trigger-known", lambda df: df.withColumn("trigger", F.coalesce("trigger", F.lit("unknown")))),
    Rule("folders-redacted", lambda df: df.withColumn("working_dir", redact_directory("working_dir"))),
)


def with_rules(rows: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    return reduce(lambda df, rule: rule.change(df), rules, rows)


def costs_from_events(events: DataFrame, now: str) -> DataFrame:
    """cost_emitted events: project, date and source are required; last per key."""
    e = computed(_payload(events, "cost_emitted"), canonical_project=canonical_project("project"), date=F.to_date(parse_time("date")))
    e = e.where(F.col("canonical_project").isNotNull() & F.col("date").isNotNull() & F.col("source").isNotNull())
    e = drop_confidential(e, ["project", "canonical_project"])
    e = e.withColumns({"cost_id": F.concat_ws("|", "canonical_project", F.col("date").cast("string"), "source"), "valid_from": F.lit(now).cast("timestamp")})
    return S.conform(last_per_key(e, ["cost_id"], ["ts", "file", "line"]), S.COSTS)


def new_costs(old: DataFrame, events: DataFrame, now: str) -> DataFrame:
    return not_stored(old, costs_from_events(events, now), ["cost_id"])


def append_costs(old: DataFrame, events: DataFrame, now: str) -> DataFrame:
    return append_new(S.conform(old, S.COSTS), costs_from_events(events, now), ["cost_id"])


def commits_from_events(events: DataFrame, now: str) -> DataFrame:
    """git_commit events: project and hash are required; changed lines fall back to added plus deleted."""
    e = computed(_payload(events, "git_commit"), canonical_project=canonical_project("project"))
    e = e.where(F.col("canonical_project").isNotNull() & F.coalesce(F.col("hash") != "", F.lit(False)))
    e = drop_confidential(e, ["project", "canonical_project"])
    e = e.withColumns({
        "commit_pk": F.concat_ws("|", "canonical_project", "hash"), "date": F.to_date(parse_time("date")),
        "lines_changed": F.coalesce("lines_changed", F.col("lines_added") + F.col("lines_deleted")), "valid_from": F.lit(now).cast("timestamp"),
    })
    return S.conform(last_per_key(e, ["commit_pk"], ["ts", "file", "line"]), S.COMMITS)


def new_commits(old: DataFrame, events: DataFrame, now: str) -> DataFrame:
    return not_stored(old, commits_from_events(events, now), ["commit_pk"])


def append_commits(old: DataFrame, events: DataFrame, now: str) -> DataFrame:
    return append_new(S.conform(old, S.COMMITS), commits_from_events(events, now), ["commit_pk"])


# upserts ---------------------------------------------------------------------


def replace_by_key(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows, and old ones of keys that the new ones do not have."""
    return new.unionByName(old.join(new.select(*keys).distinct(), keys, "left_anti"))


def upsert_findings(old: DataFrame, new: DataFrame) -> DataFrame:
    """Findings that are not stored get the next ids; stored ones get the new scrape time.

    Key: (job_id, content_hash), one row per key.  Ids go on from the largest
    stored one in the order of the key; they are dealt by a running number over
    the key's hash ranges, so no task numbers the whole batch.
    """
    keys = ["job_id", "content_hash"]
    batch = last_per_key(new, keys, ["scraped_at", "severity"])
    seen = batch.select(*keys, F.col("scraped_at").alias("__at"))
    kept = old.join(seen, keys, "left").withColumn("scraped_at", F.coalesce("__at", "scraped_at")).drop("__at").select(*old.columns)
    fresh = batch.join(old.select(*keys), keys, "left_anti")
    base = F.broadcast(old.agg(F.coalesce(F.max("finding_id"), F.lit(0)).cast("long").alias("__base")))
    return kept.unionByName(numbered(fresh, keys, "finding_id").crossJoin(base).withColumn("finding_id", F.col("finding_id") + F.col("__base")).select(*old.columns))


def numbered(rows: DataFrame, keys: list[str], name: str, parts: int = 256) -> DataFrame:
    """Gapless numbers from 1: in hash ranges of the key, and by the key within one."""
    from pyspark.sql import Window

    r = rows.withColumn("__p", F.pmod(F.xxhash64(*keys), F.lit(parts)))
    ahead = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    start = r.groupBy("__p").count().select(F.col("__p").alias("__q"), F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("__s"))  # `parts` rows
    place = F.row_number().over(Window.partitionBy("__p").orderBy(*keys))
    r = r.withColumn("__i", place).join(F.broadcast(start), F.col("__p") == F.col("__q"))
    return r.withColumn(name, (F.col("__s") + F.col("__i")).cast("long")).drop("__p", "__q", "__s", "__i")


def upsert_loops(old: DataFrame, new: DataFrame) -> DataFrame:
    """New loops replace stored ones by hash; acknowledgements that are stored stay."""
    acks = ["ack_by", "ack_at", "ack_reason", "ack_until"]
    o, n = old.alias("o"), new.alias("n")
    both = o.join(n, F.col("o.content_hash") == F.col("n.content_hash"), "full")
    is_new = F.col("n.content_hash").isNotNull()
    out = []
    for c in old.columns:
        if c in acks:
            out.append(F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")).alias(c))
        else:
            out.append(F.when(is_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
    return both.select(*out)


def additive_merge(old: DataFrame, new: DataFrame, keys: list[str], sums: list[str], low: list[str] = (), high: list[str] = (), newest: list[str] = (), nullable: list[str] = ()) -> DataFrame:
    """Rollups of two batches as one: numbers added, ranges widened, texts new first.

    ``nullable`` numbers are NULL only where both are; keys match also on NULL.
    """
    on = None
    for k in keys:
        same = F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}"))
        on = same if on is None else on & same
    both = old.withColumn("__o", F.lit(1)).alias("o").join(new.withColumn("__n", F.lit(1)).alias("n"), on, "full")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    out = [F.when(F.col("n.__n") == 1, F.col(f"n.{k}")).otherwise(F.col(f"o.{k}")).alias(k) for k in keys]
    out += [(zero(f"o.{c}") + zero(f"n.{c}")).alias(c) for c in sums]
    out += [F.when(F.col(f"o.{c}").isNotNull() | F.col(f"n.{c}").isNotNull(), zero(f"o.{c}") + zero(f"n.{c}")).alias(c) for c in nullable]
    out += [F.least(f"o.{c}", f"n.{c}").alias(c) for c in low] + [F.greatest(f"o.{c}", f"n.{c}").alias(c) for c in high]
    out += [F.coalesce(f"n.{c}", f"o.{c}").alias(c) for c in newest]
    return both.select(*out)


def blocklist(loops: DataFrame, now: str) -> DataFrame:
    """Loops of tier block or escalate that nobody acknowledged, or whose acknowledgement has run out."""
    at = F.lit(now).cast("timestamp")
    live = F.col("ack_by").isNull() | F.coalesce(F.col("ack_until") < at, F.lit(False))
    return loops.where(F.col("tier").isin("block", "escalate") & live).select("content_hash", "severity", "primary_file", "summary", "cycles", "tier", at.alias("updated_at"))


def acknowledge(loops: DataFrame, content_hash: str, by: str, reason: str, now: str, until: str | None = None) -> DataFrame:
    """The loops with one acknowledged; an unknown hash is an error."""
    if not loops.where(F.col("content_hash") == content_hash).limit(1).count():
        raise KeyError(f"no loop {content_hash}")
    mine = F.col("content_hash") == content_hash
    values = {"ack_by": F.lit(by), "ack_reason": F.lit(reason), "ack_at": F.lit(now).cast("timestamp"), "ack_until": F.lit(until).cast("timestamp")}
    return loops.withColumns({c: F.when(mine, v).otherwise(F.col(c)) for c, v in values.items()})


def backfill(current: DataFrame, older: DataFrame, keys: list[str], date: str) -> tuple[DataFrame, DataFrame]:
    """Rows of an older store whose keys are absent are added; with a report of counts and ranges before and after."""
    merged = append_new(current, older, keys)
    line = lambda df, tag: df.agg(F.lit(tag).alias("state"), F.count(F.lit(1)).alias("n"), F.min(date).alias("first"), F.max(date).alias("last"))
    return merged, line(current, "before").unionByName(line(merged, "after"))


def key_of(*columns: str) -> Column:
    """Text key in which NULL is written NA."""
    return F.concat_ws("|", *(F.coalesce(col(c).cast("string"), F.lit("NA")) for c in columns))
