"""Conforming and privacy queries P-01..P-12, P-15..P-17, and the scalar functions F-01..F-15."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerspark.functions import columns as C
from ledgerspark.functions import identifiers as I
from ledgerspark.operators import sinks
from ledgerspark.plans.registry import query
from ledgerspark.rules.projects import ALIASES, DENIED, DENIED_PREFIXES, HOME_PATHS, PROJECTS, SENSITIVE

_LIST = lambda xs: "(" + ", ".join(f"'{x}'" for x in xs) + ")"


def _canon_sql(column: str) -> str:
    """The canonical project of a column, step by step, as DuckDB SQL over a one-row lateral chain."""
    r = PROJECTS
    x = column
    for p in r.homes:
        x = f"regexp_replace({x}, '{p}', '')"
    x = f"regexp_replace({x}, '(?i)-({'|'.join(r.branches)})(-.*)?$', '')"
    for p in r.prefixes:
        x = f"regexp_replace({x}, '^{p}-', '')"
    x = f"replace({x}, '-', '/')"
    flat = "x0"
    for p in (*r.flat_homes, *(f"^{p}_" for p in r.prefixes)):
        flat = f"regexp_replace({flat}, '{p}', '')"
    inner = "CASE " + " ".join(f"WHEN starts_with(y, '{p}') THEN substr(y, {len(p) + 1})" for p in r.containers) + " ELSE y END"
    over = " ".join(f"WHEN starts_with(y, '{a}') THEN '{b}'" for a, b in r.overrides)
    remap = " ".join(f"WHEN x = '{a}' THEN '{b}'" for a, b in r.remaps)
    trees = " OR ".join(f"regexp_matches(coalesce(raw, ''), '{p}')" for p in r.worktrees)
    dashed = _LIST([n for n in r.noise if "-" in n])
    return f"""(SELECT CASE WHEN raw IS NULL OR raw = '' OR raw IN {dashed} OR {trees} THEN NULL {remap} WHEN x IN {_LIST(r.noise)} OR regexp_matches(x, '{r.hashes}') THEN NULL
 WHEN y = '' THEN NULL {over} WHEN first = '' OR regexp_matches(first, '^[0-9]+$') OR first IN {_LIST(r.noise)} THEN NULL ELSE first END
 FROM (SELECT *, string_split({inner}, '/')[1] AS first FROM (SELECT *, regexp_replace(x, '{r.checkout}', '') AS y FROM
  (SELECT *, CASE WHEN starts_with(x0, '/') OR starts_with(x0, '{r.flat_root}') THEN replace({flat}, '_', '/') ELSE x0 END AS x FROM (SELECT {column} AS raw, {x} AS x0)))))"""


@query("p01_canonical_project", f"SELECT event_id, {_canon_sql('name')} AS project FROM raw_names")
def _(t):
    return t("raw_names").select("event_id", I.canonical_project("name").alias("project"))


_OUT = _LIST(("alps", "asia", "europe", "git", "left-over", "srv"))
_PLAIN = f"list_filter(string_split({{0}}, '/'), lambda s: s <> '' AND s NOT IN {_OUT} AND NOT regexp_matches(s, '^[0-9]+$') AND NOT starts_with(s, '.'))"


@query("p02_project_of_directory", f"SELECT event_id, coalesce(CASE WHEN contains(cwd, '/git/') THEN ({_PLAIN.format(chr(34) + 'tail' + chr(34))})[1] END, ({_PLAIN.format('cwd')})[-1]) AS project FROM (SELECT *, substr(cwd, strpos(cwd, '/git/') + 5) AS tail FROM raw_names)")
def _(t):
    return t("raw_names").select("event_id", I.project_of_directory("cwd").alias("project"))


@query("p03_clean_projects", f"""
WITH b AS (SELECT event_id, name, regexp_replace(name, '(?i)-(build|chore|ci|docs|feat|fix|perf|refactor|revert|style|test)-.*$', '') AS base FROM raw_names),
one AS (SELECT event_id, CASE WHEN lower(base) = 'cash-book' OR lower(name) = 'cash-book' THEN 'ledger' ELSE name END AS name, CASE WHEN lower(base) = 'cash-book' OR lower(name) = 'cash-book' THEN 'ledger' ELSE base END AS base FROM b),
two AS (SELECT event_id, CASE WHEN lower(base) = 'p11' OR lower(name) = 'p11' THEN 'p10' ELSE name END AS name, CASE WHEN lower(base) = 'p11' OR lower(name) = 'p11' THEN 'p10' ELSE base END AS base FROM one)
SELECT event_id, name FROM two WHERE base IS NULL OR lower(base) NOT IN ('secret_lab', 'p3')""")
def _(t):
    return I.clean_projects(t("raw_names"), "name", ALIASES).select("event_id", "name")


_DENY = f"(lower(name) IN {_LIST(DENIED)} OR " + " OR ".join(f"starts_with(lower(name), '{p}')" for p in DENIED_PREFIXES) + ")"


@query("p04_drop_confidential", f"SELECT event_id, name FROM raw_names WHERE NOT coalesce({_DENY}, false)")
def _(t):
    return I.drop_confidential(t("raw_names"), ["name", "absent"]).select("event_id", "name")


_PATHLIKE = "regexp_matches({0}, '^-|[/\\\\]')"


@query("p06_sanitize_session_id", f"""
SELECT event_id, CASE WHEN {_PATHLIKE.format("name")} THEN concat('sanitized@', CASE WHEN event_id % 3 = 0 THEN 'unknown' ELSE concat('p', CAST(user_id AS STRING)) END, '@', CASE WHEN event_id % 7 = 0 THEN 'na' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END, '@h', substr(md5(name), 1, 12)) ELSE name END AS id FROM raw_names""")
def _(t):
    p = F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("p"), F.col("user_id").cast("string")))
    return t("raw_names").select("event_id", I.sanitize_session_id("name", p, F.when(F.col("event_id") % 7 != 0, F.col("ts"))).alias("id"))


@query("p05_public_view", f"""
SELECT event_id, project, CASE WHEN {_PATHLIKE.format("name")} THEN concat('sanitized@', project, '@', strftime(ts, '%Y-%m-%dT%H:%M:%SZ'), '@h', substr(md5(name), 1, 12)) ELSE name END AS session_id
FROM (SELECT *, {_canon_sql("name")} AS project FROM raw_names) WHERE project IS NOT NULL""")
def _(t):
    rows = t("raw_names").withColumn("project", I.canonical_project("name")).where(F.col("project").isNotNull())
    return rows.select("event_id", "project", I.sanitize_session_id("name", "project", "ts").alias("session_id"))


_SENS = lambda c: "(" + " OR ".join(f"regexp_matches(coalesce({c}, ''), '{p}')" for p in SENSITIVE) + ")"


@query("p07_sanitize_usage_id", f"""
SELECT event_id, CASE WHEN {_PATHLIKE.format("name")} OR {_SENS("name")} THEN concat('sanitized@', coalesce({_canon_sql("name")}, 'unknown'), '@h', substr(md5(name), 1, 12)) ELSE name END AS id FROM raw_names""")
def _(t):
    return t("raw_names").select("event_id", I.sanitize_usage_id("name").alias("id"))


@query("p08_merge_daily_usage", f"""
WITH n AS (SELECT u.date, {_canon_sql("r.name")} AS project, u.cost, u.input_tokens, u.output_tokens, u.model FROM usage u JOIN raw_names r USING (event_id))
SELECT project, date, round(sum(cost), 6) AS cost, sum(input_tokens) AS input_tokens, sum(output_tokens) AS output_tokens, string_agg(DISTINCT model, ',' ORDER BY model) AS models, count(*) AS n_breakdowns FROM n WHERE project IS NOT NULL GROUP BY 1, 2""")
def _(t):
    from ledgerspark.operators.merges import merge_daily

    rows = t("usage").join(t("raw_names").select("event_id", "name"), "event_id").withColumn("project", I.canonical_project("name")).where(F.col("project").isNotNull())
    rows = rows.select("project", "date", "cost", "input_tokens", "output_tokens", F.array("model").alias("models"), F.array(F.struct("model", "cost")).alias("breakdowns"))
    return merge_daily(rows).select("project", "date", F.round("cost", 6).alias("cost"), "input_tokens", "output_tokens", F.array_join(F.array_sort("models"), ",").alias("models"), F.size("breakdowns").alias("n_breakdowns"))


@query("p09_strip_fields", "SELECT CAST(count(*) FILTER (user_id % 3 = 0) + count(*) FILTER (user_id % 5 = 0) AS BIGINT) AS n_removed FROM raw_names")
def _(t):
    from ledgerspark.sources.usage import strip_fields

    usage = F.struct(F.when(F.col("user_id") % 3 == 0, F.lit("a@b")).alias("accountEmail"), F.when(F.col("user_id") % 5 == 0, F.lit("Me")).alias("loginMethod"), F.lit(1.0).alias("used"))
    clean, removed = strip_fields(t("raw_names").select("event_id", usage.alias("usage")), "usage", ["accountEmail", "loginMethod", "identity"])
    assert clean.schema["usage"].dataType.names == ["used"]
    return removed


@query("p10_leak_scan", " UNION ALL ".join(f"SELECT '{p}' AS pattern, count(*) FILTER (regexp_matches(coalesce(name, '') || ' ' || coalesce(cwd, ''), '{p}')) AS n FROM raw_names" for p in SENSITIVE))
def _(t):
    return sinks.leaks(t("raw_names").select("name", "cwd"), SENSITIVE)


def _redacted(c: str) -> str:
    for p in HOME_PATHS:
        c = f"regexp_replace({c}, '{p}', '')"
    return c


@query("p11_redact_directory", f"SELECT event_id, CASE WHEN {_SENS('x')} THEN NULL ELSE x END AS cwd FROM (SELECT event_id, {_redacted('cwd')} AS x FROM raw_names)")
def _(t):
    return t("raw_names").select("event_id", I.redact_directory("cwd").alias("cwd"))


@query("p12_whitelist_keys", "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN '{}' ELSE concat('{\"k\":\"', CAST(json_extract(props, '$.k') AS STRING), '\"}') END AS evidence FROM events")
def _(t):
    from ledgerspark.sources.usage import keep_keys

    raw = F.when(F.col("event_id") % 4 == 0, F.lit('{"secret": "x"}')).otherwise(F.regexp_replace("props", r"\{", '{"path": "/home/me", '))
    return t("events").select("event_id", keep_keys(raw, ["k"]).alias("evidence"))


@query("p15_hygiene", "SELECT event_id, name FROM raw_names WHERE name IS NOT NULL AND name <> '*' AND NOT regexp_matches(name, '^ab[0-9a-f]{10,}')")
def _(t):
    from ledgerspark.sources.usage import hygienic

    return hygienic(t("raw_names"), "name", r"^ab[0-9a-f]{10,}").select("event_id", "name")


@query("p16_normal_sessions", """
SELECT session_id, epoch_us(CASE WHEN e IS NOT NULL THEN greatest(e, started_at) END) AS ended_us, CASE WHEN e IS NOT NULL THEN greatest(0, round(duration_min, 1)) END AS duration_min
FROM (SELECT *, CASE WHEN trigger IS NULL THEN NULL WHEN trigger = 'cron' THEN started_at - INTERVAL 1 HOUR ELSE ended_at END AS e FROM sessions)""")
def _(t):
    from ledgerspark.operators.merges import normal_sessions

    s = t("sessions").withColumn("ended_at", F.when(F.col("trigger") == "cron", F.col("started_at") - F.expr("INTERVAL 1 HOUR")).when(F.col("trigger").isNotNull(), F.col("ended_at")))
    s = s.withColumn("duration_min", F.when(F.col("ended_at").isNotNull(), F.col("duration_min")))
    return normal_sessions(s).select("session_id", C.micros("ended_at").alias("ended_us"), "duration_min")


@query("p17_staleness", "SELECT event_id, CASE WHEN event_id % 5 < 2 THEN false ELSE epoch_us(TIMESTAMP '2024-01-20') - epoch_us(date_trunc('second', ts)) > 6 * 3.6E9 END AS stale FROM events")
def _(t):
    from ledgerspark.operators.merges import is_stale

    text = F.when(F.col("event_id") % 5 == 0, F.lit("bad")).when(F.col("event_id") % 5 == 1, F.lit(None)).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return t("events").select("event_id", is_stale(text, "2024-01-20 00:00:00", 6).alias("stale"))


# scalar functions -------------------------------------------------------

_WORDS = r"regexp_split_to_array(lower(text), '[[:space:][:punct:]]+')"
_TOKENS = f"list_distinct(list_filter({_WORDS}, lambda w: w <> '' AND w NOT IN {_LIST(C.STOPWORDS)}))"
_FIRST = r"array_to_string(string_split(trim(regexp_replace(text, '[\t\n\v\f\r ]+', ' ', 'g')), ' ')[1:12], ' ')"


@query("f01_text_basics", r"SELECT doc_id, lower(substr(trim(source), 1, 3)) AS head, contains(text, 'the') AS has_the, starts_with(lang, 'e') AS is_e, regexp_extract(source, '([0-9]+)', 1) AS number, string_split(source, 'c')[2] AS tail FROM documents")
def _(t):
    return t("documents").select("doc_id", F.lower(F.substring(F.trim("source"), 1, 3)).alias("head"), F.contains("text", F.lit("the")).alias("has_the"), F.startswith("lang", F.lit("e")).alias("is_e"), F.regexp_extract("source", "([0-9]+)", 1).alias("number"), F.get(F.split("source", "c"), F.lit(1)).alias("tail"))


@query("f02_first_words", f"SELECT doc_id, {_FIRST} AS words FROM documents")
def _(t):
    return t("documents").select("doc_id", C.first_words("text").alias("words"))


@query("f03_token_set", f"SELECT doc_id, len({_TOKENS}) AS n_tokens, array_to_string(list_sort({_TOKENS})[1:5], ' ') AS first_tokens FROM documents")
def _(t):
    tok = t("documents").select("doc_id", C.token_set("text").alias("tok"))
    return tok.select("doc_id", F.size("tok").alias("n_tokens"), F.array_join(F.slice(F.array_sort("tok"), 1, 5), " ").alias("first_tokens"))


@query("f04_jaccard", f"""
WITH k AS (SELECT doc_id, {_TOKENS} AS tok FROM documents) SELECT a.doc_id, round(CASE WHEN len(a.tok) = 0 AND len(b.tok) = 0 THEN 1 WHEN len(a.tok) = 0 OR len(b.tok) = 0 THEN 0
 ELSE len(list_intersect(a.tok, b.tok))::DOUBLE / len(list_distinct(list_concat(a.tok, b.tok))) END, 6) AS similarity FROM k a JOIN k b ON b.doc_id = a.doc_id + 1""")
def _(t):
    k = t("documents").select("doc_id", C.token_set("text").alias("tok"))
    nxt = k.select((F.col("doc_id") - 1).alias("doc_id"), F.col("tok").alias("tok2"))
    return k.join(nxt, "doc_id").select("doc_id", F.round(C.jaccard("tok", "tok2"), 6).alias("similarity"))


@query("f05_finding_hash", f"SELECT doc_id, md5(concat(lower(lang), chr(31), source, chr(31), {_FIRST})) AS h FROM documents")
def _(t):
    return t("documents").select("doc_id", C.finding_hash("lang", "source", "text").alias("h"))


@query("f06_path_hash", "SELECT event_id, substr(md5(cwd), 1, 12) AS h FROM raw_names")
def _(t):
    return t("raw_names").select("event_id", C.hash12("cwd").alias("h"))


@query("f07_weeks", """
SELECT o_orderkey, strftime(d, '%G-%V') AS iso_week, CAST(date_trunc('week', d) AS DATE) AS monday, CAST(d - CAST(dayofweek(d) AS INT) AS DATE) AS sunday, strftime(d, '%Y-W%W') AS week_of_year, strftime(d, '%Y-%m') AS month
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def _(t):
    d = F.to_date("o_orderdate")
    return t("orders").select("o_orderkey", C.iso_week(d).alias("iso_week"), C.monday(d).alias("monday"), C.sunday(d).alias("sunday"), C.monday_week_of_year(d).alias("week_of_year"), C.month(d).alias("month"))


@query("f08_dates", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS from_day_of_year, CAST(o_orderdate AS DATE) AS parsed FROM orders")
def _(t):
    d = F.col("o_orderdate")
    text = F.when(F.col("o_orderkey") % 2 == 0, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(F.date_format(d, "yyyy-MM-dd"))
    return t("orders").select("o_orderkey", C.year_day(F.year(d), F.dayofyear(d)).alias("from_day_of_year"), F.to_date(C.parse_time(text)).alias("parsed"))


@query("f09_differences", """
SELECT session_id, round((epoch_us(ended_at) - epoch_us(started_at)) / 3.6E9, 4) AS hours, CAST(date + INTERVAL 6 MONTH AS DATE) AS later FROM sessions""")
def _(t):
    return t("sessions").select("session_id", F.round(C.hours_between("started_at", "ended_at"), 4).alias("hours"), F.add_months("date", 6).alias("later"))


@query("f10_ratios", "SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice / nullif(l_tax, 0), 4) AS by_tax, round(l_quantity / greatest(1, l_linenumber - 3), 6) AS guarded, floor(l_discount * 100 + 0.5) AS pct FROM lineitem")
def _(t):
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(C.ratio("l_extendedprice", "l_tax"), 4).alias("by_tax"), F.round(C.ratio1("l_quantity", F.col("l_linenumber") - 3), 6).alias("guarded"), F.floor(F.col("l_discount") * 100 + 0.5).alias("pct"))


@query("f11_conditionals", "SELECT event_id, coalesce(CASE WHEN value > 100 THEN 'high' WHEN value > 10 THEN 'mid' END, event_type) AS label FROM events")
def _(t):
    return t("events").select("event_id", F.coalesce(F.when(F.col("value") > 100, "high").when(F.col("value") > 10, "mid"), "event_type").alias("label"))


@query("f12_arrays", """
WITH g AS (SELECT user_id, list_sort(list(DISTINCT event_type)) AS kinds FROM events GROUP BY user_id) SELECT user_id, len(kinds) AS n, array_to_string(list_sort(list_distinct(list_concat(kinds, ['x', 'view']))), ',') AS more, kinds[1] AS first FROM g""")
def _(t):
    g = t("events").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("kinds"))
    return g.select("user_id", F.size("kinds").alias("n"), F.array_join(F.array_sort(F.array_union("kinds", F.array(F.lit("x"), F.lit("view")))), ",").alias("more"), F.get("kinds", F.lit(0)).alias("first"))


@query("f13_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k, coalesce(CAST(json_extract(props, '$.absent') AS INT), -1) AS absent FROM events")
def _(t):
    return t("events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"), F.coalesce(F.get_json_object("props", "$.absent").cast("int"), F.lit(-1)).alias("absent"))


@query("f14_enumerations", """
SELECT review_id, coalesce(severity, 'unknown') AS severity, CASE severity WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3 WHEN 'critical' THEN 4 END AS rank FROM lifecycle""")
def _(t):
    return t("lifecycle").select("review_id", C.one_of(F.upper("severity"), C.SEVERITIES).alias("severity"), C.rank_in("severity", C.SEVERITIES).alias("rank"))


@query("f15_models", "SELECT event_id, event_type AS short, CASE WHEN contains(event_type, 'pur') THEN 'pur' WHEN contains(event_type, 'e') THEN 'e' ELSE 'rest' END AS family FROM events")
def _(t):
    raw = F.concat(F.lit('"vendor/'), "event_type", F.lit('"'))
    return t("events").select("event_id", C.short_model(raw).alias("short"), C.model_family("event_type", ("pur", "e"), "rest").alias("family"))
