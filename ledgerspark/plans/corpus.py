"""Corpus and recurring-finding queries: A-66..A-68, U-12, U-13, J-13, J-14."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerspark.functions.columns import finding_hash, micros
from ledgerspark.operators import corpus as K
from ledgerspark.operators import joins as J
from ledgerspark.operators import loops as L
from ledgerspark.plans.conform import _TOKENS
from ledgerspark.plans.registry import query

# the corpus has no wiki links: words in capital letters at a sentence's start stand for their targets
_LINK = r"(?:^|\. )([A-ZÉ][a-zé]+)"
_SRC, _MARK = "(?m)^Th", "tion"


def _pages(t):
    return K.measured(t("documents"), links=_LINK, sources=_SRC, marker=_MARK)


_M = f"""m AS (SELECT doc_id, source, text, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) AS words, length(text) - length(replace(text, chr(10), '')) AS lines, strlen(text) AS bytes,
 regexp_matches(text, '{_SRC}') AS has_sources, len(regexp_extract_all(text, '{_MARK}')) AS markers, regexp_extract_all(text, '{_LINK}', 1) AS links FROM documents)"""


@query("a66_corpus_summary", f"""
WITH {_M} SELECT count(*) AS pages, sum(words) AS words, sum(lines) AS lines, count(*) FILTER (has_sources) AS with_sources, 100 * count(*) FILTER (has_sources) // count(*) AS provenance_pct,
 count(*) FILTER (markers > 0) AS marked_pages, sum(markers) AS markers, sum(len(links)) AS links, count(*) FILTER (len(links) = 0) AS isolated, count(*) FILTER (has_sources AND markers = 0) AS fully_sourced,
 count(*) FILTER (has_sources AND markers > 0) AS partial, count(*) FILTER (NOT has_sources) AS unsourced, (SELECT count(DISTINCT l) FROM (SELECT unnest(links) AS l FROM m)) AS links_unique FROM m""")
def _(t):
    return K.corpus_summary(_pages(t))


@query("a66_link_edges", f"WITH {_M} SELECT doc_id AS source, unnest(links) AS target FROM m")
def _(t):
    return K.link_edges(_pages(t), "doc_id")


@query("a66_longest_pages", f"WITH {_M} SELECT doc_id, words FROM m ORDER BY words DESC, doc_id LIMIT 10")
def _(t):
    return K.longest(_pages(t), "doc_id")


@query("a66_stale_pages", "SELECT count(*) AS n_stale FROM events WHERE ts < TIMESTAMP '2024-02-10' - INTERVAL 30 DAY")
def _(t):
    return K.stale(t("events"), "ts", "2024-02-10 00:00:00")


@query("a67_config_summary", f"""
WITH {_M} SELECT source, count(*) AS files, sum(lines) AS lines, sum(bytes) AS bytes, floor(sum(bytes) / 4) AS tokens, floor(sum(lines) / count(*)) AS avg_lines, count(*) FILTER (lines > 20) AS long_files,
 count(*) FILTER (regexp_matches(text, '(?m)^The')) AS with_front_matter FROM m GROUP BY source""")
def _(t):
    return K.config_summary(_pages(t), "source", front="(?m)^The", limit=20)


@query("a67_largest_configs", f"WITH {_M} SELECT source, doc_id, lines FROM m QUALIFY row_number() OVER (PARTITION BY source ORDER BY lines DESC, doc_id) <= 10")
def _(t):
    return K.largest_per_category(_pages(t), "source", "doc_id")


_ITEMS = "(SELECT CASE WHEN p_partkey % 3 = 0 THEN 'hook' ELSE 'skill' END AS item_type, concat(p_name, CAST(p_partkey AS STRING)) AS name, CASE p_size % 3 WHEN 0 THEN 'never_used' WHEN 1 THEN 'stale' ELSE 'active' END AS staleness_status FROM part)"


def _items(t):
    return t("part").select(F.when(F.col("p_partkey") % 3 == 0, "hook").otherwise("skill").alias("item_type"), F.concat("p_name", F.col("p_partkey").cast("string")).alias("name"), F.when(F.col("p_size") % 3 == 0, "never_used").when(F.col("p_size") % 3 == 1, "stale").otherwise("active").alias("staleness_status"))


@query("a68_staleness_view", f"SELECT item_type, name, CASE WHEN item_type = 'hook' AND staleness_status = 'never_used' THEN 'not instrumented' ELSE staleness_status END AS staleness_status FROM {_ITEMS}")
def _(t):
    return K.staleness_view(_items(t))


@query("a68_staleness_counts", f"SELECT CASE WHEN staleness_status = 'never_used' THEN 'not instrumented' ELSE staleness_status END AS staleness_status, count(*) AS n FROM {_ITEMS} WHERE item_type = 'hook' GROUP BY 1")
def _(t):
    return K.staleness_counts(K.staleness_view(_items(t), "hook"))


# recurring findings ---------------------------------------------------------

#: All findings with their whole texts; a file is a project here, and one of a few files in the queries that end in _all.
_F2 = "(SELECT job_id, severity, project AS primary_file, problem_text, reviewed_at FROM findings)"
_ALL = "(SELECT job_id, severity, primary_file, problem_text, reviewed_at FROM findings)"
_HASH = r"md5(concat(severity, chr(31), primary_file, chr(31), array_to_string(string_split(trim(regexp_replace(problem_text, '[\t\n\v\f\r ]+', ' ', 'g')), ' ')[1:12], ' ')))"
_COLLAPSE = f"""f AS (SELECT *, {_HASH} AS h FROM {_F2}), tk AS (SELECT *, {_TOKENS.replace("text", "problem_text")} AS tok FROM f),
e AS (SELECT DISTINCT a.h AS a, b.h AS b FROM tk a JOIN tk b ON a.severity = b.severity AND a.primary_file = b.primary_file
 WHERE CASE WHEN len(a.tok) = 0 OR len(b.tok) = 0 THEN len(a.tok) = len(b.tok) ELSE len(list_intersect(a.tok, b.tok))::DOUBLE / len(list_distinct(list_concat(a.tok, b.tok))) >= 0.6 END),
reach(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a),
seen AS (SELECT h, min(reviewed_at) AS at FROM f GROUP BY h),
canon AS (SELECT r.a AS h, arg_min(r.b, (s.at, r.b)) AS c FROM reach r JOIN seen s ON s.h = r.b GROUP BY r.a),
col AS (SELECT f.*, canon.c AS content_hash FROM f JOIN canon USING (h))"""


_COLLAPSE_ALL = _COLLAPSE.replace(_F2, _ALL)


def _findings(t, file: str = "project"):
    f = t("findings").select("job_id", "severity", F.col(file).alias("primary_file"), "problem_text", "reviewed_at", F.col("primary_file").alias("folder"))
    return f.withColumn("content_hash", finding_hash("severity", "primary_file", "problem_text"))


@query("u13_near_duplicate_collapse", f"WITH RECURSIVE {_COLLAPSE} SELECT job_id, content_hash FROM col")
def _(t):
    return L.collapse(_findings(t), keep=["job_id"]).select("job_id", "content_hash")


@query("u13_near_duplicate_collapse_all", f"WITH RECURSIVE {_COLLAPSE_ALL} SELECT job_id, content_hash FROM col")
def _(t):
    return L.collapse(_findings(t, "primary_file"), keep=["job_id"]).select("job_id", "content_hash")


_RUNS = "runs AS (SELECT ts AS started_at, concat('c', CAST(event_id % 50 AS STRING)) AS commit_sha, value AS cost FROM events WHERE event_type IN ('error', 'purchase'))"
_CYCLES = f"""p AS (SELECT content_hash, reviewed_at AS a, lead(reviewed_at) OVER w AS b, row_number() OVER w AS i FROM col WINDOW w AS (PARTITION BY content_hash ORDER BY reviewed_at, job_id)),
cy AS (SELECT content_hash, count(DISTINCT i) AS cycles, string_agg(DISTINCT commit_sha, ',' ORDER BY commit_sha) AS fix_commit_shas, round(sum(cost), 6) AS wasted FROM p JOIN runs ON started_at BETWEEN a AND b WHERE b IS NOT NULL GROUP BY content_hash HAVING count(DISTINCT i) >= 3)"""


def _runs(t):
    kind = F.when(F.col("event_type").isin("error", "purchase"), "fixer").otherwise("reader")
    return t("events").select(kind.alias("agent_type"), F.col("ts").cast("timestamp").alias("started_at"), F.concat(F.lit("c"), (F.col("event_id") % 50).cast("string")).alias("commit_sha"), F.col("value").alias("total_cost_usd"))


# hashes of one or two cycles count as well; the threshold is that of loops
_ANY = _CYCLES.replace(" HAVING count(DISTINCT i) >= 3", "")


@query("j13_fix_cycles", f"WITH RECURSIVE {_COLLAPSE}, {_RUNS}, {_ANY} SELECT content_hash, cycles, fix_commit_shas, wasted AS estimated_wasted_usd FROM cy")
def _(t):
    return L.cycles(L.collapse(_findings(t), keep=["job_id", "reviewed_at"]), _runs(t))


@query("j13_fix_cycles_all", f"WITH RECURSIVE {_COLLAPSE_ALL}, {_RUNS}, {_ANY} SELECT content_hash, cycles, fix_commit_shas, wasted AS estimated_wasted_usd FROM cy")
def _(t):
    return L.cycles(L.collapse(_findings(t, "primary_file"), keep=["job_id", "reviewed_at"]), _runs(t))


# findings spread over 60 days, so that the window of 30 holds half of them at any size
_SPREAD = "CAST(TIMESTAMP '2023-12-02 00:00:00' AS TIMESTAMP) + (job_id * 7919) % 1440 * INTERVAL 1 HOUR"
_LOOPS = """SELECT cy.content_hash, any_value(severity) AS severity, any_value(primary_file) AS primary_file, arg_min(substr(problem_text, 1, 80), (reviewed_at, job_id)) AS summary, epoch_us(min(reviewed_at)) AS first_us, epoch_us(max(reviewed_at)) AS last_us,
 any_value(cycles) AS cycles, CASE WHEN any_value(cycles) >= 10 THEN 'escalate' WHEN any_value(cycles) >= 5 THEN 'block' ELSE 'watch' END AS tier, any_value(wasted) AS estimated_wasted_usd FROM cy JOIN col USING (content_hash) GROUP BY cy.content_hash"""


def _recent(rows: str) -> str:
    spread = rows.replace("reviewed_at FROM", f"{_SPREAD} AS reviewed_at FROM")
    return f"(SELECT * FROM {spread} w WHERE reviewed_at >= (SELECT max(reviewed_at) FROM {spread} m) - INTERVAL 30 DAY)"


def _loops(t, findings):
    out = L.detect_loops(findings.withColumn("reviewed_at", F.expr(_SPREAD)), _runs(t))
    return out.select("content_hash", "severity", "primary_file", "summary", micros("first_seen").alias("first_us"), micros("last_seen").alias("last_us"), "cycles", "tier", "estimated_wasted_usd")


@query("u12_detect_loops", f"WITH RECURSIVE {_COLLAPSE.replace(_F2, _recent(_F2))}, {_RUNS}, {_CYCLES} {_LOOPS}")
def _(t):
    return _loops(t, _findings(t))


# one severity and a folder as the file: large groups, in which findings come back in small tables too
_FOLDERS = "(SELECT job_id, 'high' AS severity, array_to_string(string_split(primary_file, '/')[1:2], '/') AS primary_file, problem_text, reviewed_at FROM findings)"


@query("u12_detect_loops_all", f"WITH RECURSIVE {_COLLAPSE.replace(_F2, _recent(_FOLDERS))}, {_RUNS}, {_CYCLES} {_LOOPS}")
def _(t):
    return _loops(t, _findings(t).withColumns({"severity": F.lit("high"), "primary_file": F.substring_index("folder", "/", 2)}))


# findings of every event: module k is named by 2 k + 1 of them in each of 1000 pages, in three wordings, so that loops of all tiers come up at any size
_MODULES = "(SELECT job_id, severity, primary_file, problem_text, reviewed_at FROM (SELECT event_id AS job_id, 'high' AS severity, concat('src/m', CAST(CAST(floor(sqrt(event_id % 1000)) AS INT) AS STRING), '/p', CAST(event_id // 1000 AS STRING), '.py') AS primary_file, concat('slow query in module m', CAST(CAST(floor(sqrt(event_id % 1000)) AS INT) AS STRING), ' for page ', CAST(event_id % 3 AS STRING)) AS problem_text FROM events) z)"


@query("u12_detect_loops_tiers", f"WITH RECURSIVE {_COLLAPSE.replace(_F2, _recent(_MODULES))}, {_RUNS}, {_CYCLES} {_LOOPS}")
def _(t):
    module = F.floor(F.sqrt(F.col("event_id") % 1000)).cast("string")
    rows = t("events").select(
        F.col("event_id").alias("job_id"), F.lit("high").alias("severity"), F.concat(F.lit("src/m"), module, F.lit("/p"), F.floor(F.col("event_id") / 1000).cast("string"), F.lit(".py")).alias("primary_file"),
        F.concat(F.lit("slow query in module m"), module, F.lit(" for page "), (F.col("event_id") % 3).cast("string")).alias("problem_text"), F.col("ts").cast("timestamp").alias("reviewed_at"),
    )
    return _loops(t, rows)


_MATCHES = f"""b AS (SELECT item_id, concat('src', CAST(item_id % 500 AS STRING)) AS file, {_TOKENS} AS tok FROM benchmark)
SELECT DISTINCT p.id AS prompt_id, md5(CAST(b.item_id AS STRING)) AS content_hash FROM p JOIN b ON b.file = p.file OR
 CASE WHEN len(p.tok) = 0 OR len(b.tok) = 0 THEN len(p.tok) = len(b.tok) ELSE len(list_intersect(p.tok, b.tok))::DOUBLE / len(list_distinct(list_concat(p.tok, b.tok))) >= 0.5 END"""


def _blocklist(t):
    return t("benchmark").select(F.md5(F.col("item_id").cast("string")).alias("content_hash"), F.concat(F.lit("src"), (F.col("item_id") % 500).cast("string")).alias("primary_file"), F.col("text").alias("summary"))


@query("j14_blocklist_matches", f"WITH p AS (SELECT concat(CAST(conv_id AS STRING), '/', CAST(turn AS STRING)) AS id, concat('src', CAST(conv_id % 900 AS STRING)) AS file, {_TOKENS} AS tok FROM conversations), {_MATCHES}")
def _(t):
    file = F.concat(F.lit("src"), (F.col("conv_id") % 900).cast("string"))
    prompts = t("conversations").select(F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("prompt_id"), "text", F.array(file).alias("files"))
    return J.blocklist_matches(prompts, _blocklist(t))


@query("j14_blocklist_matches_all", f"WITH p AS (SELECT doc_id AS id, source AS file, {_TOKENS} AS tok FROM documents), {_MATCHES}")
def _(t):
    prompts = t("documents").select(F.col("doc_id").alias("prompt_id"), "text", F.array("source").alias("files"))
    return J.blocklist_matches(prompts, _blocklist(t))
