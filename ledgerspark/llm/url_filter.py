"""URL verdicts from host and path rules and a learned path-template tree."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.operators.lineage import discard, stage

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WILD = "*"
POOLED = "~"
#: Levels that the SQL twin spells out; it holds for tables without longer paths.
DEPTH = 4
#: A level is variable from this share of new segments; a branch is as good as so many paths of the same branch on all hosts.
MIN_VARIETY, POOL_PATHS = 0.3, 4.0
CLOSE = 1.96
STRENGTH, REJECT = 4.0, 0.6
#: Tasks that share the segments of one branch.
SALTS = 16


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first ``://`` up to / ? # or the end, A-Z lower-cased; then up to ? or #."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(raw, _UPPER, _LOWER), path


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest (host, path, verdict) rule that fits; NULL where none does."""
    # one `when` a rule: a plan that grows with the parameter, not with the data
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _close(bad: Column, n: Column, all_bad: Column, all_n: Column) -> Column:
    """Whether a share of bad labels differs from a larger one by less than CLOSE standard errors; NULL without labels."""
    share = F.try_divide(all_bad.cast("double"), all_n)
    mine = F.try_divide(bad.cast("double"), n)
    spread = F.sqrt(share * (1 - share) * (F.try_divide(F.lit(1.0), n) + F.try_divide(F.lit(1.0), all_n)))
    return F.abs(mine - share) <= CLOSE * spread


def template_tree(paths: DataFrame) -> DataFrame:
    """Templates of (host, path, bad, good) rows, which are distinct by host and path.

    Segments are taken level by level until no path has a further one.  Below
    one branch of a host the share of paths that bring a new segment is
    estimated, drawn by POOL_PATHS paths towards that share below the same
    branch on all hosts; from MIN_VARIETY on the level is variable and becomes
    the wildcard.  How often a path is repeated has no say in it.  Other siblings
    are merged into one branch ``~`` if their labelled share of bad rows differs
    from their parent's by less than CLOSE standard errors, on their host and
    over the same segments of all hosts; labels that are not there part nothing.
    Where all paths of a branch on all hosts go on alike, the segments that
    they share are taken at once, and a path that is alone in its branch on all hosts
    takes all its further segments: so there are as many rounds as forks on a path, however
    long it is.  What all hosts say of a branch is a staged table, so that a
    join at a branch of very many hosts can be split.
    """
    seg = F.split(F.substring("path", 2, 1 << 30), "/")
    tree = paths.withColumns({"segs": seg, "template": F.lit(""), "at": F.lit(0)})
    done = []
    while True:
        tree = tree.withColumn("seg", F.get("segs", F.col("at")))
        rest = F.slice("segs", F.col("at") + 1, F.size("segs"))
        labelled = F.col("bad") + F.col("good")
        ended = F.concat(F.array_join(rest, "/"), F.lit("/"))  # each segment has an end, so that between two paths in order all share what these share
        values = tree.where(F.col("seg").isNotNull()).groupBy("host", "template", "seg").agg(F.count(F.lit(1)).alias("paths"), F.sum("bad").alias("b"), F.sum(labelled).alias("l"), F.min(ended).alias("lo"), F.max(ended).alias("hi"))
        values = stage(values, "segments")
        branch = values.groupBy("host", "template").agg(F.count(F.lit(1)).alias("kinds"), F.sum("paths").alias("below"), F.sum("b").alias("pb"), F.sum("l").alias("pl"))
        # the same branches and segments on all hosts: narrow rows, one a template or segment of one
        named = values.groupBy("template", "seg").agg(F.sum("paths").alias("all_paths"), F.sum("b").alias("ab"), F.sum("l").alias("al"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        named = stage(named.select("template", "seg", "all_paths", "ab", "al", _shared("lo", "hi").alias("shared")), "named")
        pooled = named.groupBy("template").agg(F.count(F.lit(1)).alias("all_kinds"), F.sum("all_paths").alias("all_below"), F.sum("ab").alias("apb"), F.sum("al").alias("apl"))
        pooled = stage(pooled, "pooled")
        branch = stage(branch.join(pooled, "template"), "branches")
        # SALTS rows a branch, of which Catalyst's estimate does not know: never sent to all tasks
        salted = branch.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("merge")
        nodes = values.drop("lo", "hi").withColumn("salt", F.pmod(F.xxhash64("seg"), F.lit(SALTS)).cast("int")).join(salted, ["host", "template", "salt"]).join(named, ["template", "seg"])
        usual = (F.col("all_kinds") - 1) / F.col("all_below")
        fresh = (F.col("kinds") - 1 + POOL_PATHS * usual) / (F.col("below") - 1 + POOL_PATHS)
        like = F.coalesce(_close(F.col("b"), F.col("l"), F.col("pb"), F.col("pl")), F.lit(True)) & F.coalesce(_close(F.col("ab"), F.col("al"), F.col("apb"), F.col("apl")), F.lit(True))
        step = F.when(fresh >= MIN_VARIETY, F.lit(WILD)).when(like & (F.col("kinds") > 1), F.lit(POOLED)).otherwise(F.col("seg"))
        far = F.when(F.col("all_kinds") == 1, F.col("shared")).otherwise(1)
        nodes = nodes.select("host", "template", "seg", step.alias("step"), (F.col("all_below") == 1).alias("alone"), far.alias("far"))
        tree = tree.join(nodes, ["host", "template", "seg"], "left")
        step = F.when(F.col("alone"), F.array_join(rest, "/")).when(F.col("far") > 1, F.array_join(F.slice("segs", F.col("at") + 1, F.col("far")), "/")).otherwise(F.col("step"))
        tree = tree.withColumn("template", F.when(F.col("step").isNotNull(), F.concat("template", F.lit("/"), step)).otherwise(F.col("template")))
        tree = tree.withColumn("at", F.col("at") + F.coalesce("far", F.lit(1)))
        tree = tree.withColumn("open", ~F.coalesce("alone", F.lit(True)) & (F.size("segs") > F.col("at"))).drop("seg", "step", "alone", "far")
        tree = stage(tree, "templates")  # read twice by the next level
        discard(values, named, pooled, branch)
        done.append(tree.where(~F.col("open")).drop("segs", "open", "at"))
        tree = tree.where("open").drop("open")
        if tree.isEmpty():
            return reduce(DataFrame.unionByName, done)


def _shared(lo: str, hi: str) -> Column:
    """How many segments two ended paths begin with alike."""
    x, y = F.split(lo, "/"), F.split(hi, "/")
    differ = F.array_position(F.zip_with(x, y, lambda a, b: a.eqNullSafe(b)), False)
    return F.least(F.when(differ > 0, differ - 1).otherwise(F.size(x)), F.size(x) - 1, F.size(y) - 1).cast("int")


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per input row: id, host, path, rule, verdict, template, purity.

    Where a rule fits, its verdict holds.  Other rows are judged by their
    template: the rows that rules decide are the labels; a template's share of
    blocked labels on its host is smoothed towards the same template's share on
    all hosts, and that towards the share of all labels (STRENGTH rows each);
    at REJECT or more it is blocked.  NULL urls and those without ``://`` have
    empty host and path and are judged like others; repeated rows and NULL ids
    stay; other columns are ignored.  All joins run on distinct (host, path)
    pairs with their labels, never on the rows of a host.
    """
    host, path = url_parts(F.col(url_col))
    rows = pages.select(F.col(id_col).alias(id_col), host.alias("host"), path.alias("path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "ruled": verdict})
    counted = rows.groupBy("host", "path").agg(
        F.count_if(F.col("ruled") == "block").alias("bad"),
        F.count_if(F.col("ruled") == "allow").alias("good"),
    )
    tree = template_tree(stage(counted, "paths"))
    own = tree.groupBy("host", "template").agg(F.sum("bad").alias("ob"), F.sum(F.col("bad") + F.col("good")).alias("ol"))
    own = stage(own, "templates-own")
    everywhere = stage(own.groupBy("template").agg(F.sum("ob").alias("tb"), F.sum("ol").alias("tl")), "templates-all")
    overall = everywhere.agg(F.sum("tb").alias("ab"), F.sum("tl").alias("al"))
    prior = F.coalesce(F.try_divide(F.col("ab").cast("double"), F.col("al")), F.lit(0.0))
    scored = own.join(everywhere, "template").crossJoin(F.broadcast(overall))
    general = (F.col("tb") + STRENGTH * prior) / (F.col("tl") + STRENGTH)
    scored = scored.select("host", "template", ((F.col("ob") + STRENGTH * general) / (F.col("ol") + STRENGTH)).alias("purity"))
    known = tree.select("host", "path", "template").join(scored, ["host", "template"])
    learned = F.when(F.col("purity") >= REJECT, F.lit("block")).otherwise(F.lit("allow"))
    return rows.join(known, ["host", "path"], "left").select(id_col, "host", "path", "rule", F.coalesce("ruled", learned).alias("verdict"), "template", F.round("purity", 9).alias("purity"))


def url_oracle(rules: list[tuple[str, str, str]]) -> str:
    """DuckDB SQL of the registered query."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v) for h, p, v in ordered]
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for c, r, _ in fits) + " END"
    ruled = "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for c, _, v in fits) + " END"
    levels, prev = "", "t0"

    def close(b: str, n: str, pb: str, pn: str) -> str:
        p = f"({pb}::DOUBLE / {pn})"
        return f"abs({b}::DOUBLE / {n} - {p}) <= {CLOSE}::DOUBLE * sqrt({p} * (1 - {p}) * (1::DOUBLE / {n} + 1::DOUBLE / {pn}))"

    for d in range(1, DEPTH + 1):
        levels += f"""
v{d} AS (SELECT host, template, segs[{d}] AS seg, count(*) AS n, sum(bad) AS b, sum(bad + good) AS l FROM {prev} WHERE segs[{d}] IS NOT NULL GROUP BY ALL),
h{d} AS (SELECT host, template, count(*) AS kinds, sum(n) AS below, sum(b) AS pb, sum(l) AS pl FROM v{d} GROUP BY ALL),
w{d} AS (SELECT template, seg, sum(n) AS n, sum(b) AS ab, sum(l) AS al FROM v{d} GROUP BY ALL),
a{d} AS (SELECT template, count(*) AS all_kinds, sum(n) AS all_below, sum(ab) AS apb, sum(al) AS apl FROM w{d} GROUP BY ALL),
s{d} AS (SELECT v.host, v.template, v.seg,
  CASE WHEN (kinds - 1 + {POOL_PATHS}::DOUBLE * ((all_kinds - 1)::DOUBLE / all_below)) / (below - 1 + {POOL_PATHS}::DOUBLE) >= {MIN_VARIETY}::DOUBLE THEN '{WILD}'
   WHEN kinds > 1 AND CASE WHEN l > 0 THEN {close("b", "l", "pb", "pl")} ELSE true END AND CASE WHEN al > 0 THEN {close("ab", "al", "apb", "apl")} ELSE true END THEN '{POOLED}' ELSE v.seg END AS step
  FROM v{d} v JOIN h{d} h ON h.host = v.host AND h.template = v.template JOIN w{d} w ON w.template = v.template AND w.seg = v.seg JOIN a{d} a ON a.template = v.template),
t{d} AS (SELECT p.host, p.path, p.n, p.bad, p.good, p.segs, p.template || CASE WHEN s.step IS NULL THEN '' ELSE '/' || s.step END AS template
  FROM {prev} p LEFT JOIN s{d} s ON s.host = p.host AND s.template = p.template AND s.seg = p.segs[{d}]),"""
        prev = f"t{d}"
    return f"""
WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
raw AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS h FROM cut),
parts AS (SELECT page_id, translate(h, '{_UPPER}', '{_LOWER}') AS host, regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM raw),
rows AS (SELECT *, {rule} AS rule, {ruled} AS ruled FROM parts),
t0 AS (SELECT host, path, count(*) AS n, count(*) FILTER (ruled = 'block') AS bad, count(*) FILTER (ruled = 'allow') AS good,
  string_split(substr(path, 2), '/') AS segs, '' AS template FROM rows GROUP BY host, path),{levels}
tree AS (SELECT host, path, bad, good, template FROM {prev}),
own AS (SELECT host, template, sum(bad) AS ob, sum(bad + good) AS ol FROM tree GROUP BY ALL),
ev AS (SELECT template, sum(ob) AS tb, sum(ol) AS tl FROM own GROUP BY ALL),
al AS (SELECT coalesce(sum(tb)::DOUBLE / nullif(sum(tl), 0), 0) AS prior FROM ev),
scored AS (SELECT host, template, (ob + {STRENGTH}::DOUBLE * ((tb + {STRENGTH}::DOUBLE * prior) / (tl + {STRENGTH}::DOUBLE))) / (ol + {STRENGTH}::DOUBLE) AS purity FROM own JOIN ev USING (template) CROSS JOIN al)
SELECT r.page_id, r.host, r.path, r.rule, coalesce(r.ruled, CASE WHEN purity >= {REJECT} THEN 'block' ELSE 'allow' END) AS verdict, t.template, round(purity, 9) AS purity
FROM rows r JOIN tree t USING (host, path) JOIN scored s ON s.host = t.host AND s.template = t.template
"""
