"""Canonical project names and removal of private identifiers, as column functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.columns import any_regex, col, hash12, is_in
from ledgerspark.rules.projects import DENIED, DENIED_PREFIXES, HOME_PATHS, PROJECTS, SENSITIVE, UUID_SUFFIX, ProjectRules


def _strip(x: Column, patterns) -> Column:
    return reduce(lambda v, p: F.regexp_replace(v, p, ""), patterns, x)


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def canonical_project(name: Column | str, rules: ProjectRules = PROJECTS) -> Column:
    """Project name for a raw name or path; NULL where the rules call it noise."""
    raw = col(name)
    plain = _strip(raw, rules.homes)
    plain = F.regexp_replace(plain, rf"(?i)-({'|'.join(rules.branches)})(-.*)?$", "")
    plain = F.replace(_strip(plain, [f"^{p}-" for p in rules.prefixes]), F.lit("-"), F.lit("/"))

    def flattened(x: Column) -> Column:
        flat = F.replace(_strip(x, [*rules.flat_homes, *(f"^{p}_" for p in rules.prefixes)]), F.lit("_"), F.lit("/"))
        return F.when(x.startswith("/") | x.startswith(rules.flat_root), flat).otherwise(x)

    def segment(y: Column) -> Column:
        inner = y
        for p in reversed(rules.containers):
            inner = F.when(y.startswith(p), F.substr(y, F.lit(len(p) + 1))).otherwise(inner)
        return F.substring_index(inner, "/", 1)

    def judged(x: Column, y: Column) -> Column:
        out = bind(segment(y), lambda s: F.when((s != "") & ~s.rlike("^[0-9]+$") & ~s.isin(*rules.noise), s))
        for start, value in reversed(rules.overrides):
            out = F.when(y.startswith(start), F.lit(value)).otherwise(out)
        out = F.when((y != "") & ~x.isin(*rules.noise) & ~x.rlike(rules.hashes), out)
        for token, value in rules.remaps:
            out = F.when(x == token, F.lit(value)).otherwise(out)
        return out

    tail = lambda x: F.regexp_replace(x, rules.checkout, "")
    out = bind(bind(plain, flattened), lambda x: bind(tail(x), lambda y: judged(x, y)))
    dropped = raw.isNull() | (raw == "") | raw.isin(*[n for n in rules.noise if "-" in n]) | any_regex(raw, rules.worktrees)
    return F.when(~dropped, out)


def project_of_directory(cwd: Column | str, root: str = "/git/", rules: ProjectRules = PROJECTS) -> Column:
    """Project of a working directory: the first fitting segment after the first code root, else the last one of the path.

    Segments fit that are not empty, not a number, not dotted and no folder that
    the rules name.
    """
    c = col(cwd)
    named = dict.fromkeys((*rules.roots, *rules.noise, *(x for p in rules.containers for x in p.rstrip("/").split("/"))))
    plain = lambda s: (s != "") & ~s.isin(*named) & ~s.rlike("^[0-9]+$") & ~s.startswith(".")
    at = F.instr(c, root)
    after = F.when(at > 0, F.filter(F.split(F.substr(c, at + len(root)), "/"), plain))
    return F.coalesce(F.get(after, F.lit(0)), F.try_element_at(F.filter(F.split(c, "/"), plain), F.lit(-1)))


def confidential(columns: list[str], denied=DENIED, prefixes=DENIED_PREFIXES) -> Column:
    """True where any of the columns is on the denylist or starts with a denied prefix, in any case."""
    hits = [is_in(F.lower(c), [d.lower() for d in denied]) for c in columns]
    hits += [F.coalesce(F.lower(c).startswith(p.lower()), F.lit(False)) for c in columns for p in prefixes]
    return reduce(lambda a, b: a | b, hits, F.lit(False))


def drop_confidential(df: DataFrame, columns: list[str], denied=DENIED, prefixes=DENIED_PREFIXES) -> DataFrame:
    """Rows of no denied project; absent columns are skipped, rows of NULL projects stay."""
    return df.where(~confidential([c for c in columns if c in df.columns], denied, prefixes))


def clean_projects(df: DataFrame, project: str, aliases, denied=DENIED, rules: ProjectRules = PROJECTS) -> DataFrame:
    """Aliases folded and denied projects dropped, both in any case and by the name before a branch's suffix as well.

    A name that is no alias stays as it is, with its suffix.  Aliases are taken
    in their order, each on what the ones before it have left; rows without a
    project stay, and so does a table without the column.
    """
    if project not in df.columns:
        return df
    name = F.col(project)
    state = F.struct(name.alias("name"), F.regexp_replace(name, rf"(?i)-({'|'.join(rules.branches)})-.*$", "").alias("base"))

    def fold(alias: str, value: str):
        to = F.struct(F.lit(value).alias("name"), F.lit(value).alias("base"))
        return lambda s: F.when((F.lower(s["base"]) == alias.lower()) | (F.lower(s["name"]) == alias.lower()), to).otherwise(s)

    for a, b in aliases:
        state = bind(state, fold(a, b))
    kept = df.withColumn("__clean", state).where(~is_in(F.lower("__clean.base"), [d.lower() for d in denied]))
    return kept.withColumn(project, F.col("__clean.name")).drop("__clean")


def sanitize_session_id(ident: Column | str, project: Column | str, started: Column | str) -> Column:
    """Ids that look like paths become ``sanitized@project@time@hHASH``; others stay."""
    i = col(ident)
    stamp = F.coalesce(F.date_format(col(started), "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("na"))
    clean = F.concat_ws("@", F.lit("sanitized"), F.coalesce(col(project), F.lit("unknown")), stamp, F.concat(F.lit("h"), hash12(i)))
    return F.when(i.rlike(r"^-|[/\\]"), clean).otherwise(i)


def sanitize_usage_id(ident: Column | str, rules: ProjectRules = PROJECTS) -> Column:
    """Sensitive ids become ``sanitized@project@hHASH``."""
    i = col(ident)
    clean = F.concat(F.lit("sanitized@"), F.coalesce(canonical_project(F.regexp_replace(i, UUID_SUFFIX, ""), rules), F.lit("unknown")), F.lit("@h"), hash12(i))
    return F.when(i.rlike(r"^-|[/\\]") | any_regex(i, SENSITIVE), clean).otherwise(i)


def redact_directory(path: Column | str) -> Column:
    """Home and temporary prefixes cut; NULL where the rest is still sensitive."""
    x = _strip(col(path), HOME_PATHS)
    return F.when(~any_regex(x, SENSITIVE), x)
