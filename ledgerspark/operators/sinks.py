"""Writes that switch over whole, guards before them, and gates before publishing."""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.functions.columns import any_regex
from ledgerspark.functions.identifiers import confidential
from ledgerspark.operators.lineage import discard, stage
from ledgerspark.schemas import conform, empty


class GateError(RuntimeError):
    """A table may not be written or published as it is."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


_VERSION = re.compile(r"version-(\d{12})$")
#: A version file that is not whole and older than so many minutes was left by a writer that stopped.
STOPPED_MINUTES = 10
#: So many parts of like size become one.
FAN = 4


@dataclass(frozen=True)
class Part:
    """A folder of rows: its name, their number, the names of the rules that hold for them, and the bucket of their keys, if any."""

    name: str
    rows: int
    rules: tuple[str, ...] = ()
    bucket: int | None = None


@dataclass(frozen=True)
class Rule:
    """What all rows of a table must satisfy: a name that is stored with each part, and the change that brings it about."""

    name: str
    change: Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Version:
    """What a table consists of: its number, folders of rows, their count, and notes of the writer."""

    number: int
    parts: tuple[Part, ...]
    rows: int
    notes: dict


def _version_files(spark: SparkSession, path: str) -> dict[int, object]:
    """Number -> status of each version file."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return {}
    found = [(_VERSION.match(s.getPath().getName()), s) for s in fs.listStatus(p)]
    return {int(m[1]): s for m, s in found if m}


def _load(spark: SparkSession, path: str, number: int) -> Version | None:
    """A version; None where its file is not whole."""
    fs, p = _fs(spark, f"{path}/version-{number:012d}")
    stream = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        body = json.loads(text)
    except ValueError:
        return None
    parts = (Part(x["name"], x["rows"], tuple(x["rules"]), x["bucket"]) for x in body["parts"])
    return Version(number, tuple(parts), body["rows"], body["notes"])


def version_of(spark: SparkSession, path: str) -> Version | None:
    """The newest whole version; its file is written after its rows and never changed."""
    for number in sorted(_version_files(spark, path), reverse=True):
        version = _load(spark, path, number)
        if version is not None:
            return version
    return None


def _publish(spark: SparkSession, path: str, old: Version | None, parts: list[Part], rows: int, notes: dict) -> None:
    """Create the next version's file, which no other writer may have created.

    A number is given once: of two writers that start from one version the
    second fails at ``create``, also where a rename would replace.  Readers take
    a file that is not whole for one that isn't there; a writer that stopped in
    the middle of it is in nobody's way after STOPPED_MINUTES.
    """
    number = (old.number if old else 0) + 1
    fs, target = _fs(spark, f"{path}/version-{number:012d}")
    if fs.exists(target):
        age = (time.time() * 1000 - fs.getFileStatus(target).getModificationTime()) / 60_000
        if age < STOPPED_MINUTES or _load(spark, path, number) is not None:
            raise GateError(f"{path}: another writer has made version {number}")
        fs.delete(target, False)
    body = {"parts": [{"name": p.name, "rows": p.rows, "rules": list(p.rules), "bucket": p.bucket} for p in parts], "rows": rows, "notes": notes}
    try:
        out = fs.create(target, False)
    except Py4JJavaError as e:
        raise GateError(f"{path}: another writer has made version {number}") from e
    out.write(bytearray(json.dumps(body).encode()))
    out.close()


def read_parts(spark: SparkSession, path: str, parts: Sequence[Part], ddl: str, defaults: dict | None = None) -> DataFrame:
    """Rows of some parts; no parts are an empty table, missing columns get their default."""
    if not parts:
        return empty(spark, ddl)
    have = spark.read.option("mergeSchema", "true").parquet(*(f"{path}/{x.name}" for x in parts))
    return conform(have, ddl, defaults)


def read_table(spark: SparkSession, path: str, ddl: str, defaults: dict | None = None) -> DataFrame:
    """The table's newest version; no table is an empty one, missing columns get their default."""
    version = version_of(spark, path)
    return read_parts(spark, path, version.parts if version else (), ddl, defaults)


def _drop_part(spark: SparkSession, path: str, part: Part) -> None:
    fs, p = _fs(spark, f"{path}/{part.name}")
    fs.delete(p, True)


def _write_part(df: DataFrame, path: str, rules: Sequence[str] = (), bucket: int | None = None) -> Part:
    name = f"part-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(f"{path}/{name}")
    return Part(name, df.sparkSession.read.schema(df.schema).parquet(f"{path}/{name}").count(), tuple(rules), bucket)


def write_table(df: DataFrame, path: str, allow_shrink: bool = True, notes: dict | None = None, rules: Sequence[str] = ()) -> int:
    """Write the rows beside the old version's and publish them as the next version; returns their number.

    Readers see the old version or the new one, never a part and never nothing:
    no file of a version is deleted or renamed.  With ``allow_shrink`` off, rows
    fewer than the current version's are refused and removed again.
    """
    spark = df.sparkSession
    old = version_of(spark, path)
    part = _write_part(df, path, rules)
    if not allow_shrink and old is not None and part.rows < old.rows:
        _drop_part(spark, path, part)
        raise GateError(f"{path}: {part.rows} rows would be fewer than before")
    _publish(spark, path, old, [part], part.rows, notes or {})
    return part.rows


def append_table(df: DataFrame, path: str, notes: dict | None = None, rules: Sequence[str] = ()) -> int:
    """Add rows as a part of their own: what is stored is neither read nor written; returns the table's rows.

    Without rows there is no part, and no version unless the notes change or
    the table is new.  ``rules`` are those that the rows are known to satisfy.
    """
    spark = df.sparkSession
    old = version_of(spark, path)
    part = _write_part(df, path, rules)
    had = old.notes if old else {}
    told = {**had, **(notes or {})}
    if not part.rows and old is not None:
        _drop_part(spark, path, part)
        if told != had:
            _publish(spark, path, old, list(old.parts), old.rows, told)
        return old.rows
    rows = part.rows + (old.rows if old else 0)
    _publish(spark, path, old, [*(old.parts if old else ()), part], rows, told)
    return rows


def migrate_table(spark: SparkSession, path: str, ddl: str, rules: Sequence[Rule]) -> int:
    """Bring stored rows under ``rules``: parts that lack one are read, changed and replaced; returns the rows written.

    Parts that have all rules are not opened, so a table that is up to date
    costs a look at its version.  Rules are applied in their order; parts that
    lack the same ones become one part.  The columns are those of ``ddl``.
    """
    old = version_of(spark, path)
    lacking: dict[tuple[tuple[str, ...], int | None], list[Part]] = {}
    kept, written = [], 0
    for part in old.parts if old else ():
        missing = tuple(r.name for r in rules if r.name not in part.rules)
        (lacking.setdefault((missing, part.bucket), []) if missing else kept).append(part)
    if not lacking:
        return 0
    for (missing, bucket), parts in lacking.items():
        rows = read_parts(spark, path, parts, ddl)
        for rule in rules:
            rows = rule.change(rows) if rule.name in missing else rows
        kept.append(_write_part(rows, path, [*_common_rules(parts), *missing], bucket))
        written += kept[-1].rows
    _publish(spark, path, old, kept, sum(p.rows for p in kept), old.notes)
    return written


def _common_rules(parts: Sequence[Part]) -> list[str]:
    return [r for r in parts[0].rules if all(r in p.rules for p in parts)]


def _tier(rows: int, fan: int) -> int:
    """How often ``fan`` divides the number of rows."""
    tier = 0
    while rows >= fan:
        rows //= fan
        tier += 1
    return tier


def merge_plan(parts: Sequence[Part], fan: int = FAN) -> list[list[Part]]:
    """Parts to become one, by size: ``fan`` of a tier move to the next, where they may meet others again."""
    groups = [[p] for p in parts]
    while True:
        tiers: dict[int, list[list[Part]]] = {}
        for g in groups:
            tiers.setdefault(_tier(sum(p.rows for p in g), fan), []).append(g)
        full = min((t for t, found in tiers.items() if len(found) >= fan), default=None)
        if full is None:
            return [g for g in groups if len(g) > 1]
        groups = [g for t, found in tiers.items() if t != full for g in found] + [[p for g in tiers[full] for p in g]]


def merge_tiers(spark: SparkSession, path: str, ddl: str, fan: int = FAN, combine: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> int:
    """Merge parts of like size, so that appends leave few parts; returns the rows written.

    ``combine`` makes what is stored of the rows of several parts, for tables
    whose rows add up.

    Parts belong to a tier by the power of ``fan`` that their rows reach.  A row
    is written again only when its part moves to a higher tier: N batches write
    O(N log N) rows, and less than ``fan`` parts stay in each tier.
    """
    old = version_of(spark, path)
    plan = merge_plan([p for p in old.parts if p.bucket is None], fan) if old else []  # buckets stay as they are
    if not plan:
        return 0
    merged = [_write_part(combine(read_parts(spark, path, g, ddl)), path, _common_rules(g)) for g in plan]
    gone = {p.name for g in plan for p in g}
    parts = [p for p in old.parts if p.name not in gone] + merged
    _publish(spark, path, old, parts, sum(p.rows for p in parts), old.notes)
    return sum(p.rows for p in merged)


def upsert_table(rows: DataFrame, path: str, ddl: str, keys: Sequence[str], merge: Callable[[DataFrame, DataFrame], DataFrame], buckets: int = 64) -> int:
    """Merge rows into a table that is kept in buckets of its keys' hash; returns the rows written.

    ``merge`` makes the stored rows of old and new ones, which share their keys'
    buckets; it may drop rows, but not change keys.  Only buckets that new rows fall into are read and written, the
    others stay in the next version as they are; all that is touched is one job.
    NULL keys have a bucket as well; what they match is for ``merge`` to say.  A table without buckets, or with another number
    of them, is put into buckets by the first upsert.
    """
    spark = rows.sparkSession
    old = version_of(spark, path)
    where = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    new = stage(conform(rows, ddl), "upsert")
    same = old is not None and old.notes.get("buckets") == buckets and old.notes.get("keys") == list(keys)
    touched = {r["b"] for r in new.select(where.alias("b")).distinct().collect()}  # `buckets` numbers at most
    if same and not touched:
        discard(new)
        return 0
    parts = old.parts if old else ()
    read = [p for p in parts if not same or p.bucket in touched]
    merged = conform(merge(read_parts(spark, path, read, ddl), new), ddl).withColumn("__bucket", where)
    name = f"part-{uuid.uuid4().hex}"
    merged.repartition("__bucket").write.option("compression", "zstd").partitionBy("__bucket").parquet(f"{path}/{name}")
    back = spark.read.schema(f"{ddl}, __bucket int").parquet(f"{path}/{name}")
    sizes = {r["__bucket"]: r["count"] for r in back.groupBy("__bucket").count().collect()}
    made = [Part(f"{name}/__bucket={b}", n, tuple(_common_rules(read)) if read else (), b) for b, n in sorted(sizes.items())]
    kept = [p for p in parts if p not in read]
    notes = {**(old.notes if old else {}), "buckets": buckets, "keys": list(keys)}
    _publish(spark, path, old, kept + made, sum(p.rows for p in kept + made), notes)
    discard(new)
    return sum(sizes.values())


def compact_table(spark: SparkSession, path: str, ddl: str, parts: int = 32) -> bool:
    """Write a table of more than ``parts`` parts as one; to be called by hand, drains call ``merge_tiers``."""
    old = version_of(spark, path)
    if old is None or len(old.parts) <= parts:
        return False
    write_table(read_table(spark, path, ddl), path, allow_shrink=False, notes=old.notes, rules=_common_rules(old.parts))
    return True


def vacuum_table(spark: SparkSession, path: str, keep_hours: float = 0.0) -> int:
    """Delete what no version needs that was the newest within ``keep_hours``; returns the number of deleted parts and versions.

    A version needs to stay until its successor is so old: readers that began
    with it have that long to end.  Parts of no version go by their own age, so
    that a writer at work keeps its part; with 0 hours nobody else may be at work.
    """
    files = _version_files(spark, path)
    newest = version_of(spark, path)
    if newest is None:
        return 0
    until = time.time() * 1000 - keep_hours * 3_600_000
    numbers = sorted(n for n in files if n <= newest.number)
    kept = [n for n, after in zip(numbers, numbers[1:], strict=False) if keep_hours and files[after].getModificationTime() > until] + [newest.number]
    needed = {p.name for n in kept for p in ((_load(spark, path, n) or newest).parts)} | {f"version-{n:012d}" for n in kept}
    shared = {n.partition("/")[0] for n in needed if "/" in n}  # folders of buckets, some of which may be needed
    fs, p = _fs(spark, path)
    found = [(s.getPath().getName(), s) for s in fs.listStatus(p)]
    found += [(f"{name}/{s.getPath().getName()}", s) for name, folder in found if name in shared for s in fs.listStatus(folder.getPath()) if "=" in s.getPath().getName()]
    gone = 0
    for name, status in found:
        m = _VERSION.match(name)
        old = (int(m[1]) < newest.number) if m else (not keep_hours or status.getModificationTime() <= until)
        if name not in needed and name not in shared and old:
            fs.delete(status.getPath(), True)
            gone += 1
    return gone


def keep_only(spark: SparkSession, path: str, names: set[str], keep_hours: float = 0.0) -> None:
    """Delete what else is in a folder and older than ``keep_hours``."""
    fs, p = _fs(spark, path)
    until = time.time() * 1000 - keep_hours * 3_600_000
    for status in fs.listStatus(p) if fs.exists(p) else ():
        if status.getPath().getName() not in names and status.getModificationTime() <= until:
            fs.delete(status.getPath(), True)


def append_fetch(df: DataFrame, path: str, fetched: str) -> None:
    """Append a snapshot with its fetch time."""
    df.withColumn("fetch_timestamp", F.lit(fetched).cast("timestamp")).write.mode("append").option("compression", "zstd").parquet(path)


def publish_gate(df: DataFrame, columns: list[str], drop: tuple[str, ...] = ("working_dir", "cwd", "path")) -> DataFrame:
    """The frame without path columns; raises if any row is confidential."""
    bad = df.where(confidential([c for c in columns if c in df.columns])).limit(1).count()
    if bad:
        raise GateError("confidential rows may not be published")
    return df.drop(*drop)


def manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """(file, n_rows) of what is published."""
    return catalog_summary(tables).select(F.concat("table_name", F.lit(".parquet")).alias("file"), F.col("n").alias("n_rows"))


def catalog_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


def completeness(critical: dict[str, DataFrame], optional: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """(table_name, n, ok): critical tables must have rows, optional ones their columns."""
    c = catalog_summary(critical).withColumn("ok", F.col("n") > 0)
    for name, (df, columns) in optional.items():
        ok = set(columns) <= set(df.columns)
        c = c.unionByName(df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"), F.lit(ok).alias("ok")))
    return c


def require_complete(report: DataFrame) -> None:
    """Raise with the tables that are not complete; the report has one row per table."""
    bad = [r["table_name"] for r in report.where(~F.col("ok")).collect()]
    if bad:
        raise GateError("incomplete: " + ", ".join(sorted(bad)))


def log_run(runs: DataFrame, started: str, ended: str, seen: int, new: int, loops: int, status: str) -> DataFrame:
    """The run log with one more row; run_id is the largest plus 1."""
    last = runs.agg((F.coalesce(F.max("run_id"), F.lit(0)) + 1).alias("run_id"))
    row = last.select(
        F.col("run_id").cast("long"), F.lit(started).cast("timestamp").alias("started_at"), F.lit(ended).cast("timestamp").alias("ended_at"),
        F.lit(seen).cast("long").alias("reviews_seen"), F.lit(new).cast("long").alias("new_findings"), F.lit(loops).cast("long").alias("loops_active"), F.lit(status).alias("status"),
    )
    return runs.unionByName(row)


def write_json(df: DataFrame, path: str) -> None:
    """A result table as lines of JSON."""
    df.write.mode("overwrite").json(path)


def leaks(df: DataFrame, patterns) -> DataFrame:
    """Rows per pattern in which any column holds it."""
    text = F.to_json(F.struct("*"))
    hit = F.array(*(F.struct(F.lit(p).alias("pattern"), any_regex(text, [p]).alias("hit")) for p in patterns))
    return df.select(F.inline(hit)).groupBy("pattern").agg(F.count_if("hit").alias("n"))


def as_manifest_json(report: DataFrame) -> str:
    """The manifest as JSON text; it has one row per table."""
    return json.dumps({r["file"]: r["n_rows"] for r in report.collect()}, sort_keys=True)
