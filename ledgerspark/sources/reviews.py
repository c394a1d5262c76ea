"""Review reports in markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.columns import SEVERITIES, VERDICTS, finding_hash, one_of


#: A field begins with its label in bold, behind a dash or not, and ends at the next field or heading.
_LABEL = r"^[ \t]*(?:-[ \t]+)?\*{1,2}(\w+)\*{1,2}:"
_FIELD = rf"(?ms){_LABEL}(.*?)(?=^[ \t]*(?:-[ \t]+)?\*{{1,2}}\w+\*{{1,2}}:|^[ \t]*#|\z)"


def _fields(block: Column) -> Column:
    """Array of (label, text) of a block, labels in lower case, texts trimmed."""
    labels, texts = (F.regexp_extract_all(block, F.lit(_FIELD), F.lit(k)) for k in (1, 2))
    return F.zip_with(labels, texts, lambda k, t: F.struct(F.lower(k).alias("label"), F.trim(F.regexp_replace(t, r"^\s+|\s+$", "")).alias("text")))


def _first(fields: Column, label: str) -> Column:
    """Text of the first field of a label; NULL where there is none or it is empty."""
    return F.nullif(F.get(F.filter(fields, lambda f: f["label"] == label), F.lit(0))["text"], F.lit(""))


def _place(text: Column) -> tuple[Column, Column]:
    """(path, line) of a location; of a range of lines only the path."""
    parts = F.split(F.trim(F.replace(text, F.lit("`"), F.lit(""))), ":")
    last = F.trim(F.element_at(parts, -1))
    numbered = (F.size(parts) > 1) & last.rlike(r"^\d+(-\d+)?$")
    path = F.when(numbered, F.array_join(F.slice(parts, 1, F.size(parts) - 1), ":")).otherwise(F.array_join(parts, ":"))
    return F.trim(path), F.when(numbered & ~last.contains("-"), last.cast("int"))


def parse_findings(reports: DataFrame, job: str = "job_id", text: str = "output") -> DataFrame:
    """One row per finding of a report.

    Blocks are parted by lines of three or more dashes, and each is split once
    into labelled fields, which may have several lines.  Severity and problem
    are required, location and fix optional; of a repeated label the first
    counts.  The primary file is the first of the locations without back-ticks
    and line numbers.
    """
    b = reports.select(job, F.explode(F.split(text, r"\n---+\n")).alias("b")).select(job, _fields(F.col("b")).alias("f"))
    full = F.replace(F.substring_index(_first(F.col("f"), "location"), "\n", 1), F.lit("`"), F.lit(""))
    b = b.select(job, F.lower(F.regexp_extract(_first(F.col("f"), "severity"), "^[A-Za-z]+", 0)).alias("severity"), full.alias("full_location"), _first(F.col("f"), "problem").alias("problem_text"), _first(F.col("f"), "fix").alias("fix_text"))
    primary = _place(F.get(F.split("full_location", "[;,]"), F.lit(0)))[0]
    out = b.select(job, "severity", primary.alias("primary_file"), "full_location", "problem_text", "fix_text")
    return out.where((F.col("severity") != "") & F.col("problem_text").isNotNull())


def review_listing(findings: DataFrame, jobs: DataFrame, since: str) -> DataFrame:
    """Findings with their job's columns; the time is the first known of three; odd severities and verdicts are ``unknown``."""
    times = [F.col(c).cast("timestamp") for c in ("reviewed_at", "created_at", "timestamp") if c in jobs.columns]
    j = jobs.select("job_id", "project", "agent", one_of("verdict", VERDICTS).alias("verdict"), F.coalesce(*times).alias("at"))
    out = findings.join(j, "job_id").where(F.col("at") >= F.lit(since).cast("timestamp"))
    return out.withColumns({"severity": one_of("severity", SEVERITIES), "content_hash": finding_hash("severity", "primary_file", "problem_text")})


def review_locations(reports: DataFrame, keep: list[str], text: str = "output") -> DataFrame:
    """(file_path, line) of the first place of every location; a range gives no line number."""
    rows = reports.select(*keep, F.explode(_fields(F.col(text))).alias("f")).where((F.col("f.label") == "location") & (F.col("f.text") != ""))
    path, line = _place(F.substring_index(F.substring_index("f.text", "\n", 1), ";", 1))
    return rows.select(*keep, path.alias("file_path"), line.alias("line"))
