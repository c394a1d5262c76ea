"""Column functions that the jobs share: text, hashes, dates, ratios, enumerations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words that token sets leave out.
STOPWORDS = (
    "a", "an", "the", "of", "in", "to", "for", "with", "is", "it", "at", "by", "on", "as", "or", "be", "has", "was", "are", "that", "this", "and", "but", "not", "from", "have",
)
#: Severities from mild to grave, verdicts, and check results from good to bad.
SEVERITIES = ("low", "medium", "high", "critical")
VERDICTS = ("pass", "fail")
CHECKS = ("OK", "NOTE", "WARNING", "ERROR", "FAIL")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sum0(c: Column | str) -> Column:
    """Sum that is 0 where every value is NULL."""
    return F.coalesce(F.sum(col(c)), F.lit(0))


def is_in(c: Column | str, values) -> Column:
    """Membership that is false, not NULL, for NULL."""
    return F.coalesce(col(c).isin(*values), F.lit(False)) if values else F.lit(False)


def computed(df: DataFrame, **values: Column) -> DataFrame:
    """The frame with these columns, computed once a row.

    Conditions on them stay behind the computation; on columns of a plain
    projection they are moved before it, and each of them repeats it.
    """
    kept = [c for c in df.columns if c not in values]
    return df.select(*kept, F.inline(F.array(F.struct(*(v.alias(k) for k, v in values.items())))))


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b, NULL where b is NULL or 0."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def ratio1(a: Column | str, b: Column | str) -> Column:
    """a / max(1, b)."""
    return col(a).cast("double") / F.greatest(F.lit(1), F.coalesce(col(b), F.lit(0)))


# text -----------------------------------------------------------------


def first_words(c: Column | str, n: int = 12) -> Column:
    """The first n words, joined by single spaces."""
    words = F.split(F.trim(F.regexp_replace(col(c), r"\s+", " ")), " ")
    return F.array_join(F.slice(words, 1, n), " ")


def token_set(c: Column | str) -> Column:
    """Distinct lower-case words without punctuation, empty strings and stopwords."""
    words = F.split(F.lower(col(c)), r"[\s\p{Punct}]+")
    return F.array_except(words, F.array(F.lit(""), *map(F.lit, STOPWORDS)))


def jaccard(a: Column | str, b: Column | str) -> Column:
    """Similarity of two token sets: 1 where both are empty, 0 where one is."""
    a, b = col(a), col(b)
    both = F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)).cast("double")
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(both)


def finding_hash(severity: Column | str, file: Column | str, text: Column | str) -> Column:
    """md5 of lower-case severity, file and the text's first 12 words, parted by 0x1f."""
    none = F.lit("")
    return F.md5(F.concat_ws("\x1f", F.coalesce(F.lower(col(severity)), none), F.coalesce(col(file), none), F.coalesce(first_words(text), none)))


def hash12(c: Column | str) -> Column:
    return F.substring(F.md5(col(c)), 1, 12)


def any_regex(c: Column | str, patterns) -> Column:
    return reduce(lambda x, y: x | y, (F.coalesce(col(c).rlike(p), F.lit(False)) for p in patterns), F.lit(False))


# dates ----------------------------------------------------------------


def iso_week(d: Column | str) -> Column:
    """Year and week as ISO 8601 counts them, like 2024-01."""
    return F.format_string("%04d-%02d", F.extract(F.lit("YEAROFWEEK"), col(d)), F.weekofyear(col(d)))


def monday(d: Column | str) -> Column:
    return F.date_trunc("week", col(d)).cast("date")


def sunday(d: Column | str) -> Column:
    """The Sunday on or before the date."""
    return F.date_sub(col(d), F.dayofweek(col(d)) - 1)


def monday_week_of_year(d: Column | str) -> Column:
    """Year and week, weeks starting on Mondays and days before the first one in week 00: 2024-W01."""
    week = F.floor((F.dayofyear(col(d)) + 6 - F.weekday(col(d))) / 7)
    return F.format_string("%04d-W%02d", F.year(col(d)), week)


def month(d: Column | str) -> Column:
    return F.date_format(col(d), "yyyy-MM")


def period(d: Column | str, grain: str) -> Column:
    """Label of the day, week (Mondays of the year) or month of a date."""
    return {"daily": col(d).cast("string"), "weekly": monday_week_of_year(d), "monthly": month(d)}[grain]


def year_day(year: Column | str, day: Column | str) -> Column:
    """Date from a year and a day of that year."""
    return F.date_add(F.make_date(col(year), F.lit(1), F.lit(1)), col(day).cast("int") - 1)


def parse_time(c: Column | str) -> Column:
    """ISO 8601 text in its usual spellings; NULL where none fits."""
    forms = ("yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")
    return F.coalesce(*(F.try_to_timestamp(col(c), F.lit(f)) for f in forms))


def micros(c: Column | str) -> Column:
    return F.unix_micros(col(c).cast("timestamp"))


def minutes_between(a: Column | str, b: Column | str) -> Column:
    return (micros(b) - micros(a)) / F.lit(60e6)


def hours_between(a: Column | str, b: Column | str) -> Column:
    return (micros(b) - micros(a)) / F.lit(3.6e9)


# enumerations ---------------------------------------------------------


def one_of(c: Column | str, allowed, other: str = "unknown") -> Column:
    """Lower-case value if it is allowed, else ``other``."""
    v = F.lower(F.trim(col(c)))
    return F.when(is_in(v, allowed), v).otherwise(F.lit(other))


def rank_in(c: Column | str, order) -> Column:
    """Place in an ordered list from 1; NULL outside it."""
    out = F.lit(None).cast("int")
    for k, v in enumerate(order, 1):
        out = F.when(col(c) == v, F.lit(k)).otherwise(out)
    return out


def short_model(c: Column | str) -> Column:
    """Model name without quotes and vendor prefix."""
    return F.regexp_replace(F.regexp_replace(col(c), '"', ""), r"^[a-z]+[/:]", "")


def model_family(c: Column | str, families=("opus", "haiku"), other: str = "sonnet") -> Column:
    """The first family whose name the model holds, else ``other``."""
    out = F.lit(other)
    for f in reversed(families):
        out = F.when(F.coalesce(F.lower(col(c)).contains(f), F.lit(False)), F.lit(f)).otherwise(out)
    return out


def bucket(c: Column | str, edges: list[float], labels: list[str], right: bool = False) -> Column:
    """Label of the interval [e0, e1), or (e0, e1] if ``right``; labels are one more than edges."""
    v, out = col(c), F.lit(labels[-1])
    for e, label in reversed(list(zip(edges, labels[:-1], strict=True))):
        out = F.when(v <= e if right else v < e, F.lit(label)).otherwise(out)
    return F.when(v.isNotNull(), out)
