"""Histogram sort: equal-byte shards from exact counts below refined probes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.operators.lineage import discard, stage

_LOW, _HIGH = -(1 << 63), (1 << 63) - 1
#: Bits of the key that one round of probes resolves: 4096 probes a span.
_DIGIT = 12
#: Parts of the key range at most; their start slots are broadcast, with those of the parts of hot texts fewer than 70,000 rows.
_MAX_BITS = 16
#: Texts with more than 1/1024 of all rows are hot: fewer than 1024 by that, in fewer than 4096 parts.
_HOT_BITS = 10


@dataclass(frozen=True)
class Span:
    """Keys (a, b) with a in [a_lo, a_hi] and b in [b_lo, b_hi]; ``below`` bytes lie before it."""

    a_lo: int
    a_hi: int
    b_lo: int
    b_hi: int
    below: int

    def holds(self) -> Column:
        return F.col("__a").between(self.a_lo, self.a_hi) & F.col("__b").between(self.b_lo, self.b_hi)

    def by_first(self) -> bool:
        return self.a_lo < self.a_hi

    def width_bits(self) -> int:
        lo, hi = (self.a_lo, self.a_hi) if self.by_first() else (self.b_lo, self.b_hi)
        return max(1, (hi - lo).bit_length())

    def digit(self) -> tuple[Column, int]:
        """Number of the probe interval that a key falls in, and the interval's bits."""
        name, lo = ("__a", self.a_lo) if self.by_first() else ("__b", self.b_lo)
        bits = self.width_bits()
        shift = max(0, bits - _DIGIT)
        if bits == 64:  # the whole signed range: shift first, so that nothing overflows
            return F.shiftright(name, shift) + F.lit(1 << (63 - shift)), shift
        return F.shiftright(F.col(name) - F.lit(lo), shift), shift


def _probe(keys: DataFrame, spans: list[Span]) -> dict[int, list]:
    """Exact bytes in each probe interval of each span: at most spans * 4096 rows."""
    which, digit = F.lit(None).cast("int"), F.lit(None).cast("long")
    for i, s in reversed(list(enumerate(spans))):
        which = F.when(s.holds(), F.lit(i)).otherwise(which)
        digit = F.when(s.holds(), s.digit()[0].cast("long")).otherwise(digit)
    rows = (
        keys.select(which.alias("s"), digit.alias("d"), "__a", "__size")
        .where(F.col("s").isNotNull())
        .groupBy("s", "d")
        .agg(F.sum("__size").alias("bytes"), F.count(F.lit(1)).alias("n"), F.min("__a").alias("a0"), F.max("__a").alias("a1"))
        .collect()
    )
    out: dict[int, list] = {i: [] for i in range(len(spans))}
    for r in rows:
        out[r["s"]].append(r)
    return {i: sorted(v, key=lambda r: r["d"]) for i, v in out.items()}


def find_splitters(keys: DataFrame, total: int, shards: int, tolerance: float) -> tuple[list[tuple[int, int] | None], list, bool]:
    """Lowest key of each shard but the first (None: no key reaches it), the first histogram, and whether a key was too heavy.

    A splitter is settled when the bytes below a probe differ from its target
    by at most ``tolerance`` of a shard; else the interval that holds the
    target is probed again.  Rows whose keys agree wholly can't be parted: such
    a key is too heavy where it keeps a splitter from its target.
    """
    slack = tolerance * total / shards
    whole = Span(_LOW, _HIGH, _LOW, _HIGH, 0)
    todo = {j: whole for j in range(1, shards)}
    found: dict[int, tuple[int, int] | None] = {}
    first: list = []
    heavy = False
    while todo:
        spans = list(dict.fromkeys(todo.values()))
        tables = _probe(keys, spans)
        first = first or tables[0]
        step: dict[int, Span] = {}
        for j, span in todo.items():
            target, below, cells = total * j / shards, span.below, tables[spans.index(span)]
            shift = span.digit()[1]
            for r in cells:
                after = below + r["bytes"]
                if after < target and r is not cells[-1]:
                    below = after
                    continue
                lo = (span.a_lo if span.by_first() else span.b_lo) + (r["d"] << shift)
                hi = min(lo + (1 << shift) - 1, span.a_hi if span.by_first() else span.b_hi)
                start = (lo, _LOW) if span.by_first() else (span.a_lo, lo)
                end = (hi + 1, _LOW) if span.by_first() else (span.a_lo, hi + 1)
                if end[0 if span.by_first() else 1] > _HIGH:
                    end = None if span.by_first() or span.a_lo == _HIGH else (span.a_lo + 1, _LOW)
                near = min((abs(below - target), 0, start), (abs(after - target), 1, end), key=lambda x: x[:2])
                alone = lo == hi and not span.by_first()
                if near[0] <= slack or alone:
                    found[j] = near[2]
                    heavy |= near[0] > slack and r["n"] > 1
                elif span.by_first() and r["a0"] == r["a1"]:
                    step[j] = Span(r["a0"], r["a0"], _LOW, _HIGH, below)
                elif span.by_first():
                    step[j] = Span(lo, hi, _LOW, _HIGH, below)
                else:
                    step[j] = Span(span.a_lo, span.a_lo, lo, hi, below)
                break
        todo = step
    return [found[j] for j in range(1, shards)], first, heavy


def _hot_texts(keys: DataFrame, first: list, n: int) -> list[tuple[int, int, int]]:
    """(hash, rows, rows of its most frequent key) of each hot text: only crowded intervals of the first histogram are counted."""
    limit = max(1, n >> _HOT_BITS)
    crowded = [r["d"] - (1 << (_DIGIT - 1)) for r in first if r["n"] > limit]
    if not crowded:
        return []
    some = keys.where(F.shiftright("__a", 64 - _DIGIT).isin(crowded)).groupBy("__a", "__b").agg(F.count(F.lit(1)).alias("n"))
    rows = some.groupBy("__a").agg(F.sum("n").alias("n"), F.max("n").alias("most")).where(F.col("n") > limit).collect()
    return [(r["__a"], r["n"], r["most"]) for r in rows]


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", tolerance: float = 0.001) -> DataFrame:
    """All rows with ``shard`` (0 to shards-1) and ``slot`` (gapless from 0 in its shard).

    Law ``bytes``: shards hold nearly equal sums of sizes, a size being the
    text's UTF-8 bytes plus 1 (NULL text: 1).  Rows are ordered by a hash of
    the text and then of the id, so equal texts lie together, and a splitter
    falls among them only where they outweigh the tolerance.  Exact bytes below
    candidate keys are counted over narrow rows until every splitter is within
    ``tolerance`` of its target; then whole rows are exchanged once, by parts of
    bounded size (a text with many copies is spread over parts by its ids'
    hash).  Where rows that repeat id and text are so many that they would keep
    a splitter from its target or fill a part, the rows are first written with
    a number each, which then breaks the tie.  NULL ids hash like any value.
    Input columns named shard or slot are replaced.  An empty table gives an
    empty result.
    """
    docs = docs.drop("shard", "slot")
    out = _sharded(docs, shards, id_col, text_col, tolerance, None)
    if out is None:
        numbered = stage(docs.withColumn("__tie", F.monotonically_increasing_id()), "numbered")
        out = _sharded(numbered, shards, id_col, text_col, tolerance, "__tie")
    return out.select(*docs.columns, "shard", "slot")


def _sharded(docs: DataFrame, shards: int, id_col: str, text_col: str, tolerance: float, tie: str | None) -> DataFrame | None:
    """The rows with shard and slot; None where repeated rows need a tie-break and there is none."""
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 1
    a = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    b = F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), *([tie] if tie else []))
    keys = stage(docs.select(a.alias("__a"), b.alias("__b"), size.alias("__size")), "shard-keys")
    sums = keys.agg(F.count(F.lit(1)).alias("n"), F.sum("__size").alias("bytes")).first()
    n, total = sums["n"], sums["bytes"] or 0
    splitters, first, heavy = find_splitters(keys, total, shards, tolerance) if n else ([None] * (shards - 1), [], False)
    hot = _hot_texts(keys, first, n)
    part_rows = max(1, n >> _HOT_BITS)
    if tie is None and (heavy or any(most > part_rows and most > 1 for *_, most in hot)):
        discard(keys)
        return None

    shard = F.lit(0)
    for s in splitters:
        if s is not None:
            shard = shard + ((F.col("__a") > s[0]) | ((F.col("__a") == s[0]) & (F.col("__b") >= s[1]))).cast("int")

    # parts: key ranges of about n / 2**bits rows; hot texts are split by the second hash into as many as their rows need
    bits = min(_MAX_BITS, max(10, (n // 100_000).bit_length()))
    part, sub = F.shiftright("__a", 64 - bits), F.lit(None).cast("long")
    split: dict[int, list[int]] = {}
    for text, rows, _ in hot:
        split.setdefault(max(1, (rows // part_rows).bit_length()), []).append(text)
    for fine, texts in split.items():
        part = F.when(F.col("__a").isin(texts), F.col("__a")).otherwise(part)
        sub = F.when(F.col("__a").isin(texts), F.shiftright("__b", 64 - fine)).otherwise(sub)
    placed = {"shard": shard, "__p": part, "__q": sub}
    by = ["shard", "__p", "__q"]
    counts = keys.withColumns(placed).groupBy(*by).count()
    ahead = Window.partitionBy("shard").orderBy("__p", F.col("__q").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*(F.col(c).alias(f"{c}_") for c in by), F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("__start"))

    rows = docs.withColumns({"__a": a, "__b": b}).withColumns(placed)
    inside = Window.partitionBy(*by).orderBy("__a", "__b", id_col)
    rows = rows.withColumn("__i", F.row_number().over(inside))
    on = (F.col("shard") == F.col("shard_")) & (F.col("__p") == F.col("__p_")) & F.col("__q").eqNullSafe(F.col("__q_"))
    return rows.join(F.broadcast(starts), on).withColumn("slot", (F.col("__start") + F.col("__i") - 1).cast("long"))
