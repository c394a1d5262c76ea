"""Pfair mixing: blocks of each source interleaved earliest-deadline-first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.operators.lineage import discard, stage

#: The pool of sources that have no weight of their own.
REST = "*"
#: Bound on the (pool, bucket) pairs of which the running sums are broadcast.
_BROADCAST_BUCKETS = 100_000
#: Rows of a pool that one task should sort; an id with more is dealt into several buckets.
BUCKET_ROWS = 200_000


def pfair_period(weights: dict[str, int]) -> list[tuple[str, int, int, int, int]]:
    """One period of the schedule: (pool, k, release, deadline, slot) for each block.

    Weights are whole shares of the period, whose length is their sum W.  Block
    k of a pool with share w may start at floor(k W / w) and must be done by
    ceil((k + 1) W / w).  Each slot goes to the released block with the earliest
    deadline; every pool is then always less than one block from its share, and
    at the period's end exactly on it, so the schedule repeats.
    """
    length, done, out = sum(weights.values()), dict.fromkeys(weights, 0), []
    for slot in range(length):
        ready = [(-(-(k + 1) * length // weights[p]), p) for p, k in done.items() if k < weights[p] and k * length // weights[p] <= slot]
        deadline, pool = min(ready)
        k = done[pool]
        out.append((pool, k, k * length // weights[pool], deadline, slot))
        done[pool] += 1
    return out


def _keyed(docs: DataFrame, named: Column, id_col: str, text_col: str) -> DataFrame:
    """The rows with their pool, size and sort key."""
    return docs.withColumns({
        "pool": named,
        "__size": F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 1,
        "__key": F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("null"))),
        "__tie": F.crc32(F.coalesce(F.col(text_col), F.lit(""))),
    })


def _crowded_ids(base: DataFrame, sums: DataFrame, bucket_rows: int) -> DataFrame | None:
    """(__p, __hot, parts) of each pool's ids that more than ``bucket_rows`` rows share; None where no bucket is that full.

    Only rows of full buckets are counted by id, and the partial counts of an
    id meet as one row a task.
    """
    full = sums.where(F.col("__n") > 4 * bucket_rows).select(F.col("pool").alias("__p"), F.col("__bucket").alias("__b"))
    if full.isEmpty():
        return None
    inside = base.join(full, (F.col("pool") == F.col("__p")) & (F.col("__bucket") == F.col("__b")), "left_semi")
    counts = inside.groupBy(F.col("pool").alias("__p"), F.col("__key").alias("__hot")).count().where(F.col("count") > bucket_rows)
    return stage(counts.select("__p", "__hot", F.ceil(F.col("count") * 2 / bucket_rows).cast("long").alias("__parts")), "crowded-ids")


def mix_sources(docs: DataFrame, weights: dict[str, int], rest: int = 1, block_bytes: int = 1 << 16, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """All rows with pool, block, slot, release, deadline, block_offset and balanced.

    A pool is a weighted source; sources without a weight, NULL among them,
    share the pool ``*`` of weight ``rest``.  Pools that have no rows leave the
    schedule.  Within a pool rows are ordered by the md5 of their id and cut
    into blocks of ``block_bytes`` (a row, of its UTF-8 bytes plus 1, belongs to
    the block in which it starts; a block that lies within one long row stays
    empty).  ``slot`` is the block's place in the Pfair order; rows before the
    slot at which the first pool runs out are ``balanced``: every prefix of them
    keeps each pool less than one block from its weight.  No row is dropped or
    repeated: what is left of longer pools follows in the same order.  NULL
    texts count 1 byte; rows that agree in id and text have any order.  Rows of
    an id (NULL is one) that very many rows share stand behind the others of
    their bucket, in any order: they are numbered and dealt into parts of about
    half of ``bucket_rows``, so that no task sorts one id's rows.  Input
    columns with the names of added ones are replaced.  Weights and ``rest`` are
    whole numbers from 1; others raise ValueError.
    """
    if any(w < 1 or w != int(w) for w in [*weights.values(), rest]):
        raise ValueError("weights must be whole numbers from 1")
    added = ["pool", "block", "slot", "release", "deadline", "block_offset", "balanced"]
    docs = docs.drop(*added)
    named = F.col(source_col).isin(*weights) if weights else F.lit(False)
    pool = F.when(named, F.col(source_col)).otherwise(F.lit(REST))
    base = _keyed(docs, pool, id_col, text_col)
    # one row per pool: as many as there are weights, and one
    totals = {r["pool"]: (r["bytes"], r["n"]) for r in base.groupBy("pool").agg(F.sum("__size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()}
    shares = {p: w for p, w in (weights | {REST: rest}).items() if p in totals}
    n = sum(x[1] for x in totals.values())
    digits = 2
    while 16**digits * bucket_rows < n:
        digits += 1
    bucket, order = F.substring("__key", 1, digits), ["__key", id_col, "__size", "__tie"]
    base = base.withColumn("__bucket", bucket)

    # running sums in two levels, so that no pool is sorted in one task
    in_bucket = [F.sum("__size").alias("__bytes"), F.count(F.lit(1)).alias("__n")]
    sums = stage(base.groupBy("pool", "__bucket").agg(*in_bucket), "bucket-sums")
    crowded = _crowded_ids(base, sums, bucket_rows)
    if crowded is not None:
        discard(sums)
        # a written number, so that a row keeps its part when a task is run again
        numbered = stage(docs.withColumn("__no", F.monotonically_increasing_id()), "numbered")
        part = F.lpad(F.pmod(F.xxhash64("__no"), F.col("__parts")).cast("string"), 12, "0")
        base = _keyed(numbered, pool, id_col, text_col).join(crowded, (F.col("pool") == F.col("__p")) & (F.col("__key") == F.col("__hot")), "left")
        base = base.withColumn("__bucket", F.concat(bucket, F.coalesce(F.concat(F.lit(":"), F.col("__key"), part), F.lit(""))))
        order.append("__no")
        sums = stage(base.groupBy("pool", "__bucket").agg(*in_bucket), "bucket-sums")
    ahead = Window.partitionBy("pool").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("pool").alias("__pool"), F.col("__bucket").alias("__b"), F.coalesce(F.sum("__bytes").over(ahead), F.lit(0)).alias("__start"))
    if crowded is None and 16**digits * (len(weights) + 1) <= _BROADCAST_BUCKETS:
        starts = F.broadcast(starts)
    inside = Window.partitionBy("pool", "__bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = base.withColumn("__upto", F.sum("__size").over(inside))
    rows = rows.join(starts, (F.col("pool") == F.col("__pool")) & (F.col("__bucket") == F.col("__b")))
    rows = rows.withColumn("__before", F.col("__start") + F.col("__upto") - F.col("__size"))
    rows = rows.withColumns({"block": F.floor(F.col("__before") / F.lit(block_bytes)).cast("long"), "block_offset": F.col("__before") % block_bytes})

    # the period has sum(weights) rows: fixed by the parameters, whatever the data
    length = sum(shares.values())
    period = pfair_period(shares)
    plan = docs.sparkSession.createDataFrame(
        [(p, k, shares[p], r, d, s) for p, k, r, d, s in period] or [("", 0, 1, 0, 0, 0)],
        "__of string, __turn_k long, __w long, __r long, __d long, __s long",
    )
    slot_of = {(p, k): s for p, k, _, _, s in period}
    horizon = None
    for p, w in shares.items():
        blocks = -(-totals[p][0] // block_bytes)
        end = blocks // w * length + slot_of[p, blocks % w]
        horizon = end if horizon is None else min(horizon, end)
    share = F.lit(None).cast("long")
    for p, w in shares.items():
        share = F.when(F.col("pool") == p, F.lit(w).cast("long")).otherwise(share)
    rows = rows.withColumn("__share", share).withColumns({"__turn": F.floor(F.col("block") / F.col("__share")).cast("long"), "__k": F.col("block") % F.col("__share")})
    rows = rows.join(F.broadcast(plan), (F.col("pool") == F.col("__of")) & (F.col("__k") == F.col("__turn_k")), "left")
    at = F.col("__turn") * length
    rows = rows.withColumns({"slot": at + F.col("__s"), "release": at + F.col("__r"), "deadline": at + F.col("__d")})
    rows = rows.withColumn("balanced", F.coalesce(F.col("slot") < F.lit(horizon or 0), F.lit(False)))
    return rows.select(*docs.columns, *added)


def in_mixed_order(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The rows dealt into key ranges and sorted by their place in the mix."""
    order = ["slot", "block_offset"]
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order).select(*columns)


def mixing_oracle(weights: dict[str, int], block_bytes: int) -> str:
    """DuckDB SQL of the registered query, for tables that hold every weighted source and no other."""
    length = sum(weights.values())
    period = ", ".join(f"('{p}', {k}, {weights[p]}, {r}, {d}, {s})" for p, k, r, d, s in pfair_period(weights))
    return f"""
WITH plan(pool, k, share, r, d, s) AS (VALUES {period}),
sized AS (SELECT doc_id, source AS pool, coalesce(strlen(text), 0) + 1 AS size, md5(coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key FROM documents),
run AS (SELECT *, sum(size) OVER (PARTITION BY pool ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) - size AS before FROM sized),
blocks AS (SELECT doc_id, pool, CAST(before // {block_bytes} AS BIGINT) AS block, CAST(before % {block_bytes} AS BIGINT) AS block_offset FROM run),
shares AS (SELECT DISTINCT pool, share FROM plan),
ends AS (SELECT pool, CAST((sum(size) + {block_bytes - 1}) // {block_bytes} AS BIGINT) AS blocks FROM sized GROUP BY pool),
horizon AS (SELECT min(e.blocks // p.share * {length} + p.s) AS h FROM ends e JOIN plan p ON p.pool = e.pool AND p.k = e.blocks % p.share)
SELECT b.doc_id, b.pool, b.block, CAST(b.block // p.share * {length} + p.s AS BIGINT) AS slot,
  CAST(b.block // p.share * {length} + p.r AS BIGINT) AS release, CAST(b.block // p.share * {length} + p.d AS BIGINT) AS deadline,
  b.block_offset, b.block // p.share * {length} + p.s < h AS balanced
FROM blocks b JOIN shares USING (pool) JOIN plan p ON p.pool = b.pool AND p.k = b.block % shares.share CROSS JOIN horizon
"""
