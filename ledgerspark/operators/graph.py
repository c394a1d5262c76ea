"""Connected components as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators.lineage import discard, stage


def _fingerprint(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"] or 0


def _star(edges: DataFrame, large: bool) -> tuple[DataFrame, DataFrame]:
    """One star step on edges with u > v: neighbours move to the smallest one; and the staged minima."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    least = stage(least, "least")  # read as a table of its own, so that a join at a hub may be split
    moved = both.join(least, "u")
    if large:
        out = moved.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = moved.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = out.union(least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") > F.col("v")).distinct(), least


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """Smallest reachable node for every node that has an edge: (node, component).

    Alternating large-star and small-star rounds; each round is staged, and the
    rounds end when the edge set stops changing (every tree is then a star).
    Self-loops and NULL ends are ignored; repeated edges count once.
    """
    e = edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).where(
        F.col(src).isNotNull() & F.col(dst).isNotNull() & (F.col("u") > F.col("v"))
    )
    e = stage(e.distinct(), "edges")
    seen = _fingerprint(e)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        out, tops = _star(e, True)
        out, least = _star(out, False)
        last, e = e, stage(out, "edges")
        discard(last, tops, least)
        now = _fingerprint(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
