"""Exact quantiles of groups of any size: ranks are counted in value histograms that are refined round by round."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.operators.lineage import discard, stage

#: Groups, or what is left of one, of at most so many values are sorted in one buffer; others are cut into BINS a round.
CELL, BINS = 4096, 1024


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equality of the keys, NULL with NULL."""
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[k]) for k in keys))


def with_columns_of(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on keys that match also on NULL; the keys come from the left."""
    other = right.select(*(F.col(k).alias(f"__{k}") for k in keys), *(c for c in right.columns if c not in keys))
    on = reduce(lambda a, b: a & b, (left[k].eqNullSafe(other[f"__{k}"]) for k in keys))
    return left.join(other, on, "left").drop(*(f"__{k}" for k in keys))


def quantiles(rows: DataFrame, keys: list[str], value: Column | str, shares: list[float], name: str = "q", cell: int = CELL, bins: int = BINS) -> DataFrame:
    """One row per group: the keys and ``name``, an array of the values at ``shares``, interpolated between neighbours.

    NULL values have no rank; a group without values has no row; NULL keys are a
    group.  Without keys there is one row, of NULLs where there are no values.

    Keys and values are written once.  Groups of at most ``cell`` values are
    sorted as they are.  For each rank that is asked of a larger group the
    values are counted in ``bins`` ranges between its least and largest, and then
    again in the one range that holds the rank, until that holds one value or at
    most ``cell``: each round reads two narrow columns, shuffles at most
    ``bins`` rows for a rank and task, and no task holds a group's values.
    """
    group = keys or ["__all"]
    narrow = rows.select(*keys, *([] if keys else [F.lit(0).alias("__all")]), (F.col(value) if isinstance(value, str) else value).cast("double").alias("__v"))
    narrow = stage(narrow.where(F.col("__v").isNotNull()), "quantile-values")
    sizes = stage(narrow.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.min("__v").alias("a"), F.max("__v").alias("b")), "quantile-sizes")
    large = sizes.where((F.col("n") > cell) & (F.col("a") < F.col("b")))
    at = F.array(*(F.lit(float(p)) for p in shares))
    if large.isEmpty():
        out = narrow.groupBy(*group).agg(F.percentile("__v", at).alias(name))
    else:
        few = narrow.join(F.broadcast(large) if large.count() <= 1 << 16 else large, _same(narrow, large, group), "left_anti")
        out = few.groupBy(*group).agg(F.percentile("__v", at).alias(name)).unionByName(_refined(narrow, large, group, shares, name, cell, bins))
    return out if keys else rows.sparkSession.range(1).select(F.lit(0).alias("__all")).join(out, "__all", "left").drop("__all")


def _refined(narrow: DataFrame, large: DataFrame, group: list[str], shares: list[float], name: str, cell: int, bins: int) -> DataFrame:
    place = lambda p: F.lit(float(p)) * (F.col("n") - 1)
    ranks = F.array_distinct(F.flatten(F.array(*(F.array(F.floor(place(p)), F.ceil(place(p))) for p in shares))))
    open_ = stage(large.select(*group, F.explode(ranks).alias("rank"), "a", "b", F.lit(0).cast("long").alias("before"), F.col("n").alias("m")), "quantile-ranks")
    found: list[DataFrame] = []
    while not open_.isEmpty():
        met = narrow.join(open_.withColumnsRenamed({k: f"__{k}" for k in group}), _renamed(narrow, group)).where(F.col("__v").between(F.col("a"), F.col("b")))
        bin_ = F.least(F.lit(bins - 1), F.floor((F.col("__v") - F.col("a")) / (F.col("b") - F.col("a")) * bins))
        counted = met.groupBy(*group, "rank", "before", bin_.alias("bin")).agg(F.count(F.lit(1)).alias("m"), F.min("__v").alias("a"), F.max("__v").alias("b"))
        upto = F.sum("m").over(Window.partitionBy(*group, "rank").orderBy("bin"))  # at most `bins` rows
        counted = counted.withColumn("upto", F.col("before") + upto).where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("m")))
        left = stage(counted.select(*group, "rank", "a", "b", (F.col("upto") - F.col("m")).alias("before"), "m"), "quantile-ranks")
        found.append(left.where("a = b").select(*group, "rank", F.col("a").alias("v")))
        small = left.where((F.col("a") < F.col("b")) & (F.col("m") <= cell))
        near = narrow.join(small.withColumnsRenamed({k: f"__{k}" for k in group}), _renamed(narrow, group)).where(F.col("__v").between(F.col("a"), F.col("b")))
        near = near.groupBy(*group, "rank", "before").agg(F.sort_array(F.collect_list("__v")).alias("vs"))
        found.append(near.select(*group, "rank", F.element_at("vs", (F.col("rank") - F.col("before") + 1).cast("int")).alias("v")))
        discard(open_)
        open_ = stage(left.where((F.col("a") < F.col("b")) & (F.col("m") > cell)), "quantile-ranks")
    values = reduce(DataFrame.unionByName, found).groupBy(*group).agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("at"))  # two ranks a share
    sizes = with_columns_of(large.select(*group, "n"), values, group)

    def between(p: float) -> Column:
        low, high = F.col("at")[F.floor(place(p))], F.col("at")[F.ceil(place(p))]
        return low + (place(p) - F.floor(place(p))) * (high - low)

    return sizes.select(*group, F.array(*map(between, shares)).alias(name))


def _renamed(narrow: DataFrame, group: list[str]) -> Column:
    return reduce(lambda a, b: a & b, (narrow[k].eqNullSafe(F.col(f"__{k}")) for k in group))
