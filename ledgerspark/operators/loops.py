"""Recurring findings: near-duplicate collapse, fix cycles, tiers."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.functions.columns import finding_hash, jaccard, token_set
from ledgerspark.operators.graph import connected_components
from ledgerspark.operators.lineage import discard, stage

#: Kinds of agents whose runs count as fixes, and the tiers' least cycles.
FIXERS = ("fixer", "quick-fix", "r-debugger", "claude-code")
TIERS = ((10, "escalate"), (5, "block"), (3, "watch"))


def tier_of(cycles: Column) -> Column:
    out = F.lit(None).cast("string")
    for least, name in reversed(TIERS):
        out = F.when(cycles >= least, F.lit(name)).otherwise(out)
    return out


#: Groups of at most HOT nodes are paired by a join, larger ones compared in blocks of BLOCK nodes of up to WORDS words each, or of fewer and larger ones.
#: A family of more than HOT nodes of a block is known to other blocks by PIVOTS of its nodes.
HOT, PIVOTS, BLOCK, WORDS = 64, 4, 16_384, 128


def similar_edges(nodes: DataFrame, group: list[str], limit: float, hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) that tie the same nodes together as all pairs in one group whose token sets ``tok`` reach the Jaccard limit.

    No token is a key of a shuffle, and no pair carries its sets: a set travels
    once to its block.  Blocks follow the sizes of sets, so that only those of like
    sizes meet.  What is similar within a block is tied first, and large
    families by a few of their nodes; what that leaves apart is compared between
    blocks by sketches of a few bits a token, and only sets whose sketches allow the limit are read again.
    Tokens hold no spaces.
    """
    n = nodes.select(*group, "node", F.array_join("tok", " ").alias("words"), F.size("tok").alias("n")).where(F.col("n") > 0)
    n = stage(n, "token-sets")
    sizes = stage(n.groupBy(*group, "n").agg(F.count(F.lit(1)).alias("s")), "set-sizes")
    large = sizes.groupBy(*group).agg(F.sum("s").alias("m")).where(F.col("m") > hot).select(*group)
    pairs = stage(_paired(n.join(large, group, "left_anti"), group, limit), "pairs")
    if large.isEmpty():
        discard(n)
        return pairs
    rows = _placed(n.join(large, group, "left_semi"), sizes, group, block)
    rows = stage(rows.withColumns({"id": F.monotonically_increasing_id(), "component": F.col("node")}), "blocks")
    discard(n)
    own = _tied(rows.withColumns({"pair": _name(group, F.col("block")), "side": F.lit(0)}), limit)
    stars = stage(own, "stars").select(F.col("x").alias("a"), F.col("y").alias("b"))
    several = rows.groupBy(*group).agg(F.max("block").alias("hi"), F.min("block").alias("lo")).where("lo < hi").select(*group)
    several = stage(several, "several")  # few rows, as a table that is seen to be small
    if several.isEmpty():
        return pairs.unionByName(stars)
    members, component = rows.join(several, group, "left_semi"), connected_components(stars, "a", "b")
    few = stage(_pivots(members.select("node"), component, hot), "pivots")
    families, _ = _between(members.join(few, "node", "left_semi"), component, rows, group, limit)
    stars = stars.unionByName(families)
    return pairs.unionByName(stars).unionByName(_between_stars(members, stars, rows, group, limit))


def _paired(sets: DataFrame, group: list[str], limit: float) -> DataFrame:
    """Edges within groups of few nodes, of all pairs."""
    left = sets.select(*group, F.col("node").alias("a"), F.col("n").alias("na"), F.col("words").alias("wa"))
    right = sets.select(*group, F.col("node").alias("b"), F.col("n").alias("nb"), F.col("words").alias("wb"))
    near = (F.col("a") < F.col("b")) & (F.least("na", "nb") >= F.lit(limit) * F.greatest("na", "nb"))
    return left.hint("merge").join(right, group).where(near).where(jaccard(F.split("wa", " "), F.split("wb", " ")) >= limit).select("a", "b")


def _name(group: list[str], *parts: Column) -> Column:
    return F.concat_ws("\x1f", *(F.col(g).cast("string") for g in group), *(p.cast("string") for p in parts))


def _placed(sets: DataFrame, sizes: DataFrame, group: list[str], block: int) -> DataFrame:
    """The sets with the number of their block: by size, and of equal sizes by a hash.

    What smaller sets fill is a running sum over the distinct sizes of a group.
    """
    weight = F.greatest(F.col("n"), F.lit(WORDS)).cast("long")
    before = Window.partitionBy(*group).orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*group, "n", "s", F.coalesce(F.sum(F.col("s") * weight).over(before), F.lit(0)).alias("before"))
    place = F.floor((F.col("before") + weight * F.pmod(F.xxhash64("node"), F.col("s"))) / F.lit(WORDS * block))
    return sets.join(sizes, [*group, "n"]).select(*group, "node", "n", "words", place.alias("block"))


def _sketched(sets: DataFrame, group: list[str]) -> DataFrame:
    """The sets without their words, with a sketch: a bit for each hash of a word, in two to four columns a word."""
    kinds = dict(sets.dtypes)
    keep = [*group, "block", "id", "node", "n"]

    def run(batches):
        for batch in batches:
            words = pc.split_pattern(batch.column("words"), " ")
            ends, flat = words.offsets.to_numpy() - words.offsets[0].as_py(), words.flatten().dictionary_encode()
            hashes = np.fromiter((zlib.crc32(w.encode()) for w in flat.dictionary.to_pylist()), np.int64, len(flat.dictionary))
            width = _columns(np.diff(ends))
            bits = np.zeros(width.sum(), np.uint8)
            at, each = np.cumsum(width) - width, np.diff(ends)
            bits[np.repeat(at, each) + (hashes[flat.indices.to_numpy()] & np.repeat(width - 1, each))] = 1
            places = np.append(at, width.sum()) // 8
            sketch = pa.BinaryArray.from_buffers(pa.binary(), len(width), [None, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(np.packbits(bits, bitorder="little"))])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), sketch], [*keep, "sketch"])

    return sets.select(*keep, "words").mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", sketch binary")


def _columns(n: np.ndarray) -> np.ndarray:
    """Bits of the sketch of n words: the power of two that is at least 2 n, and 64."""
    return 1 << np.maximum(6, np.ceil(np.log2(2 * np.maximum(n, 1)))).astype(np.int64)


def _pivots(nodes: DataFrame, component: DataFrame, hot: int) -> DataFrame:
    """A few of the nodes of each component of more than ``hot`` nodes."""
    few = F.array_distinct(F.array(*(F.min_by("node", F.xxhash64("node", F.lit(k))) for k in range(PIVOTS))))
    families = nodes.join(component, "node").groupBy("component").agg(F.count(F.lit(1)).alias("m"), few.alias("p"))
    return families.where(F.col("m") > hot).select(F.explode("p").alias("node"))


def _between_stars(members: DataFrame, stars: DataFrame, rows: DataFrame, group: list[str], limit: float) -> DataFrame:
    """Edges between the blocks of a group that the stars have not tied.

    Pairs of blocks of which sketches left too many pairs of sets are compared
    by their words, with what the others have tied.
    """
    edges, cut = _between(members, connected_components(stars, "a", "b"), rows, group, limit)
    if cut.isEmpty():
        return edges
    component = connected_components(stars.unionByName(edges), "a", "b").withColumnRenamed("component", "top")
    whole = rows.join(cut, [*group, "block"]).join(component, "node", "left").withColumn("component", F.coalesce("top", "component"))
    rest = stage(_tied(whole, limit), "between")
    return edges.unionByName(rest.select(F.col("x").alias("a"), F.col("y").alias("b")))


def _between(sets: DataFrame, component: DataFrame, rows: DataFrame, group: list[str], limit: float) -> tuple[DataFrame, DataFrame]:
    """Edges (a, b) between blocks of like sizes, and the sides of those pairs of blocks that may have more.

    Blocks that are both of one component are not compared.
    """
    known = stage(_sketched(sets, group).join(component.withColumnRenamed("component", "family"), "node", "left"), "members")
    top = F.coalesce("family", "node")
    ends = known.groupBy(*group, "block").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.min(top).alias("first"), F.max(top).alias("last"))
    ends = stage(ends, "ends")
    other = ends.select(*group, *(F.col(c).alias(f"{c}2") for c in ("block", "lo", "hi", "first", "last")))
    near = (F.col("block") < F.col("block2")) & (F.col("hi") >= F.lit(limit) * F.col("lo2")) & (F.col("hi2") >= F.lit(limit) * F.col("lo"))
    one = (F.col("first") == F.col("last")) & (F.col("first2") == F.col("last2")) & (F.col("first") == F.col("first2"))
    met = ends.join(other, group).where(near & ~one).withColumn("pair", _name(group, F.col("block"), F.col("block2")))
    need = stage(met.select(*group, "pair", F.posexplode(F.array("block", "block2")).alias("side", "block")), "sides")
    sides = known.join(need, [*group, "block"]).select("pair", "side", "id", "n", "family", "sketch")
    found = stage(sides.groupBy("pair").applyInArrow(_meeting(limit), "pair string, x long, y long"), "candidates")
    candidates = found.where(F.col("x").isNotNull())
    wanted = stage(candidates.select(F.explode(F.array("x", "y")).alias("id")).distinct(), "wanted")
    again = stage(rows.join(wanted, "id", "left_semi").select("id", "node", "words"), "read-again")
    left, right = (again.select(F.col("id").alias(k), F.col("node").alias(f"node_{k}"), F.col("words").alias(f"words_{k}")) for k in "xy")
    alike = jaccard(F.split("words_x", " "), F.split("words_y", " ")) >= limit
    edges = candidates.join(left.hint("merge"), "x").join(right.hint("merge"), "y").where(alike).select(F.col("node_x").alias("a"), F.col("node_y").alias("b"))
    edges = stage(edges, "between")
    discard(ends, known, wanted, again)
    return edges, need.join(found.where(F.col("x").isNull()).select("pair"), "pair", "left_semi")


#: Pairs of sets of two components that are read again, at most.
PROBES = 4


def _meeting(limit: float):
    """Pairs (x, y) of sets of two blocks whose sketches allow the limit, a few for each two components; and a row of NULLs where there are more.

    Columns that only one of two sketches has are tokens that only one of the
    sets has, and sets that reach the limit have few of these.  No more sets are named than the blocks hold.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("side", "ascending"), ("n", "ascending")])
        side, n, ids = (table[c].to_numpy() for c in ("side", "n", "id"))
        family = table["family"].combine_chunks().dictionary_encode().indices
        label = pc.fill_null(family, -1).to_numpy().astype(np.int64)
        label = np.where(label < 0, len(n) + np.arange(len(n)), label)  # sets of no family are their own
        sketch = table["sketch"].combine_chunks()
        sketch = sketch.chunk(0) if isinstance(sketch, pa.ChunkedArray) else sketch
        width, places = _columns(n), np.frombuffer(sketch.buffers()[1], np.int32)[sketch.offset : sketch.offset + len(n) + 1]
        data = np.frombuffer(sketch.buffers()[2], np.uint8)
        odd = (1 - limit) / (1 + limit)

        def matrix(lo, hi, columns):
            x = data[places[lo] : places[hi]].reshape(hi - lo, -1)
            while x.shape[1] * 8 > columns:
                x = x[:, : x.shape[1] // 2] | x[:, x.shape[1] // 2 :]
            return np.unpackbits(x, axis=1, bitorder="little").astype(np.float32)

        def few(found):
            """Of each two components those of the fewest odd columns."""
            a, b, far = found
            one, two = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
            order = np.lexsort((far, two, one))
            new = np.ones(len(a), bool)
            new[1:] = (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0)
            begin = np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))
            take = np.sort(order[np.arange(len(a)) - begin < PROBES])
            return a[take], b[take], far[take]

        stripes, lo = [], 0
        while lo < len(n):
            hi = lo + 1  # sets of one side and one width
            while hi < len(n) and side[hi] == side[lo] and width[hi] == width[lo] and (hi + 1 - lo) * width[lo] <= _CELLS:
                hi += 1
            stripes.append((lo, hi))
            lo = hi
        most, cut = max(len(n) // 2, 1), False
        found = tuple(np.zeros(0, np.int64) for _ in range(3))
        for lo, hi in (t for t in stripes if side[t[0]] == side[0]):
            for lo2, hi2 in (t for t in stripes if side[t[0]] != side[0]):
                if n[hi - 1] < limit * n[lo2] or n[hi2 - 1] < limit * n[lo]:
                    continue
                if (label[lo:hi] == label[lo]).all() and (label[lo2:hi2] == label[lo]).all():
                    continue
                columns = min(width[lo], width[lo2])
                x, y = matrix(lo, hi, columns), matrix(lo2, hi2, columns)
                far = x.sum(axis=1)[:, None] + y.sum(axis=1)[None, :] - 2 * (x @ y.T)
                may = np.float32(odd) * (n[lo:hi].astype(np.float32)[:, None] + n[lo2:hi2].astype(np.float32)[None, :])
                i, j = np.nonzero(far <= may + np.float32(0.01))
                apart = label[lo + i] != label[lo2 + j]
                i, j = i[apart], j[apart]
                if not len(i):
                    continue
                found = tuple(np.concatenate(c) for c in zip(found, (lo + i, lo2 + j, far[i, j].astype(np.int64)), strict=True))
                fewer = few(found)
                cut |= len(fewer[0]) < len(found[0]) or len(fewer[0]) > most
                found = tuple(c[:most] for c in fewer)
        name = table["pair"][0].as_py()
        x, y = (pa.array(ids[c], pa.int64()) for c in found[:2])
        if cut:
            x, y = (pa.concat_arrays([c, pa.nulls(1, pa.int64())]) for c in (x, y))
        return pa.table({"pair": pa.array([name] * len(x), pa.string()), "x": x, "y": y})

    return run


def _tied(rows: DataFrame, limit: float) -> DataFrame:
    """Edges (x, y) within each ``pair`` of one block or two, and the components (a, b) that they tie."""
    return rows.select("pair", "side", "node", "component", "n", "words").groupBy("pair").applyInArrow(_tying(limit), "x string, y string, a string, b string")


#: Numbers of a stripe's matrix.
_CELLS = 1 << 20


def _tying(limit: float):
    """Edges that tie components of two blocks, or of one: one edge at most for each tie.

    Sets are counted into few columns, of which the frequent tokens have one each:
    products of such rows are no less than what two sets share, and only where
    they reach the limit are the tokens themselves compared.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("side", "ascending"), ("n", "ascending"), ("component", "ascending")])
        words = pc.split_pattern(table["words"].combine_chunks(), " ")
        flat = words.flatten().dictionary_encode().indices.to_numpy()
        ends = words.offsets.to_numpy() - words.offsets[0].as_py()
        side, n = table["side"].to_numpy(), np.diff(ends).astype(np.int64)
        node, component = table["node"].combine_chunks(), table["component"].combine_chunks()
        label = component.dictionary_encode().indices.to_numpy().copy()
        df = np.bincount(flat)
        rank = np.empty(len(df), np.int64)
        rank[np.argsort(-df, kind="stable")] = np.arange(len(df))
        place, mark = rank[flat], np.zeros(len(df), bool)
        share = np.float32(limit / (1 + limit))

        def matrix(lo, hi, width):
            half = width // 2
            p = place[ends[lo] : ends[hi]]
            at = np.repeat(np.arange(hi - lo) * width, n[lo:hi]) + np.where(p < half, p, half + p % half)
            return np.bincount(at, minlength=(hi - lo) * width).reshape(hi - lo, width).astype(np.float32)

        def columns(most):
            return 1 << max(8, int(4 * most - 1).bit_length())

        stripes, lo = [], 0
        while lo < len(n):
            hi = lo + 1  # sets of one side; the last of them has the most columns
            while hi < len(n) and side[hi] == side[lo] and (hi + 1 - lo) * columns(n[hi]) <= _CELLS:
                hi += 1
            stripes.append((lo, hi))
            lo = hi
        two, edges = side[-1] != side[0], []
        for lo, hi in stripes:
            x, width = None, columns(n[hi - 1])
            for lo2, hi2 in [(lo, hi), *(t for t in stripes if t[0] != lo)]:  # families of its own first
                # the larger sets, of equal ones those that stand later, look for the smaller
                if n[hi2 - 1] > n[hi - 1] or (n[hi2 - 1] == n[hi - 1] and lo2 > lo) or n[hi2 - 1] < limit * n[lo] or (two and side[lo] == side[lo2]):
                    continue
                if (label[lo:hi] == label[lo]).all() and (label[lo2:hi2] == label[lo]).all():
                    continue
                x = matrix(lo, hi, width) if x is None else x
                y = x if lo2 == lo else matrix(lo2, hi2, width)
                bound = share * n[lo:hi].astype(np.float32)[:, None] + share * n[lo2:hi2].astype(np.float32)[None, :]
                close = x @ y.T >= bound - np.float32(0.01)
                if lo2 == lo:
                    close &= np.tri(hi - lo, k=-1, dtype=bool)
                for i in np.flatnonzero(close.any(axis=1)):
                    a = lo + i
                    other = lo2 + np.flatnonzero(close[i] & (label[lo2:hi2] != label[a]))
                    if not len(other):
                        continue
                    own, few = flat[ends[a] : ends[a + 1]], 16
                    mark[own] = True
                    while len(other):  # some at a time: what the first ones tie need not be compared
                        now, other = other[:few], other[few:]
                        shared = np.add.reduceat(mark[np.concatenate([flat[ends[b] : ends[b + 1]] for b in now])].astype(np.int64), np.concatenate(([0], np.cumsum(n[now])[:-1])))
                        for b in now[shared / (n[a] + n[now] - shared) >= limit]:
                            if label[a] != label[b]:
                                label[label == label[b]] = label[a]
                                edges.append((a, b))
                        other, few = other[label[other] != label[a]], 2 * few
                    mark[own] = False
        a, b = (pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1))
        columns_ = {"x": node.take(a), "y": node.take(b), "a": component.take(a), "b": component.take(b)}
        return pa.table({c: v.cast(pa.string()) for c, v in columns_.items()})

    return run


def collapse(findings: DataFrame, limit: float = 0.6, keep: list[str] | None = None) -> DataFrame:
    """The findings with ``content_hash`` replaced by its component's; of their columns those named, or all.

    Within (severity, primary_file) hashes are tied where any of their texts
    reach the limit; the component takes the hash seen first (then the smallest).
    Hashes name severity and file, so a component never leaves its group.
    """
    keep = list(dict.fromkeys(["content_hash", *(c for c in findings.columns if keep is None or c in keep)]))
    group = ["severity", "primary_file"]
    own = list(dict.fromkeys([*keep, *group, "reviewed_at"]))
    f = stage(findings.select(*own, F.array_join(F.array_sort(token_set(F.coalesce("problem_text", F.lit("")))), " ").alias("words")), "findings")
    g = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in group]
    # equal token sets of a group are one node
    node = F.md5(F.concat_ws("\x1f", F.coalesce("severity", F.lit("")), F.coalesce("primary_file", F.lit("")), "words"))
    keyed = f.select(*g, "words", node.alias("node"), F.col("content_hash").alias("h"))
    nodes = keyed.where("words <> ''").groupBy(*group, "node").agg(F.split(F.first("words"), " ").alias("tok"))  # a node names its tokens
    # a node stands for the smallest of its hashes, which it ties to the others: only hashes that something ties take part in the rounds
    names = stage(keyed.select("node", "h").distinct(), "names")
    least = stage(names.groupBy("node").agg(F.min("h").alias("m"), F.max("h").alias("__last")), "least")
    of = lambda k: least.select(F.col("node").alias(k), F.col("m").alias(f"h{k}")).hint("merge")
    near = similar_edges(nodes, group, limit).join(of("a"), "a").join(of("b"), "b").select(F.col("ha").alias("a"), F.col("hb").alias("b"))
    several = least.where(F.col("m") < F.col("__last")).select("node", "m")
    same = names.hint("merge").join(several, "node").where(F.col("h") != F.col("m")).select(F.col("h").alias("a"), F.col("m").alias("b"))
    comp = connected_components(near.unionByName(same), "a", "b")
    seen = f.groupBy("content_hash").agg(F.min("reviewed_at").alias("at"))
    named = comp.select(F.col("node").alias("content_hash"), "component").hint("merge").join(seen, "content_hash")
    # staged copies are small as files, not as rows: none of these is to be broadcast
    first = named.groupBy("component").agg(F.min(F.struct("at", "content_hash")).alias("m")).select("component", F.col("m.content_hash").alias("__hash"))
    final = named.hint("merge").join(first, "component").select("content_hash", "__hash")
    out = f.select(*keep).hint("merge").join(final, "content_hash", "left")
    return out.select(*(F.coalesce("__hash", "content_hash").alias(c) if c == "content_hash" else F.col(c) for c in keep))


#: Microseconds of the spans by which runs are summed.
HOUR, DAY = 3_600_000_000, 86_400_000_000
#: Exact sums: a difference of two running sums is the sum between them.
_EXACT = "decimal(38,12)"


def _running(findings: DataFrame, runs: DataFrame, keep: list[str]) -> DataFrame:
    """The findings with the number and cost of runs up to their time, without and with those at that time.

    Findings and runs of an hour are one sorted sequence, over which runs are
    summed; what came before the hour is a running sum over the hours, one row each.
    """
    t = F.unix_micros("started_at")
    rows = findings.select(*keep, F.unix_micros("reviewed_at").alias("t"), F.lit(0).alias("n"), F.lit(0).cast(_EXACT).alias("c"), F.lit(True).alias("point"))
    empty = [F.lit(None).cast(kind).alias(c) for c, kind in findings.select(*keep).dtypes]
    rows = rows.unionByName(runs.select(*empty, t.alias("t"), F.lit(1).alias("n"), F.col("cost").cast(_EXACT).alias("c"), F.lit(False).alias("point")))
    rows = rows.withColumn("h", F.floor(F.col("t") / HOUR))
    within = Window.partitionBy("h").orderBy("t")
    to, at = within.rangeBetween(Window.unboundedPreceding, Window.currentRow), within.rangeBetween(Window.currentRow, Window.currentRow)
    own = rows.select("*", *(F.sum(x).over(w).alias(f"{x}_{k}") for x in "nc" for k, w in (("to", to), ("at", at)))).where("point")
    before = Window.orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    hours = rows.groupBy("h").agg(F.sum("n").alias("hn"), F.sum("c").alias("hc"))  # one row an hour of the calendar
    hours = hours.select(F.col("h"), *(F.coalesce(F.sum(f"h{x}").over(before), F.lit(0)).alias(f"{x}_before") for x in "nc"))
    up_to = [(F.col(f"{x}_before") + F.col(f"{x}_to")).alias(f"{x}_with") for x in "nc"]
    without = [(F.col(f"{x}_before") + F.col(f"{x}_to") - F.col(f"{x}_at")).alias(f"{x}_without") for x in "nc"]
    return own.join(hours, "h").select(*keep, *up_to, *without)


def _fixes_of(spans: DataFrame, runs: DataFrame) -> DataFrame:
    """The distinct shas of runs within each (content_hash, a, b), in byte order and joined by commas.

    A span is cut into the whole days in it, the whole hours before and after
    these, and the hours of its two ends; what lies beyond the first and last run is left out.  Days and hours meet their distinct
    shas; only the hours at the ends meet single runs.
    """
    t = F.unix_micros("started_at")
    r = runs.where(F.col("commit_sha").isNotNull()).select(t.alias("t"), F.floor(t / DAY).alias("d"), F.floor(t / HOUR).alias("h"), "commit_sha")
    ends = F.broadcast(r.agg(F.min("t").alias("first"), F.max("t").alias("last")))  # no span need reach beyond the runs
    g = spans.crossJoin(ends).select("content_hash", F.greatest(F.unix_micros("a"), "first").alias("a"), F.least(F.unix_micros("b"), "last").alias("b")).where("a <= b")
    g = g.withColumns({"ha": F.floor(F.col("a") / HOUR), "hb": F.floor(F.col("b") / HOUR)})
    g = g.withColumns({"d1": F.ceil((F.col("ha") + 1) / 24), "d2": F.floor(F.col("hb") / 24) - 1})  # the whole days
    none, days = F.array().cast("array<bigint>"), F.col("d1") <= F.col("d2")
    span = lambda lo, hi: F.when(lo <= hi, F.sequence(lo, hi)).otherwise(none)
    before = F.when(days, F.col("d1") * 24 - 1).otherwise(F.col("hb") - 1)
    after = F.when(days, span((F.col("d2") + 1) * 24, F.col("hb") - 1)).otherwise(none)
    hours = F.concat(span(F.col("ha") + 1, before), after)
    by_day, by_hour = (r.select(F.col(k).alias("k"), "commit_sha").distinct() for k in ("d", "h"))
    whole = g.select("content_hash", F.explode(span(F.col("d1"), F.col("d2"))).alias("k")).join(by_day, "k").select("content_hash", "commit_sha")
    part = g.select("content_hash", F.explode(hours).alias("k")).join(by_hour, "k").select("content_hash", "commit_sha")
    ends = g.withColumn("h", F.explode(F.array_distinct(F.array("ha", "hb")))).join(r, "h").where(F.col("t").between(F.col("a"), F.col("b"))).select("content_hash", "commit_sha")
    found = whole.unionByName(part).unionByName(ends).distinct()
    return found.groupBy("content_hash").agg(F.array_join(F.sort_array(F.collect_list("commit_sha")), ",").alias("fix_commit_shas"))


def cycles(findings: DataFrame, runs: DataFrame | None, order: str = "job_id", least: int = 1) -> DataFrame:
    """Per hash the consecutive findings with a fix run between them, both ends included; hashes of at least ``least`` such.

    Without a table of runs every consecutive pair counts and the cost is NULL;
    with a table that has no rows every pair counts at cost 0.  The number and
    cost of runs in a gap are differences of running sums, so findings and runs
    are sorted once and never paired.  The gaps of a hash follow each other, so
    its shas are those of one span, from its first finding to its last.
    """
    w = Window.partitionBy("content_hash").orderBy("reviewed_at", order)
    none = runs is None or runs.isEmpty()
    if none:
        points = findings.select("content_hash", "reviewed_at", order)
        cost, hit = F.lit(None if runs is None else 0.0).cast("double"), F.lit(True)
    else:
        cost = F.coalesce("total_cost_usd", F.lit(0.0)) if "total_cost_usd" in runs.columns else F.lit(0.0)
        fixes = runs.where(F.col("agent_type").isin(*FIXERS) & F.col("started_at").isNotNull()).select("started_at", "commit_sha", cost.alias("cost"))
        points = _running(findings, fixes, ["content_hash", "reviewed_at", order])
        cost, hit = F.lead("c_with").over(w) - F.col("c_without"), F.lead("n_with").over(w) > F.col("n_without")
    gaps = points.select("content_hash", F.col("reviewed_at").alias("a"), F.lead("reviewed_at").over(w).alias("b"), hit.alias("hit"), cost.alias("cost"))
    gaps = gaps.where(F.col("b").isNotNull())
    wasted = F.sum(F.when(F.col("hit"), F.col("cost"))).cast("double")
    out = gaps.groupBy("content_hash").agg(F.count_if("hit").cast("int").alias("cycles"), F.round(wasted, 6).alias("estimated_wasted_usd"), F.min("a").alias("a"), F.max("b").alias("b"))
    out = out.where(F.col("cycles") >= least)
    if none:
        return out.select("content_hash", "cycles", F.lit("").alias("fix_commit_shas"), "estimated_wasted_usd")
    out = stage(out, "cycles")  # read for its spans and for its numbers
    shas = _fixes_of(out, fixes)
    return out.join(shas, "content_hash", "left").select("content_hash", "cycles", F.coalesce("fix_commit_shas", F.lit("")).alias("fix_commit_shas"), "estimated_wasted_usd")


def detect_loops(findings: DataFrame, runs: DataFrame | None, limit: float = 0.6, window_days: int = 30, order: str = "job_id") -> DataFrame:
    """Findings that came back at least three times within the window before the newest one.

    Hashes of fewer than four findings can't have three cycles and are left out
    before the gaps are looked at; see ``cycles`` for tables without runs.
    """
    last = F.broadcast(findings.agg(F.max("reviewed_at").alias("__last")))
    recent = findings.crossJoin(last).where(F.col("reviewed_at") >= F.col("__last") - F.make_dt_interval(F.lit(window_days))).drop("__last")
    recent = recent.withColumns({"content_hash": finding_hash("severity", "primary_file", "problem_text"), "summary": F.substring("problem_text", 1, 80)})
    f = collapse(recent, limit, ["reviewed_at", order, "severity", "primary_file", "summary"])
    often = f.groupBy("content_hash").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > TIERS[-1][0]).select("content_hash")
    c = cycles(f.join(often, "content_hash", "left_semi"), runs, order, least=TIERS[-1][0])
    head = F.min(F.struct("reviewed_at", order, "severity", "primary_file", "summary")).alias("m")
    g = f.join(c.select("content_hash"), "content_hash", "left_semi").groupBy("content_hash").agg(head, F.min("reviewed_at").alias("first_seen"), F.max("reviewed_at").alias("last_seen"))
    acks = {"ack_by": "string", "ack_at": "timestamp", "ack_reason": "string", "ack_until": "timestamp"}
    return g.join(c, "content_hash").select(
        "content_hash", "m.severity", "m.primary_file", "m.summary", "first_seen", "last_seen", "cycles", tier_of(F.col("cycles")).alias("tier"), "fix_commit_shas", "estimated_wasted_usd",
        *(F.lit(None).cast(k).alias(a) for a, k in acks.items()),
    )
