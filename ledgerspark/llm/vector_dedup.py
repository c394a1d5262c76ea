"""Near-duplicate vectors by cross-polytope hashing."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators.graph import connected_components
from ledgerspark.operators.lineage import stage

TABLES = 12
#: Cross-polytopes joined in one bucket code.
JOINED = 2
#: Other buckets that a vector also looks into, in each table.
PROBES = 4
#: Own buckets of more vectors are compared as matrices instead of pair by pair, in blocks of so many.
CROWD, BLOCK = 64, 2048
#: Sign bits of a vector (two longs) and how many may differ in a candidate pair:
#: at cosine 0.93 about 15 of 128 do, with a deviation under 4.
SKETCH_BITS, SKETCH_APART = 128, 44


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the last axis, whose length is a power of two."""
    n, h = x.shape[-1], 1
    x = x.copy()
    while h < n:
        pairs = x.reshape(*x.shape[:-1], n // (2 * h), 2, h)
        a, b = pairs[..., 0, :].copy(), pairs[..., 1, :].copy()
        pairs[..., 0, :], pairs[..., 1, :] = a + b, a - b
        h *= 2
    return x / np.sqrt(n)


def rotations(unit: np.ndarray, seed: int) -> np.ndarray:
    """Three rounds of random signs and a Hadamard transform: close to a random rotation."""
    signs = np.random.default_rng(seed).choice([-1.0, 1.0], (3, unit.shape[1]))
    for s in signs:
        unit = hadamard(unit * s)
    return unit


def _codes(unit: np.ndarray, seed: int, joined: int = JOINED, probes: int = PROBES) -> tuple[np.ndarray, np.ndarray]:
    """Base code of each row (nearest signed axis of each polytope), and the next-nearest codes.

    A code is read in base 2 d over ``joined`` polytopes.  Other codes take a
    further axis in one or several of them; those that lose least come first.
    """
    n, d = unit.shape
    width = min(d, probes + 1)
    axes, loss = [], []
    for j in range(joined):
        y = rotations(unit, seed * 101 + j)
        size = np.abs(y)
        top = np.argpartition(-size, width - 1, axis=1)[:, :width]
        top = np.take_along_axis(top, np.argsort(-np.take_along_axis(size, top, 1), axis=1, kind="stable"), 1)
        big = np.take_along_axis(size, top, 1)
        axes.append(2 * top + (np.take_along_axis(y, top, 1) < 0))
        loss.append(big[:, :1] ** 2 - big**2)
    codes, costs = [], []
    for ranks in itertools.product(range(width), repeat=joined):
        if sum(ranks) <= probes:
            code = np.zeros(n, np.int64)
            for near, k in zip(axes, ranks, strict=True):
                code = code * (2 * d) + near[:, k]
            codes.append(code)
            costs.append(sum(lost[:, k] for lost, k in zip(loss, ranks, strict=True)))
    others, cost = np.stack(codes[1:] or [np.zeros(n, np.int64)], 1), np.stack(costs[1:] or [np.zeros(n)], 1)
    keep = np.argsort(cost, axis=1, kind="stable")[:, : probes if len(codes) > 1 else 0]
    return codes[0], np.take_along_axis(others, keep, 1)


def _unit(raw: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision, padded to a power of two."""
    d = 1 << max(0, raw.shape[1] - 1).bit_length()
    x = raw.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    x = x / np.sqrt((x * x).sum(1, keepdims=True))
    return np.pad(x, ((0, 0), (0, d - x.shape[1])))


def _by_length(batch: pa.RecordBatch, column: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) of the batch's packed vectors, by their length."""
    vectors = [np.frombuffer(v, "<f8") for v in batch.column(column).to_pylist()]
    sizes = np.array([len(v) for v in vectors])
    for n in np.unique(sizes):
        rows = np.flatnonzero(sizes == n)
        yield rows, np.stack([vectors[i] for i in rows])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as little-endian doubles; NULL where they link with nothing."""
    for batch in batches:
        out = []
        for v in batch.column(2).to_pylist():
            x = None
            if v and None not in v:
                x = np.array(v, "<f8")
                x = x.tobytes() if np.isfinite(x).all() and x.any() else None
            out.append(x)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["id", "label", "vec"])


def _hashed(joined: int):
    """Bucket codes: one row per vector and table, codes[0] its own bucket, then the probes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, raw in _by_length(batch, 1):
                unit, n = _unit(raw), len(rows)
                d = unit.shape[1]
                plane = np.random.default_rng(7).standard_normal((d, SKETCH_BITS))
                bits = np.packbits(unit @ plane > 0, axis=1).copy().view("<i8")
                codes = [_codes(unit, t, joined) for t in range(TABLES)]
                own = np.stack([c[0] for c in codes], 1)
                ids = batch.column(0).take(pa.array(rows))
                for t, (base, probes) in enumerate(codes):
                    buckets = np.concatenate([base[:, None], probes], 1)
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array(np.full(n, t, np.int32)), pa.array(list(buckets), pa.list_(pa.int64())), pa.array(list(own), pa.list_(pa.int64())), pa.array(bits[:, 0]), pa.array(bits[:, 1])],
                        names=["node", "t", "buckets", "own", "s0", "s1"],
                    )

    return run


def _verified(limit: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(a, "<f8"), np.frombuffer(b, "<f8")
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                keep.append(len(x) == len(y) and float(x @ y) >= limit * float(np.sqrt((x @ x) * (y @ y))))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    return run


def _forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Edges of one tree for each part that the links of a symmetric matrix connect."""
    left, out = near.any(1), []
    for root in np.flatnonzero(left):
        if not left[root]:
            continue
        left[root], todo = False, [int(root)]
        while todo:
            k = todo.pop()
            more = np.flatnonzero(near[k] & left)
            left[more] = False
            todo += more.tolist()
            out += [(k, x) for x in more.tolist()]
    return out


class _Members:
    """Vectors of a block: ids, copies, unit rows, lengths, own codes and the tables in which their bucket is crowded."""

    def __init__(self, rows: list[tuple]):
        ids, n, vecs, codes, hot = zip(*rows, strict=True)
        raw = [np.frombuffer(v, "<f8") for v in vecs]
        self.length = np.array([len(v) for v in raw])
        self.unit = np.zeros((len(raw), int(self.length.max())))
        for k, v in enumerate(raw):
            v = v / np.abs(v).max()
            self.unit[k, : len(v)] = v / np.sqrt(v @ v)
        self.ids, self.n, self.codes, self.hot = np.array(ids, np.int64), np.array(n, np.int64), np.array(codes, np.int64), np.array(hot, np.int64)

    def near(self, other: _Members, limit: float) -> np.ndarray:
        d = min(self.unit.shape[1], other.unit.shape[1])  # longer vectors do not link with shorter ones
        return (self.unit[:, :d] @ other.unit[:, :d].T >= limit) & (self.length[:, None] == other.length[None, :])

    def agree(self, other: _Members, i: np.ndarray, j: np.ndarray, tables: int) -> np.ndarray:
        """Whether pairs share a crowded own bucket in one of the first tables."""
        out = np.zeros(len(i), bool)
        for t in range(tables):
            out |= (self.codes[i, t] == other.codes[j, t]) & ((self.hot[i] >> t) & 1 == 1)
        return out


def _compared(limit: float):
    """Links within crowded buckets, block by block.

    Rows come sorted by (label, t, bucket, lo, hi), members before those that
    only probe the bucket.  Of members it gives the number of links (kind 0) of
    which this is the first table that the pair shares a crowded bucket in, and
    one tree of links for each connected part (kind 1); of those that probe, the
    links themselves that no crowded bucket holds (kind 2).
    """

    def within(t: int, one: _Members, two: _Members | None) -> Iterator[tuple[np.ndarray, ...]]:
        near = one.near(two or one, limit)
        if two is None:
            np.fill_diagonal(near, False)
        i, j = np.nonzero(near if two is not None else np.triu(near))
        other = two or one
        new = ~one.agree(other, i, j, t)
        i, j = i[new], j[new]
        for side, at, n in ((one, i, other.n[j]), (other, j, one.n[i])):
            sums = np.bincount(at, n, minlength=len(side.ids)).astype(np.int64)
            some = np.flatnonzero(sums)
            yield np.zeros(len(some), np.int64), side.ids[some], side.ids[some], sums[some]
        if two is not None:
            m = len(one.ids)
            both = np.zeros((m + len(two.ids),) * 2, bool)
            both[:m, m:], both[m:, :m] = near, near.T
            near, ids = both, np.append(one.ids, two.ids)
        else:
            ids = one.ids
        edges = np.array(_forest(near), np.int64).reshape(-1, 2)
        yield np.ones(len(edges), np.int64), ids[edges[:, 0]], ids[edges[:, 1]], np.zeros(len(edges), np.int64)

    def probing(members: _Members, rows: list[tuple]) -> tuple[np.ndarray, ...]:
        others = _Members(rows)
        i, j = np.nonzero(members.near(others, limit))
        new = ~members.agree(others, i, j, TABLES) & (members.ids[i] != others.ids[j])
        a, b = members.ids[i[new]], others.ids[j[new]]
        return np.full(len(a), 2, np.int64), np.minimum(a, b), np.maximum(a, b), np.zeros(len(a), np.int64)

    def batch_of(columns: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["kind", "a", "b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, lo, hi, probers = None, [], [], []
        members: _Members | None = None

        def settle() -> Iterator[pa.RecordBatch]:
            nonlocal members
            if members is None and lo:
                members = _Members(lo)
                if now[1] == now[2]:
                    yield from map(batch_of, within(now[0], members, None))
                elif hi:
                    yield from map(batch_of, within(now[0], members, _Members(hi)))
            if probers and members is not None:
                yield batch_of(probing(members, probers))
                probers.clear()

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in range(11)]
            for label, t, bucket, first, last, side, *row in zip(*columns, strict=True):
                key = (t, first, last, label, bucket)
                if key != now:
                    yield from settle()
                    now, lo, hi, members = key, [], [], None
                    probers.clear()
                (lo if side == 0 else hi if side == 1 else probers).append(tuple(row))
                if len(probers) >= BLOCK:
                    yield from settle()
        yield from settle()

    return run


def _crowded(own: DataFrame, probed: DataFrame, hot: DataFrame, vec: DataFrame, limit: float) -> DataFrame:
    """(kind, a, b, n) of all crowded buckets; see ``_compared``."""
    key = ["label", "t", "bucket"]
    hot = hot.withColumn("parts", F.ceil(F.col("m") / BLOCK).cast("int"))
    place = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    inside = own.join(hot, key).withColumn("at", place).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    inside = inside.withColumns({"lo": F.least("at", "other"), "hi": F.greatest("at", "other")}).withColumn("side", F.when(F.col("at") == F.col("lo"), 0).otherwise(1))
    outside = probed.join(hot, key).withColumn("lo", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumns({"hi": F.col("lo"), "side": F.lit(2)})
    keep = [*key, "lo", "hi", "side", "node", "own", "hot"]
    rows = inside.select(*keep).unionByName(outside.select(*keep)).join(vec, "node")
    by = [*key, "lo", "hi"]
    dealt = rows.select(*by, "side", "node", "n", "vec", "own", "hot").repartition(*by).sortWithinPartitions(*by, "side")
    return stage(dealt.mapInArrow(_compared(limit), "kind long, a long, b long, n long"), "crowded")


def near_vectors(vectors: DataFrame, limit: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", joined: int = JOINED) -> DataFrame:
    """One row per input row: id, n_links, component_id, kept.

    Two vectors of the same label link when their cosine, in double precision,
    is at least ``limit``.  Equal vectors form one class first, so copies are
    never paired.  Classes meet where one's own bucket is among the other's
    probed ones in any of TABLES tables; a pair is passed on by the first table
    in which the own buckets agree, must agree in most sign bits, and is then
    verified on the vectors.  Buckets of more than CROWD vectors are compared as
    matrices, in blocks: a group of vectors that are all near one another gives
    numbers of links and a tree, not its pairs.  Vectors that are NULL, empty, zero or hold NULL or
    non-finite numbers, and rows without label or id, link with nothing;
    vectors of different lengths do not link.  Ids are whole numbers; rows that
    repeat an id and its vector are copies, and an id of several vectors is one
    node of the graph.
    """
    src = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("vec"))
    rows = stage(src.mapInArrow(_packed, "id long, label string, vec binary"), "vectors")
    usable = F.col("vec").isNotNull() & F.col("label").isNotNull() & F.col("id").isNotNull()
    good = rows.where(usable)
    classes = stage(good.groupBy("label", "vec").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("n")), "classes")
    hashed = stage(classes.select("node", "vec").mapInArrow(_hashed(joined), "node long, t int, buckets array<long>, own array<long>, s0 long, s1 long"), "buckets")
    labelled = hashed.join(classes.select("node", "label"), "node")
    key, bucket = ["label", "t", "bucket"], F.get("buckets", F.lit(0)).alias("bucket")
    hot = stage(labelled.groupBy("label", "t", bucket).agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > CROWD), "crowded-buckets")
    crowds = labelled.select("label", "t", "node", bucket).join(hot, key).groupBy("node").agg(F.expr("sum(shiftleft(1L, t))").alias("hot"))
    labelled = labelled.join(stage(crowds, "crowds"), "node", "left").withColumn("hot", F.coalesce("hot", F.lit(0)).cast("long"))
    own = labelled.select("label", "t", bucket, "node", "own", "hot", "s0", "s1")
    probed = labelled.select("label", "t", F.posexplode("buckets").alias("nth", "bucket"), "node", "own", "hot", "s0", "s1")

    # buckets of few vectors: pairs of own and probing vectors, but for those that share a crowded bucket
    few = own.join(hot.select(*key), key, "left_anti")
    few = few.select(*key, F.col("node").alias("x"), F.col("own").alias("xo"), F.col("hot").alias("xh"), F.col("s0").alias("x0"), F.col("s1").alias("x1"))
    others = probed.select(*key, F.col("node").alias("y"), F.col("own").alias("yo"), F.col("s0").alias("y0"), F.col("s1").alias("y1"))
    apart = F.bit_count(F.col("x0").bitwiseXOR(F.col("y0"))) + F.bit_count(F.col("x1").bitwiseXOR(F.col("y1")))
    earlier = F.lit(False)
    for t in range(TABLES):
        agree = F.get("xo", F.lit(t)) == F.get("yo", F.lit(t))
        earlier = earlier | (agree & ((F.col("t") > t) | (F.col("xh").bitwiseAND(F.lit(1 << t)) != 0)))
    met = few.join(others, key).where((F.col("x") != F.col("y")) & (apart <= SKETCH_APART) & ~earlier)
    pairs = met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    vec = classes.select("node", "vec")
    held = pairs.join(vec.select(F.col("node").alias("a"), F.col("vec").alias("va")), "a").join(vec.select(F.col("node").alias("b"), F.col("vec").alias("vb")), "b")
    links = held.select("a", "b", "va", "vb").mapInArrow(_verified(limit), "a long, b long")

    crowded = _crowded(own, probed.where(F.col("nth") > 0), hot, classes.select("node", "n", "vec"), limit)
    links = stage(links.union(crowded.where("kind = 2").select("a", "b")).distinct(), "links")
    sizes = classes.select("node", "n")
    both = links.union(links.select("b", "a"))
    listed = both.join(sizes.withColumnRenamed("node", "b"), "b").select("a", "n")
    others = listed.union(crowded.where("kind = 0").select("a", "n")).groupBy("a").agg(F.sum("n").alias("others"))
    comp = connected_components(links.union(crowded.where("kind = 1").select("a", "b")), "a", "b").select(F.col("node").alias("c"), "component")
    known = classes.join(others, classes["node"] == others["a"], "left").join(comp, classes["node"] == comp["c"], "left")
    known = known.select("label", "vec", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    found = good.join(known, ["label", "vec"]).select("id", "n_links", "component_id")
    alone = rows.where(~usable).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = found.unionByName(alone)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
