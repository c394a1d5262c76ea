"""Vectors as short codes: product quantisation with exact search by slices and bitmasks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators.lineage import stage

PARTS, ROUNDS = 16, 2
#: Entries of a codebook: one bit each of a mask.
ENTRIES = 64
SCALE = 256
#: Integers beyond are held here, so that squared distances of up to 4096 components fit a long.
LIMIT = 1 << 24


class Codebook:
    """Nearest entries of one part position, exactly.

    Each dimension holds the entries' coordinates in order, and for each prefix
    of that order the mask of its entries.  The entries whose coordinate lies in
    a slice are the difference of two prefix masks; the slices of all dimensions
    ANDed leave the entries in a cube around the query.  If the best of them is
    no farther than the cube reaches, no other is nearer; else the cube grows, at
    once to the best distance found.
    """

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        n, width = entries.shape
        order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.ascontiguousarray(np.take_along_axis(entries, order, 0).T)
        self.prefix = np.zeros((width, n + 1), np.uint64)
        np.bitwise_or.accumulate(np.uint64(1) << order.T.astype(np.uint64), axis=1, out=self.prefix[:, 1:])
        self.all = np.bitwise_or.reduce(np.uint64(1) << np.arange(n, dtype=np.uint64))
        self.radius = self._usual_gap()

    def _usual_gap(self) -> int:
        """Median distance of an entry to the nearest other one: where the first cube starts."""
        gap = np.sqrt(((self.entries[:, None] - self.entries[None]) ** 2).sum(axis=2, dtype=np.float64))
        np.fill_diagonal(gap, np.inf)
        nearest = gap.min(axis=1) if len(gap) > 1 else np.ones(1)
        return int(np.ceil(max(1.0, np.median(nearest))))

    def candidates(self, q: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks of the entries within ``radius`` in every dimension."""
        mask = np.full(len(q), self.all)
        for d in range(q.shape[1]):
            low = np.searchsorted(self.sorted[d], q[:, d] - radius, "left")
            high = np.searchsorted(self.sorted[d], q[:, d] + radius, "right")
            mask &= self.prefix[d][high] ^ self.prefix[d][low]
        return mask

    def _best(self, q: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry in each mask, the lowest of equals; -1 where it is empty."""
        best, far = np.full(len(q), -1), np.full(len(q), np.iinfo(np.int64).max)
        left = np.flatnonzero(mask)
        while len(left):
            lowest = mask[left] & (~mask[left] + np.uint64(1))
            entry = np.bitwise_count(lowest - np.uint64(1)).astype(np.int64)
            d = ((q[left] - self.entries[entry]) ** 2).sum(axis=1)
            nearer = d < far[left]
            best[left[nearer]], far[left[nearer]] = entry[nearer], d[nearer]
            mask[left] ^= lowest
            left = left[mask[left] != 0]
        return best, far

    def nearest(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        index, error = np.empty(len(q), np.int64), np.empty(len(q), np.int64)
        open_, radius = np.arange(len(q)), np.full(len(q), self.radius, np.int64)
        while len(open_):
            best, far = self._best(q[open_], self.candidates(q[open_], radius))
            sure = (best >= 0) & (far <= radius * radius)
            index[open_[sure]], error[open_[sure]] = best[sure], far[sure]
            reach = np.ceil(np.sqrt(far.astype(np.float64))).astype(np.int64) + 1  # a root may round down
            radius = np.where(best >= 0, reach, 2 * radius)[~sure]
            open_ = open_[~sure]
        return index, error


def part_bounds(length: int, parts: int = PARTS) -> list[tuple[int, int]]:
    """Consecutive parts, equal where the length allows it."""
    return [(k * length // parts, (k + 1) * length // parts) for k in range(parts)]


def _integers(column: pa.Array, length: int) -> np.ndarray:
    x = np.asarray(column.flatten(), np.float64).reshape(-1, length) if length else np.zeros((len(column), 0))
    return np.clip(np.floor(SCALE * x), -LIMIT, LIMIT).astype(np.int64)


def _summed(books: list[np.ndarray], length: int):
    """A partition's sums and counts by part, entry and position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, n = [Codebook(b) for b in books], len(books[0])
        sums, counts = np.zeros((length, n), np.int64), np.zeros((len(books), n), np.int64)
        for batch in batches:
            x = _integers(batch.column(0), length)
            for k, (lo, hi) in enumerate(part_bounds(length, len(books))):
                at, _ = search[k].nearest(x[:, lo:hi])
                counts[k] += np.bincount(at, minlength=n)
                for d in range(lo, hi):
                    sums[d] += np.bincount(at, x[:, d], minlength=n).astype(np.int64)  # a batch's sums are exact doubles
        part = np.concatenate([np.full(hi - lo, k) for k, (lo, hi) in enumerate(part_bounds(length, len(books)))])
        d, e = np.nonzero(counts[part] if length else np.zeros((0, n)))
        yield pa.RecordBatch.from_arrays([pa.array(d), pa.array(e), pa.array(sums[d, e]), pa.array(counts[part[d], e])], names=["position", "entry", "total", "n"])

    return run


def _encoded(books: list[np.ndarray], length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Codebook(b) for b in books]
        for batch in batches:
            fits = batch.column(2).value_lengths().to_numpy(zero_copy_only=False) == length
            x = _integers(batch.column(2).filter(pa.array(fits)), length)
            codes, error = np.empty((len(x), len(books)), np.uint8), np.zeros(len(x), np.int64)
            for k, (lo, hi) in enumerate(part_bounds(length, len(books))):
                at, far = search[k].nearest(x[:, lo:hi])
                codes[:, k] = at
                error += far
            row = np.cumsum(fits) - 1
            code = [codes[r].tobytes().hex() if f else None for r, f in zip(row, fits, strict=True)]
            far = [int(error[r]) if f else None for r, f in zip(row, fits, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code, pa.string()), pa.array(far, pa.int64())], names=["id", "label", "code", "error"])

    return run


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", entries: int = ENTRIES, parts: int = PARTS, rounds: int = ROUNDS, length: int | None = None) -> tuple[DataFrame, list[np.ndarray]]:
    """(rows of id, label, code, error, label_error; the final codebooks).

    Rows whose vector is NULL or holds NULL or non-finite components are left
    out; components become floor(256 * x), held within LIMIT.  The codebook of each
    part position starts from the ``entries`` smallest ids (NULL ids last, equal
    ids by vector), and is moved ``rounds`` times to the floored means of its
    parts; an entry without parts stays, ties go to the lower index.  Vectors
    have ``length`` components, by default the commonest length, the longest of
    equally common ones; rows of another length stay, with a NULL code and
    error.  Parts are as equal as the length allows.  ``label_error`` sums the
    errors of equal labels, NULLs together; a sum beyond a long is NULL.
    Repeated rows and NULL ids stay; other columns are ignored.  Without kept
    rows the result is empty and so are the codebooks.

    Each round is one pass over the vectors; a task returns at most one row for each entry
    and component, which are summed before the driver sees entries * length of them.
    """
    x = F.col(vec_col)
    sound = x.isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    kept = vectors.where(sound).select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), x.cast("array<double>").alias("x"))
    if length is None:
        common = kept.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
        length = common["d"] if common else 0
    fitting = kept.where(F.size("x") == length)
    seeds = fitting.orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).select("x").toArrow()  # bounded by `entries`
    start = _integers(seeds.column(0).combine_chunks(), length)
    books = [start[:, lo:hi] for lo, hi in part_bounds(length, parts)]
    for _ in range(rounds if len(start) else 0):
        moved = np.concatenate(books, axis=1)
        sums = fitting.select("x").mapInArrow(_summed(books, length), "position long, entry long, total long, n long")
        for r in sums.groupBy("position", "entry").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).toLocalIterator():
            moved[r["entry"], r["position"]] = r["total"] // r["n"]
        books = [moved[:, lo:hi] for lo, hi in part_bounds(length, parts)]
    kinds = dict(kept.dtypes)
    schema = f"id {kinds['id']}, label {kinds['label']}, code string, error long"
    if not len(start):
        return vectors.sparkSession.createDataFrame([], f"{id_col} {kinds['id']}, label {kinds['label']}, code string, error long, label_error long"), books
    # read twice: the search isn't run again, and Catalyst sees how large the sums by label are
    coded = stage(kept.mapInArrow(_encoded(books, length), schema), "vector-codes")
    sums = stage(coded.groupBy(F.col("label").alias("of")).agg(F.expr("try_cast(sum(cast(error as decimal(38,0))) as bigint)").alias("label_error")), "label-errors")
    joined = coded.join(sums, coded["label"].eqNullSafe(sums["of"]), "left")
    return joined.select(F.col("id").alias(id_col), "label", "code", "error", "label_error"), books


def codebooks_sha256(books: list[np.ndarray]) -> str:
    """Of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(v) for b in books for v in b.reshape(-1).tolist()).encode()).hexdigest()


def _rounds() -> str:
    """One more round of assignment and floored means."""
    out = ""
    for k in range(ROUNDS + 1):
        out += f"""
a{k} AS (SELECT r, part, min({{'d': d, 'e': e}}) AS m FROM (SELECT p.r, p.part, c.e, list_sum(list_transform(range(1, len(p.v) + 1), lambda i: (p.v[i] - c.v[i]) * (p.v[i] - c.v[i])))::BIGINT AS d FROM p JOIN c{k} c ON c.part = p.part) GROUP BY r, part),"""
        if k < ROUNDS:
            out += f"""
s{k} AS (SELECT part, e, i, sum(x)::BIGINT AS s, count(*)::BIGINT AS n FROM (SELECT a.part, a.m.e AS e, unnest(p.v) AS x, generate_subscripts(p.v, 1) AS i FROM a{k} a JOIN p ON p.r = a.r AND p.part = a.part) GROUP BY ALL),
n{k} AS (SELECT part, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM s{k} GROUP BY ALL),
c{k + 1} AS (SELECT c.part, c.e, coalesce(n.v, c.v) AS v FROM c{k} c LEFT JOIN n{k} n ON n.part = c.part AND n.e = c.e),"""
    return out


ORACLE = f"""
WITH x AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda i: i IS NULL OR NOT isfinite(i))) = 0),
q AS (SELECT row_number() OVER (ORDER BY vec_id, v) AS r, vec_id, label, list_transform(v, lambda i: greatest(-{LIMIT}, least({LIMIT}, floor({SCALE} * i)))::BIGINT) AS v FROM x),
p AS (SELECT r, k AS part, v[k * len(v) // {PARTS} + 1:(k + 1) * len(v) // {PARTS}] AS v FROM q, range({PARTS}) t(k)),
c0 AS (SELECT part, r - 1 AS e, v FROM p WHERE r <= {ENTRIES}),{_rounds()}
f AS (SELECT r, string_agg(lpad(to_hex(m.e), 2, '0'), '' ORDER BY part) AS code, sum(m.d)::BIGINT AS error FROM a{ROUNDS} GROUP BY r),
h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, e)) AS h FROM c{ROUNDS})
SELECT vec_id, lower(code) AS code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, h AS codebooks_sha256 FROM q JOIN f USING (r), h
"""
