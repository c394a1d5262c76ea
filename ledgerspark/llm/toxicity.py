"""Toxicity scores: a character n-gram linear classifier on naive-Bayes-scaled features."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators.lineage import stage

GRAMS = (3, 4, 5)
#: N-grams are told apart by so many bits of their hash.
TABLE_BITS = 20
#: Labelled rows that the classifier is fitted on at most, taken by the hash of their id.
TRAIN_ROWS = 20_000
#: Rows that are added to the counts of each n-gram, in the classes' proportion: few rows say little, none say 0.
PRIOR_ROWS = 500.0
#: A toxic row's weight in the fit, and the ridge; with PRIOR_ROWS chosen by three folds of the rows that are learnt from.
TOXIC_WEIGHT, RIDGE = 3.0, 0.3
#: Partitions of the labelled sample: as bounded as its rows are.
_PARTS = 8
_CHUNK = 2_000_000
#: Entries of lists that a task works on at a time.
_PIECE = 1 << 19


def _fold() -> np.ndarray:
    """Byte table: A-Z lower-cased, digits as one, other ASCII that is no letter as a space."""
    t = np.arange(256, dtype=np.uint32)
    t[65:91] += 32
    for b in range(128):
        if not (65 <= b < 91 or 97 <= b < 123):
            t[b] = 48 if 48 <= b < 58 else 32
    return t


_TABLE = _fold()


def _buckets(raw: np.ndarray, bits: int) -> list[tuple[int, np.ndarray]]:
    """(n, bucket of the n-gram that starts at each byte) over one run of bytes."""
    x, out = _TABLE[raw], []
    h = x.copy()
    for n in range(2, max(GRAMS) + 1):
        if len(x) < n:
            break
        h = h[:-1] * np.uint32(0x01000193) + x[n - 1 :] * np.uint32(0x9E3779B1)
        if n in GRAMS:
            out.append((n, (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> np.uint32(32 - bits)))
    return out


def text_buckets(texts: pa.Array, bits: int) -> Iterator[np.ndarray]:
    """The distinct buckets of each text's n-grams, NULL as empty.

    Texts are padded with a space on both sides, so that words at the ends look
    like others.  Buckets are told apart by who wrote last to a table: no sort.
    """
    last = np.empty(1 << bits, np.int32)
    n, at = len(texts), 0
    while at < n:
        padded, total = [], 0
        while at < n and (not padded or total < _CHUNK):
            padded.append(b" " + (texts[at].as_py() or "").encode() + b" ")
            total += len(padded[-1])
            at += 1
        grams, begin = _buckets(np.frombuffer(b"".join(padded), np.uint8), bits), 0
        for text in padded:
            end = begin + len(text)
            own = [b[begin : end - g + 1] for g, b in grams if end - g >= begin]
            all_ = np.concatenate(own) if own else np.zeros(0, np.uint32)
            order = np.arange(len(all_), dtype=np.int32)
            last[all_] = order
            yield all_[last[all_] == order]
            begin = end


def _listed(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                lists = [b.astype("<i4").tobytes() for b in text_buckets(part.column(0), bits)]
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(lists, pa.binary())], names=["toxic", "buckets"])

    return run


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Labels, sizes of the lists and the lists in a row, of about _PIECE entries at a time."""
    for batch in batches:
        ends = np.cumsum([b.as_buffer().size // 4 for b in batch.column(1)])
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _PIECE, "right")))
            part = batch.slice(lo, hi - lo)
            lists = [np.frombuffer(b, "<i4") for b in part.column(1).to_pylist()]
            yield np.array(part.column(0).to_pylist(), np.float64), np.array([len(x) for x in lists], np.int64), np.concatenate(lists)
            lo = hi


def _counted(bits: int):
    """Rows of each class that hold a bucket, summed over the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 << bits), np.int64)
        for y, sizes, cols in _entries(batches):
            toxic = np.repeat(y == 1, sizes)
            for k in range(2):
                sums[k] += np.bincount(cols[toxic == bool(k)], minlength=1 << bits)
        seen = np.flatnonzero(sums[0] + sums[1])
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(sums[0][seen]), pa.array(sums[1][seen])], names=["bucket", "clean", "toxic"])

    return run


def log_count_ratios(t: np.ndarray, c: np.ndarray, toxic: int, clean: int, prior: float = PRIOR_ROWS) -> np.ndarray:
    """Log of the shares of toxic and of clean rows that hold an n-gram, after ``prior`` rows of the usual mixture that hold it as well."""
    pt, pc = prior * toxic / (toxic + clean), prior * clean / (toxic + clean)
    return np.log((t + pt) / (toxic + pt)) - np.log((c + pc) / (clean + pc))


def _narrowed(shared):
    """The lists with places among the seen buckets instead of the buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = shared.value
        for batch in batches:
            lists = [place[np.frombuffer(b, "<i4")].tobytes() for b in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.binary())], names=["toxic", "buckets"])

    return run


def _gradient(shared, toxic_weight: float):
    """Loss of a partition's rows and its slopes by weight of a bucket and by the intercept; a toxic row counts ``toxic_weight`` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, intercept = shared.value
        slope, loss, rest = np.zeros(len(weights)), 0.0, 0.0
        for y, sizes, cols in _entries(batches):
            z = intercept + np.bincount(np.repeat(np.arange(len(y)), sizes), weights[cols], minlength=len(y))
            heavy = np.where(y == 1, toxic_weight, 1.0)
            off = heavy * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y)
            slope += np.bincount(cols, np.repeat(off, sizes), minlength=len(weights))
            loss += float((heavy * (np.logaddexp(0, z) - y * z)).sum())
            rest += float(off.sum())
        yield pa.RecordBatch.from_arrays([pa.array([loss]), pa.array([rest]), pa.array([slope.astype("<f4").tobytes()], pa.binary())], names=["loss", "off", "slope"])

    return run


@dataclass(frozen=True)
class Model:
    """Weights by bucket (0 for those never seen) and the intercept."""

    weights: np.ndarray
    intercept: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        bits = len(self.weights).bit_length() - 1
        z = np.array([self.weights[b].sum(dtype=np.float64) for b in text_buckets(texts, bits)], np.float64) + self.intercept
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def minimise(evaluate, start: np.ndarray, rounds: int = 30, memory: int = 4, tolerance: float = 1e-3) -> np.ndarray:
    """L-BFGS with backtracking; ``evaluate`` gives the value and slope at a point."""
    x = start
    value, slope = evaluate(x)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    first = np.abs(slope).max()
    for _ in range(rounds):
        if np.abs(slope).max() <= tolerance * first:
            break
        way, scales = -slope, []
        for s, d, rho in reversed(past):
            scales.append(rho * (s @ way))
            way = way - scales[-1] * d
        if past:
            s, d, rho = past[-1]
            way = way / (rho * (d @ d))
        for (s, d, rho), scale in zip(past, reversed(scales), strict=True):
            way = way + (scale - rho * (d @ way)) * s
        step = 1.0 if past else 1 / np.abs(slope).sum()
        for _ in range(20):
            new_value, new_slope = evaluate(x + step * way)
            if new_value <= value + 1e-4 * step * (way @ slope):
                break
            step /= 2
        else:
            break
        moved, turned = step * way, new_slope - slope
        if moved @ turned > 0:
            past = [*past, (moved, turned, 1 / (moved @ turned))][-memory:]
        x, value, slope = x + moved, new_value, new_slope
    return x


def held_out(ident: Column) -> Column:
    """Rows that are never learnt from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(ident.cast("string")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", train_rows: int = TRAIN_ROWS, bits: int = TABLE_BITS, ridge: float = RIDGE, prior: float = PRIOR_ROWS, toxic_weight: float = TOXIC_WEIGHT) -> Model:
    """Fit on at most ``train_rows`` labelled ids that are not held out.

    The sample is taken by the hash of the id, one text an id.  Every n-gram
    that it holds is a feature: counts by class give the naive Bayes log-count
    ratios r, smoothed by ``prior`` rows, so that an n-gram seen once or twice
    does not count like one seen often; a logistic regression with ridge penalty,
    in which toxic rows weigh more, is fitted on presence times r.  Each evaluation is one job:
    partitions of the staged sample return their share of the slope, of at most
    2**bits numbers each, whatever the corpus.

    NULL ids, labels other than 0 and 1, and ids with both labels teach
    nothing; repeated labels count once; of an id's several texts the smallest
    counts.  Without rows of both classes every score is the number of toxic
    rows divided by one more than all labelled rows.
    """
    spark = docs.sparkSession
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(F.col(id_col)))
    usable = usable.groupBy(F.col(id_col).alias("__id")).agg(F.min(label_col).cast("long").alias("__toxic"), F.max(label_col).cast("long").alias("__most")).where(F.col("__toxic") == F.col("__most"))
    chosen = usable.select("__id", "__toxic").orderBy(F.xxhash64("__id"), "__id").limit(train_rows)
    sample = docs.join(F.broadcast(chosen), F.col(id_col) == F.col("__id")).groupBy("__id", "__toxic").agg(F.min(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    sample = sample.select("text", F.col("__toxic").alias("toxic"), "__id").repartition(_PARTS, "__id").select("text", "toxic")
    lists = stage(sample.mapInArrow(_listed(bits), "toxic long, buckets binary"), "toxic-sample").coalesce(_PARTS)
    sums = lists.mapInArrow(_counted(bits), "bucket long, clean long, toxic long").groupBy("bucket").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t")).toArrow()
    sizes = {r["toxic"]: r["count"] for r in lists.groupBy("toxic").count().collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not clean or not toxic:
        share = toxic / (clean + toxic + 1)
        return Model(np.zeros(1 << bits, np.float32), float(np.log(max(share, 1e-9) / (1 - share))))
    ratio = log_count_ratios(sums["t"].to_numpy().astype(float), sums["c"].to_numpy().astype(float), toxic, clean, prior)
    seen = sums["bucket"].to_numpy()
    del sums
    place = np.full(1 << bits, -1, np.int32)
    place[seen] = np.arange(len(seen))
    lists = stage(lists.mapInArrow(_narrowed(spark.sparkContext.broadcast(place)), "toxic long, buckets binary"), "toxic-features").coalesce(_PARTS)

    def evaluate(x: np.ndarray) -> tuple[float, np.ndarray]:
        shared = spark.sparkContext.broadcast((x[:-1] * ratio, float(x[-1])))
        rows = lists.mapInArrow(_gradient(shared, toxic_weight), "loss double, off double, slope binary").collect()
        slope, loss = np.zeros(len(seen)), 0.5 * ridge * float(x[:-1] @ x[:-1])
        for r in rows:
            slope += np.frombuffer(r["slope"], "<f4")
            loss += r["loss"]
        shared.destroy()
        return loss, np.append(slope * ratio + ridge * x[:-1], sum(r["off"] for r in rows))

    x = minimise(evaluate, np.append(np.zeros(len(seen)), np.log(toxic / clean)))
    weights = np.zeros(1 << bits, np.float32)
    weights[seen] = x[:-1] * ratio
    return Model(weights, float(x[-1]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """One row per input row: id, held_out, score, predicted.

    Only the text decides a score; NULL and empty texts get the intercept's.
    Repeated rows and NULL ids stay (a NULL id is not held out).
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**bits weights: fixed size
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = dict(src.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.scores(batch.column(1)))], names=["id", "score"])

    out = src.mapInArrow(run, f"id {kind}, score double")
    return out.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows that are not predicted toxic, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            yield batch.filter(pa.array(shared.value.scores(batch.column(at)) < threshold))

    return docs.mapInArrow(run, docs.schema)
