"""Benchmark passages in documents: Wu-Manber search for all windows of all items at once."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators.lineage import stage

WINDOW = 10
#: Words and item ids of one search table; a larger benchmark is searched in several tables.
BLOCK_WORDS = 1 << 20
#: An item of more words is cut into stretches that share WINDOW - 1 words.
STRETCH_WORDS = 1 << 16
_MULTIPLY = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)


def _fold() -> bytes:
    """Byte table: A-Z lower-cased, ASCII that is neither letter nor digit as a space."""
    t = bytearray(range(256))
    for b in range(128):
        if 65 <= b < 91:
            t[b] += 32
        elif not (48 <= b < 58 or 97 <= b < 123):
            t[b] = 32
    return bytes(t)


_TABLE = _fold()


def words(text: str | None) -> list[bytes]:
    """Runs of letters, digits and non-ASCII characters, A-Z lower-cased; none of NULL."""
    return (text or "").encode().translate(_TABLE).split()


class WindowTable:
    """Wu-Manber tables for windows of one length over word numbers.

    ``shift`` says by block (two words; one for windows of one word) how far the
    end of a window may move without missing one; at 0 the block ends windows,
    which ``start`` lists by the block's hash, sorted by their words.
    """

    def __init__(self, windows: np.ndarray, owners: np.ndarray):
        self.length = windows.shape[1]
        self.block = min(2, self.length)
        distinct, which = np.unique(windows, axis=0, return_inverse=True)
        self.bits = max(10, int(len(distinct) * 4).bit_length())
        self.shift = np.full(1 << self.bits, self.length - self.block + 1, np.uint8)
        for at in range(self.length - self.block + 1):
            np.minimum.at(self.shift, self._codes(distinct[:, at : at + self.block]), self.length - self.block - at)
        codes = self._codes(distinct[:, -self.block :])
        order = np.argsort(codes, kind="stable")  # stays sorted by words in each bucket
        self.windows = distinct[order]
        self.first = np.ascontiguousarray(self.windows[:, 0])
        self.start = np.searchsorted(codes[order], np.arange((1 << self.bits) + 1)).astype(np.int32)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        held = np.unique(np.stack([place[which.reshape(-1)], owners]), axis=1)
        self.owners = held[1]
        self.owned = np.searchsorted(held[0], np.arange(len(order) + 1))

    def _codes(self, blocks: np.ndarray) -> np.ndarray:
        h = blocks[:, -1].astype(np.uint32) * _MULTIPLY[0]
        if self.block == 2:
            h = (h ^ (h >> np.uint32(15))) + blocks[:, 0].astype(np.uint32) * _MULTIPLY[1]
        return (h ^ (h >> np.uint32(13))) * _MULTIPLY[1] >> np.uint32(32 - self.bits)

    def occurrences(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """(first word, window) of each occurrence."""
        back = self.length - self.block
        if len(ids) < self.length:
            return
        codes = self._codes(np.stack([ids[: len(ids) - self.block + 1], ids[self.block - 1 :]], axis=1))
        skip = self.shift[codes].tobytes()
        at, end = back, len(skip)
        while at < end:
            far = skip[at]
            if far:
                at += far
                continue
            begin = at - back
            lo, hi = self.start[codes[at]], self.start[codes[at] + 1]
            if hi - lo > 1:
                near = self.first[lo:hi]
                lo, hi = lo + np.searchsorted(near, ids[begin], "left"), lo + np.searchsorted(near, ids[begin], "right")
            if hi > lo:
                same = (self.windows[lo:hi] == ids[begin : begin + self.length]).all(axis=1)
                if same.any():
                    yield begin, int(lo + same.argmax())
            at += 1


class Searcher:
    """All windows of (words joined by spaces, item ids) rows; one table for each window length."""

    def __init__(self, stretches: list[tuple[str, list[str]]], window: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        self.items = [items for _, items in stretches]
        parts: dict[int, tuple[list, list]] = {}
        for k, (text, _) in enumerate(stretches):
            ids = np.array([self.numbers.setdefault(w, len(self.numbers) + 1) for w in text.encode().split(b" ")], np.int32)
            cut = np.lib.stride_tricks.sliding_window_view(ids, min(window, len(ids)))
            rows, owners = parts.setdefault(cut.shape[1], ([], []))
            rows.append(cut)
            owners.append(np.full(len(cut), k))
        self.tables = [WindowTable(np.concatenate(rows), np.concatenate(owners)) for _, (rows, owners) in sorted(parts.items())]

    def search(self, found: list[bytes]) -> tuple[list[tuple[int, int]], list[str]]:
        """Merged spans [begin, end) of hit words, and the ids of items with occurring windows."""
        number = self.numbers.get
        ids = np.array([number(w, 0) for w in found], np.int32)
        spans, owners = [], set()
        for table in self.tables:
            for begin, window in table.occurrences(ids):
                spans.append((begin, begin + table.length))
                owners.update(table.owners[table.owned[window] : table.owned[window + 1]].tolist())
        return merge_spans(spans), sorted({i for k in owners for i in self.items[k]})


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans in which those that touch or overlap are one."""
    out: list[list[int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [(b, e) for b, e in out]


def _stretched(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, texts = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = words(text.as_py())
                step = STRETCH_WORDS - window + 1
                for at in range(0, max(1, len(found) - window + 1), step) if found else ():
                    items.append(item)
                    texts.append(b" ".join(found[at : at + STRETCH_WORDS]).decode())
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(texts, pa.string())], names=["item", "words"])

    return run


_FOUND = "n_words long, n_hit long, spans array<struct<begin:int,end:int>>, items array<string>"


def _searched(shared, only_hits: bool):
    """Search results by row number or id; with ``only_hits`` rows without a hit are left out."""
    spans_type = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = shared.value
        for batch in batches:
            kept, counts, hits, spans, items = [], [], [], [], []
            for k, text in enumerate(batch.column(1)):
                found = words(text.as_py())
                marked, owners = searcher.search(found)
                if marked or not only_hits:
                    kept.append(k)
                    counts.append(len(found))
                    hits.append(sum(e - b for b, e in marked))
                    spans.append([{"begin": b, "end": e} for b, e in marked])
                    items.append(owners)
            columns = [pa.array(counts, pa.int64()), pa.array(hits, pa.int64()), pa.array(spans, spans_type), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(kept, pa.int64())), *columns], names=["id", "n_words", "n_hit", "spans", "items"])

    return run


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of the finds of several tables in one text."""
    for batch in batches:
        rows = batch.to_pylist()
        spans = [merge_spans([(s["begin"], s["end"]) for part in r["spans"] for s in part]) for r in rows]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([sum(e - b for b, e in s) for s in spans], pa.int64()),
                pa.array([[{"begin": b, "end": e} for b, e in s] for s in spans], pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
                pa.array([sorted({i for part in r["items"] for i in part}) for r in rows], pa.list_(pa.string())),
            ],
            names=["row", "n_hit", "spans", "items"],
        )


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document row: id, n_words, n_hit, spans of hit words, items with occurring windows.

    A window is ``window`` consecutive words of an item, or all words of a
    shorter one; items without words have none.  ``spans`` are [begin, end)
    positions of words inside any occurrence, merged; ``items`` are ids as
    strings, sorted.  NULL and empty texts have no words.  Items of one id
    count once, equal items each; an item whose id is NULL marks words but is
    not listed.  Repeated document rows and NULL ids stay.

    The benchmark becomes search tables of about ``block_words`` words and item
    ids each, sent to all tasks: the usual one is searched in one pass without
    a shuffle.  If there are more, the rows are written once with a number, each table is
    searched in a pass of its own, and the few rows with hits are united by number.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = dict(src.dtypes)["id"]
    stretches = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text")).mapInArrow(_stretched(window), "item string, words string")
    stretches = stage(stretches.groupBy("words").agg(F.collect_set("item").alias("items")), "benchmark-windows")
    weight = stretches.agg(F.sum(F.size(F.split("words", " ")) + F.size("items")).alias("w")).first()["w"] or 0
    blocks = max(1, -(-weight // block_words))

    def table(k: int):
        rows = stretches if blocks == 1 else stretches.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == k)
        return spark.sparkContext.broadcast(Searcher([(r["words"], sorted(r["items"])) for r in rows.collect()], window))  # about block_words

    if blocks == 1:
        return src.mapInArrow(_searched(table(0), False), f"id {kind}, {_FOUND}").withColumnRenamed("id", id_col)
    rows = stage(src.withColumn("row", F.monotonically_increasing_id()), "numbered-texts")
    # by the first table all rows, for the number of their words; by the others those with hits
    every = stage(rows.select("row", "text").mapInArrow(_searched(table(0), False), f"id long, {_FOUND}"), "leaks")
    found = [every.where("n_hit > 0")]
    for k in range(1, blocks):
        found.append(stage(rows.select("row", "text").mapInArrow(_searched(table(k), True), f"id long, {_FOUND}"), "leaks"))
    hits = reduce(DataFrame.unionByName, found).groupBy(F.col("id").alias("row")).agg(F.collect_list("spans").alias("spans"), F.collect_list("items").alias("items"))
    hits = hits.mapInArrow(_united, "row long, n_hit long, spans array<struct<begin:int,end:int>>, items array<string>")
    out = rows.select("row", F.col("id").alias(id_col)).join(every.select(F.col("id").alias("row"), "n_words", F.col("spans").alias("none"), F.col("items").alias("nothing")), "row").join(hits, "row", "left")
    return out.select(id_col, "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("spans", "none").alias("spans"), F.coalesce("items", "nothing").alias("items"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
ig AS (SELECT item_id, least(10, len(w)) AS n, list_transform(range(1, greatest(2, len(w) - 8)), lambda k: array_to_string(w[k:k + 9], ' ')) AS g FROM i WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, unnest(g) AS s FROM ig), lens AS (SELECT DISTINCT n FROM win),
dg AS (SELECT r, n, list_transform(range(1, len(w) - n + 2), lambda k: array_to_string(w[k:k + n - 1], ' ')) AS g FROM d JOIN lens ON len(w) >= n),
dw AS (SELECT r, n, unnest(g) AS s, generate_subscripts(g, 1) AS k FROM dg),
occ AS (SELECT r, k, n, item_id FROM dw JOIN win USING (n, s)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS p FROM (SELECT DISTINCT r, k, n FROM occ)) GROUP BY r),
ids AS (SELECT r, count(*) AS n_items, sha256(string_agg(x, ',' ORDER BY x)) AS h FROM (SELECT DISTINCT r, item_id::VARCHAR AS x FROM occ WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN ids USING (r)
"""
