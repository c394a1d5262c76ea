"""Best-fit-decreasing packing of token streams into fixed windows."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.operators.lineage import stage

#: Bytes of ids after which a task hands on what it has cut.
_BATCH_BYTES = 8 << 20
#: Windows of one group: sequence ids hold the group above this many bits.
_GROUP_BITS = 24
_END_TEXT = "<|endoftext|>"


def _byte_chars() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    odd = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(odd)}


class ByteBpe:
    """Ids of a byte-level BPE file, as ``tokenizers`` gives them without added tokens.

    The merges of such a file are numbered in the order of its ids, so a rank
    encoder over the same vocabulary gives the same ids at several times the
    speed; probe strings are compared when it is loaded, and the library itself
    encodes everything if they differ.  Special strings inside a text become
    their id, the library's default.
    """

    PROBES = ("Plain words, 12 numbers; and l'été d'Öl.", "a  b \n\n c\t\td ", "'s 'LL x's 中文 \U0001f600", " lead\r\nline\x0bend  ", "###%%% &amp; --- !!")

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        chars = _byte_chars()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(chars[c] for c in w): i for w, i in spec["model"]["vocab"].items() if w not in self.special}
        pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        fast = tiktoken.Encoding("byte-bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.fast = fast if all(fast.encode_ordinary(p) == self._slow(p) for p in self.PROBES) else None

    def _slow(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None or any(s in text for s in self.special):
            return np.array(self._slow(text), "<u4")
        return np.array(self.fast.encode_ordinary(text), "<u4")


class TightestWindow:
    """Segment tree over remaining capacities 0..size: runs of open windows with equal room."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.open = [0] * (2 * self.leaves)
        self.at: list[list[tuple[int, int]]] = [[] for _ in range(self.leaves)]

    def add(self, room: int, first: int, count: int) -> None:
        """Windows first, first + 1, ... of this room."""
        if room and count:
            self.at[room].append((first, count))
            self._count(room, 1)

    def _count(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.open[node] += by
            node >>= 1

    def take(self, need: int) -> tuple[int, int, int] | None:
        """Remove and return (room, first, count): a run of windows with the least room >= need."""
        node, tree = need + self.leaves, self.open
        while not tree[node]:
            while node & 1:  # a right child: climb until there is a right sibling
                node >>= 1
                if node <= 1:
                    return None
            node += 1
        while node < self.leaves:
            node = 2 * node if tree[2 * node] else 2 * node + 1
        room = node - self.leaves
        first, count = self.at[room].pop()
        self._count(room, -1)
        return room, first, count


def best_fit_plan(counts: dict[int, int], window: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over a histogram of lengths: (length, from, first, each, offset) rows.

    Pieces of one length are alike, so they are placed in runs.  Of a length's
    pieces, numbered from 0, those from number ``from`` on go to the windows
    first, first + 1, ..., ``each`` of them in a window, the first of these at
    ``offset``.  The tightest open windows that fit take as many pieces as they
    hold before others are looked at, as they would one piece at a time.  Runs
    are split at most once a length and room, so the plan is bounded by the
    window's size, not by the number of pieces.
    """
    tree, plan, opened = TightestWindow(window), [], 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = counts[length] - left
            found = tree.take(length)
            if found is None:
                room, first, count = window, opened, -(-left // (window // length))
                opened += count
            else:
                room, first, count = found
            each = room // length
            whole = min(count, left // each)
            if whole:
                plan.append((length, at, first, each, window - room))
                tree.add(room - each * length, first, whole)
                left -= whole * each
            elif left:  # fewer than one window takes: the last of this length
                plan.append((length, at, first, left, window - room))
                tree.add(room - left * length, first, 1)
                left, whole = 0, 1
            tree.add(room, first + whole, count - whole)
    return plan


def places(plan: list[tuple[int, int, int, int, int]]):
    """Function from arrays (length, number among its length) to arrays (window, offset)."""
    rows = np.array(sorted(plan), np.int64).reshape(-1, 5)
    lengths = np.unique(rows[:, 0])
    start = np.searchsorted(rows[:, 0], lengths)
    width = int(rows[:, 1].max(initial=0)) + 1
    keys = np.searchsorted(lengths, rows[:, 0]) * width + rows[:, 1]

    def place(length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kind = np.searchsorted(lengths, length)
        at = np.searchsorted(keys, kind * width + np.minimum(number, width - 1), side="right") - 1
        _, begin, first, each, offset = rows[np.maximum(at, start[kind])].T
        nth = number - begin
        return first + nth // each, offset + nth % each * length

    return place


def _cut(path: str, window: int, end_id: int):
    """Each document's stream in pieces: full windows and what is left; ``nth`` numbers a task's pieces of one length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end, task = ByteBpe(path), np.array([end_id], "<u4"), TaskContext.get().partitionId()
        seen = [0] * (window + 1)
        for batch in batches:
            rows: list[tuple] = []
            held = 0

            def made(batch=batch) -> pa.RecordBatch:
                nonlocal rows, held
                at, *columns = zip(*rows, strict=True)
                types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                arrays = [batch.column(0).take(pa.array(at))] + [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                rows, held = [], 0
                return pa.RecordBatch.from_arrays(arrays, names=["_id", "start", "length", "doc_tokens", "task", "nth", "ids"])

            for lo in range(0, batch.num_rows, 64):
                for k, text in enumerate(batch.column(1).slice(lo, 64).to_pylist(), lo):
                    ids = np.concatenate([bpe.ids(text), end]) if text else end
                    for s in range(0, len(ids), window):
                        raw = ids[s : s + window].tobytes()
                        size = len(raw) // 4
                        rows.append((k, s, size, len(ids), task, seen[size], raw))
                        seen[size] += 1
                        held += len(raw)
                        if held > _BATCH_BYTES:
                            yield made()
            if rows:
                yield made()

    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = 1024, end_id: int = 0) -> DataFrame:
    """Pieces of token streams placed in windows of at most ``window`` ids.

    One row per piece: id, start, length, doc_tokens, sequence_id, offset and
    ``ids``, the piece as packed little-endian unsigned 32-bit numbers.  A
    document's stream is its ids and then ``end_id``; NULL and empty texts are
    the end id alone.  Streams longer than a window are first cut into full
    windows; what is left is packed best-fit-decreasing over the whole table.

    Best fit needs no more than how many pieces there are of each length: the
    driver plans the windows from that histogram of at most ``window`` numbers,
    and each piece looks up its place by its number among the pieces of its
    length.  Numbers are the task's own plus those of the tasks before it, so
    no length, source or group of copies meets in one task, and the result has
    the same windows however the table is split.  Sequence ids are gapless from
    0.  Repeated rows and NULL ids, of any type, are packed like others.
    """
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = src.schema["_id"].dataType.simpleString()
    # written once: numbers and pieces must come from the same run of a task
    cut = src.mapInArrow(_cut(tokenizer_path, window, end_id), f"_id {kind}, start long, length long, doc_tokens long, task long, nth long, ids binary")
    pieces = stage(cut, "pieces")
    ahead = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    # a table of its own: Catalyst sees its size and sends it to all tasks or, where it is large, shuffles
    starts = stage(counts.select("length", "task", "n", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before")), "piece-starts")
    plan = best_fit_plan({r["length"]: r["n"] for r in starts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, window)
    shared = docs.sparkSession.sparkContext.broadcast(plan)  # bounded by the window's size

    @F.pandas_udf("sequence_id long, offset long")
    def placed(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        place = places(shared.value)
        for length, number in batches:
            at, offset = place(length.to_numpy(), number.to_numpy())
            yield pd.DataFrame({"sequence_id": at, "offset": offset})

    rows = pieces.join(starts.select("length", "task", "before"), ["length", "task"]).withColumn("place", placed("length", F.col("before") + F.col("nth")))
    return rows.select(F.col("_id").alias(id_col), "start", "length", "doc_tokens", "place.sequence_id", "place.offset", "ids")


def _packed_groups(path: str, window: int, end_id: int, most: int | None):
    """Pieces of rows that come sorted by (group, order), each group packed for itself, or each stretch of about ``most`` ids in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = ByteBpe(path), np.array([end_id], "<u4")
        names = ["_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
        now, rows, kind, held, done = None, [], None, 0, 0

        def close() -> tuple[pa.RecordBatch, int]:
            counts: dict[int, int] = {}
            nth = []
            for r in rows:
                nth.append(counts.get(r[2], 0))
                counts[r[2]] = nth[-1] + 1
            place = places(best_fit_plan(counts, window))
            at, offset = place(np.array([r[2] for r in rows]), np.array(nth))
            # windows are numbered by the piece in them that came first
            _, first, which = np.unique(at, return_index=True, return_inverse=True)
            rank = np.empty(len(first), np.int64)
            rank[np.argsort(first)] = np.arange(len(first))
            ids, start, length, tokens, raw = zip(*rows, strict=True)
            columns = [pa.array(ids, kind), *(pa.array(c, pa.int64()) for c in (start, length, tokens, (now << _GROUP_BITS) + done + rank[which], offset)), pa.array(raw, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=names), len(first)

        for batch in batches:
            kind = batch.column(0).type
            for lo in range(0, batch.num_rows, 64):
                for key, text, group in zip(*(batch.column(c).slice(lo, 64).to_pylist() for c in range(3)), strict=True):
                    if rows and (group != now or most and held >= most):
                        made, windows = close()
                        yield made
                        rows, held, done = [], 0, done + windows
                    done = done if group == now else 0
                    now = group
                    ids = np.concatenate([bpe.ids(text), end]) if text else end
                    for s in range(0, len(ids), window):
                        raw = ids[s : s + window].tobytes()
                        rows.append((key, s, len(raw) // 4, len(ids), raw))
                    held += len(ids)
        if rows:
            yield close()[0]

    return run


def pack_in_order(docs: DataFrame, tokenizer_path: str, group_col: str, order_cols: list[str], id_col: str = "doc_id", text_col: str = "text", window: int = 1024, end_id: int = 0, group_ids: int | None = None) -> DataFrame:
    """As ``pack_documents``, but each group of rows is packed for itself and sequence ids follow the groups' numbers.

    Groups are whole numbers from 0, NULL none, of so many bytes as one task may
    hold; with ``group_ids``, of any size: in their order, rows of so many ids
    are packed together.  A sequence id is the group's number above _GROUP_BITS bits, and below
    them the window's place by the piece in it that comes first in the order.
    """
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(group_col).cast("long").alias("_group"), *(F.col(c).alias(f"_by{k}") for k, c in enumerate(order_cols)))
    kind = src.schema["_id"].dataType.simpleString()
    dealt = src.repartition("_group").sortWithinPartitions("_group", *(f"_by{k}" for k in range(len(order_cols))))
    out = dealt.select("_id", "_text", "_group").mapInArrow(_packed_groups(tokenizer_path, window, end_id, group_ids), f"_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
    return out.withColumnRenamed("_id", id_col)
