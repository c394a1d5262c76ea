"""Exact duplicates found by owners of Patricia tries."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators.lineage import stage

#: Bytes of edges and nodes that a task's trie holds before a subtree is spilled.
TRIE_BYTES = 48 << 20
#: What a node costs besides the bytes of its edge.
NODE_BYTES = 200
#: A text that one task holds more often than this is dealt over SALTS owners.
CROWD, SALTS = 16, 16
#: Groups of more than 1/2048 of all rows, fewer than 2048 by that, are broadcast to their rows.
SPREAD = 2048
SPACES = r"[\x20\x09-\x0D]+"


class PatriciaTrie:
    """Compressed radix trie over whole byte strings.

    An edge holds the bytes down to the next fork; a terminal node holds the
    smallest identifier, how many rows have it, and how many rows ended there.
    """

    __slots__ = ("children", "edge", "least", "n", "same")

    def __init__(self, edge: bytes = b""):
        self.edge = edge
        self.children: dict[int, PatriciaTrie] = {}
        self.n, self.least, self.same = 0, None, 0

    def insert(self, key: bytes, ident: int | None, same: int = 1, n: int = 1) -> int:
        """Add ``n`` rows of a string, ``same`` of them with its smallest id; the bytes that the trie grew by."""
        node, at, grown = self, 0, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = PatriciaTrie(key[at:])
                node, grown = child, grown + NODE_BYTES + len(child.edge)
                break
            edge = child.edge
            if not key.startswith(edge, at):
                shared = _shared(edge, key, at)
                fork = PatriciaTrie(edge[:shared])
                child.edge = edge[shared:]
                fork.children[child.edge[0]] = child
                node.children[key[at]] = fork
                child, edge, grown = fork, fork.edge, grown + NODE_BYTES
            node, at = child, at + len(edge)
        if not node.n or (ident is not None and (node.least is None or ident < node.least)):
            node.least, node.same = ident, same
        elif ident == node.least:
            node.same += same
        node.n += n
        return grown

    def terminals(self, above: bytes = b"") -> Iterator[tuple[bytes, PatriciaTrie]]:
        """(whole string, node) of every string in the trie."""
        stack = [(above, self)]
        while stack:
            prefix, node = stack.pop()
            if node.n:
                yield prefix, node
            stack += [(prefix + c.edge, c) for c in node.children.values()]

    def weight(self) -> int:
        """Bytes of the nodes below this one and of its own."""
        total, stack = 0, [self]
        while stack:
            node = stack.pop()
            total += NODE_BYTES + len(node.edge)
            stack += node.children.values()
        return total

    def cut_heaviest(self) -> tuple[bytes, PatriciaTrie]:
        """Take the heaviest subtree below the first fork off the trie: (the bytes above it, subtree)."""
        node, above = self, b""
        while len(node.children) == 1 and not node.n:
            (child,) = node.children.values()
            if not child.children:
                break
            node, above = child, above + child.edge
        first = max(node.children, key=lambda b: node.children[b].weight())
        return above, node.children.pop(first)


def _shared(edge: bytes, key: bytes, at: int) -> int:
    """Length of the common prefix of edge and key[at:], by halving."""
    lo, hi = 0, min(len(edge), len(key) - at)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if edge[lo:mid] == key[at + lo : at + mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def _tries(trie_bytes: int, digest: bool):
    """One trie over a task's (text, least, same, n) rows; each string's sums as they are spilled or at the end.

    A subtree that is spilled is forgotten: a string that comes again later
    begins anew, and its parts are summed afterwards.  With ``digest`` the
    string itself is left out for its length and SHA-256.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, held = PatriciaTrie(), 0
        out: list[tuple] = []
        size = 0

        def emit(above: bytes, subtree: PatriciaTrie) -> Iterator[pa.RecordBatch]:
            nonlocal out, size
            for text, node in subtree.terminals(above + subtree.edge):
                key = (len(text), hashlib.sha256(text).hexdigest()) if digest else (text,)
                out.append((*key, node.least, node.same, node.n))
                size += 100 if digest else len(text)
                if size > 8 << 20:
                    yield batch_of()
                    out, size = [], 0

        def batch_of() -> pa.RecordBatch:
            types = ([pa.int64(), pa.string()] if digest else [pa.binary()]) + [pa.int64()] * 3
            names = (["len", "sha"] if digest else ["text"]) + ["least", "same", "n"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

        for batch in batches:
            texts, ids, same, n = (batch.column(i) for i in range(4))
            for at in range(0, batch.num_rows, 256):
                part = (c.slice(at, 256).to_pylist() for c in (texts, ids, same, n))
                for row in zip(*part, strict=True):
                    held += trie.insert(*row)
                    while held > trie_bytes and trie.children:
                        above, subtree = trie.cut_heaviest()
                        held -= subtree.weight()
                        yield from emit(above, subtree)
        yield from emit(b"", trie)
        if out:
            yield batch_of()

    return run


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; NULL as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = normalised(F.col(text_col))
    return docs.select(F.col(id_col).cast("long").alias("id"), F.octet_length(text).cast("long").alias("len"), F.sha2(text, 256).alias("sha"), F.xxhash64(text).alias("hash"))


def _groups(docs: DataFrame, id_col: str, text_col: str, trie_bytes: int) -> DataFrame:
    """One row per distinct text: len, sha, least, same (rows with the least id), n."""
    one = F.lit(1).cast("long")
    texts = docs.select(normalised(F.col(text_col)).cast("binary").alias("text"), F.col(id_col).cast("long").alias("least"), one.alias("same"), one.alias("n"))
    heads = texts.mapInArrow(_tries(trie_bytes, False), "text binary, least long, same long, n long")
    salt = F.when(F.col("n") > CROWD, F.pmod(F.spark_partition_id(), F.lit(SALTS))).otherwise(0)
    heads = heads.withColumns({"len": F.octet_length("text"), "hash": F.xxhash64("text"), "salt": salt})
    owned = heads.repartition("len", "hash", "salt").select("text", "least", "same", "n")
    parts = owned.mapInArrow(_tries(trie_bytes, True), "len long, sha string, least long, same long, n long")
    # what was spilled or salted comes together by narrow rows
    ids = parts.repartition("len", "sha").groupBy("len", "sha", "least").agg(F.sum("same").alias("same"), F.sum("n").alias("n"))
    least = F.min(F.struct(F.col("least").isNull().alias("none"), "least", "same"))
    merged = ids.groupBy("len", "sha").agg(least.alias("first"), F.sum("n").alias("n"))
    return stage(merged.select("len", "sha", "first.least", "first.same", "n"), "exact-groups")


def _with_groups(docs: DataFrame, groups: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each row's id, sha, hash and the least and n of its group."""
    total = groups.agg(F.sum("n")).first()[0] or 0
    rows = _keyed(docs, id_col, text_col)
    hot = groups.where(F.col("n") > total // SPREAD).select(F.col("len").alias("hl"), F.col("sha").alias("hs"), F.col("least").alias("h_least"), F.col("n").alias("h_n"))
    rows = rows.join(F.broadcast(hot), (F.col("len") == F.col("hl")) & (F.col("sha") == F.col("hs")), "left")
    # rows that have found their group are dealt by their ids: they need no partner
    rows = rows.withColumn("key", F.when(F.col("h_n").isNull(), F.col("sha")).otherwise(F.xxhash64("id").cast("string")))
    rest = groups.where(F.col("n") <= total // SPREAD).select(F.col("sha").alias("gs"), F.col("len").alias("gl"), F.col("least").alias("g_least"), F.col("n").alias("g_n"))
    rows = rows.join(rest, (F.col("key") == F.col("gs")) & (F.col("len") == F.col("gl")), "left")
    least = F.when(F.col("h_n").isNull(), F.col("g_least")).otherwise(F.col("h_least"))
    return rows.select("id", "sha", "hash", least.alias("least"), F.coalesce("h_n", "g_n").alias("n"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their normalised bytes are.  Each task first inserts
    what it reads into a compressed radix trie, so that copies leave it as one
    string; strings go to the owner of their length and content hash, which
    inserts the whole bytes into a trie of all strings that it owns.  A terminal
    node keeps the smallest id and the counts.  Beyond ``trie_bytes`` the heaviest
    subtree is spilled as narrow sums, which are added up at the end, like those
    of texts so frequent that several owners share them.  Rows find their group
    by length and SHA-256.

    The row with the smallest id stays; NULL counts as the empty text; a NULL id
    is larger than all others and stays only in a group that has no other; of
    rows that repeat the kept id every one is marked kept.  Ids are whole
    numbers; other columns are ignored.
    """
    rows = _with_groups(docs, _groups(docs, id_col, text_col, trie_bytes), id_col, text_col)
    kept = F.col("id").eqNullSafe(F.col("least"))
    return rows.select(F.col("id").alias(id_col), F.col("least").alias("keep_id"), F.col("n").alias("group_size"), kept.alias("kept"), F.col("sha").alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group, all columns as they are: the row of the smallest id.

    Of rows that repeat the kept id and its text any one stays, and so it is
    with the rows of a group that has NULL ids only.  A row goes by its id and
    the hash of its text: an id that occurs with several texts loses only the copies.
    """
    groups = _groups(docs, id_col, text_col, TRIE_BYTES)
    rows = _with_groups(docs, groups, id_col, text_col)
    # a table of its own: Catalyst sees its size and sends it to all tasks or, where it is large, shuffles both sides
    gone = stage(rows.where(~F.col("id").eqNullSafe(F.col("least"))).select(F.col("id").alias("__gone"), F.col("hash").alias("__gone_hash")).distinct(), "exact-gone")
    text, ident = normalised(F.col(text_col)), F.col(id_col).cast("long")
    left = docs.withColumn("__hash", F.xxhash64(text)).join(gone, (F.col("__hash") == F.col("__gone_hash")) & ident.eqNullSafe(F.col("__gone")), "left_anti").drop("__hash")
    again = groups.where(F.col("same") > 1).select(F.col("sha").alias("__again"))
    if again.isEmpty():
        return left
    left = left.withColumn("__sha", F.sha2(text, 256))
    once = left.join(again, F.col("__sha") == F.col("__again"), "left_anti").drop("__sha")
    repeated = left.join(again, F.col("__sha") == F.col("__again"), "left_semi").groupBy("__sha").agg(F.first(F.struct(*docs.columns)).alias("__row"))
    return once.unionByName(repeated.select("__row.*"))


ORACLE = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
g AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM t JOIN g USING (body)
"""
