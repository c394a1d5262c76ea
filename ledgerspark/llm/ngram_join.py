"""Exact Jaccard self-join of word n-gram sets by prefixes under several token orders."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators.graph import connected_components
from ledgerspark.operators.lineage import discard, stage

#: Multipliers of the token orders: order k sorts tokens by token * ORDERS[k] mod 2**64.
ORDERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Tokens held by more sets than this count as frequent: their lists are not paired.
LIST_SETS = 8
#: Postings that one range of tokens should hold: with fewer, a set is named in more rows of the exchange.
RANGE_POSTINGS = 2_000_000
#: Places of sets in blocks that are sent to all tasks at most, at about 25 bytes each; with more, the texts are shuffled to them.
SENT_PLACES = 1_000_000
#: A block of sets that one task compares holds at most so many sets and tokens.
BLOCK_SETS, BLOCK_TOKENS = 1024, 1_000_000
_REMEMBERED = 500_000


class WordHashes(dict):
    """64-bit hash of each word; forgets when it is full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: str | None, words: WordHashes, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles: A-Z lower-cased, words parted by ASCII white space."""
    w = text.encode().lower().split() if text else []
    if not w:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, w), np.uint64, len(w))
    size = min(n, len(w))
    out = np.full(len(w) - size + 1, size, np.uint64)
    for k in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + h[k : k + len(out)]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(29)
    return np.unique(out)


def _key(tokens: np.ndarray) -> int:
    """63-bit key of a whole set."""
    return xxhash.xxh3_64_intdigest(tokens.tobytes(), 1) >> 1


def spare(size: int) -> int:
    """Tokens by which prefixes are longer than the shortest valid ones: so many must be shared.

    The more there are, the larger a part of a set must be frequent tokens
    before these alone could make it similar to another.
    """
    return size // 40 + min(size, 40) + 2


def _spare(size: Column) -> Column:
    return F.floor(size / 40) + F.least(size, F.lit(40)) + 2


def prefix_size(size: int, percent: int) -> int:
    """Tokens of a set's prefix: two sets of at least ``percent`` share min(spare) of them."""
    return min(size, size - -(-percent * size // 100) + spare(size))


def _sets(n: int, percent: int, ranges: int):
    """For each document its set's key and size; and, by range of tokens, the prefixes' postings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, shift = WordHashes(), np.uint64(64 - max(1, (ranges - 1).bit_length()))
        for batch in batches:
            keys, sizes, post = [], [], [([], [], []) for _ in ORDERS]
            for at in range(0, batch.num_rows, 256):
                for text in batch.column(1).slice(at, 256).to_pylist():
                    tokens = shingles(text, words, n)
                    key = _key(tokens)
                    keys.append(key)
                    sizes.append(len(tokens))
                    if not len(tokens):
                        continue
                    p = prefix_size(len(tokens), percent)
                    for m, (ts, ks, cs) in zip(ORDERS, post, strict=True):
                        order = tokens * np.uint64(m)
                        ts.append(np.partition(order, p - 1)[:p] if p < len(order) else order)
                        ks.append(np.full(p, key, np.uint64))
                        cs.append(np.full(p, len(tokens), np.uint32))
            none = [None] * len(keys)
            columns = [[*none], [*none], batch.column(0).to_pylist(), batch.column(2).to_pylist(), keys, sizes, [*none], [*none], [*none]]
            for k, (ts, ks, cs) in enumerate(post):
                if not ts:
                    continue
                t, owner, size = np.concatenate(ts), np.concatenate(ks), np.concatenate(cs)
                # a prefix keeps the smallest numbers of its order: ranges are dealt by the other bits
                where = (t * np.uint64(0xFF51AFD7ED558CCD)) >> shift
                by = np.argsort(where, kind="stable")
                t, owner, size, where = t[by], owner[by], size[by], where[by]
                cuts = np.flatnonzero(np.diff(where)) + 1
                for part_t, part_o, part_s, r in zip(np.split(t, cuts), np.split(owner, cuts), np.split(size, cuts), where[np.append(0, cuts)].tolist(), strict=True):
                    for column, value in zip(columns, (k, r, None, None, None, None, part_t.tobytes(), part_o.tobytes(), part_s.tobytes()), strict=True):
                        column.append(value)
            types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["ord", "range", "id", "text_hash", "key", "size", "tokens", "owners", "sizes"])

    return run


def _runs(tokens: np.ndarray, owners: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct (token, owner) sorted, the owners' sizes, and each token's list: start and length."""
    by = np.lexsort((owners, tokens))
    tokens, owners, sizes = tokens[by], owners[by], sizes[by]
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (owners[1:] != owners[:-1])
    tokens, owners, sizes = tokens[new], owners[new], sizes[new]
    first = np.ones(len(tokens), bool)
    first[1:] = tokens[1:] != tokens[:-1]
    start = np.flatnonzero(first)
    return tokens, owners, sizes, start, np.diff(np.append(start, len(tokens)))


def _met(percent: int):
    """Pairs of sets that share tokens of short lists, with how many; postings of frequent tokens.

    Pairs whose sizes alone rule out the similarity are never made.
    """
    names = ["ord", "a", "b", "shared", "token", "a_size", "b_size"]

    def close(order: int, tokens: list, owners: list, sizes: list) -> pa.RecordBatch:
        t, o, n, start, size = _runs(np.concatenate(tokens), np.concatenate(owners), np.concatenate(sizes))
        n = n.astype(np.int64)
        a, b = [], []
        for d in range(2, LIST_SETS + 1):
            at = start[size == d]
            if len(at):
                spots = at[:, None] + np.arange(d)
                i, j = np.triu_indices(d, 1)
                i, j = spots[:, i].ravel(), spots[:, j].ravel()
                near = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
                a.append(i[near])
                b.append(j[near])
        i = np.concatenate(a) if a else np.zeros(0, np.int64)
        j = np.concatenate(b) if b else np.zeros(0, np.int64)
        by = np.lexsort((o[j], o[i]))
        i, j = i[by], j[by]
        new = np.ones(len(i), bool)
        new[1:] = (o[i[1:]] != o[i[:-1]]) | (o[j[1:]] != o[j[:-1]])
        at = np.flatnonzero(new)
        shared = np.diff(np.append(at, len(i)))
        i, j = i[at], j[at]
        hot = np.flatnonzero(np.repeat(size > LIST_SETS, size))
        pairs, single = np.zeros(len(i), bool), np.ones(len(hot), bool)
        none, no_token = np.append(pairs, single), np.append(~pairs, ~single)
        zeros = np.zeros(len(hot), np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(none), order, np.int32)),
                pa.array(np.concatenate([o[i], o[hot]]).astype(np.int64)),
                pa.array(np.append(o[j].astype(np.int64), zeros), mask=none),
                pa.array(np.append(shared, zeros + 1)),
                pa.array(np.append(np.zeros(len(i), np.int64), t[hot].view(np.int64)), mask=no_token),
                pa.array(np.append(n[i], n[hot])),
                pa.array(np.append(n[j], zeros), mask=none),
            ],
            names=names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, ([], [], [])
        for batch in batches:
            keys = zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True)
            for key, t, o, n in zip(keys, *(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                if key != now:
                    if held[0]:
                        yield close(now[0], *held)
                    now, held = key, ([], [], [])
                for column, raw, kind in zip(held, (t, o, n), (np.uint64, np.uint64, np.uint32), strict=True):
                    column.append(np.frombuffer(raw, kind))
        if held[0]:
            yield close(now[0], *held)

    return run


def _with_tokens(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                tokens = pa.array([shingles(t, words, n).tobytes() for t in part.column(3).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(3)), tokens], names=["family", "blocks", "key", "tokens"])

    return run


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of intersection sizes of sorted distinct arrays."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    row = np.repeat(np.arange(m), sizes)
    tokens = np.concatenate(sets) if m else np.zeros(0, np.uint64)
    by = np.argsort(tokens, kind="stable")
    tokens, row = tokens[by], row[by]
    start = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1])) if len(tokens) else np.zeros(0, int)
    size = np.diff(np.append(start, len(tokens)))
    shared = np.zeros((m, m), np.float32)
    wide = max(32, m // 16)
    flat: list[np.ndarray] = []
    for d in np.unique(size[(size > 1) & (size < wide)]):
        at = start[size == d]
        i, j = np.triu_indices(d, 1)
        step = max(1, 2_000_000 // len(i))
        for lo in range(0, len(at), step):  # each token's holders, pair by pair, within a fixed memory
            lists = row[at[lo : lo + step, None] + np.arange(d)]
            flat.append((lists[:, i] * m + lists[:, j]).ravel())
            if sum(map(len, flat)) > 4_000_000:
                shared += np.bincount(np.concatenate(flat), minlength=m * m).reshape(m, m).astype(np.float32)
                flat = []
    if flat:
        shared += np.bincount(np.concatenate(flat), minlength=m * m).reshape(m, m).astype(np.float32)
    at, held = start[size >= wide], size[size >= wide]
    for lo in range(0, len(at), 512):
        some = held[lo : lo + 512]
        one = np.zeros((m, len(some)), np.float32)
        for k, (s, d) in enumerate(zip(at[lo : lo + 512], some, strict=True)):
            one[row[s : s + d], k] = 1
        shared += np.triu(one @ one.T, 1)
    return shared + shared.T


def _linked(percent: int):
    """Links within each block pair of a family, thinned to one tree for each linked part."""

    def trees(keys: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
        size = np.array([len(s) for s in sets], np.float64)
        both = overlaps(sets).astype(np.float64)
        near = 100 * both >= percent * (size[:, None] + size[None, :] - both)
        np.fill_diagonal(near, False)
        left: np.ndarray = np.ones(len(keys), bool)
        out: list[tuple[int, int]] = []
        for root in range(len(keys)):
            if not left[root]:
                continue
            left[root] = False
            todo = [root]
            while todo:
                k = todo.pop()
                more = np.flatnonzero(near[k] & left)
                left[more] = False
                todo += more.tolist()
                out += [(keys[k], keys[x]) for x in more.tolist()]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, sets, out = None, [], [], []
        for batch in batches:
            for group, key, tokens in zip(zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if group != now:
                    out += trees(keys, sets) if len(keys) > 1 else []
                    now, keys, sets = group, [], []
                if not keys or key != keys[-1]:  # a repeated row speaks once for its set
                    keys.append(key)
                    sets.append(np.frombuffer(tokens, np.uint64))
        out += trees(keys, sets) if len(keys) > 1 else []
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], names=["a", "b"])

    return run


def _grouped(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """One row per input row: id, text_hash, size, group (NULL for empty sets) and component_id; see ``ngram_groups``."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))
    n_docs = docs.count()
    ranges = 32
    expected = n_docs * prefix_size(600, percent) * len(ORDERS)  # for texts of about 600 words; only the ranges' size depends on it
    while ranges * RANGE_POSTINGS < expected:
        ranges *= 2
    schema = "ord int, range long, id long, text_hash long, key long, size long, tokens binary, owners binary, sizes binary"
    made = stage(src.mapInArrow(_sets(words, percent, ranges), schema), "shingles")
    members = stage(made.where(F.col("ord").isNull()).select("id", "text_hash", "key", "size"), "members")
    dealt = made.where(F.col("ord").isNotNull()).select("ord", "range", "tokens", "owners", "sizes")
    place = (F.col("ord") * ranges + F.col("range")).cast("int")  # a task for each range of each order
    dealt = dealt.repartitionById(len(ORDERS) * ranges, place).sortWithinPartitions("ord", "range")
    met = stage(dealt.mapInArrow(_met(percent), "ord int, a long, b long, shared long, token long, a_size long, b_size long"), "met")
    discard(made)

    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("first")
    sizes = members.where(F.col("size") > 0).groupBy("key").agg(F.max("size").alias("size"), first)
    sizes = stage(sizes.select("key", "size", F.col("first.id").alias("least"), F.col("first.text_hash").alias("of")), "sets")
    frequent = met.where(F.col("token").isNotNull())
    held_by = [F.count_if(F.col("ord") == k).alias(f"f{k}") for k in range(len(ORDERS))]
    counts = stage(frequent.groupBy("a").agg(F.max("a_size").alias("size"), *held_by), "frequent")

    # pairs: shared tokens under each order, and what frequent tokens could add
    shared = [F.sum(F.when(F.col("ord") == k, F.col("shared")).otherwise(0)).alias(f"c{k}") for k in range(len(ORDERS))]
    pairs = met.where(F.col("token").isNull()).groupBy("a", "b").agg(F.max("a_size").alias("a_size"), F.max("b_size").alias("b_size"), *shared)
    for s in ("a", "b"):
        side = counts.select(F.col("a").alias(f"{s}_key"), *(F.col(f"f{k}").alias(f"{s}_f{k}") for k in range(len(ORDERS))))
        pairs = pairs.join(side, F.col(s) == F.col(f"{s}_key"), "left").drop(f"{s}_key")
    small, large = F.least("a_size", "b_size"), F.greatest("a_size", "b_size")
    enough = F.lit(True)
    for k in range(len(ORDERS)):
        might = F.least(F.coalesce(f"a_f{k}", F.lit(0)), F.coalesce(f"b_f{k}", F.lit(0)))
        enough = enough & (F.col(f"c{k}") + might >= F.least(_spare(small), F.ceil(large * percent / 100)))
    edges = pairs.where(enough).select("a", "b")

    # sets that frequent tokens alone could join: one star per frequent token
    partner = F.ceil(F.col("size") * percent / 100)  # the smallest set that could still be similar
    full = F.lit(True)
    for k in range(len(ORDERS)):
        full = full & (F.col(f"f{k}") >= F.least(_spare(partner), partner))
    hot = frequent.where(F.col("ord") == 0).join(counts.where(full).select("a"), "a", "left_semi").select("token", "a")
    heads = stage(hot.groupBy("token").agg(F.min("a").alias("head")), "heads")  # a table of its own: the join may split a hot token
    stars = hot.join(heads, "token").where(F.col("a") != F.col("head")).select("a", F.col("head").alias("b")).distinct()
    families = stage(connected_components(edges.union(stars), "a", "b"), "families")
    discard(met, counts, heads)

    # each set of a family once, with its tokens; large families in pairs of blocks of like sizes
    held = families.join(sizes, F.col("node") == F.col("key")).select(F.col("component").alias("family"), "key", "least", "of", "size")
    held = staged = stage(held.withColumn("class", F.floor(F.log(F.col("size")) / math.log(100 / percent)).cast("int")), "held")
    room = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("size") / BLOCK_TOKENS)).cast("int")
    whole = held.groupBy("family").agg(room.alias("blocks"))
    parts = held.groupBy("family", "class").agg(room.alias("parts")).join(whole.where(F.col("blocks") > 1), "family", "left_semi")
    held = held.join(whole, "family").withColumn("class", F.when(F.col("blocks") > 1, F.col("class")).otherwise(0))
    near = parts.select(F.col("family").alias("f"), F.col("class").alias("c"), "parts")
    met_in = held.where(F.col("blocks") > 1).withColumn("c", F.explode(F.array(F.col("class") - 1, F.col("class"), F.col("class") + 1)))
    met_in = met_in.join(near, (F.col("family") == F.col("f")) & (met_in["c"] == near["c"])).select("family", "key", "least", "of", "class", near["c"].alias("c"), "parts")
    own = met_in.where(F.col("c") == F.col("class")).select(F.col("key").alias("k"), F.pmod(F.xxhash64("key"), F.col("parts")).cast("int").alias("part"))
    met_in = met_in.join(own, F.col("key") == F.col("k")).withColumn("q", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    mine, other = F.struct(F.col("class"), F.col("part")), F.struct(F.col("c").alias("class"), F.col("q").alias("part"))
    met_in = met_in.select("family", "key", "least", "of", F.concat_ws("/", F.least(mine, other)["class"], F.least(mine, other)["part"], F.greatest(mine, other)["class"], F.greatest(mine, other)["part"]).alias("block"))
    met_in = met_in.groupBy("family", "key", "least", "of").agg(F.collect_set("block").alias("blocks"))  # one entry per block of like sizes
    plain = held.where(F.col("blocks") == 1).select("family", "key", "least", "of", F.array(F.lit("0")).alias("blocks"))
    named = stage(plain.unionByName(met_in), "named")
    reach = named.agg(F.sum(F.size("blocks") + 4)).first()[0] or 0
    sent = F.broadcast(named) if reach <= SENT_PLACES else named
    texts = src.join(sent, F.col("id").eqNullSafe(F.col("least")) & (F.col("text_hash") == F.col("of"))).select("family", "blocks", "key", "text")
    tokens = texts.mapInArrow(_with_tokens(words), "family long, blocks array<string>, key long, tokens binary")
    tokens = tokens.select("family", F.explode("blocks").alias("block"), "key", "tokens")
    grouped = tokens.repartition("family", "block").sortWithinPartitions("family", "block", "key")
    links = stage(grouped.mapInArrow(_linked(percent), "a long, b long"), "links")
    discard(families, staged, named)

    comp = connected_components(links, "a", "b")
    group = sizes.join(comp, F.col("key") == F.col("node"), "left").withColumn("group", F.coalesce("component", "key"))
    least = group.groupBy("group").agg(F.min("least").alias("component_id"))
    named = stage(group.join(least, "group").select(F.col("key").alias("k"), "group", "component_id"), "components")
    discard(links, sizes)
    return members.join(named, (F.col("key") == F.col("k")) & (F.col("size") > 0), "left").select("id", "text_hash", "size", "group", "component_id")


def ngram_groups(docs: DataFrame, words: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_shingles, component_id.

    Documents link when the Jaccard similarity of their shingle sets is at
    least ``percent`` hundredths, and components are what links reach.

    1. Each text becomes its set of shingle hashes; equal sets share one key.
    2. Under each of several global token orders a set's prefix is cut so long
       that two similar sets must share ``spare`` of its tokens.  Postings meet
       by token range; lists of at most LIST_SETS sets are paired and counted.
    3. A pair stays a candidate only if, under every order, the tokens it shares
       and the frequent ones that it might share reach that number.
    4. Sets so full of frequent tokens that they could reach it by these alone,
       under every order, are tied to one set of each frequent token's list.
    5. What candidates connect is a family: its sets are brought together once,
       in blocks of bounded size, and every pair in it is compared exactly.

    A text of fewer words is one shingle; NULL, empty and blank texts have none,
    link with nothing and are their own component.  Ids are whole numbers;
    repeated rows are copies.  A row with a NULL id belongs to the component of
    the texts that it is tied to, and is NULL's own where none of these has an id.
    """
    out = _grouped(docs, words, percent, id_col, text_col)
    return out.select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"), F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group, all columns as they are: that of the smallest id.

    Rows without words are in no group and stay.  NULL ids come after all
    others; of the texts of one id that with the smallest hash stays, and of
    rows that agree in id and text any one.
    """
    rows = stage(_grouped(docs, words, percent, id_col, text_col).where(F.col("group").isNotNull()).select("group", "id", "text_hash"), "near-rows")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("first")
    kept = rows.groupBy("group").agg(first).select(F.col("group").alias("g"), F.col("first.id").alias("k_id"), F.col("first.text_hash").alias("k_hash"))
    is_kept = F.col("id").eqNullSafe(F.col("k_id")) & (F.col("text_hash") == F.col("k_hash"))
    judged = stage(rows.join(kept, F.col("group") == F.col("g")).groupBy("id", "text_hash").agg(F.max(is_kept).alias("kept"), F.count(F.lit(1)).alias("n")), "near-judged")
    discard(rows)
    gone = judged.where(~F.col("kept")).select(F.col("id").alias("__gone"), F.col("text_hash").alias("__gone_hash"))
    ident = F.col(id_col).cast("long")
    keyed = docs.withColumn("__hash", F.xxhash64(text_col))
    left = keyed.join(gone, (F.col("__hash") == F.col("__gone_hash")) & ident.eqNullSafe(F.col("__gone")), "left_anti")
    again = judged.where(F.col("kept") & (F.col("n") > 1)).select(F.col("id").alias("__again"), F.col("text_hash").alias("__again_hash"))
    if again.isEmpty():
        return left.drop("__hash")
    same = (F.col("__hash") == F.col("__again_hash")) & ident.eqNullSafe(F.col("__again"))
    once = left.join(again, same, "left_anti").drop("__hash")
    repeated = left.join(again, same, "left_semi").groupBy(ident.alias("__id"), "__hash").agg(F.first(F.struct(*docs.columns)).alias("__row"))
    return once.unionByName(repeated.select("__row.*"))
