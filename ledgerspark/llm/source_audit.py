"""How sources of one language differ in their terms: in-mapper stripes and exact divergences."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.operators.lineage import stage

MIN_DOCS, TOP_TERMS = 30, 50
#: Counts are raised by SMOOTH; shares are in parts of SHARES.
SMOOTH, SHARES = 5, 1_000_000_000
#: A task's stripes are spilled beyond so many (term, source) cells.
STRIPE_CELLS = 200_000
#: Cells of the matrices that a task works on.
MATRIX_CELLS = 1 << 21
#: No term is empty: this stripe counts a language's documents by source.
ALL_DOCS = ""
_STRIPE = pa.schema([("lang", pa.string()), ("term", pa.string()), ("df", pa.int64()), ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
_STRIPES = "lang string, term string, df long, sources array<string>, counts array<long>"


def _fold() -> bytes:
    """Byte table: A-Z lower-cased, ASCII that is no letter as a space."""
    t = bytearray(range(256))
    for b in range(128):
        if 65 <= b < 91:
            t[b] += 32
        elif not 97 <= b < 123:
            t[b] = 32
    return bytes(t)


_TABLE = _fold()


def terms(text: str | None) -> list[bytes]:
    """Runs of letters and non-ASCII characters, A-Z lower-cased; none of NULL."""
    return (text or "").encode().translate(_TABLE).split()


def _rows(stripes: dict[str, dict[bytes, list | tuple]], chunk: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Stripes as rows; the map is emptied."""
    for lang in list(stripes):
        own = stripes.pop(lang)
        keys, values = list(own), list(own.values())
        for lo in range(0, len(keys), chunk):
            df, sizes, sources, counts = [], [0], [], []
            for stripe in values[lo : lo + chunk]:
                if len(stripe) == 3:  # one document
                    df.append(1)
                    sources.append(stripe[1])
                    counts.append(stripe[2])
                else:
                    df.append(stripe[0])
                    sources.extend(stripe[1])
                    counts.extend(stripe[1].values())
                sizes.append(len(sources))
            ends = pa.array(sizes, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(sources, pa.string())), pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64()))]
            term = pa.array(keys[lo : lo + chunk], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(df), pa.string()), term, pa.array(df, pa.int64()), *lists], schema=_STRIPE)


def _folded(limit: int):
    """Whole documents folded into stripes: term -> [documents, {source: occurrences}], by language.

    A term of one document so far is (1, source, occurrences): most are, and stay so.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stripes: dict[str, dict[bytes, list | tuple]] = {}
        cells = 0
        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                own = stripes.setdefault(lang, {})
                counts = Counter(terms(text.as_py()))
                counts[ALL_DOCS.encode()] = 1
                for term, n in counts.items():
                    stripe = own.get(term)
                    if stripe is None:
                        own[term] = (1, source, n)
                        cells += 1
                        continue
                    if len(stripe) == 3:
                        stripe = own[term] = [1, {stripe[1]: stripe[2]}]
                    stripe[0] += 1
                    by_source = stripe[1]
                    if source in by_source:
                        by_source[source] += n
                    else:
                        by_source[source] = n
                        cells += 1
                if cells > limit:
                    yield from _rows(stripes)
                    cells = 0
        yield from _rows(stripes)

    return run


def _merge_runs(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Stripes of one key, which stand in a row, as one: documents added, occurrences added by source."""
    lang, term = batch.column(0), batch.column(1)
    new = pc.or_(pc.not_equal(lang[1:], lang[:-1]), pc.not_equal(term[1:], term[:-1])).to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(np.concatenate([[True], new]))
    run = np.cumsum(np.concatenate([[0], new])).astype(np.int64)
    sources = batch.column(3).flatten().dictionary_encode()
    cell = np.repeat(run, batch.column(3).value_lengths().to_numpy(zero_copy_only=False)) * len(sources.dictionary) + sources.indices.to_numpy()
    cells, which = np.unique(cell, return_inverse=True)
    counts = np.zeros(len(cells), np.int64)
    np.add.at(counts, which, batch.column(4).flatten().to_numpy())
    ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(cells // len(sources.dictionary), minlength=len(starts)))]), pa.int32())
    lists = [pa.ListArray.from_arrays(ends, sources.dictionary.take(pa.array(cells % len(sources.dictionary)))), pa.ListArray.from_arrays(ends, pa.array(counts))]
    return pa.RecordBatch.from_arrays([lang.take(pa.array(starts)), term.take(pa.array(starts)), pa.array(np.add.reduceat(batch.column(2).to_numpy(), starts)), *lists], schema=_STRIPE)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stripes of one key, which come one after the other, as one; the last one of a batch may go on in the next."""
    last = None
    for batch in batches:
        batch = pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(batch.columns, _STRIPE, strict=True)], schema=_STRIPE)
        if last is not None:
            batch = pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
        if batch.num_rows:
            merged = _merge_runs(batch)
            yield merged.slice(0, merged.num_rows - 1)
            last = merged.slice(merged.num_rows - 1)
    if last is not None:
        yield last


def shares(counts: np.ndarray, totals: np.ndarray, kept: int) -> np.ndarray:
    """1 + floor(SHARES * (count + SMOOTH) / (total + SMOOTH * kept)), by long division in steps of 1000 that fit a long."""
    below = totals + SMOOTH * kept
    out, rest = np.zeros_like(counts), counts + SMOOTH
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // below
        rest = rest % below
    return out + 1


_APART = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def _pairs(lang: str, names: pa.Array, first: int, sums: np.ndarray) -> pa.RecordBatch:
    """Sums of sources ``first``.. with each later source as rows."""
    a, b = np.nonzero(np.arange(len(names))[None, :] > np.arange(first, first + len(sums))[:, None])
    n = len(a)
    return pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), names.take(pa.array(a + first)), pa.array(["pair"] * n, pa.string()), names.take(pa.array(b)), pa.array(sums[a, b])], schema=_APART)


def _apart(cells: int):
    """Divergences that merged stripes give: the terms above the language's share, and sums over terms for each pair of sources.

    Sums are kept by language over a partition as long as they fit ``cells``; those of a
    language with more sources leave with each batch, some sources at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[pa.Array, np.ndarray]] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for lang in sorted(set(langs)):
                at = np.flatnonzero([x == lang for x in langs])
                own = batch.take(pa.array(at))
                names = pa.array(own.column("names")[0].as_py(), pa.string())
                totals, kept = np.array(own.column("totals")[0].as_py(), np.int64), own.column("kept")[0].as_py()
                place = {s: k for k, s in enumerate(names.to_pylist())}
                fits = len(names) ** 2 <= cells
                if fits and lang not in sums:
                    if sum(m.size for _, m in sums.values()) + len(names) ** 2 > cells:
                        yield from (_pairs(x, n, 0, m) for x, (n, m) in sums.items())
                        sums = {}
                    sums[lang] = names, np.zeros((len(names), len(names)), np.int64)
                own = own.filter(pa.array([t != ALL_DOCS for t in own.column("term").to_pylist()], pa.bool_()))
                slab = max(1, cells // len(names))
                for lo in range(0, max(1, own.num_rows), slab):
                    part = own.slice(lo, slab)
                    words = part.column("term")
                    rows = np.repeat(np.arange(part.num_rows), part.column("sources").value_lengths().to_numpy(zero_copy_only=False))
                    cols = np.array([place[s] for s in part.column("sources").flatten().to_pylist()], np.int64)
                    counts = np.zeros((part.num_rows, len(names)), np.int64)
                    counts[rows, cols] = np.asarray(part.column("counts").flatten(), np.int64)
                    p = shares(counts, totals[None, :], kept)
                    above = p - shares(counts.sum(axis=1), totals.sum(), kept)[:, None]
                    t, s = np.nonzero((counts > 0) & (above > 0))
                    n = len(t)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), names.take(pa.array(s)), pa.array(["term"] * n, pa.string()), words.take(pa.array(t)), pa.array(above[t, s])], schema=_APART)
                    for first in range(0, len(names), slab):
                        found = np.zeros((min(slab, len(names) - first), len(names)), np.int64)
                        for k in range(len(found)):
                            found[k, first + k + 1 :] = np.abs(p[:, first + k, None] - p[:, first + k + 1 :]).sum(axis=0)
                        if fits:
                            sums[lang][1][first : first + len(found)] += found
                        else:
                            yield _pairs(lang, names, first, found)
        yield from (_pairs(x, n, 0, m) for x, (n, m) in sums.items())

    return run


def source_divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, stripe_cells: int = STRIPE_CELLS, matrix_cells: int = MATRIX_CELLS) -> DataFrame:
    """Rows of lang, source, part, item, value, rank, as exact integers.

    NULL text, language and source count as empty.  A language keeps the terms
    that at least ``min_docs`` of its documents hold; each group of language and
    source, also one without terms, and each language gives every kept term a
    smoothed share (``shares``).  Part ``pair`` sums the differences of two
    sources' shares over the kept terms (0 without any), for every other source
    of the language; part ``term`` lists the ``top_terms`` terms that occur in the
    group and stand above the language's share.  Ranks start at 1 for each group and
    part, larger values first, then items in UTF-8 order.  Repeated rows count
    as often as they occur; other columns are ignored; an empty table gives no
    rows.

    A task folds its documents into stripes and spills them beyond
    ``stripe_cells``; stripes of a key follow each other after one sort, those of
    rare terms go, and the others are merged one at a time, however many tasks
    wrote them.  Every stripe meets the
    totals of its language's sources: a list as long as the square root of
    that language's result.
    """
    src = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    folded = src.mapInArrow(_folded(stripe_cells), _STRIPES)
    # the window's exchange and sort bring the stripes of a key together, for the merging as well
    known = F.sum("df").over(Window.partitionBy("lang", "term"))
    often = folded.withColumn("known", known).where((F.col("known") >= min_docs) | (F.col("term") == ALL_DOCS)).drop("known")
    stripes = stage(often.mapInArrow(_merged, _STRIPES), "stripes")
    cells = stripes.select("lang", "term", F.explode(F.arrays_zip("sources", "counts")).alias("c"))
    term = F.col("term") != ALL_DOCS
    totals = cells.groupBy("lang", F.col("c.sources").alias("source")).agg(F.coalesce(F.sum(F.when(term, F.col("c.counts"))), F.lit(0)).alias("n"))
    totals = totals.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("g"))
    kept = stripes.groupBy("lang").agg(F.count_if(term).alias("kept"))
    totals = stage(totals.join(kept, "lang").select("lang", "kept", F.col("g.source").alias("names"), F.col("g.n").alias("totals")), "source-totals")
    schema = "lang string, source string, part string, item string, value long"
    apart = stage(stripes.join(totals, "lang").mapInArrow(_apart(matrix_cells), schema), "divergences")
    pairs = apart.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.unionByName(pairs.select("lang", F.col("item").alias("source"), "part", F.col("source").alias("item"), "value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [df.withColumn("rank", F.row_number().over(order)) for df in (pairs, apart.where("part = 'term'"))]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= top_terms))


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
o AS (SELECT r, lang, source, term, count(*) AS n FROM (SELECT r, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
k AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(*) >= {MIN_DOCS}), v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d), c AS (SELECT lang, source, term, sum(n)::BIGINT AS n FROM o JOIN k USING (lang, term) GROUP BY ALL),
t AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0)::BIGINT AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT k.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + ({SHARES} * (coalesce(c.n, 0) + {SMOOTH})) // (t.n + {SMOOTH} * v.v) AS p
  FROM k JOIN g USING (lang) JOIN t USING (lang, source) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
l AS (SELECT lang, term, 1 + ({SHARES} * (sum(p.n)::BIGINT + {SMOOTH})) // (any_value(x.n) + {SMOOTH} * any_value(v.v)) AS q
  FROM p JOIN (SELECT lang, sum(n)::BIGINT AS n FROM t GROUP BY lang) x USING (lang) JOIN v USING (lang) GROUP BY lang, term),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
u AS (SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(s.value, 0) AS value FROM g JOIN g h ON g.lang = h.lang AND g.source <> h.source LEFT JOIN s ON s.lang = g.lang AND s.source = g.source AND s.item = h.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p JOIN l USING (lang, term) WHERE n > 0 AND p > q),
z AS (SELECT lang, source, part, item, value::BIGINT AS value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM u)
SELECT * FROM z WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
