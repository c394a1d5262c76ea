"""Benchmark passages, vector codes and source audits against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerspark.llm import decontamination as D
from ledgerspark.llm import source_audit as S
from ledgerspark.llm import vector_codes as C


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# --- benchmark passages


def leaks_brute(docs, bench, window=10):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    out = []
    items = [(i, cut(t)) for i, t in bench]
    for ident, text in docs:
        w, hit, found = cut(text), set(), set()
        for item, v in items:
            n = min(window, len(v))
            for a in range(len(v) - n + 1) if n else ():
                for b in range(len(w) - n + 1):
                    if w[b : b + n] == v[a : a + n]:
                        hit |= set(range(b, b + n))
                        found |= {str(item)} if item is not None else set()
        out.append((ident, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


def leak_case(seed):
    rng = random.Random(seed)
    vocab = ["a", "B", "c7", "é", "Éa", "ß", "and", "the", "x"]
    some = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    bench = [(k, some(rng.choice([0, 1, 2, 5, 10, 11, 14, 40]))) for k in range(12)]
    bench += [(100, bench[3][1]), (3, bench[5][1]), (None, some(12)), (7, None), (8, " \t!? "), (5, bench[5][1])]
    docs = []
    for k in range(40):
        text = some(rng.randint(0, 60))
        for _ in range(rng.randint(0, 2)):
            part = (rng.choice(bench)[1] or "").upper().replace(" ", rng.choice([" ", "--", "\n.", "\x00"]))
            text += rng.choice(["", " ", "zz"]) + part + rng.choice([" ", "q"]) + some(3)
        docs.append((k, text))
    return docs + [(None, "a B c7"), (5, docs[5][1]), (900, None), (901, ""), (902, "a")], bench


@pytest.mark.parametrize("seed,window,block_words", [(1, 10, 1 << 20), (2, 3, 1 << 20), (3, 10, 40), (4, 2, 25)])
def test_leaks_equal_brute_force(spark, seed, window, block_words):
    docs, bench = leak_case(seed)
    df = spark.createDataFrame([(i, t, "w", 1, 2) for i, t in docs], "doc_id long, text string, words string, n_hit int, row int")
    items = spark.createDataFrame([(i, t, [1]) for i, t in bench], "item_id long, text string, items array<int>")
    got = D.find_leaks(df, items, window=window, block_words=block_words).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got), key=repr) == leaks_brute(docs, bench, window)
    for r in got:
        assert r["n_hit"] == sum(s["end"] - s["begin"] for s in r["spans"])
        assert all(x["end"] < y["begin"] for x, y in zip(r["spans"], r["spans"][1:], strict=False))


def test_leaks_of_a_very_long_text_and_a_cut_item(spark, monkeypatch):
    monkeypatch.setattr(D, "STRETCH_WORDS", 50)
    rng = random.Random(5)
    item = [f"i{rng.randrange(10**6)}" for _ in range(400)]
    text = [f"w{k % 997}" for k in range(200_000)]
    text[150_000:150_012] = item[44:56]  # across the end of a stretch
    run = list(D._stretched(10)(iter([pa.record_batch([["1"], [" ".join(item)]], names=["item", "text"])])))[0]
    windows = {" ".join(t.split()[k : k + 10]) for t in run.column(1).to_pylist() for k in range(len(t.split()) - 9)}
    assert windows == {" ".join(item[k : k + 10]) for k in range(391)}
    found = D.Searcher([(t, ["1"]) for t in run.column(1).to_pylist()]).search([w.encode() for w in text])
    assert found == ([(150_000, 150_012)], ["1"])


def test_leaks_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert D.find_leaks(none, items).collect() == []
    assert [tuple(r) for r in D.find_leaks(docs, items).collect()] == [(1, 2, 0, [], [])]
    assert D.find_leaks(none, spark.createDataFrame([(1, "a")], items.schema)).collect() == []


def test_shifts_never_miss_a_window():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 10):
        windows = rng.integers(1, 4, (300, n)).astype(np.int32)
        table = D.WindowTable(windows, np.arange(300))
        ids = rng.integers(0, 4, 3000).astype(np.int32)
        want = [b for b in range(3000 - n + 1) if (windows == ids[b : b + n]).all(axis=1).any()]
        got = list(table.occurrences(ids))
        assert [b for b, _ in got] == want
        for b, w in got:
            assert set(table.owners[table.owned[w] : table.owned[w + 1]]) == set(np.flatnonzero((windows == ids[b : b + n]).all(axis=1)))


# --- vector codes


def codes_brute(rows, entries, parts, rounds, length):
    kept = [(i, lab, v) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole = [(i, lab, [max(-C.LIMIT, min(C.LIMIT, math.floor(256 * x))) for x in v]) for i, lab, v in kept if len(v) == length]
    first = sorted(((i is None, i or 0, [y / 256 for y in v], v) for i, _, v in whole))[:entries]
    cuts = C.part_bounds(length, parts)
    books = [[f[3][lo:hi] for f in first] for lo, hi in cuts]

    def best(book, q):
        return min((sum((a - b) ** 2 for a, b in zip(q, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for k, (lo, hi) in enumerate(cuts):
            held = [[] for _ in books[k]]
            for _, _, v in whole:
                held[best(books[k], v[lo:hi])[1]].append(v[lo:hi])
            books[k] = [[sum(c) // len(h) for c in zip(*h, strict=True)] if h else e for h, e in zip(held, books[k], strict=True)]
    out, by_label = [], {}
    for i, lab, v in kept:
        if len(v) != length:
            out.append((i, lab, None, None))
            continue
        at = [best(books[k], [max(-C.LIMIT, min(C.LIMIT, math.floor(256 * x))) for x in v[lo:hi]]) for k, (lo, hi) in enumerate(cuts)]
        out.append((i, lab, "".join(f"{e:02x}" for _, e in at), sum(d for d, _ in at)))
        by_label[lab] = by_label.get(lab, 0) + out[-1][3]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((*r, by_label.get(r[1])) for r in out), key=repr), sha


def vector_case(seed, n, length, spread):
    rng = random.Random(seed)
    rows = [(rng.choice([k, k, None]) if seed % 2 else k, [rng.choice([rng.gauss(0, spread), 0.0, 0.25]) for _ in range(length)], rng.choice([1, 2, None])) for k in range(n)]
    rows += rows[:5] + [(n + 1, None, 1), (n + 2, [None] * length, 1), (n + 3, [float("nan")] + [0.0] * (length - 1), 2), (n + 4, [float("inf")] * length, 2)]
    return rows + [(n + 5, [0.5] * (length + 1), 2), (n + 6, [], 1), (-1, [1e30, -1e30] * (length // 2), 3)]


@pytest.mark.parametrize("seed,n,length,spread", [(2, 300, 32, 0.2), (4, 150, 64, 3.0), (6, 20, 20, 0.01), (8, 90, 8, 0.2)])
def test_codes_equal_brute_force(spark, seed, n, length, spread):
    rows = vector_case(seed, n, length, spread)
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "vec_id long, embedding array<double>, label int, code string, of double").repartition(3)
    got, books = C.vector_codes(df)
    want, sha = codes_brute(rows, 64, 16, 2, length)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    assert C.codebooks_sha256(books) == sha


def test_codes_with_null_ids_and_empty_tables(spark):
    rows = [(None, [1.0] * 16, 1), (None, [0.0] * 16, 1), (3, [0.0] * 16, None)]
    got, books = C.vector_codes(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    want, sha = codes_brute(rows, 64, 16, 2, 16)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want and C.codebooks_sha256(books) == sha
    none, books = C.vector_codes(spark.createDataFrame([(1, None, 1)], "vec_id long, embedding array<float>, label int"))
    assert none.collect() == [] and none.columns == got.columns and C.codebooks_sha256(books) == hashlib.sha256(b"").hexdigest()


def test_label_error_beyond_a_long_is_null(spark):
    far = [[1e30] * 4096, [-1e30] * 4096, *[[-1e30] * 4095 + [1e30]] * 7]
    df = spark.createDataFrame([(k, v, 1) for k, v in enumerate(far)], "vec_id long, embedding array<double>, label int")
    got, _ = C.vector_codes(df, entries=1, rounds=0)
    assert {r["label_error"] for r in got.collect()} == {None}
    assert max(r["error"] for r in got.collect()) == 4096 * (2 * C.LIMIT) ** 2


@pytest.mark.parametrize("width,n,spread", [(1, 64, 3), (4, 64, 40), (4, 5, 1000), (8, 64, 2), (0, 3, 1), (2, 1, 10**7)])
def test_slices_find_the_nearest_entry(width, n, spread):
    rng = np.random.default_rng(width + n)
    entries, q = rng.integers(-spread, spread + 1, (n, width)), rng.integers(-2 * spread, 2 * spread + 1, (500, width))
    d = ((q[:, None] - entries[None]) ** 2).sum(axis=2)
    index, error = C.Codebook(entries).nearest(q)
    assert (index == d.argmin(axis=1)).all() and (error == d.min(axis=1)).all()


# --- source audit


def audit_brute(rows, min_docs, top):
    rows = [(lang or "", source or "", Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text)))) for lang, source, text in rows]
    out = []
    for lang in {r[0] for r in rows}:
        df, by = Counter(), {}
        for _, source, c in (r for r in rows if r[0] == lang):
            df.update(set(c))
            by.setdefault(source, Counter()).update(c)
        kept = [t for t, n in df.items() if n >= min_docs]
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[k] for k in kept) + 5 * len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in by.items()}, share(sum(by.values(), Counter()))
        for s in by:
            parts = {
                "pair": [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in by if o != s],
                "term": [(p[s][t] - q[t], t) for t in kept if by[s][t] and p[s][t] > q[t]],
            }
            for part, found in parts.items():
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, k + 1) for k, (v, item) in enumerate(found[: top if part == "term" else None])]
    return sorted(out)


def audit_case(seed):
    rng = random.Random(seed)
    vocab = ["a", "B", "b", "é", "É", "ß", "and", "the", "x-y", "z9z", "日本", "\U0001f600"]
    rows = []
    for k in range(120):
        w = [rng.choice(vocab[: 4 + k % 9]) for _ in range(rng.randint(0, 30))]
        rows.append((rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s1", "s2", "s3", None]), rng.choice([" ", "\x00", "7"]).join(w)))
    return rows + [("en", "only", None), ("en", "empty", ""), ("xx", "s1", "rare"), ("xx", "s2", None), ("yy", "s1", None), rows[0], rows[0]]


@pytest.mark.parametrize("seed,min_docs,top,stripe_cells,matrix_cells", [(1, 5, 3, 300_000, 1 << 21), (2, 2, 50, 7, 1 << 21), (3, 3, 50, 20, 4), (4, 1, 2, 300_000, 40), (5, 500, 50, 10, 1 << 21)])
def test_divergence_equals_brute_force(spark, seed, min_docs, top, stripe_cells, matrix_cells):
    rows = audit_case(seed)
    df = spark.createDataFrame([(*r, 1, "t") for r in rows], "lang string, source string, text string, df int, term string").repartition(5)
    got = S.source_divergence(df, min_docs=min_docs, top_terms=top, stripe_cells=stripe_cells, matrix_cells=matrix_cells)
    assert sorted(tuple(r) for r in got.select("lang", "source", "part", "item", "value", "rank").collect()) == audit_brute(rows, min_docs, top)


def test_divergence_of_no_documents_and_a_very_long_one(spark):
    none = spark.createDataFrame([], "lang string, source string, text string")
    assert S.source_divergence(none).collect() == []
    rows = [("en", "s1", " ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}" for k in range(300_000))), ("en", "s2", "waa wab")]
    got = S.source_divergence(spark.createDataFrame(rows, none.schema), min_docs=1)
    assert sorted(tuple(r) for r in got.select("lang", "source", "part", "item", "value", "rank").collect()) == audit_brute(rows, 1, 50)


def test_stripes_are_merged_across_batches():
    rng = random.Random(7)
    rows = [(lang, term, rng.randint(1, 3), [rng.choice("xyz")] if k % 2 else ["x", "z"], [k + 1] if k % 2 else [1, k]) for lang in ("de", "en") for term in ("", "a", "b") for k in range(rng.randint(1, 9))]
    want = {}
    for lang, term, df, sources, counts in rows:
        total, by = want.setdefault((lang, term), [0, Counter()])
        want[lang, term][0] = total + df
        by.update(dict(zip(sources, counts, strict=True)))
    whole = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), S._STRIPE, strict=True)], schema=S._STRIPE)
    for size in (1, 2, 5, 1000):
        got = [r for b in S._merged(iter([whole.slice(k, size) for k in range(0, len(rows), size)])) for r in b.to_pylist()]
        assert [(r["lang"], r["term"]) for r in got] == list(want)
        assert all(want[r["lang"], r["term"]] == [r["df"], dict(zip(r["sources"], r["counts"], strict=True))] for r in got)


def test_shares_of_large_counts_are_exact():
    counts = [0, 1, 10**12, 9 * 10**14, 3]
    totals = sum(counts)
    got = S.shares(np.array(counts), np.int64(totals), 7)
    assert got.tolist() == [1 + 10**9 * (c + 5) // (totals + 35) for c in counts]
