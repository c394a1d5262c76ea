"""Sharding, mixing, exact groups, url verdicts and toxicity on small tables."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerspark.llm import exact_dedup as X
from ledgerspark.llm import mixing as M
from ledgerspark.llm import sharding as S
from ledgerspark.llm import toxicity as T
from ledgerspark.llm import url_filter as U


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, slot string, k int, `count` int")


def some_docs(n=600, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = "hot copy" if i % 3 == 0 else " ".join(rng.choice("ab cd ef gh".split()) for _ in range(rng.randint(0, 60)))
        rows.append((i, text, f"s{rng.randint(0, 3)}" if i % 3 else "hot", "x", 1, 2))
    return rows + [(None, None, None, "x", 1, 2), (None, "", "s1", "x", 1, 2), (5, "word " * 20_000, "s1", "x", 1, 2), (7, "dup", "s2", "x", 1, 2), (7, "dup", "s2", "x", 1, 2)]


def test_shards_have_equal_bytes_and_gapless_slots(spark):
    rows = some_docs(2000)
    rows = [r for r in rows if r[0] != 5 or r[1] != "word " * 20_000]
    out = S.shard_documents(docs_of(spark, rows), shards=8).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r["shard"], []).append((r["slot"], len((r["text"] or "").encode()) + 1))
    total = sum(b for v in by.values() for _, b in v)
    assert set(by) == set(range(8))
    for v in by.values():
        assert sorted(s for s, _ in v) == list(range(len(v)))
        assert abs(sum(b for _, b in v) - total / 8) <= 0.001 * total / 8 + 320
    small = [r["shard"] for r in out if r["text"] == "dup"]
    assert len(set(small)) == 1  # two rows alike weigh less than the tolerance: they stay together


def test_shards_of_odd_tables(spark):
    assert S.shard_documents(docs_of(spark, [])).collect() == []
    one = S.shard_documents(docs_of(spark, [(1, None, None, "x", 1, 2)])).collect()
    assert [(r["slot"], 0 <= r["shard"] < 16) for r in one] == [(0, True)]
    same = S.shard_documents(docs_of(spark, [(1, "t", "s", "x", 1, 2)] * 40), shards=4).collect()
    assert sorted((r["shard"], r["slot"]) for r in same) == [(s, k) for s in range(4) for k in range(10)]  # repeated rows are parted too
    empty = S.shard_documents(docs_of(spark, [(None, None, "s", "x", 1, 2)] * 100 + [(1, "one longer text", "s", "x", 1, 2)] * 30), shards=4).collect()
    by = {}
    for r in empty:
        by.setdefault(r["shard"], []).append((r["slot"], len((r["text"] or "").encode()) + 1))
    assert all(sorted(s for s, _ in v) == list(range(len(v))) for v in by.values()) and len(empty) == 130
    assert all(abs(sum(b for _, b in v) - (100 + 30 * 16) / 4) <= 16 for v in by.values())
    long = S.shard_documents(docs_of(spark, some_docs(50)), shards=4).collect()
    assert len(long) == 55


def test_splitters_against_a_sorted_list(spark):
    """Splitters of the histogram lie where a sort of all keys would put them, within the tolerance and one row."""
    rng = random.Random(11)
    keys = [(rng.choice([5, -(1 << 63), (1 << 63) - 1, rng.randint(-(1 << 63), (1 << 63) - 1)]), rng.randint(-(1 << 63), (1 << 63) - 1), rng.randint(1, 900)) for _ in range(3000)]
    total = sum(k[2] for k in keys)
    df = spark.createDataFrame(keys, "__a long, __b long, __size long")
    for shards, tolerance in ((2, 0.0), (7, 0.001), (16, 0.01)):
        found, _, heavy = S.find_splitters(df, total, shards, tolerance)
        assert found == sorted(found) and len(found) == shards - 1 and not heavy
        for j, key in enumerate(found, 1):
            below = sum(k[2] for k in keys if k[:2] < key)
            assert abs(below - total * j / shards) <= max(tolerance * total / shards, 450)


def test_pfair_period_stays_within_one_block():
    weights = {"a": 50, "b": 7, "c": 13, **{f"s{i}": 1 for i in range(30)}}
    total = sum(weights.values())
    period = M.pfair_period(weights)
    assert [s for *_, s in period] == list(range(total))
    done = dict.fromkeys(weights, 0)
    for t, (pool, k, release, deadline, slot) in enumerate(period):
        assert release <= slot < deadline and k == done[pool]
        done[pool] += 1
        assert all(abs(done[p] - (t + 1) * w / total) < 1 for p, w in weights.items())
    assert done == weights


def test_mixing_against_plain_loop(spark):
    rows = some_docs()
    weights = {"hot": 2, "s0": 3, "s1": 4}
    got = M.mix_sources(docs_of(spark, rows), weights, rest=1, block_bytes=500).collect()
    assert len(got) == len(rows)
    shares = weights | {M.REST: 1}
    slot_of = {(p, k): s for p, k, _, _, s in M.pfair_period(shares)}
    pools = {}
    for i, t, src, *_ in rows:
        pools.setdefault(src if src in weights else M.REST, []).append((hashlib.md5(("null" if i is None else str(i)).encode()).hexdigest(), -1 if i is None else i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())))
    want, end = [], []
    for p, v in pools.items():
        at = 0
        for key, i, size, _ in sorted(v):
            b = at // 500
            want.append((i, p, b, b // shares[p] * 10 + slot_of[p, b % shares[p]], at % 500))
            at += size
        n = -(-at // 500)
        end.append(n // shares[p] * 10 + slot_of[p, n % shares[p]])
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["pool"], r["block"], r["slot"], r["block_offset"]) for r in got) == sorted(want)
    assert {r["balanced"] for r in got if r["slot"] < min(end)} == {True}
    assert all(r["balanced"] == (r["slot"] < min(end)) for r in got)
    assert M.mix_sources(docs_of(spark, []), weights).collect() == []
    for odd in ({"hot": 0}, {"hot": 1.5}):
        with pytest.raises(ValueError, match="whole numbers"):
            M.mix_sources(docs_of(spark, rows), odd)


def test_mixing_deals_a_crowded_id_into_parts(spark):
    """A third of the rows without an id, many of one id and text: every byte of a pool's stream is still given to one row."""
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, "same" if i % 2 else f"t {i} " * (i % 5), "s0" if i % 4 else "s1", "x", 1, 2) for i in range(3000)]
    docs = docs_of(spark, rows).repartition(5)
    got = M.mix_sources(docs, {"s0": 2, "s1": 1}, block_bytes=500, bucket_rows=100).collect()
    assert sorted(map(repr, ((r["doc_id"], r["text"], r["source"]) for r in got))) == sorted(map(repr, (r[:3] for r in rows)))
    for pool in ("s0", "s1"):
        stream = sorted((r["block"] * 500 + r["block_offset"], len(r["text"]) + 1) for r in got if r["pool"] == pool)
        at = 0
        for before, size in stream:
            assert before == at
            at += size
    keyed = M._keyed(docs, F.col("source"), "doc_id", "text").withColumn("__bucket", F.substring("__key", 1, 2))
    sums = keyed.groupBy("pool", "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    crowded = {(r["__p"], r["__hot"]): r["__parts"] for r in M._crowded_ids(keyed, sums, 100).collect()}
    md5 = {k: hashlib.md5(k.encode()).hexdigest() for k in ("null", "7")}
    assert crowded == {("s0", md5["null"]): 15, ("s0", md5["7"]): 15} | {("s1", md5[k]): 5 for k in md5 if ("s1", md5[k]) in crowded}
    # without crowded ids the order is that of the plain loop, however small buckets are
    plain = docs_of(spark, some_docs())
    few, many = (M.mix_sources(plain, {"hot": 2}, block_bytes=500, bucket_rows=n) for n in (200, 10**6))
    assert sorted(map(repr, few.collect())) == sorted(map(repr, many.collect()))


def test_mixed_order_keeps_all_rows(spark):
    rows = some_docs(100)
    mixed = M.mix_sources(docs_of(spark, rows), {"hot": 1}, block_bytes=100)
    assert M.in_mixed_order(mixed, ["doc_id", "text"]).count() == len(rows)


def test_trie_finds_what_sets_find():
    rng = random.Random(3)
    trie, seen = X.PatriciaTrie(), {}
    for i in range(3000):
        key = bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9)))
        trie.insert(key, i % 1000)
        seen.setdefault(key, []).append(i % 1000)
    got = {k: (node.least, node.same, node.n) for k, node in trie.terminals()}
    assert got == {k: (min(v), v.count(min(v)), len(v)) for k, v in seen.items()}


def test_trie_keeps_shared_prefixes_once():
    trie, prefix = X.PatriciaTrie(), b"the same long beginning " * 100
    grown = sum(trie.insert(prefix + tail, k) for k, tail in enumerate([b"one", b"other", b"two", b"one", b""]))
    assert grown == trie.weight() - X.NODE_BYTES < 2 * len(prefix)  # the root is not counted
    (stem,) = trie.children.values()
    assert stem.edge == prefix and stem.n == 1 and len(stem.children) == 2  # o(ne|ther) and two
    assert sorted(c.edge for c in stem.children.values()) == [b"o", b"two"]
    above, cut = trie.cut_heaviest()
    assert above == prefix and {above + cut.edge + k: v.n for k, v in cut.terminals()} == {prefix + b"one": 2, prefix + b"other": 1}


@pytest.mark.parametrize("digest", [False, True])
def test_trie_spills_subtrees_and_loses_nothing(digest):
    rng = random.Random(4)
    keys = [b"x" * rng.randint(0, 30) + bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 5))) for _ in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(range(2000)), pa.array([1] * 2000), pa.array([1] * 2000)], names=["text", "id", "same", "n"])
    for budget, whole in ((3000, False), (1 << 30, True)):
        rows = [tuple(r.values()) for b in X._tries(budget, digest)(iter([batch])) for r in b.to_pylist()]
        sums: dict = {}
        for *key, least, _, n in rows:
            old = sums.setdefault(tuple(key), [least, 0])
            old[0], old[1] = min(old[0], least), old[1] + n
        want: dict = {}
        for i, k in enumerate(keys):
            want.setdefault((len(k), hashlib.sha256(k).hexdigest()) if digest else (k,), [i, 0])[1] += 1
        assert sums == want and (len(rows) == len(want)) == whole


def exact_brute(rows):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t, *_ in rows]
    groups = {}
    for i, t in norm:
        groups.setdefault(t, []).append(i)
    out = []
    for i, t in norm:
        ids = [x for x in groups[t] if x is not None]
        keep = min(ids) if ids else None
        out.append((i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("n", [3, 600])
def test_exact_groups_against_brute_force(spark, n):
    rows = some_docs(n) + [(900, "a\t\n b", "s", "x", 1, 2), (901, "a b", "s", "x", 1, 2), (902, " a b", "s", "x", 1, 2), (903, "a b", "s", "x", 1, 2)]
    for trie_bytes in (X.TRIE_BYTES, 4000):
        got = sorted(map(tuple, X.exact_groups(docs_of(spark, rows).repartition(5), trie_bytes=trie_bytes).collect()), key=str)
        assert got == exact_brute(rows)


def test_exact_groups_of_an_empty_table(spark):
    assert X.exact_groups(docs_of(spark, [])).collect() == []


def test_drop_exact_duplicates(spark):
    rows = [(3, "a  b", "s", "x", 1, 2), (1, "a b", "s", "x", 1, 2), (2, "c", "s", "x", 1, 2)]
    out = X.drop_exact_duplicates(docs_of(spark, rows))
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 2] and out.columns == docs_of(spark, rows).columns


def test_drop_exact_duplicates_with_repeated_and_null_ids(spark):
    """One row of each text stays: repeated rows, an id with two texts, NULL ids beside others and alone."""
    rows = [(1, "t"), (1, "t"), (2, "t"), (2, "u"), (None, "t"), (None, "v"), (None, "v"), (None, None), (3, ""), (None, "u")]
    out = X.drop_exact_duplicates(docs_of(spark, [(i, t, "s", "x", 1, 2) for i, t in rows]).repartition(3))
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str) == sorted([(1, "t"), (2, "u"), (None, "v"), (3, "")], key=str)
    assert X.drop_exact_duplicates(docs_of(spark, [])).collect() == []


RULES = [("net", "/", "allow"), ("x.net", "/b/", "block")]


def test_url_parts_and_rules(spark):
    urls = ["http://A.X.net/b/1?q=/z#f", "x.net/b", None, "ftp://X.NET", "http://y.net?u=http://x.net/b/", "http://xx.net/b/2", "http://x.net/b#/b/", "http://é.NET/É", "://h/p://q"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in U.judge_urls(df, RULES).collect()}
    assert got[0] == ("a.x.net", "/b/1", "x.net/b/", "block")
    assert got[1][:3] == ("", "", None) and got[2][:3] == ("", "", None)
    assert got[3][:3] == ("x.net", "", None)
    assert got[4][:3] == ("y.net", "", None)
    assert got[5] == ("xx.net", "/b/2", "net/", "allow")
    assert got[6] == ("x.net", "/b", "net/", "allow")
    assert got[7] == ("é.net", "/É", "net/", "allow")
    assert got[8] == ("h", "/p://q", None, got[8][3])
    assert len(got) == len(urls)


def test_url_templates_learn_from_ruled_rows(spark):
    rows = [(i, f"http://h.com/spam/{i}") for i in range(40)] + [(100 + i, f"http://h.com/news/{i}") for i in range(40)]
    rules = [("h.com", f"/spam/{d}", "block") for d in "123"] + [("h.com", f"/news/{d}", "allow") for d in "123"]
    got = {r["page_id"]: r for r in U.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert got[5]["template"] == "/spam/*" and got[5]["rule"] is None and got[5]["verdict"] == "block"
    assert got[105]["verdict"] == "allow"
    empty = U.judge_urls(spark.createDataFrame([], "page_id long, url string"), rules)
    assert empty.collect() == []


def test_url_templates_do_not_change_by_repeated_rows(spark):
    rules = [("h.com", f"/spam/{d}", "block") for d in "123"] + [("h.com", f"/news/{d}", "allow") for d in "123"]
    paths = [f"/{kind}/{i}" for kind in ("spam", "news") for i in range(40)]
    for copies in (1, 4):
        rows = [(k, f"http://h.com{p}?page={k}") for p in paths for k in range(copies)]
        got = {(r["path"], r["template"], r["verdict"]) for r in U.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
        assert {(t, v) for p, t, v in got if p.startswith("/spam/")} == {("/spam/*", "block")}
        assert {(t, v) for p, t, v in got if p.startswith("/news/")} == {("/news/*", "allow")}


def test_url_templates_take_all_segments(spark):
    rules = [("h.com", f"/a/b/c/d/spam/{d}", "block") for d in "123"] + [("h.com", f"/a/b/c/d/news/{d}", "allow") for d in "123"]
    urls = [f"http://h.com/a/b/c/d/{kind}/{i}" for kind in ("spam", "news") for i in range(40)] + ["http://h.com/a/alone/" + "x/" * 300]
    got = {r["path"]: (r["template"], r["verdict"]) for r in U.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).collect()}
    assert len(got) == len(urls)
    assert got["/a/b/c/d/spam/5"] == ("/a/~/~/~/spam/*", "block") and got["/a/b/c/d/news/5"] == ("/a/~/~/~/news/*", "allow")
    assert got["/a/alone/" + "x/" * 300][0] == "/a/~/~/~/~/" + "x/" * 297  # unlabelled: merged until it is alone, then as it is


def test_url_templates_learn_over_hosts(spark):
    """Hosts with a path or two share what is known of the same branch elsewhere."""
    rules = [(f"h{k}.com", "/spam/", "block") for k in range(6)] + [(f"h{k}.com", "/news/", "allow") for k in range(6)]
    urls = [f"http://h{k}.com/{kind}/{10 * k + i}" for k in range(6) for kind in ("spam", "news") for i in range(2)]
    urls += [f"http://small{k}.net/{kind}/{200 + k}" for k in range(8) for kind in ("spam", "news")] + ["http://other.net/odd/1"]
    got = {r["path"]: (r["template"], r["verdict"], r["rule"]) for r in U.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).collect()}
    assert {got[f"/spam/{200 + k}"] for k in range(8)} == {("/spam/*", "block", None)}
    assert {got[f"/news/{200 + k}"] for k in range(8)} == {("/news/*", "allow", None)}


def tree_brute(rows):
    """Templates of (host, path, bad, good) by recursion over the branches, all hosts of one at once."""
    out = {}

    def close(b, n, pb, pn):
        if not n or not pn:
            return True
        p = pb / pn
        return abs(b / n - p) <= 1.96 * math.sqrt(p * (1 - p) * (1 / n + 1 / pn))

    def grow(template, members, depth):
        kids = {}
        for host, path, segs, bad, good in members:
            if len(segs) <= depth:
                out[host, path] = template
            else:
                kids.setdefault(host, {}).setdefault(segs[depth], []).append((host, path, segs, bad, good))
        everywhere = {}
        for by in kids.values():
            for seg, ms in by.items():
                everywhere.setdefault(seg, []).extend(ms)
        total = [m for ms in everywhere.values() for m in ms]
        if len(total) == 1:
            host, path, segs, _, _ = total[0]
            out[host, path] = template + "/" + "/".join(segs[depth:])
            return
        count = lambda ms: (sum(m[3] for m in ms), sum(m[3] + m[4] for m in ms))
        after = {}
        for by in kids.values():
            mine = [m for ms in by.values() for m in ms]
            fresh = (len(by) - 1 + 4 * ((len(everywhere) - 1) / len(total))) / (len(mine) - 1 + 4)
            for seg, ms in by.items():
                like = close(*count(ms), *count(mine)) and close(*count(everywhere[seg]), *count(total))
                step = "*" if fresh >= 0.3 else "~" if like and len(by) > 1 else seg
                after.setdefault(f"{template}/{step}", []).extend(ms)
        for t, ms in after.items():
            grow(t, ms, depth + 1)

    grow("", [(h, p, p[1:].split("/"), b, g) for h, p, b, g in rows], 0)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_url_trees_equal_recursion(spark, seed):
    """Random trees over several hosts: shared runs of segments, ends within them, empty segments, labels of both kinds."""
    rng = random.Random(seed)
    run = "/".join(f"r{k}" for k in range(9))
    heads = ["", "a", "a/b", f"a/{run}", f"{run}/x", f"{run}-1", "deep/" + "/".join("ab" for _ in range(7))]
    rows = {}
    for _ in range(120):
        host, head = rng.choice(["h1", "h2", "h3", ""]), rng.choice(heads if seed > 1 else heads[3:6])
        tail = "/".join(rng.choice(["p", "q", "", str(rng.randrange(40))]) for _ in range(rng.randrange(4)))
        cut = head.split("/")[: rng.randint(1, 12)]
        path = rng.choice(["/" + "/".join([*cut, tail]), "/" + "/".join(cut), ""])
        rows[host, path] = (rng.randrange(3), rng.randrange(3)) if head.startswith("a") else (0, 0)
    rows = [(h, p, b, g) for (h, p), (b, g) in rows.items()]
    got = U.template_tree(spark.createDataFrame(rows, "host string, path string, bad long, good long")).collect()
    assert {(r["host"], r["path"]): r["template"] for r in got} == tree_brute(rows) and len(got) == len(rows)


def test_long_shared_paths_take_few_rounds(spark, monkeypatch):
    rounds, stage = [], U.stage
    monkeypatch.setattr(U, "stage", lambda df, label: rounds.append(label) or stage(df, label))
    deep = "http://h.com/" + "trap/" * 300
    got = {r["page_id"]: r["template"] for r in U.judge_urls(spark.createDataFrame([(1, deep + "x"), (2, deep + "y"), (3, deep + "y/z")], "page_id long, url string"), RULES).collect()}
    assert len(got) == 3 and all(t.startswith("/trap" * 300) for t in got.values())
    assert rounds.count("templates") <= 4


def test_urls_of_odd_tables(spark):
    """Clashing column names, NULL ids, repeated rows and a very long url."""
    long = "http://h.com/" + "a" * 200_000
    df = spark.createDataFrame([(None, "http://h.com/x", "t", 1), (1, "http://h.com/x", "t", 1), (1, "http://h.com/x", "t", 1), (2, long, "t", 1), (3, None, "t", 1)], "page_id long, url string, template string, host int")
    got = U.judge_urls(df, RULES).collect()
    assert sorted((str(r["page_id"]), r["host"], len(r["path"])) for r in got) == [("1", "h.com", 2), ("1", "h.com", 2), ("2", "h.com", 200_001), ("3", "", 0), ("None", "h.com", 2)]


def toxic_tables(spark):
    rng = random.Random(5)
    words = [a + b for a in ("ba", "do", "ke", "li", "mu", "ta") for b in ("ra", "so", "ne", "vi")]
    rows, labels = [], []
    for i in range(1200):
        text = [rng.choice(words) for _ in range(rng.randint(20, 80))]
        bad = i % 6 == 0
        if bad:
            for _ in range(3):
                text[rng.randrange(len(text))] = rng.choice(["zorgle", "quibbat"])
        rows.append((i, " ".join(text), "s", "x", 1, 2))
        labels.append((i, int(bad)))
    rows += [(None, None, None, "x", 1, 2), (5000, "", "s", "x", 1, 2), (5001, "zorgle " * 9000, "s", "x", 1, 2)]
    return docs_of(spark, rows), spark.createDataFrame(labels + [(None, 1), (3, None), (99999, 1)], "doc_id long, toxic int"), dict(labels)


def test_toxicity_on_held_out_rows(spark):
    docs, labels, truth = toxic_tables(spark)
    model = T.fit(docs, labels)
    got = {r["doc_id"]: r for r in T.score(docs, model).collect()}
    assert len(got) == 1203 and all(0 <= r["score"] <= 1 for r in got.values())
    for i, r in got.items():
        assert r["held_out"] == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2)
        assert r["predicted"] == int(r["score"] >= 0.3)
    held = [i for i, r in got.items() if r["held_out"] and i in truth]
    assert sum(got[i]["predicted"] == truth[i] for i in held) / len(held) > 0.98
    assert got[5000]["predicted"] == 0 and got[5001]["predicted"] == 1
    clean = T.drop_toxic(docs, labels)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == {i for i, r in got.items() if not r["predicted"]}


def test_toxicity_without_rows(spark):
    docs, labels, _ = toxic_tables(spark)
    model = T.fit(docs.limit(0), labels.limit(0))
    assert T.score(docs.limit(0), model).collect() == []
    assert {r["predicted"] for r in T.score(docs.limit(5), model).collect()} == {0}


def plain_buckets(text, bits):
    """Buckets of a text's n-grams, one number at a time."""
    raw = [b + 32 if 65 <= b < 91 else b if 97 <= b < 123 or b > 127 else 48 if 48 <= b < 58 else 32 for b in b" " + (text or "").encode() + b" "]
    out = set()
    for n in (3, 4, 5):
        for at in range(len(raw) - n + 1):
            h = raw[at]
            for b in raw[at + 1 : at + n]:
                h = (h * 0x01000193 + b * 0x9E3779B1) % 2**32
            out.add(((h ^ (h >> 15)) * 0x85EBCA6B) % 2**32 >> (32 - bits))
    return out


def test_buckets_match_a_plain_loop():
    texts = ["Hello, World!", None, "", "aaaa", "é" * 10, "x" * 30, "A1 b2\t\x00"] * 3
    got = list(T.text_buckets(pa.array(texts), 16))
    assert all(len(b) == len(set(b.tolist())) for b in got)
    assert [set(b.tolist()) for b in got] == [plain_buckets(t, 16) for t in texts]


def test_toxicity_against_a_plain_fit(spark):
    """The same ratios, logistic loss and minimum found by plain gradient steps over dense rows."""
    docs, labels, truth = toxic_tables(spark)
    bits = 12
    model = T.fit(docs, labels, bits=bits)
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] in truth}
    train = [i for i in sorted(texts) if zlib.crc32(str(i).encode()) % 4 != 2 and i != 3]
    train += [3]  # its second label is NULL and teaches nothing
    x = np.zeros((len(train), 1 << bits))
    for k, i in enumerate(train):
        x[k, list(plain_buckets(texts[i], bits))] = 1
    y = np.array([truth[i] for i in train], float)
    toxic, clean = y.sum(), len(y) - y.sum()
    pt, pc = 500 * toxic / len(y), 500 * clean / len(y)
    ratio = np.array([math.log((t + pt) / (toxic + pt)) - math.log((c + pc) / (clean + pc)) if t + c else 0.0 for t, c in zip(x[y == 1].sum(0), x[y == 0].sum(0), strict=True)])
    # every n-gram that was seen is a feature, but for those that are equally common in both classes
    told = {k for k, (t, c) in enumerate(zip(x[y == 1].sum(0), x[y == 0].sum(0), strict=True)) if t * clean != c * toxic}
    assert set(np.flatnonzero(model.weights)) == told and len(told) > 0.9 * (x.sum(0) > 0).sum()
    x, heavy = x * ratio, np.where(y == 1, 3.0, 1.0)
    w, b = np.zeros(1 << bits), math.log(toxic / clean)
    rate = 1 / (0.3 + 3 * 0.25 * np.linalg.norm(np.column_stack([x, np.ones(len(y))]), 2) ** 2)
    for _ in range(20_000):
        off = heavy * (1 / (1 + np.exp(-(x @ w + b))) - y)
        w, b = w - rate * (x.T @ off + 0.3 * w), b - rate * off.sum()
    want = {i: 1 / (1 + math.exp(-(sum((w * ratio)[k] for k in plain_buckets(t, bits)) + b))) for i, t in texts.items()}
    got = {r["doc_id"]: r["score"] for r in T.score(docs, model).collect() if r["doc_id"] in truth}
    assert max(abs(got[i] - want[i]) for i in want) < 0.02


def test_lists_are_read_in_bounded_pieces(monkeypatch):
    """Slopes and counts of a partition do not hang on how its lists are cut; a list larger than a piece is one."""
    rng = np.random.default_rng(1)
    lists = [rng.choice(64, n, replace=False).astype("<i4") for n in (5, 0, 40, 3, 3, 60, 1)]
    batch = pa.record_batch([pa.array([1, 0, 0, 1, 0, 1, 0]), pa.array([x.tobytes() for x in lists], pa.binary())], names=["toxic", "buckets"])

    class Shared:
        value = rng.normal(size=64), 0.5

    def both():
        slope = next(T._gradient(Shared, 2.0)(iter([batch, batch.slice(0, 0), batch]))).to_pylist()[0]
        return slope["loss"], slope["off"], np.frombuffer(slope["slope"], "<f4"), next(T._counted(6)(iter([batch]))).to_pydict()

    whole = both()
    for size in (1, 7, 50):
        monkeypatch.setattr(T, "_PIECE", size)
        assert max(len(c) for _, _, c in T._entries(iter([batch]))) <= max(size, 60)
        got = both()
        assert np.allclose(whole[0], got[0]) and np.allclose(whole[1], got[1]) and np.allclose(whole[2], got[2], atol=1e-5) and whole[3] == got[3]


def test_toxicity_of_odd_labels(spark):
    """Repeated labels count once, ids with both teach nothing, one class alone gives its share; repeated documents are one."""
    docs, labels, truth = toxic_tables(spark)
    once = T.fit(docs, labels, bits=12)
    both = spark.createDataFrame([(5001, 0), (5001, 1)], "doc_id long, toxic int")
    again = T.fit(docs.unionByName(docs), labels.unionByName(labels).unionByName(both), bits=12)
    assert np.allclose(once.weights, again.weights, atol=1e-3) and abs(once.intercept - again.intercept) < 1e-3
    for toxic, share in ((1, 0.99), (0, 0.0)):
        some = spark.createDataFrame([(i, toxic) for i in range(1, 200)], "doc_id long, toxic int")
        got = {r["score"] for r in T.score(docs.limit(20), T.fit(docs, some)).collect()}
        assert len(got) == 1 and abs(got.pop() - share) < 0.01


def test_toxicity_does_not_hang_on_the_table_bits(spark):
    docs, labels, truth = toxic_tables(spark)
    few, many = ({r["doc_id"]: r["predicted"] for r in T.score(docs, T.fit(docs, labels, bits=b)).collect()} for b in (16, 20))
    assert few == many


def test_held_out_is_the_stated_rule(spark):
    df = spark.range(100).withColumn("h", T.held_out(F.col("id")))
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in df.collect())
