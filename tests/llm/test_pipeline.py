"""The pipeline's stages against plain loops over the same rows."""

import random
import re

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline as P
from ledgerspark.llm import toxicity
from ledgerspark.llm.packing import ByteBpe

SF = "/root/testdata/sf0.001"


def test_pipeline_equals_plain_loops(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit(docs, labels)
    scored = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, model).collect()}
    rows = sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
    clean = [(i, t) for i, t in rows if not scored[i]]
    seen, unique = set(), []
    for i, t in clean:
        body = re.sub(r"[\x20\x09-\x0D]+", " ", t)
        if body not in seen:
            seen.add(body)
            unique.append((i, t))
    sets = []
    for _, t in unique:
        w = t.encode().lower().split()
        k = min(5, len(w))
        sets.append({tuple(w[a : a + k]) for a in range(len(w) - k + 1)} if w else set())
    up = list(range(len(unique)))
    for a in range(len(unique)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = a, b
                while up[x] != x:
                    x = up[x]
                while up[y] != y:
                    y = up[y]
                up[max(x, y)] = min(x, y)
    kept = [r for k, r in enumerate(unique) if up[k] == k]
    assert len(kept) < len(unique) < len(clean) < len(rows)

    got = P.run(spark, SF).collect()
    bpe = ByteBpe(public_tokenizers.path("byte_bpe_50k.json"))
    streams: dict = {}
    for r in got:
        streams.setdefault(r["doc_id"], []).append((r["start"], np.frombuffer(r["ids"], "<u4")))
    assert sorted(streams) == [i for i, _ in kept]
    for i, t in kept:
        whole = np.concatenate([ids for _, ids in sorted(streams[i], key=lambda x: x[0])])
        assert whole.tolist() == bpe.library.encode(t, add_special_tokens=False).ids + [0]


def test_windows_follow_the_mix(spark, tmp_path, monkeypatch):
    """Prefixes of sequence_id are prefixes of the mix: each source has its weight but for a block and a document."""
    rng = random.Random(2)
    sources = [f"src{k}" for k in range(3)] + ["src0"] * 3  # two thirds of one source
    rows = [(i, " ".join(rng.choice(["one", "two", "three", "four"]) for _ in range(rng.choice([20, 90, 300, 2500]))), rng.choice(sources)) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights, block = {"src0": 2, "src1": 3, "src2": 3}, 1 << 12
    monkeypatch.setattr(P, "TARGETS", weights)
    monkeypatch.setattr(P, "BLOCK_BYTES", block)
    monkeypatch.setattr(P, "GROUP_IDS", 1 << 12)
    mixed = P.mixing.mix_sources(docs, weights, block_bytes=block).collect()
    place = {r["doc_id"]: (r["slot"], r["block_offset"]) for r in mixed}
    source, size = {i: s for i, _, s in rows}, {i: len(t) + 1 for i, t, _ in rows}
    last = min(r["slot"] for r in mixed if not r["balanced"])

    def packed(step, to):
        step(spark, docs, SF).write.parquet(f"{tmp_path}/{to}")
        return P.documents_are_packed(spark, spark.read.parquet(f"{tmp_path}/{to}"), SF).collect()

    got = packed(P.sources_are_mixed, "mixed")
    owner, held = {}, {}
    for r in got:
        owner.setdefault(r["sequence_id"], set()).add((r["offset"], r["length"]))
        held.setdefault(r["sequence_id"], set()).add(r["doc_id"])
    for parts in owner.values():  # no window is made of two
        spans = sorted(parts)
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and sum(n for _, n in spans) <= 1024

    def ordered(got):
        """Whether windows follow the mix, but for the documents that are packed with them."""
        first = {}
        for r in got:
            first[r["sequence_id"]] = min(first.get(r["sequence_id"], (1 << 60, 0)), place[r["doc_id"]])
        firsts = [first[w] for w in sorted(first)]
        ahead = 8  # windows of a stretch
        return all(firsts[k] < firsts[k + 2 * ahead] for k in range(len(firsts) - 2 * ahead))

    assert ordered(got)
    # while all sources last, the windows up to one keep each source to its weight but for a stretch
    seen, total, checked, done = dict.fromkeys(weights, 0), 0, 0, set()
    for w in sorted(held):
        for i in held[w] - done:
            done.add(i)
            seen[source[i]] += size[i]
        if max(place[i][0] for i in held[w]) >= last:
            break
        total, checked = sum(seen.values()), checked + 1
        assert all(abs(seen[s] - total * k / 8) <= block + 2 * max(size.values()) + 4 * (1 << 12) for s, k in weights.items())
    assert checked > 20 and seen["src0"] < 0.35 * total
    # without the mixing stage neither holds: the order is what that stage hands on
    assert not ordered(packed(lambda spark, docs, sf: docs.repartition(3), "unmixed"))


def test_a_run_leaves_no_copies(spark, tmp_path):
    """Only what the result reads is left of the stages' copies, and nothing once its owner ends."""
    import pathlib

    from ledgerspark.operators.lineage import scratch, shared_dir

    folder = pathlib.Path(shared_dir(spark).removeprefix("file://")) / "staged"
    before = set(folder.iterdir()) if folder.exists() else set()
    with scratch():
        out = P.run(spark, SF)
        assert [p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - before] == ["mix_sources"]
        out.write.parquet(str(tmp_path / "out"))
    assert set(folder.iterdir()) == before and spark.read.parquet(str(tmp_path / "out")).count() > 0


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("extra", F.lit(1))
    for _, step in P.STAGES[:-1]:
        assert step(spark, docs, SF).columns == docs.columns


def test_stages_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, step in P.STAGES:
        docs = step(spark, docs, SF)
    assert docs.collect() == []


def test_stages_of_odd_documents(spark, monkeypatch):
    """NULL and empty texts, repeated and NULL ids, a very long text, a clashing column: each text once, nothing else lost."""
    long = " ".join(f"word{i}" for i in range(60_000))
    rows = [(1, "one text of a few words", "src0"), (1, "one text of a few words", "src0"), (1, "another text of the same id", "src1"), (None, "a text without id", None)]
    rows += [(None, "a text without id", "src1"), (2, None, "src2"), (3, "", "src2"), (4, long, "src3"), (5, long + " end", "src3"), (6, "one  text of\ta few words", "odd")]
    docs = spark.createDataFrame([(*r, 7, "x") for r in rows], "doc_id long, text string, source string, slot int, `group` string")
    monkeypatch.setattr(P.toxicity, "drop_toxic", lambda d, labels: d)  # the given labels are of other documents
    left = docs
    for name, step in P.STAGES[:-1]:
        left = step(spark, left, SF)
        assert left.columns == docs.columns, name
    want = [(1, "one text of a few words"), (1, "another text of the same id"), (None, "a text without id"), (2, None), (4, long)]
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == sorted(want, key=str)
    packed = P.documents_are_packed(spark, left, SF).collect()
    assert sorted({str(r["doc_id"]) for r in packed}) == ["1", "2", "4", "None"]
    bpe = ByteBpe(public_tokenizers.path("byte_bpe_50k.json"))
    assert sum(r["length"] for r in packed) == sum(len(bpe.ids(t or "")) + 1 for _, t in want)
