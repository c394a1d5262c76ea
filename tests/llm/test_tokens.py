"""Token counts and packing against the libraries themselves."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerspark.llm.packing import ByteBpe, TightestWindow, best_fit_plan, pack_documents, pack_in_order, places
from ledgerspark.llm.token_counts import PieceCounter, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
JSON = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", " ", "  ", "\n", "\n\n a", " a", "a ", "a  b", "a \n b", "▁x ▁", "<s>x</s> <unk>", "café l'été\tz\r\n", "x" * 5000, "the the the", "<|endoftext|>", "a <|endoftext|> b", "\x00\x01", " 　 q", "hello\nworld foo\nbar"]


@pytest.fixture(scope="module")
def counter():
    return PieceCounter(MODEL)


@pytest.fixture(scope="module")
def bpe():
    return ByteBpe(JSON)


def test_shortcut_is_proved(counter):
    assert counter.safe and counter.whole_tokens[0] > 10_000
    word = next(iter(counter.after_space))
    assert len(counter.sp.encode(word)) == 1


def test_counts_equal_library(counter):
    for t in TEXTS:
        assert counter.count(t) == len(counter.sp.encode(t)), repr(t)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" \n\tabé▁x.,<s>/'0中")), max_size=40))
def test_counts_equal_library_random(counter, text):
    assert counter.count(text) == len(counter.sp.encode(text))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" \n\t\rabéx.,'s0²½中 ́")), max_size=40))
def test_ids_equal_library_random(bpe, text):
    assert bpe.ids(text).tolist() == bpe.library.encode(text, add_special_tokens=False).ids


def test_ids_equal_library(bpe):
    assert bpe.fast is not None
    for t in TEXTS:
        assert bpe.ids(t).tolist() == bpe.library.encode(t, add_special_tokens=False).ids, repr(t)


def test_texts_with_runs_of_spaces_take_the_shortcut(counter):
    text = "  the   house and\n  a garden  \n\n the end " * 50
    want = len(counter.sp.encode(text))
    assert counter.count(text) == want  # merges what is not proved, and remembers it
    counter._rest = None  # nothing is left to be merged
    try:
        assert counter.count(text) == want
    finally:
        del counter._rest


def test_token_counts_rows(spark, counter):
    rows = [(i, t, "c") for i, t in enumerate(TEXTS)] + [(None, None, "c"), (3, "dup", "c"), (3, "dup", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(map(tuple, token_counts(df, MODEL, limit=100).collect()), key=str)
    want = sorted(((i, len((t or "").encode()), len(counter.sp.encode(t or "")), len(counter.sp.encode(t or "")) > 100) for i, t, _ in rows), key=str)
    assert got == want
    assert token_counts(df.limit(0), MODEL).collect() == []


def test_tightest_window_matches_scan():
    rng = random.Random(1)
    tree, rooms = TightestWindow(64), []
    for k in range(2000):
        if rooms and rng.random() < 0.5:
            need = rng.randint(1, 64)
            fits = [r for r in rooms if r >= need]
            got = tree.take(need)
            if not fits:
                assert got is None
            else:
                assert got[0] == min(fits)
                rooms.remove(got[0])
        else:
            r = rng.randint(1, 64)
            rooms.append(r)
            tree.add(r, k, 1)


def plain_best_fit(sizes, window):
    """Rooms left by best-fit decreasing, one piece at a time."""
    bins: list[int] = []
    for s in sorted(sizes, reverse=True):
        open_ = [i for i, r in enumerate(bins) if r >= s]
        if open_:
            bins[min(open_, key=lambda i: bins[i])] -= s
        else:
            bins.append(window - s)
    return bins


@settings(deadline=None, max_examples=150)
@given(st.lists(st.integers(1, 40), max_size=200), st.sampled_from([40, 41, 64]))
def test_plan_of_a_histogram_equals_plain_best_fit(sizes, window):
    counts = {n: sizes.count(n) for n in set(sizes)}
    place = places(best_fit_plan(counts, window))
    spans: dict = {}
    for n, c in counts.items():
        at, offset = place(np.full(c, n), np.arange(c))
        for w, o in zip(at.tolist(), offset.tolist()):
            spans.setdefault(w, []).append((o, n))
    bins = plain_best_fit(sizes, window)
    assert sorted(spans) == list(range(len(bins)))
    for parts in spans.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= window
    assert sorted(window - sum(n for _, n in parts) for parts in spans.values()) == sorted(bins)


def test_plan_does_not_grow_with_the_table():
    rng = random.Random(5)
    counts = {n: rng.randint(1, 10**9) for n in range(1, 1025)}
    plan = best_fit_plan(counts, 1024)
    assert len(plan) < 20_000
    assert {n: sum(1 for r in plan if r[0] == n) > 0 for n in counts} == dict.fromkeys(counts, True)


def test_packing_round_trip(spark, bpe):
    rows = [(i, t, 1) for i, t in enumerate(TEXTS)] + [(100, None, 1), (None, "no id", 1), (101, "word " * 3000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, offset int").repartition(3)
    got = pack_documents(df, JSON, window=256).collect()
    by_doc, by_seq = {}, {}
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] <= 256
        by_doc.setdefault(r["doc_id"], []).append((r["start"], ids, r["doc_tokens"]))
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, t, _ in rows:
        want = bpe.library.encode(t or "", add_special_tokens=False).ids + [0]
        ids = [int(x) for _, part, _ in sorted(by_doc[i], key=lambda p: p[0]) for x in part]
        assert ids == want and all(n == len(want) for _, _, n in by_doc[i])
    for spans in by_seq.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= 256
    assert pack_documents(df.limit(0), JSON).collect() == []


def test_packing_is_the_same_however_the_table_is_split(spark, bpe):
    rng = random.Random(7)
    rows = [(str(i), " ".join(["word"] * rng.choice([1, 2, 5, 30, 61, 90, 130]))) for i in range(400)] + [("x", None)] * 200
    df = spark.createDataFrame(rows, "doc_id string, text string")
    want = len(plain_best_fit([n % 128 for _, t in rows if (n := len(bpe.ids(t or "")) + 1) % 128], 128)) + sum((len(bpe.ids(t or "")) + 1) // 128 for _, t in rows)
    for parts in (1, 9):
        seqs = [r["sequence_id"] for r in pack_documents(df.repartition(parts), JSON, window=128).select("sequence_id").distinct().collect()]
        assert sorted(seqs) == list(range(want))


def test_packing_in_order_of_groups(spark):
    rows = [(i, "word " * (i % 50 + 1), i // 20) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id int, text string, g long")
    got = pack_in_order(df, JSON, "g", ["doc_id"], window=64).collect()
    assert {(r["doc_id"], r["sequence_id"] >> 24) for r in got} == {(i, g) for i, _, g in rows}
    assert pack_in_order(df.limit(0), JSON, "g", ["doc_id"]).collect() == []


def test_packing_crc_is_of_the_ids(spark, bpe):
    df = spark.createDataFrame([(1, "one two three")], "doc_id long, text string")
    row = pack_documents(df, JSON).select(F.crc32("ids").alias("c")).first()
    want = np.array(bpe.library.encode("one two three", add_special_tokens=False).ids + [0], "<u4").tobytes()
    assert row["c"] == zlib.crc32(want)
