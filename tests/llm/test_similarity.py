"""N-gram join, vector groups and page text against brute force."""

import html
import math
import random
import re

import numpy as np
import pandas as pd
import pytest

from ledgerspark.llm import html_text as H
from ledgerspark.llm import ngram_join as J
from ledgerspark.llm import vector_dedup as V


def components(n, links):
    up = list(range(n))

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return [top(x) for x in range(n)]


def ngram_brute(texts, words=3, percent=90):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        k = min(words, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    n = len(texts)
    links = [(i, j) for i in range(n) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    return [len(s) for s in sets], components(n, links)


def near_copies(rng, n_base, copies, length, rate):
    vocab = [f"w{i}" for i in range(3000)]
    passage = [rng.choice(vocab) for _ in range(30)]
    out = []
    for _ in range(n_base):
        base = [rng.choice(vocab) for _ in range(rng.randint(*length))]
        if rng.random() < 0.5:
            base = passage + base
        for _ in range(copies):
            w = list(base)
            for k in range(len(w)):
                if rng.random() < rate:
                    w[k] = rng.choice(vocab)
            out.append(" ".join(w))
    return out


@pytest.mark.parametrize("case", ["small", "hot", "mixed"])
def test_ngram_groups_against_brute_force(spark, monkeypatch, case):
    rng = random.Random(case)
    if case == "small":
        texts = near_copies(rng, 30, 3, (1, 120), 0.01)
    elif case == "hot":
        texts = near_copies(rng, 1, 120, (60, 80), 0.015) + near_copies(rng, 2, 40, (5, 9), 0.05)
        monkeypatch.setattr(J, "BLOCK_SETS", 40)
    else:
        texts = near_copies(rng, 60, 1, (20, 60), 0.0) + near_copies(rng, 4, 30, (40, 400), 0.008)
    texts += ["", None, " \t\n", "One", "one", "ONE two", "one  two", "a b c", "A\tb\x0bC", "É x y", "é x y", "a b c", "word " * 3000]
    rng.shuffle(texts)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, key string, size int").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.ngram_groups(df).collect()}
    sizes, comp = ngram_brute(texts)
    assert got == {i: (s, c) for i, (s, c) in enumerate(zip(sizes, comp))}
    assert len(set(comp)) < len(comp) - 5


def test_ngram_groups_of_odd_tables(spark):
    schema = "doc_id long, text string"
    assert J.ngram_groups(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, "a b c d"), (4, "a b c d"), (4, "a b c d"), (None, None), (9, "q")]
    got = sorted((str(tuple(r)) for r in J.ngram_groups(spark.createDataFrame(rows, schema)).collect()))
    assert got == sorted(str(x) for x in [(None, 2, 4), (4, 2, 4), (4, 2, 4), (None, 0, None), (9, 1, 9)])


def test_drop_near_duplicates(spark):
    text = " ".join(f"w{i}" for i in range(100))
    df = spark.createDataFrame([(5, text), (3, text + " end"), (8, "other words here now")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in J.drop_near_duplicates(df).collect()) == [3, 8]


def test_drop_near_duplicates_with_repeated_and_null_ids(spark):
    base = [f"w{k}" for k in range(40)]
    near = lambda k: " ".join([*base[:-1], f"x{k}"])
    rows = [(2, near(1)), (2, near(2)), (None, near(3)), (5, near(4)), (2, "another text of id two, kept for itself"), (None, "only null ids here twice over"), (None, "only null ids here twice over")]
    rows += [(7, "repeated row of seven words in all"), (7, "repeated row of seven words in all"), (8, ""), (8, None), (None, None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, `group` int")
    out = J.drop_near_duplicates(df.repartition(3))
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    assert out.columns == df.columns and len([g for g in got if g[0] == 2 and g[1].startswith("w0")]) == 1
    assert [g for g in got if g[0] != 2 or not g[1].startswith("w0")] == sorted([(2, rows[4][1]), (None, rows[5][1]), (7, rows[7][1]), (8, ""), (8, None), (None, None)], key=str)
    assert J.drop_near_duplicates(df.limit(0)).collect() == []


def test_overlaps_equal_sets():
    rng = random.Random(4)
    sets = [np.array(sorted(rng.sample(range(120), rng.randint(0, 60))), np.uint64) for _ in range(80)]
    got = J.overlaps(sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert i == j or got[i, j] == len(set(a.tolist()) & set(b.tolist()))


def vector_brute(rows, limit):
    def usable(v, label):
        return v is not None and label is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    n, links = len(rows), []
    for i in range(n):
        for j in range(i):
            (a, la), (b, lb) = rows[i], rows[j]
            if usable(a, la) and usable(b, lb) and la == lb and len(a) == len(b):
                x, y = np.array(a, float), np.array(b, float)
                if x @ y >= limit * np.sqrt((x @ x) * (y @ y)):
                    links.append((i, j))
    count = [0] * n
    for a, b in links:
        count[a] += 1
        count[b] += 1
    return count, components(n, links)


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(60):
        base = rng.standard_normal(64)
        for _ in range(int(rng.integers(1, 7))):
            noise = rng.standard_normal(64) * rng.uniform(0.05, 0.35)
            rows.append(([float(np.float32(x)) for x in base + noise], int(rng.integers(0, 2))))
    rows += [rows[0]] * 5 + [([2 * x for x in rows[0][0]], rows[0][1])]
    rows += [(None, 1), ([0.0] * 64, 1), ([float("nan")] + [1.0] * 63, 1), ([None] + [1.0] * 63, 1), ([], 1), (rows[0][0], None), ([1.0, 2.0, 3.0], 1), ([1.0, 2.0, 3.1], 1), ([float("inf")] * 64, 0)]
    df = spark.createDataFrame([(i, v, l, 1, "z") for i, (v, l) in enumerate(rows)], "vec_id long, embedding array<float>, label int, n int, node string").repartition(3)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in V.near_vectors(df).collect()}
    f32 = [([None if x is None else float(np.float32(x)) for x in v] if v is not None else None, l) for v, l in rows]
    count, comp = vector_brute(f32, 0.93)
    assert got == {i: (count[i], comp[i], comp[i] == i) for i in range(len(rows))}
    assert V.near_vectors(df.limit(0)).collect() == []


def brute_links(ids, labels, x):
    """Links of each id: others of the same label at cosine 0.93 or more."""
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = dict.fromkeys(ids.tolist(), 0)
    for label in set(labels):
        at = np.flatnonzero(np.array(labels) == label)
        near = (unit[at] @ unit[at].T >= 0.93).sum(1) - 1
        out.update(zip(ids[at].tolist(), near.tolist()))
    return out


def test_recall_on_twenty_thousand_vectors(spark):
    """A table made here: a large group of near copies, pairs at every similarity around the limit, and vectors near nothing."""
    rng = np.random.default_rng(11)
    n, dims = 20_000, 64
    x = rng.standard_normal((n, dims))
    x[:1500] = x[0] + 0.15 * rng.standard_normal((1500, dims))
    base = x[2000:7000]  # a partner each, at cosine 0.90 to 0.99
    cosine = rng.uniform(0.90, 0.99, (5000, 1))
    side = rng.standard_normal((5000, dims))
    side -= base * (side * base).sum(1, keepdims=True) / (base * base).sum(1, keepdims=True)
    side *= np.linalg.norm(base, axis=1, keepdims=True) / np.linalg.norm(side, axis=1, keepdims=True)
    x[7000:12_000] = cosine * base + np.sqrt(1 - cosine**2) * side
    labels = np.where(np.arange(n) < 1500, 0, np.arange(n) % 5)
    want = brute_links(np.arange(n), labels.tolist(), x)
    rows = pd.DataFrame({"vec_id": np.arange(n), "label": labels, "embedding": list(x)})
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(8)
    got = {r["vec_id"]: r["n_links"] for r in V.near_vectors(df).collect()}
    assert all(got[i] <= k for i, k in want.items())
    pairs = {i: k for i, k in want.items() if i >= 1500}
    group, apart = sum(got[i] for i in range(1500)) / sum(want[i] for i in range(1500)), sum(got[i] for i in pairs) / sum(pairs.values())
    print(f"recall in the group {group:.4f}, of pairs {apart:.4f}")
    assert sum(pairs.values()) > 5000 and group >= 0.9 and apart >= 0.9


@pytest.mark.parametrize("joined", [1, 2, 3])
def test_recall_in_a_large_group_of_near_copies(spark, joined):
    """One group of different vectors that are all near one another, and others around; for any number of joined polytopes."""
    rng = np.random.default_rng(3)
    centre = rng.standard_normal(32)
    x = np.concatenate([centre + 0.12 * rng.standard_normal((400, 32)), rng.standard_normal((600, 32))])
    want = brute_links(np.arange(1000), ["a"] * 1000, x)
    df = spark.createDataFrame([(i, "a", v.tolist()) for i, v in enumerate(x)], "vec_id long, label string, embedding array<double>")
    got = {r["vec_id"]: r for r in V.near_vectors(df, joined=joined).collect()}
    assert all(got[i]["n_links"] <= n for i, n in want.items())
    assert sum(r["n_links"] for r in got.values()) >= 0.9 * sum(want.values()) > 50_000
    assert len({got[i]["component_id"] for i in range(400)}) == 1


@pytest.mark.parametrize(("crowd", "block"), [(3, 7), (20, 16), (10**6, 2048)])
def test_crowded_buckets_change_nothing(spark, monkeypatch, crowd, block):
    """Pair by pair or as matrices, in one block or many: links of close groups, copies and vectors of other lengths, each counted once."""
    rng = np.random.default_rng(9)
    rows = []
    for label in ("a", "b"):
        for size in (1, 2, 9, 60):
            centre = rng.standard_normal(24)
            rows += [(label, (centre + 0.05 * rng.standard_normal(24)).tolist()) for _ in range(size)]
    rows += [("a", rows[30][1])] * 5 + [("a", [*rows[30][1], 0.0])] * 2 + [("b", [2 * v for v in rows[100][1]])]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "vec_id long, label string, embedding array<double>")
    monkeypatch.setattr(V, "CROWD", crowd)
    monkeypatch.setattr(V, "BLOCK", block)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in V.near_vectors(df).collect()}
    links = {i: set() for i in range(len(rows))}
    for i, (la, x) in enumerate(rows):
        for j, (lb, y) in enumerate(rows):
            if i != j and la == lb and len(x) == len(y) and np.dot(x, y) >= 0.93 * math.sqrt(np.dot(x, x) * np.dot(y, y)):
                links[i].add(j)
    comp = components(len(rows), [(i, j) for i in links for j in links[i]])
    assert got == {i: (len(links[i]), comp[i]) for i in links}


def test_hadamard_is_a_rotation():
    x = np.random.default_rng(0).standard_normal((5, 16))
    y = V.hadamard(x)
    assert np.allclose((x * x).sum(1), (y * y).sum(1)) and np.allclose(V.hadamard(y), x)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header><a href=/>Site</a></header><nav><ul><li><a href="/a">A</a></li></ul></nav>
<div id="cookie-notice">We use cookies</div><div class="ad">Buy &amp; run</div>
<article><header><h1>Head &amp; line</h1></header><p>One <b>bold
 text<br>next<p>Two &lt;tags&gt; <a href=x>link</a> here and more words to read</p>
<ul><li>first<li>second</ul><script>var x = "</p>";</script><form><input>search</form>
<pre>kept  as   words</pre><!-- gone --><blockquote>cited</blockquote></article>
<section class="comments"><p>Reader says a lot of things in a very long comment that could win by length alone, really.</p></section>
<aside>Aside</aside><footer>&copy; F</footer></body></html>"""


def test_main_text_of_a_page():
    want = ["Head & line", "One bold text next", "Two <tags> link here and more words to read", "first", "second", "kept as words", "cited"]
    assert H.main_text(PAGE) == "\n\n".join(want)


@pytest.mark.parametrize("wrapper", ['div class="content has-sidebar"', 'div id="page" class="fixed-header"', 'section class="page header"'])
@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_markers_around_the_article(wrapper, tag):
    side = '<div class="sidebar"><p>Aside</p></div><div class="related"><article class="card"><a href="/x">Another article to read</a></article></div>'
    talk = '<div class="comments"><article><p>A reader says something.</p></article></div>' if tag != "div" else ""
    page = f'<body><{wrapper}>{side}<{tag}><p>{"Many words of the page. " * 9}</p><p>{"And more of them. " * 9}</p></{tag}>{talk}</div></section><div class="site-footer">Foot</div></body>'
    assert H.main_text(page).split("\n\n") == [("Many words of the page. " * 9).strip(), ("And more of them. " * 9).strip()]


def test_markers_inside_the_article():
    page = f'<body><div class="header">Site</div><article><div class="article-header"><h1>Title</h1></div><div class="body no-ads"><p>{"Words of it. " * 20}</p></div><div class="share-box">Share</div></article></body>'
    assert H.main_text(page).split("\n\n") == ["Title", ("Words of it. " * 20).strip()]


class Everything(H.Page):
    """Ablation: the text of all nodes that are content by HTML's own rules."""

    def main_nodes(self):
        return {k for k in range(len(self.tag)) if not self.boiler[k]}


def given_pages(sf="sf0.001"):
    import pyarrow.parquet as pq

    return pq.read_table(f"/root/testdata/{sf}/pages.parquet").column("html").to_pylist()


def test_density_decides_on_the_given_pages():
    """Advert and article differ by density: without its choice every page would hold the advert too."""
    for page in given_pages():
        article = re.search(r"<article>(.*)</article>", page, re.S)[1]
        blocks = (html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))) for b in re.split(r"</?(?:p|h1)>", article))
        want = "\n\n".join(" ".join(b.split()) for b in blocks if b.strip())
        assert H.main_text(page) == want != Everything(page).text()


def test_density_decides_where_names_say_nothing():
    """No article tag, no telling class: long articles are found all the same."""
    for tag, names in (("div", ("q1", "q7")), ("section", ("ad", "q7"))):
        found = long = 0
        for page in given_pages("sf0.01"):
            want = H.main_text(page)
            odd = page.replace("<article>", f'<{tag} class="{names[0]}">').replace("</article>", f"</{tag}>").replace('class="ad"', f'class="{names[1]}"')
            if len(want) > 600:
                long += 1
                found += H.main_text(odd) == want
        assert long > 100 and found >= 0.95 * long
    said = "<p>" + "A reader says many things. " * 3 + "</p>"
    page = f'<body><div class="a1"><div class="b1"><h1>Title</h1>{"<p>" + "Words of it. " * 40}<p>{"More words. " * 30}</p>{"<p>And so on, line by line. " * 12}<ul><li><a href=1>one link</a><li><a href=2>two links</a><li><a href=3>three links</a></ul></div></div><div class="c9">{said}</div></body>'
    assert H.main_text(page).split("\n\n") == ["Title", ("Words of it. " * 40).strip(), ("More words. " * 30).strip(), *["And so on, line by line."] * 12]


def plain_sums(page):
    """Largest sum of child densities, by the formula written out over a plain tree."""
    p = H.Page(page)
    n = len(p.tag)
    kids = {k: [c for c in range(1, n) if p.parent[c] == k and not p.boiler[c]] for k in range(n)}

    def total(values, k):
        return values[k] + sum(total(values, c) for c in kids[k])

    chars, links = [0] * n, [0] * n
    for node, run in p.runs:
        if run is not None and p.tag[node] not in H.RAW:
            size = len("".join(run.split()))
            chars[node] += size
            up = node
            while up > 0 and p.tag[up] != "a":
                up = p.parent[up]
            links[node] += size * (up > 0)
    all_chars, all_links = sum(chars), sum(links)

    def density(k):
        c, lc = total(chars, k), total(links, k)
        t, lt = total([1] * n, k) - 1, total([int(x == "a") for x in p.tag], k)
        if not c:
            return 0.0
        base = math.log(c / max(1, c - lc) * lc + all_links / max(1, all_chars) * c + math.e)
        return c / max(1, t) * math.log(max(1, c / max(1, lc) * max(1, t) / max(1, lt))) / max(1e-3, math.log(base))

    return p, {k: density(k) for k in range(1, n) if not p.boiler[k]}


def test_densities_against_the_formula():
    for page in [*given_pages()[:20], PAGE]:
        p, want = plain_sums(page)
        got = p.densities()
        assert all(got[k] == pytest.approx(v) for k, v in want.items() if p.tag[k] not in H.RAW) and len(want) > 3


def test_a_very_long_page_and_repeated_rows(spark):
    page = "<body><nav>" + '<a href="/x">menu</a>' * 2000 + "</nav><article>" + "".join(f"<p>Paragraph {i} of many.</p>" for i in range(40_000)) + "</article></body>"
    df = spark.createDataFrame([(1, "u", page)] * 3, "page_id long, url string, html string")
    assert [(r["page_id"], r["text"].count("\n\n"), r["n_chars"] == len(r["text"])) for r in H.extract_text(df).collect()] == [(1, 39_999, True)] * 3


def test_main_text_of_odd_pages():
    assert H.main_text(None) == H.main_text("") == H.main_text("<nav>x</nav>") == ""
    assert H.main_text("plain words") == "plain words"
    assert H.main_text("<p>a<p>b") == "a\n\nb"
    assert H.main_text("<div>" * 3000 + "deep" + "</div>" * 10) == "deep"
    assert H.main_text("<body><p>x &nbsp; y</p></b></body><p>z") == "x y\n\nz"
    assert H.main_text("<body><div><p>" + "long words " * 50 + "</p><p>more</p></div><p unclosed='") != ""


def test_extract_text_rows(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "t"), (None, None, None, "t"), (1, "u", "é", "t")], "page_id long, url string, html string, text string")
    got = sorted((str(r["page_id"]), r["url"], r["text"], r["n_chars"]) for r in H.extract_text(df).collect())
    assert [g[3] for g in got] == [len(g[2]) for g in got] and len(got) == 3
    assert H.extract_text(df.limit(0)).collect() == []
