"""Main text of web pages by composite text density."""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORDS = re.compile(r"[a-z]+")
#: Elements by what HTML says of them (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em embed font i img input ins kbd label mark picture q rp rt ruby s samp small source span strike strong sub sup time tt u var wbr".split())
#: A start tag of the key closes an open element of the value, inside the nearest of _SCOPES.
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPES = frozenset("html body table ul ol dl div section article main aside nav header footer form fieldset blockquote td th details select".split())
#: Elements that HTML itself defines as no part of the content around them (fixed values).
BOILERPLATE = frozenset("nav footer aside form menu button select dialog head svg object canvas audio video map datalist".split()) | RAW
#: Words of class, id or role that say what a block is for: with one, a block inside the article must be denser than the article.
PURPOSES = frozenset("ad ads advert advertisement banner comment comments cookie notice promo promoted related share sponsored".split())
#: A block with so many links, which hold this share of its text, is a list of links.
LINKS, LINKED = 3, 0.5
#: A section beside the core is part of the article from this share of the core's sum.
PART = 0.1
_SECTIONS = frozenset("div section ul ol dl table details figure".split())


class Page:
    """The nodes of a page in document order, with the figures that densities need."""

    __slots__ = ("boiler", "in_article", "in_link", "link_chars", "link_tags", "named", "opened", "parent", "runs", "size", "tag", "tags")

    def __init__(self, source: str):
        self.tag, self.parent, self.boiler = ["#root"], [-1], [False]
        self.in_link, self.in_article = [False], [False]
        self.named = [False]  # class, id or role names a purpose
        self.opened: dict[str, int] = {}  # start tags by name: an end tag without one ends nothing
        self.size, self.tags, self.link_chars, self.link_tags = [0], [0], [0], [0]
        #: (node, text) in page order; text None is a border between blocks
        self.runs: list[tuple[int, str | None]] = []
        self._parse(source)
        self._sum()

    def _parse(self, source: str) -> None:
        open_nodes, at, end = [0], 0, len(source)
        while at < end:
            m = _TOKEN.search(source, at)
            stop = m.start() if m else end
            if stop > at:
                self._text(open_nodes, source[at:stop])
            if not m:
                break
            at, name = m.end(), m[2]
            if name is None:
                continue
            name = name.lower()
            if m[1]:
                self._close(open_nodes, name)
                continue
            self._open(open_nodes, name, m[3])
            if name in RAW:
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(source, at)
                self._close(open_nodes, name)
                at = close.end() if close else end

    def _text(self, open_nodes: list[int], raw: str) -> None:
        node = open_nodes[-1]
        text = html.unescape(raw) if "&" in raw else raw
        self.runs.append((node, text))
        n = len("".join(text.split()))
        self.size[node] += n
        if self.in_link[node]:
            self.link_chars[node] += n

    def _open(self, open_nodes: list[int], name: str, attrs: str) -> None:
        if name in BLOCKS:
            self._end_up_to(open_nodes, ("p",))
            self.runs.append((open_nodes[-1], None))
        if name in _CLOSES:
            self._end_up_to(open_nodes, _CLOSES[name])
        node, up = len(self.tag), open_nodes[-1]
        self.tag.append(name)
        self.parent.append(up)
        self.size.append(0)
        self.tags.append(0)
        self.link_chars.append(0)
        self.link_tags.append(int(name == "a"))
        self.in_link.append(self.in_link[up] or name == "a")
        self.in_article.append(self.in_article[up] or name in ("article", "main"))
        boiler, named = self._is_boiler(name, attrs, up)
        self.boiler.append(self.boiler[up] or boiler)
        self.named.append(named)
        if name == "br":
            self.runs.append((node, " "))
        if name not in VOID:
            open_nodes.append(node)
            self.opened[name] = self.opened.get(name, 0) + 1

    def _is_boiler(self, name: str, attrs: str, up: int) -> tuple[bool, bool]:
        """(no content by HTML's own rules, a class, id or role that names a purpose)."""
        if name in BOILERPLATE or (name == "header" and not self.in_article[up]):
            return True, False
        if "=" not in attrs and "hidden" not in attrs:
            return False, False
        found = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTR.finditer(attrs)}
        if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", ""):
            return True, False
        return False, name in _SECTIONS and any(set(_WORDS.findall(found.get(k, ""))) & PURPOSES for k in ("class", "id", "role"))

    def _end_up_to(self, open_nodes: list[int], names: tuple[str, ...]) -> None:
        """End the nearest open element of these names, if no scope lies between."""
        for k in range(len(open_nodes) - 1, 0, -1):
            tag = self.tag[open_nodes[k]]
            if tag in names:
                if tag in BLOCKS:
                    self.runs.append((open_nodes[k], None))
                del open_nodes[k:]
                return
            if tag in _SCOPES:
                return

    def _close(self, open_nodes: list[int], name: str) -> None:
        if name in BLOCKS:
            self.runs.append((open_nodes[-1], None))
        if name not in self.opened or name in ("body", "html"):  # what follows still belongs to the page
            return
        for k in range(len(open_nodes) - 1, 0, -1):
            if self.tag[open_nodes[k]] == name:
                del open_nodes[k:]
                return
            if name not in BLOCKS and self.tag[open_nodes[k]] in BLOCKS:
                return  # an inline end tag does not end blocks around it

    def _sum(self) -> None:
        """Totals of each subtree; boilerplate counts for the page alone."""
        for k in range(len(self.tag) - 1, 0, -1):
            up = self.parent[k]
            if self.boiler[k] and not self.boiler[up]:
                up = 0
            self.size[up] += self.size[k]
            self.tags[up] += self.tags[k] + 1
            self.link_chars[up] += self.link_chars[k]
            self.link_tags[up] += self.link_tags[k]

    def densities(self) -> list[float]:
        """Characters per tag, adjusted by links: high for long text with few links."""
        page_links = self.link_chars[0] / max(1, self.size[0])
        out = []
        for c, t, lc, lt in zip(self.size, self.tags, self.link_chars, self.link_tags, strict=True):
            if not c:
                out.append(0.0)
                continue
            base = math.log(c / max(1, c - lc) * lc + page_links * c + math.e)
            value = math.log(max(1.0, c / max(1, lc) * max(1, t) / max(1, lt)))
            out.append(c / max(1, t) * value / max(1e-3, math.log(base)))
        return out

    def main_nodes(self) -> set[int]:
        """Nodes of the chosen subtrees.

        Sums run over the elements that structure a page; inline elements only
        count as tags of the element around them.  The search starts at the
        ``main`` or ``article`` with the largest sum below it, or at the body
        where there is none with more than links, or several with less than
        half of the body's sum.
        The node with the largest sum of child densities is the core.  The
        least density on its path from the body is the threshold; below every
        node that reaches it, the subtree with the largest sum is chosen too,
        unless it is a section of less than PART of the core's sum.  Inside the
        chosen subtrees a list of links and a section right below the body go if
        they stay under the threshold, and a block that its class names an
        advert, a notice or comments if it stays under the core.
        """
        n, density = len(self.tag), self.densities()
        children: list[list[int]] = [[] for _ in range(n)]
        above = [0] * n  # the nearest element that is not inline
        for k in range(1, n):
            up = self.parent[k]
            above[k] = above[up] if self.tag[up] in INLINE else up
            if not self.boiler[k] and self.tag[k] not in INLINE:
                children[above[k]].append(k)
        sums = [sum(density[c] for c in children[k]) if children[k] else density[k] for k in range(n)]
        best = list(range(n))  # the node of the largest sum in each subtree; the upper one of equals
        for k in range(n - 1, 0, -1):
            up = above[k]
            if not self.boiler[k] and self.tag[k] not in INLINE and sums[best[k]] > sums[best[up]]:
                best[up] = best[k]
        body = next((k for k in range(n) if self.tag[k] == "body"), 0)
        articles = [k for k in range(n) if self.tag[k] in ("main", "article") and not self.boiler[k] and self.size[k] > 2 * self.link_chars[k]]
        top = max(articles, key=lambda k: sums[best[k]], default=body)
        if len(articles) > 1 and sums[best[top]] < 0.5 * sums[best[body]]:
            top = body  # cards of other articles beside a text in plain blocks
        core, path = best[top], []
        k = core
        while k >= 0:
            path.append(density[k])
            if k == body:
                break
            k = above[k] if k else -1
        threshold = min(path)
        chosen, todo = {core}, [top]
        while todo:
            k = todo.pop()
            if self.tag[k] in _SECTIONS and sums[best[k]] < PART * sums[core]:
                continue
            if density[k] >= threshold and sums[best[k]] > 0:
                chosen.add(best[k])
            if k not in chosen:
                todo += children[k]
        inside = set()
        for k in range(n):
            if self.boiler[k] or not (k in chosen or self.parent[k] in inside):
                continue
            if self.tag[k] in _SECTIONS and k != core:
                links = self.link_tags[k] >= LINKS and self.link_chars[k] >= LINKED * self.size[k]
                if ((links or above[k] == body) and density[k] < threshold) or (self.named[k] and density[k] < density[core]):
                    continue
            inside.add(k)
        return inside

    def text(self) -> str:
        inside = self.main_nodes()
        blocks: list[str] = []
        now: list[str] = []
        for node, run in self.runs:
            if run is None:
                if now:
                    blocks.append(" ".join("".join(now).split()))
                    now = []
            elif node in inside or (self.tag[node] == "br" and self.parent[node] in inside):
                now.append(run)
        blocks.append(" ".join("".join(now).split()))
        return "\n\n".join(b for b in blocks if b)


def main_text(source: str | None) -> str:
    return Page(source).text() if source else ""


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts: list[str] = []
        for at in range(0, batch.num_rows, 256):
            texts += [main_text(h) for h in batch.column(2).slice(at, 256).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["id", "url", "text"])


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: id, url, text, n_chars (code points).

    Composite text density chooses the subtrees; see ``Page.main_nodes``.
    NULL and empty pages, and pages without any main text, give the empty text.
    Menus, headers outside the article, footers, sidebars, notices, adverts,
    forms, scripts, styles, comments and hidden parts are left out; character
    references are decoded; white space inside a block becomes one space and
    blocks are joined by a blank line.  Repeated rows and NULL ids stay; other
    columns are ignored.  No shuffle: each page is read where it lies.
    """
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kind = dict(src.dtypes)["id"]
    out = src.mapInArrow(_extracted, f"id {kind}, url string, text string")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))
