"""HTML to text and links, for pages as text or bytes. The tree lives inside one Arrow-batched function; everything after it is native."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from ..functions import lexicons as lx
from ..functions import urls
from ..functions.text import squeeze, text
from ..session import durable
from .clean import without_blocks, without_pairs
from .dedup import consecutive
from .score import candidate_score, link_score, navigation_score

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An open one of these ends when one of the named kind begins.
ENDS = {"p": frozenset(["p"]), "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"])}
BLOCK = frozenset("address article aside blockquote body div dl dt dd fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tr ul".split())
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None) -> None:
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    def walk(self) -> Iterator[Node]:
        for c in self.children:
            if isinstance(c, Node):
                yield c
                yield from c.walk()

    def text(self, gap: str = " ") -> str:
        parts: list[str] = []
        todo = [self]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                parts.append(x)
            else:
                todo.extend(reversed(x.children))
        return " ".join(gap.join(parts).split())


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("document", {}, None)
        self.depth = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ENDS:
            x = self.at
            while x.parent and x.tag not in ("table", "ul", "ol", "dl", "div", "article", "section", "body"):
                if x.tag in ENDS[tag]:
                    self.at, self.depth = x.parent, self.depth - 1
                    break
                x = x.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID and self.depth < 200:
            self.at, self.depth = node, self.depth + 1

    def handle_endtag(self, tag: str) -> None:
        x, up = self.at, 0
        while x.parent and x.tag != tag:
            x, up = x.parent, up + 1
        if x.parent:
            self.at, self.depth = x.parent, max(0, self.depth - up - 1)

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def tree(page: str | bytes | None) -> Node:
    t = _Tree()
    t.feed(page.decode("utf-8", "replace") if isinstance(page, bytes | bytearray) else page or "")
    t.close()
    return t.root


def _hidden(n: Node) -> bool:
    style = n.attrs.get("style", "").lower()
    return "hidden" in n.attrs or n.attrs.get("aria-hidden", "").lower() == "true" or any(s in style for s in lx.HIDDEN_STYLES)


def _layout(n: Node) -> bool:
    names = f"{n.attrs.get('class', '')} {n.attrs.get('id', '')}".lower()
    return bool(names.strip()) and any(w in names for w in lx.LAYOUT_NAMES) and not any(w in names for w in lx.CONTENT_NAMES)


def prune(n: Node) -> None:
    """Takes out scripts, layout, hidden and layout-named elements, then what is empty (images stay)."""
    kept = []
    for c in n.children:
        if isinstance(c, str):
            kept.append(c)
        elif not (c.tag in lx.REMOVED_TAGS or c.tag in lx.LAYOUT_TAGS or _hidden(c) or c.tag not in ("html", "body") and _layout(c)):
            prune(c)
            if c.tag in VOID or any(isinstance(x, Node) or x.strip() for x in c.children):
                kept.append(c)
    n.children = kept


# The weights of a container's signs and its least length, which results depend on.
def _container_score(n: Node, t: str) -> int:
    low, inside = t.lower(), list(n.walk())
    names = f"{n.attrs.get('class', '')} {n.attrs.get('id', '')}".lower()
    count = lambda tags: sum(x.tag in tags for x in inside)
    linked = sum(len(x.text()) for x in inside if x.tag == "a")
    s = len(t) + 500 * any(w in names for w in lx.CONTENT_NAMES) + 200 * count({"table"}) + 50 * count(HEADINGS) + 100 * any(w in low for w in lx.PAGE_TERMS)
    return s - 200 * (linked > len(t) / 2) - 300 * (sum(w in low for w in lx.NAVIGATION_HEAVY) >= 3)


def content_root(doc: Node) -> Node:
    """main, article or role=main if it has substance, else the best-scoring div or section, else the body."""
    nodes = list(doc.walk())
    for want in (lambda x: x.tag == "main", lambda x: x.tag == "article", lambda x: x.attrs.get("role") == "main"):
        for n in nodes:
            if want(n):
                t = n.text()
                if len(t) >= 150 or any(w in t.lower() for w in lx.PAGE_TERMS):
                    return n
    best, top = None, 0
    for n in nodes:
        if n.tag in ("div", "section") and len(t := n.text()) >= 300 and (s := _container_score(n, t)) > top:
            best, top = n, s
    return best or next((n for n in nodes if n.tag == "body"), doc)


def _table(n: Node) -> list[str]:
    rows = []
    for r in (x for x in n.walk() if x.tag == "tr"):
        cells = [c.text() for c in r.walk() if c.tag in ("td", "th")]
        row = " | ".join(c for c in cells if c)
        if row and row not in rows:
            rows.append(row)
    return rows


def render(n: Node) -> list[str]:
    """Lines: headings and paragraphs of their own, `term : value`, bullets, table rows as `a | b`."""
    out: list[str] = []
    held: list[str] = []

    def close(mark: str = "") -> None:
        t = " ".join("".join(held).split())
        held.clear()
        if t:
            out.append(mark + t)

    def go(x: Node, mark: str = "") -> None:
        for c in x.children:
            if isinstance(c, str):
                held.append(c)
            elif c.tag == "br":
                close(mark)
            elif c.tag == "table" and len(c.text()) >= 120 and sum(w in c.text().lower() for w in lx.NAVIGATION_HEAVY) < 2:
                close(mark)
                out.extend(_table(c))
            elif c.tag == "dl":
                close(mark)
                term = ""
                for d in (y for y in c.walk() if y.tag in ("dt", "dd")):
                    if d.tag == "dt":
                        term = d.text()
                    elif d.text():
                        out.append(f"{term} : {d.text()}" if term else d.text())
            elif c.tag in BLOCK:
                close(mark)
                go(c, "• " if c.tag == "li" else mark)
                close("• " if c.tag == "li" else mark)
            else:
                go(c, mark)
        if x is n:
            close(mark)

    go(n)
    return [x for x in out if not re.fullmatch(r"[-_=]{3,}", x)]


def page_lines(page: str | bytes | None) -> list[str]:
    doc = tree(page)
    prune(doc)
    return [re.sub("[​-‍﻿]", "", x) for x in render(content_root(doc))]


@pandas_udf(T.ArrayType(T.StringType()))
def lines_udf(pages: pd.Series) -> pd.Series:
    return pages.map(page_lines)


def to_text(pages: DataFrame, column: str = "html") -> DataFrame:
    """Adds lines and text: pruned content in order, without repeated neighbours, frequent short lines and repeated pairs."""
    rows = pages.withColumn("lines", lines_udf(F.col(column)))
    rows = rows.withColumn("lines", without_pairs(without_blocks(consecutive(F.col("lines")))))
    return rows.withColumn("text", F.array_join("lines", "\n"))


LINK = "array<struct<n:int,url:string,label:string,context:string>>"


def _links(page: str | bytes | None, base: str | None) -> list[dict]:
    """Anchors in order, the first of each URL: absolute, http(s), without fragment; a generic label takes its row's or item's text."""
    doc, out, seen = tree(page), [], set()
    base = base or ""
    home = urlsplit(base)
    title = next((n.text() for n in doc.walk() if n.tag == "title"), "")
    for a in (n for n in doc.walk() if n.tag == "a" and n.attrs.get("href", "").strip()):
        raw = a.attrs["href"].strip()
        if raw.lower().startswith(tuple(lx.LINK_SCHEMES)):
            continue
        try:
            u = urljoin(base, raw).split("#")[0]
            p = urlsplit(u)
        except ValueError:
            continue
        if p.scheme not in ("http", "https") or p.netloc in lx.MESSAGING or any(x in p.path.lower() for x in lx.NAVIGATION_PATHS) or p.netloc == home.netloc and p.path.strip("/") == "" and not p.query or u in seen:
            continue
        seen.add(u)
        label, around, up = a.text(), [], a.parent
        while up and up.tag != "document":
            if up.tag in ("tr", "li") and up.text() not in around:
                around.append(up.text())
            up = up.parent
        if a.parent and a.parent.text() not in around:
            around.append(a.parent.text())
        if label.lower() in lx.GENERIC_ANCHORS and around and around[0]:
            label = around[0][:500]
        context = " | ".join(dict.fromkeys(x for x in (a.text(), *around, title) if x))[:1200]
        out.append({"n": len(out), "url": u, "label": label, "context": context})
    return out


def links(pages: DataFrame, page: str = "html", url: str = "url", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """(keep..., page_url, n, url, label, context) of every anchor of every page."""

    @pandas_udf(LINK)
    def udf(html: pd.Series, base: pd.Series) -> pd.Series:
        return pd.Series([_links(h, b) for h, b in zip(html, base)])

    rows = pages.select(*keep, F.col(url).alias("page_url"), udf(F.col(page), F.col(url)).alias("_l"))
    return rows.select(*keep, "page_url", F.inline("_l"))


def best_link(found: DataFrame, keep: tuple[str, ...] = ("page_id",), least: int = 30) -> DataFrame:
    """(keep..., page_url, best): the best-scoring link of a page if it reaches least, else the page itself; ties keep page order. A PDF page stands for itself."""
    s = link_score(F.col("url"), F.col("label"), F.col("page_url"))
    rows = found.withColumn("_s", s).groupBy(*keep, "page_url").agg(F.max_by(F.col("url"), F.struct(F.col("_s"), -F.col("n"))).alias("best"), F.max("_s").alias("_s"))
    return rows.select(*keep, "page_url", F.when(urls.is_pdf(F.col("page_url")) | (F.col("_s") < least), F.col("page_url")).otherwise(F.col("best")).alias("best"))


def _admitted(found: DataFrame) -> DataFrame:
    """Links to the page's host or a subdomain without a bad URL or title."""
    t = F.lower(squeeze(text("label")))
    h, b = urls.host(F.col("url")), urls.host(F.col("page_url"))
    near = (h == b) | F.endswith(h, F.concat(F.lit("."), b))
    bad = F.lit(False)
    for p in lx.CRAWL_BAD_TITLES:
        bad = bad | (t.rlike(rf"\b{re.escape(p)}\b") if len(p) <= 4 else F.contains(t, F.lit(p)))
    return found.where(near & ~urls.is_bad(F.col("url")) & ~bad)


def _best(rows: DataFrame, most: int) -> DataFrame:
    """The most links of each page by score, ties in page order. Anchors of one page are bounded by the page."""
    best = rows.groupBy("page_id", "page_url").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "n", "url", "label"))), 1, most).alias("x"))
    return best.select("page_id", "page_url", F.inline("x")).select("page_id", "page_url", "n", "url", "label", (-F.col("s")).alias("score"))


def candidates(found: DataFrame, tokens, most: int = 25) -> DataFrame:  # noqa: ANN001
    """Admitted links of a page by candidate score, the best of each page."""
    return _best(_admitted(found).withColumn("score", candidate_score(F.col("label"), F.col("url"), tokens, F.col("context"))), most)


def navigation(found: DataFrame, most: int = 12) -> DataFrame:
    """Where a crawler goes on from a page: its admitted links with a positive navigation score, documents and bad queries left out; of one URL the first."""
    rows = _admitted(found).where(~urls.is_document(F.col("url")) & ~urls.has_bad_query(F.col("url")))
    rows = rows.withColumn("score", navigation_score(F.col("label"), F.col("url"))).where("score > 0")
    first = rows.groupBy("page_id", "page_url", "url").agg(F.min_by(F.struct("n", "label", "score"), "n").alias("f"))
    return _best(first.select("page_id", "page_url", "url", "f.*"), most)


def expander(pages: DataFrame, tokens, page: str = "html", url: str = "url", most_links: int = 12, most_found: int = 25):  # noqa: ANN001, ANN201
    """What discover.guided() asks of landed pages (url, html): navigation links and candidates of those of a front, parsed then. Of a URL's repeated pages one counts."""

    def expand(front: DataFrame, deeper: bool) -> tuple[DataFrame, DataFrame]:
        here = pages.select(urls.normalized(F.col(url)).alias("page_id"), F.col(page).cast("string").alias("html"))
        here = here.join(front.select(F.col("url").alias("page_id")), "page_id", "left_semi").groupBy("page_id").agg(F.min("html").alias("html"))
        found = durable(links(here.withColumn("url", F.col("page_id"))))
        offered = candidates(found, tokens, most_found).select(F.col("page_url").alias("url"), urls.normalized(F.col("url")).alias("link"), "score", F.col("n").alias("pos"))
        on = navigation(found, most_links).select(F.col("page_url").alias("url"), urls.normalized(F.col("url")).alias("to_url"), "score", F.col("n").alias("pos"))
        return on, offered

    return expand
