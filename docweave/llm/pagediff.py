"""HTML extraction by nearest-URL page differencing.

Pages are ordered by host and URL path. Each is paired with the nearest pages of its host on both sides, up to NEAR on each that are unlike it and each other
(pages with COPY of its lines outside of known boilerplate are copies of its article and tell nothing about a template; up to LOOK pages are looked through). The lines of a page and of each
partner are aligned by longest common subsequence of their forms: the path of tags, classes and roles with the text, digits masked; for lines of boilerplate elements and of link
lists the path alone, as menus and adverts say something else on every page. A partner that shares two lines is a witness of the template, and lines that two witnesses
share (or the only one) are deleted. Lines inside the article element always stay. Evidence in the page itself comes last: lines of boilerplate elements (by tag, class or role) that no partner shares go too.

Pages are dealt to stretches of the order by cut keys, with the pages around each cut sent to both sides, so that one shuffle of
the pages brings all partners together, each page is parsed once, and a task holds a few pages of the order at a time.
"""

from __future__ import annotations

import bisect
import html
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, forget, small_batches, small_table
from .urlfilter import split_url

RAW = "script|style|noscript|template|svg|iframe|textarea|select|title|object|math|canvas"
TOKEN = re.compile(rf"(?s)<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*?(?:/>|>.*?(?:</\1\s*>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([a-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|([^<]+|<)", re.I)
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody tfoot thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILER = frozenset("nav footer aside form button menu dialog head".split())
_NAMED = r"(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu|breadcrumbs?|footer|sidebar|cookies?|consent|notice|newsletter|subscribe|comments?|replies|disqus|share|social|related|popup|modal|complementary|contentinfo|navigation|search)"
NAMES = re.compile(rf"(?i)(?:class|id|role|aria-label)\s*=\s*[\"']?[^\"'>]*\b{_NAMED}\b")
#: Inside an article a whole class, role or id must match; headings and sections are not judged by their ids.
WHOLE = re.compile(rf"(?i)(?<![\w-])(?:(?:class|role)\s*=\s*(?:\"(?:[^\"]*\s)?|'(?:[^']*\s)?|){_NAMED}(?=[\s\"'/]|\Z)|(id)\s*=\s*[\"']?{_NAMED}(?=[\s\"'/]|\Z))")
TITLED = frozenset("section h1 h2 h3 h4 h5 h6".split())
#: Open elements that a start tag ends, and the elements that keep them from it.
IMPLIED = {t: (frozenset(ends.split()), frozenset(stops.split())) for t, ends, stops in (
    ("li", "li", "ul ol menu dir table td th"), ("dd", "dd dt", "dl table td th"), ("dt", "dd dt", "dl table td th"), ("td", "td th", "table"), ("th", "td th", "table"),
    ("tr", "tr", "table"), ("tbody", "thead tbody tfoot", "table"), ("tfoot", "thead tbody tfoot", "table"), ("option", "option", "datalist"),
)}
PARAGRAPH, CELLS, TABLE = frozenset(["p"]), frozenset("table td th caption button".split()), frozenset("table caption thead tbody tfoot tr td th article main body html".split())
#: Partners on each side, and pages looked through for them.
NEAR, LOOK = 8, 64
#: Share of a page's lines outside of boilerplate elements that make a partner a copy; lines that make it a witness, and witnesses whose agreement deletes a line.
COPY, WITNESS, VOTES = 0.75, 2, 2
#: What of an element's attributes is part of a line's path.
PLACED = re.compile(r"(?i)(?<![\w-])(class|role|id)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)")
DIGITS = re.compile(r"\d+")
#: Pages of a stretch, and most cut keys that reach the driver; with more pages stretches grow (a task streams its stretch).
STRETCH, CUTS = 2048, 32_768
#: Bits that one alignment may hold; larger ones are halved first.
TABLE_BITS = 1 << 28
HIDDEN = re.compile(r"(?i)\bhidden\b(?!\s*=\s*[\"']?false)|display\s*:\s*none|visibility\s*:\s*hidden")


def _close(opened: list[str], tags: frozenset[str], stops: frozenset[str]) -> None:
    """Ends the innermost open element of tags with all in it, unless one of stops is met first."""
    for i in range(len(opened) - 1, -1, -1):
        if opened[i] in tags:
            del opened[i:]
            return
        if opened[i] in stops:
            return


def _named(tag: str, attributes: str, article: bool) -> bool:
    if not article:
        return bool(NAMES.search(attributes))
    return any(not m.group(1) or tag not in TITLED for m in WHOLE.finditer(attributes))


def lines(page: str | None) -> list[tuple[str, int]]:
    """(line, kind) of a page in order; kind 0: boilerplate, 1: other, 2: inside the article."""
    return [(line, kind) for line, kind, _ in parsed(page)]


def _form(line: str, kind: int, path: list[str], linked: int, links: int) -> int:
    """What a line is aligned by; odd for lines whose text does not count."""
    listed = kind == 1 and linked >= 0.8 * len(line) and (links > 1 or any(m.startswith("li") for m in path))
    frame = not kind or listed
    said = ("links" if 2 * linked >= len(line) else "text") if frame else DIGITS.sub("0", line.lower())
    return xxhash.xxh64_intdigest(f"{'>'.join(path)}|{said}") >> 1 << 1 | frame


def parsed(page: str | None) -> list[tuple[str, int, int]]:
    """(line, kind, form) of a page in order."""
    out: list[tuple[str, int, int]] = []
    held: list[str] = []
    opened: list[str] = []
    # of the elements open: what paths show of them; of the line held: its path, and the text and number of its links
    marks: list[str] = []
    path: list[str] = []
    linked = links = 0
    # the elements open around a skipped one; it ends by its end tag, its implied end or the end of an element around it
    skip, around, article = "", 0, 0

    def close() -> None:
        nonlocal linked, links
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            kind = 0 if skip else 2 if article else 1
            out.append((text, kind, _form(text, kind, path, linked, links)))
        linked = links = 0

    for m in TOKEN.finditer(page or ""):
        end, tag, attributes, text = m.group(2, 3, 4, 5)
        if text is not None:
            if not text.isspace():
                if not any(map(str.strip, held)):
                    path = [m for m in marks[: len(opened)] if m]
                if "a" in opened:
                    linked += len(html.unescape(text).strip())
                    links += 1
            held.append(text)
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if end:
            _close(opened, frozenset([tag]), frozenset() if tag in TABLE else CELLS - {tag})
        else:
            if tag in IMPLIED:
                _close(opened, *IMPLIED[tag])
            if tag in BLOCKS:
                _close(opened, PARAGRAPH, CELLS)
        # an element that is never closed ends with the page's main parts
        over = skip and (len(opened) <= around or tag in ("article", "main") and not end)
        boiler = not end and tag not in VOID and (not skip or over) and (tag in BOILER or tag == "header" and not article or attributes and (_named(tag, attributes, article > 0) or bool(HIDDEN.search(attributes))) and tag not in ("body", "html", "article", "main"))
        if tag in BLOCKS or boiler or over:
            close()
        elif tag in ("br", "td", "th", "img"):
            held.append(" ")
        if over:
            skip = ""
        if boiler:
            skip, around = tag, len(opened)
        del marks[len(opened) :]
        if not end and tag not in VOID:
            opened.append(tag)
            marks.append(f"{tag}.{'.'.join(DIGITS.sub('0', v.strip(chr(34) + chr(39)).lower()) for _, v in PLACED.findall(attributes or ''))}" if tag in BLOCKS or boiler else "")
        if not skip and tag in ("article", "main"):
            article = max(0, article + (-1 if end else 1))
    close()
    return out


def _masks(a: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for k, x in enumerate(a):
        out[x] = out.get(x, 0) | 1 << k
    return out


def _lengths(a: list[int], b: list[int]) -> list[int]:
    """Lengths of the longest common subsequences of b and each beginning of a."""
    masks, full = _masks(a), (1 << len(a)) - 1
    v = full
    for x in b:
        u = v & masks.get(x, 0)
        v = (v + u | v - u) & full
    out = [0]
    for bit in reversed(f"{v:0{len(a)}b}" if a else ""):
        out.append(out[-1] + (bit == "0"))
    return out


def _subsequence(a: list[int], b: list[int]) -> list[int]:
    """Places in a of one longest common subsequence with b, in memory of TABLE_BITS."""
    if len(a) * len(b) > TABLE_BITS and len(b) > 1:
        half = len(b) // 2
        left, right = _lengths(a, b[:half]), _lengths(a[::-1], b[half:][::-1])[::-1]
        cut = max(range(len(a) + 1), key=lambda k: left[k] + right[k])
        return _subsequence(a[:cut], b[:half]) + [cut + i for i in _subsequence(a[cut:], b[half:])]
    masks, full = _masks(a), (1 << len(a)) - 1
    rows = [full]
    for x in b:
        v = rows[-1]
        u = v & masks.get(x, 0)
        rows.append((v + u | v - u) & full)
    found, k, j = [], len(a) - 1, len(b)
    while k >= 0 and j > 0:
        if rows[j] >> k & 1:
            k -= 1
        elif not rows[j - 1] >> k & 1:
            j -= 1
        else:
            found.append(k)
            k, j = k - 1, j - 1
    return found[::-1]


def shared(a: list[int], b: list[int]) -> list[int]:
    """Places in a of one longest common subsequence with b."""
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    both = set(a[lo : len(a) - hi]) & set(b[lo : len(b) - hi])
    at = [i for i in range(lo, len(a) - hi) if a[i] in both]
    found = _subsequence([a[i] for i in at], [x for x in b[lo : len(b) - hi] if x in both])
    return [*range(lo), *(at[k] for k in found), *range(len(a) - hi, len(a))]


def unlike(own: tuple[int, ...], other: tuple[int, ...]) -> bool:
    """Whether a page is no copy of another, by the forms of both."""
    mine = [x for x in own if not x & 1]
    have = set(other)
    return own != other and sum(x in have for x in mine) < COPY * max(len(mine), 1)


def judged(page: list[tuple[str, int, int]], forms: tuple[int, ...], partners: list[tuple[int, ...]]) -> tuple[str, int, int]:
    """(text, lines deleted as shared, further lines deleted by evidence in the page) of a page, given its partners' forms."""
    votes, witnesses = [0] * len(page), 0
    for other in partners:
        at = shared(forms, other)
        if len(at) >= WITNESS:
            witnesses += 1
            for i in at:
                votes[i] += 1
    keep, by_share, by_tag = [], 0, 0
    for (line, kind, _), n in zip(page, votes):
        if kind < 2 and n and n >= min(VOTES, witnesses):
            by_share += 1
        elif not kind:
            by_tag += 1
        else:
            keep.append(line)
    return "\n".join(keep), by_share, by_tag


class Key:
    """The pages at one place of the order: its rows, its first page's lines, and the partners met so far on both sides."""

    def __init__(self, place: tuple, lines_: tuple[int, ...], before: list[tuple[int, ...]]) -> None:
        self.place, self.lines, self.rows, self.waited = place, lines_, [], 0
        self.before, self.after = before, []

    def meet(self, other: tuple[int, ...]) -> None:
        self.waited += 1
        if len(self.after) < NEAR and unlike(self.lines, other) and other not in self.after:
            self.after.append(other)

    def out(self) -> Iterator[tuple]:
        done: dict[tuple[int, ...], tuple] = {}
        for page_id, url, page, hashes in self.rows:
            if hashes not in done:
                partners = [p for p in (*self.before, *self.after) if unlike(hashes, p)]
                done[hashes] = judged(page, hashes, partners)
            yield page_id, url, *done[hashes]


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (stretch, host, path, pid, k) -> the texts of those that aren't guests."""
    names = ["page_id", "url", "text", "n_shared", "n_tagged"]
    waiting: deque[Key] = deque()
    recent: deque[tuple[int, ...]] = deque(maxlen=LOOK)
    last: tuple | None = None
    out: list[tuple] = []
    known: tuple = (None, None, None)

    for b in batches:
        host, path, pid, stretch, guest, page_id, url = (b.column(c).to_pylist() for c in ("host", "path", "pid", "stretch", "guest", "page_id", "url"))
        for i, column in enumerate(b.column("html")):
            place, text = (stretch[i], host[i], path[i], pid[i]), column.as_py()
            if known[0] is None or known[0] != text:
                page = parsed(text)
                known = (text, page, tuple(f for _, _, f in page))
            _, page, hashes = known
            if last is None or place[:2] != last[:2]:
                for w in waiting:
                    out += w.out()
                waiting.clear()
                recent.clear()
            if place != last:
                for w in waiting:
                    w.meet(hashes)
                while waiting and (waiting[0].waited >= LOOK or len(waiting[0].after) >= NEAR):
                    out += waiting.popleft().out()
                before: list[tuple[int, ...]] = []
                for other in reversed(recent):
                    if len(before) < NEAR and unlike(hashes, other) and other not in before:
                        before.append(other)
                waiting.append(Key(place, hashes, before))
                recent.append(hashes)
                last = place
            if not guest[i]:
                waiting[-1].rows.append((page_id[i], url[i], page, hashes))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (b.schema.field("page_id").type, pa.string(), pa.string(), pa.int32(), pa.int32()))], names=names)
            out = []
        schema = b.schema
    for w in waiting:
        out += w.out()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (schema.field("page_id").type, pa.string(), pa.string(), pa.int32(), pa.int32()))], names=names)


def _cuts(keys: DataFrame) -> list[tuple[tuple, tuple, tuple]]:
    """(LOOK keys before, first key, last of the LOOK keys after) of every stretch but the first, of distinct keys (host, path, pid)."""
    order = ["host", "path", "pid"]
    ordered = durable(keys.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))
    ranked = ordered.select(*order, F.shiftright("at", 33).cast("int").alias("part"), F.col("at").bitwiseAND(F.lit((1 << 33) - 1)).alias("i"))
    offset, n = [], 0
    for r in ranked.groupBy("part").count().orderBy("part").collect():  # as many as partitions
        offset.append([r["part"], n])
        n += r["count"]
    each = max(STRETCH, -(-n // CUTS))
    ranked = ranked.join(F.broadcast(small_table(keys.sparkSession, offset, "part int, before bigint")), "part").withColumn("rank", F.col("before") + F.col("i"))
    place = F.pmod("rank", F.lit(each))
    found = ranked.where(((place == 0) | (place == LOOK - 1) | (place == each - LOOK)) | (F.col("rank") == n - 1)).select("rank", *order).collect()  # 3 * CUTS at most
    forget(ordered)
    key = {r["rank"]: (r.host.encode(), r.path.encode(), r.pid) for r in found}
    return [(key[c - LOOK], key[c], key[min(c + LOOK - 1, n - 1)]) for c in range(each, n, each)]


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, n_shared, n_tagged) of every row of pages (page_id, url, html).

    Lines are joined by a line end; without any, and for a null html, text is empty. n_shared lines went as shared with a partner, n_tagged further
    ones by evidence in the page alone. Pages with a null or hostless url are paired among themselves as one host; a page alone on its host has no
    partner, nor has one among copies of itself only. Ties in the path go by page_id; rows with equal path and page_id are not partners of
    each other, and the first of them by content stands for all to other pages. Repeated rows are each returned. Extra columns
    are ignored, whatever their names. No rows give no rows.
    """
    spark = pages.sparkSession
    small_batches(spark)
    host, path = split_url(F.col("_url"))
    read = pages.select("page_id", "url", "html", F.col("url").alias("_url"))
    placed = read.select("page_id", "url", "html", host.alias("host"), path.alias("path"), F.coalesce(F.expr("try_cast(page_id as bigint)"), F.lit(-(2**63))).alias("pid"))
    cuts = spark.sparkContext.broadcast(list(map(list, zip(*_cuts(placed.select("host", "path", "pid").distinct())))) or [[], [], []])  # CUTS at most

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, first, high = cuts.value
        for b in batches:
            rows, stretch, guest = [], [], []
            for i, key in enumerate(zip(*(b.column(c).to_pylist() for c in ("host", "path", "pid")))):
                key = (key[0].encode(), key[1].encode(), key[2])
                s = bisect.bisect_right(first, key)
                at = [s]
                if s and key <= high[s - 1]:
                    at.append(s - 1)
                if s < len(first) and key >= low[s]:
                    at.append(s + 1)
                rows += [i] * len(at)
                stretch += at
                guest += [x != s for x in at]
            b = b.take(pa.array(rows, pa.int32()))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(stretch, pa.int32()), pa.array(guest, pa.bool_())], names=[*b.schema.names, "stretch", "guest"])

    kind = pages.schema["page_id"].dataType.simpleString()
    dealt = placed.mapInArrow(deal, f"page_id {kind}, url string, html string, host string, path string, pid long, stretch int, guest boolean")
    ordered = dealt.withColumn("k", F.xxhash64("html")).repartition("stretch").sortWithinPartitions("stretch", "host", "path", "pid", "k")
    out = ordered.mapInArrow(_extracted, f"page_id {kind}, url string, text string, n_shared int, n_tagged int")
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_shared", "n_tagged")
