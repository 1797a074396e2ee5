"""Redirects, source resolving, the guided crawl, similar titles and lexicon tables, each against a plain version."""

import difflib
import random

import pytest
from pyspark.sql import functions as F

from docweave.functions import lexicon
from docweave.operators import dedup, discover, html, redirects, score

DAY = lambda: F.lit("2026-02-01").cast("date")


def plain_chase(edges, most=None):
    to = {}
    for u, v in edges:
        if u and v:
            to[u] = min(v, to.get(u, v))
    out = {}
    for u in set(to) | set(to.values()):
        at, hops, seen = u, 0, {u}
        while at in to:
            at, hops = to[at], hops + 1
            if at in seen:
                break
            seen.add(at)
        if at in to:
            out[u] = (u, None, "loop")
        elif most is not None and hops > most:
            out[u] = (u, hops, "too_many")
        else:
            out[u] = (at, hops, "redirected" if hops else "direct")
    return out


@pytest.mark.parametrize("most", [None, 30])
def test_redirects_equal_walking(spark, most):
    rng = random.Random(1)
    edges = [(f"c{i}", f"c{i + 1}") for i in range(1000)]  # a chain of 1,000
    edges += [("a", "a"), ("b0", "b1"), ("b1", "b0"), ("tail", "b0"), ("tail2", "tail")]  # loops of one and two, and what leads there
    edges += [(f"l{i}", f"l{(i + 1) % 37}") for i in range(37)]
    edges += [(f"hub{i}", "c990") for i in range(500)] + [(f"r{i}", f"r{rng.randrange(300)}") for i in range(280)]
    edges += [("c5", "zz"), ("c5", "c6"), (None, "x"), ("x", None), ("y", ""), ("c7", "c8"), ("c7", "c8")]
    got = redirects.chase(spark.createDataFrame(edges, "url string, to_url string"), most).collect()
    assert len(got) == len({r.url for r in got})
    assert {r.url: (r.final_url, r.hops, r.state) for r in got} == plain_chase(edges, most)


def test_redirects_of_nothing(spark):
    assert redirects.chase(spark.createDataFrame([], "url string, to_url string")).count() == 0


def page(*links, title="t"):
    return f"<html><head><title>{title}</title></head><body>" + "".join(f'<p><a href="{u}">{t}</a></p>' for u, t in links) + "</body></html>"


def test_resolved_sources(spark):
    s = "https://www.city.example"
    doc = f"{s}/files/structural-audit-tender-notice-2026.pdf"
    landed = [
        (f"{s}/r1", f"{s}/r2", 301, None, None), (f"{s}/r2", f"{s}/tenders/structural-audit", 302, None, None),
        (f"{s}/tenders/structural-audit", None, 200, "text/html; charset=utf-8", page((doc, "Download structural audit tender document"), (f"{s}/other", "About us"))),
        (f"{s}/plain", None, 200, "text/html", page((f"{s}/x", "x"))), (f"{s}/data", None, 200, "application/json", "{}"), (f"{s}/gone", None, 404, "text/html", page()),
        (f"{s}/to-gone", f"{s}/gone", 302, None, None), (f"{s}/loop", f"{s}/loop2", 302, None, None), (f"{s}/loop2", f"{s}/loop", 302, None, None), (f"{s}/to-pdf", f"{s}/a.pdf", 302, None, None),
    ]
    asked = [f"{s}/r1", f"{s}/r1", f"{s}/tenders/structural-audit#top", f"{s}/plain", f"{s}/data", f"{s}/to-gone", f"{s}/loop", f"{s}/to-pdf", f"{s}/b.pdf", f"{s}/nowhere", None]
    got = {r.url: (r.final_url, r.hops, r.state, r.source) for r in redirects.resolve(spark.createDataFrame([(a,) for a in asked], "url string"), spark.createDataFrame(landed, "url string, redirect_to string, status int, content_type string, html string")).collect()}
    end = f"{s}/tenders/structural-audit"
    assert got == {
        f"{s}/r1": (end, 2, "redirected", doc), end: (end, 0, "direct", doc), f"{s}/plain": (f"{s}/plain", 0, "direct", f"{s}/plain"), f"{s}/data": (f"{s}/data", 0, "direct", f"{s}/data"),
        f"{s}/to-gone": (f"{s}/to-gone", 1, "failed", f"{s}/to-gone"), f"{s}/loop": (f"{s}/loop", None, "loop", f"{s}/loop"), f"{s}/to-pdf": (f"{s}/a.pdf", 1, "redirected", f"{s}/a.pdf"),
        f"{s}/b.pdf": (f"{s}/b.pdf", 0, "pdf", f"{s}/b.pdf"), f"{s}/nowhere": (f"{s}/nowhere", 0, "failed", f"{s}/nowhere"), "": ("", 0, "failed", ""),
    }


def plain_guided(starts, links, offers, depth=2, most_pages=12, most_found=25):
    pages, finds = [], []
    for source, first in starts:
        queue, queued, n, found = [(first, 0)], {first}, 0, {}
        while queue and n < most_pages and len(found) < most_found:
            url, d = queue.pop(0)
            n += 1
            pages.append((source, url, d, n))
            for _, _, link, s in sorted((-s, p, link, s) for u, link, s, p in offers if u == url):
                if link not in found and len(found) < most_found:
                    found[link] = (len(found) + 1, s, n)
            if d < depth:
                for _, _, to in sorted((-s, p, to) for u, to, s, p in links if u == url):
                    if to not in queued:
                        queued.add(to)
                        queue.append((to, d + 1))
        finds += [(source, k, link, s, m) for link, (k, s, m) in found.items()]
    return sorted(pages), sorted(finds)


@pytest.mark.parametrize("seed", range(3))
def test_guided_crawl_equals_a_queue(spark, seed):
    rng = random.Random(seed)
    names = [f"p{i}" for i in range(40)]
    links = [(rng.choice(names), rng.choice(names), float(rng.randint(1, 5)), i) for i in range(160)]
    offers = [(rng.choice(names), f"o{rng.randrange(60)}", float(rng.randint(1, 9)), i) for i in range(150)]
    starts = [("a", "p0"), ("b", "p1"), ("c", "lost")]
    lf = spark.createDataFrame(links, "url string, to_url string, score double, pos long")
    of = spark.createDataFrame(offers, "url string, link string, score double, pos long")
    pages, finds = discover.guided(spark.createDataFrame(starts, "source string, url string"), lambda front, deeper: (lf.join(front, "url", "left_semi"), of.join(front, "url", "left_semi")), most_found=12)
    want = plain_guided(starts, links, offers, most_found=12)
    assert (sorted(tuple(r) for r in pages.collect()), sorted(tuple(r) for r in finds.collect())) == want


def test_guided_crawl_of_pages(spark):
    s = "https://city.example"
    pages = [
        (s, page((f"{s}/about", "Contact"), (f"{s}/tenders", "Tenders"), (f"{s}/procurement/open", "Open tenders and procurement notices"), ("https://else.example/tenders", "Tenders"))),
        (f"{s}/tenders", page((f"{s}/tender/structural-audit-of-bridge", "Tender notice: structural audit of bridge, last date 3 March 2026"), (s, "Tenders home"))),
        (f"{s}/procurement/open", page((f"{s}/rfp/proof-checking", "Request for proposal: proof checking of structural design"))),
        (f"{s}/unseen", page((f"{s}/rfp/never", "Request for proposal: structural audit"))),
    ]
    df = spark.createDataFrame(pages, "url string, html string")
    seen, finds = discover.guided(spark.createDataFrame([("city", s)], "source string, url string"), html.expander(df, F.array(F.lit("structural"), F.lit("audit"))))
    urls = [r.url for r in seen.orderBy("n").collect()]
    assert urls[0] == s and set(urls[1:3]) == {f"{s}/tenders", f"{s}/procurement/open"} and f"{s}/unseen" not in urls and not any("else.example" in u for u in urls)
    assert {f"{s}/tender/structural-audit-of-bridge", f"{s}/rfp/proof-checking"} <= {r.link for r in finds.collect()}


def titles(seed, n=140):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("road", "audit", "bridge", "of", "tower", "no") for b in ("", "s", "ing", "er", "17", "x")]
    out = []
    for _ in range(n // 4):
        base = " ".join(rng.choice(words) for _ in range(rng.randint(1, 9)))
        out.append(base)
        for _ in range(3):
            t = list(base)
            for _ in range(rng.randint(1, max(1, len(t) // 14))):
                i = rng.randrange(len(t))
                t[i : i + rng.randint(0, 2)] = rng.choice(["", "q", "zz", " w"])
            out.append(" ".join("".join(t).split()))
    return sorted({t for t in out if t})


@pytest.mark.parametrize(("seed", "similar"), [(0, 0.92), (1, 0.92), (2, 0.95), (3, 0.92)])
def test_title_index_finds_every_pair(spark, seed, similar):
    assert dedup._indexable(similar) and not dedup._indexable(0.7)
    own = titles(seed)
    rows = [(f"{i:04}", i % 2, t) for i, t in enumerate(own)]
    r = lambda a, b: difflib.SequenceMatcher(None, a, b).ratio() >= similar
    want = {(a, b, r(tb, ta), r(ta, tb)) for a, ga, ta in rows for b, gb, tb in rows if a < b and ga == gb and (r(tb, ta) or r(ta, tb))}
    assert {tuple(x) for x in dedup.title_pairs(spark.createDataFrame(rows, "u string, g long, t string"), similar).collect()} == want and len(want) > 10


def test_classes_expand_to_every_conflict(spark):
    """Copies and pairs of representatives hold every pair of rows that conflict, and a group of copies makes one row each."""
    rng = random.Random(5)
    named = [(t, rng.choice(["o1", "o2"]), rng.choice(["d1", ""])) for t in titles(7)]
    rows = [(i, *rng.choice(named)) for i in range(300)] + [(1000 + i, *next(n for n in named if n[2])) for i in range(200)]
    df = spark.createDataFrame(rows, "pos long, title string, organization string, deadline string")
    got = dedup.classes(df).collect()
    of = {p: (t, o, d) for p, t, o, d in rows}
    first = {}
    for p in sorted(of):
        if all(of[p]):
            first.setdefault(of[p], p)
    members = {f: [p for p in of if all(of[p]) and first[of[p]] == f] for f in first.values()}
    assert {(r.earlier, r.later) for r in got if r.kind == "copy"} == {(f, p) for f, ps in members.items() for p in ps if p != f}
    pairs = {(p, x) for ps in members.values() for p in ps for x in ps if p < x}
    for r in got:
        if r.kind == "similar":
            pairs |= {(min(p, x), max(p, x)) for p in members[r.earlier] for x in members[r.later] if (r.forward if p < x else r.backward)}
    assert pairs == {(r.earlier, r.later) for r in dedup.conflicts(df.withColumn("source_url", F.lit(""))).collect()} and len(got) < len(pairs) / 10


def test_classes_lose_no_link_of_blank_titles_or_repeated_positions(spark):
    """Blank titles have a ratio of 1, so with equal organisation and deadline their rows are linked; of rows that share a position none is lost, and their classes stay apart."""
    rows = [
        (1, "", "O", "d"), (2, None, "o", "d"), (3, "!!!", "o", "d."), (4, "", "", "d"), (5, "", "o", None), (6, "", "o2", "d"),
        (7, "audit of bridges", "o", "d"), (7, "audit of bridge", "o", "d"), (7, "Audit of bridge", "o", "d"), (8, "audit of bridges", "o", "d"), (9, "roads", "o", "d"),
    ]
    df = spark.createDataFrame(rows, "pos long, title string, organization string, deadline string")
    got = dedup.classes(df).collect()
    assert sorted((r.earlier, r.later) for r in got if r.kind == "copy") == [(1, 2), (1, 3), (7, 7), (7, 8)]
    names = {r["class"]: sorted((x.earlier, x.later) for x in got if x.kind == "copy" and x["class"] == r["class"]) for r in got}
    assert sorted(names.values()) == [[(1, 2), (1, 3)], [(7, 7)], [(7, 8)]]
    (like,) = [r for r in got if r.kind == "similar"]
    assert (like.earlier, like.later, like.forward, like.backward) == (7, 7, True, True) and {like["class"], like.other} == {c for c, ps in names.items() if ps[0][0] == 7}
    pairs = {tuple(r) for r in dedup.conflicts(df.withColumn("source_url", F.lit(""))).collect()}
    assert pairs == {(1, 2), (1, 3), (2, 3), (7, 8)}


@pytest.mark.parametrize("cell", [dedup.CELL, 300])
def test_long_titles_meet_in_cells_without_growing(spark, monkeypatch, cell):
    """Pairs of long titles in one group, also where a class of length is dealt over several cells; the rows that meet carry each title a few times, not once a gram."""
    monkeypatch.setattr(dedup, "CELL", cell)
    rng = random.Random(3)
    words = ["".join(rng.choice("aeioudrtnms") for _ in range(rng.randint(2, 5))) for _ in range(60)]
    own = []
    for n in (20, 60, 60, 100, 200, 900):
        base = [rng.choice(words) for _ in range(n)]
        own += [" ".join(base), " ".join(rng.choice(words) if rng.random() < 0.015 else w for w in base), " ".join(rng.sample(base, n))]
    rows = [(f"{i:04}", 1, t) for i, t in enumerate(own)]
    r = lambda a, b: difflib.SequenceMatcher(None, a, b).ratio() >= 0.92
    want = {(a, b, r(tb, ta), r(ta, tb)) for a, _, ta in rows for b, _, tb in rows if a < b and (r(tb, ta) or r(ta, tb))}
    sent = []
    real = dedup.durable
    monkeypatch.setattr(dedup, "durable", lambda df: sent.append(df) or real(df))
    assert {tuple(x) for x in dedup.title_pairs(spark.createDataFrame(rows, "u string, g long, t string"), 0.92).collect()} == want and len(want) >= 2
    assert not any("pivots" in d.columns or "h" in d.columns for d in sent)


def test_lexicon_table_equals_expressions(spark):
    rng = random.Random(4)
    words = ["structural", "audit", "tender", "highway", "e-tender", "naïve", "x_1", "airport", "delhi", "proof", "checking", "peer", "review"]
    gaps = [" ", ", ", "-", "  ", "\n", "/"]
    rows = [(i, "".join(rng.choice(words) + rng.choice(gaps) for _ in range(30)), rng.choice(["structural audit", "proof checking", ""]), rng.choice(["CPWD", ""]), "delhi", "https://gem.gov.in", "2026-03-01") for i in range(40)] + [(99, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "pos long, description string, title string, organization string, location string, source_url string, deadline string")
    one = {r.pos: (r.score, r.reasons) for r in score.relevance(df, DAY()).collect()}
    two = {r.pos: (r.score, r.reasons) for r in score.relevance_by_table(df, DAY(), score.policy_table(spark)).collect()}
    assert one == two
    terms = ["structural audit", "audit", "e-tender", "tender", "peer-review", "x_1", "naïve", "x", "audit,", "-tender"]
    got = {(r.pos, r.term) for r in lexicon.hits(df, "pos", F.lower(F.coalesce("description", F.lit(""))), spark.createDataFrame([(t,) for t in terms], "term string")).collect()}
    lex = lexicon.Lexicon.of(terms)
    want = {(r.pos, t) for r in df.select("pos", lex.list_(F.lower(F.coalesce("description", F.lit("")))).alias("l")).collect() for t in r.l}
    assert got == want
    assert lexicon.hits(df, "pos", F.col("description"), spark.createDataFrame([], "term string")).count() == 0
    with pytest.raises(ValueError, match="word character"):
        lexicon.hits(df, "pos", F.col("description"), spark.createDataFrame([(f"c{i}+",) for i in range(300)], "term string"))


def test_titles(spark):
    from docweave.operators import titles

    cases = {
        "Notice Inviting Tender\nStructural audit and retrofitting of bridge no 12\nfor the public works\nIssued by: Public Works Department\nfoo": "Notice Inviting Tender Structural audit and retrofitting of bridge no 12 for the public works",
        "1. Name of work: Construction of tower\nand rehabilitation of tower\n2. EMD: 5\n": "Construction of tower and rehabilitation of tower",
        "GOVERNMENT OF INDIA\nMinistry of Works\nSelection of consultant for structural design Tender No 55/2026\n": "Selection of consultant for structural design",
        "Supply of steel plates Supply of steel plates for bridge works at the site ....... 3\nPhone: 12\n": "", "": "", "Too short": "", "x@y.in\n12/03/2026": "",
        "Contents\n7\nTender for structural audit of the structural audit of the north block\n03/04/2026\n": "Tender for structural audit of the north block 03/04/2026",
        "EOI\nthe bidder shall be required\nPlain words that are four and more": "Plain words that are four and more",
    }
    rows = spark.createDataFrame([(t,) for t in [*cases, None]], "t string")
    got = {r.t: r.x for r in rows.select("t", titles.find_title(titles.lines(F.col("t"))).alias("x")).collect()}
    assert got == cases | {None: ""}


def test_descriptions(spark):
    from docweave.operators import descriptions, titles

    cases = {
        "Scope of work\n3 Scope of Work 6\nThe work covers two bridges\nPage No. 4\nand one tower.\nContact: x\nnot this": "The work covers two bridges",
        "Scope of work: inspection of all the beams\nEligibility\nnone": "inspection of all the beams", "Background\nshort one\nA story that is told in full here\n5) Next\nno": "A story that is told in full here",
        "Hello\nThis introduction is long enough to be taken as one\nImportant dates\nThis line stands below a section and is not read": "This introduction is long enough to be taken as one", "": "", "Scope of work\nabc": "",
    }
    rows = spark.createDataFrame([(t,) for t in [*cases, None]], "t string")
    got = {r.t: r.x for r in rows.select("t", descriptions.find_description(titles.lines(F.col("t"))).alias("x")).collect()}
    assert got == cases | {None: ""}


def test_cache_as_of(spark):
    from docweave.operators import cache

    rng = random.Random(3)
    landed = [(rng.choice(["a", "b", "hot", None]), rng.choice([rng.randrange(500), None]), rng.randrange(9)) for _ in range(300)]
    asked = [(i, rng.choice(["a", "b", "hot", "none", None]), rng.choice([rng.randrange(600), None])) for i in range(200)] + [(7, "hot", 40)]
    got = cache.as_of(spark.createDataFrame(asked, "id int, key string, at long"), spark.createDataFrame(landed, "key string, at long, value int"), 25).collect()
    want = []
    for i, k, t in asked:
        fit = [(at, v) for key, at, v in landed if k is not None and t is not None and key == k and at is not None and t - 25 < at <= t]
        want.append((i, k, t, bool(fit), *(max(fit) if fit else (None, None))))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
