import datetime
import difflib
import random

import pytest
from pyspark.sql import functions as F

from docweave.operators import assist, clean, dedup, discover, gates, html, insight, pages, parse, qualify, score, store

day = lambda: F.lit("2026-02-01").cast("date")
COLS = "pos long, title string, description string, organization string, location string, source string, source_url string, deadline string, email string, phone string"


def opp(spark, *rows):
    base = {"pos": 0, "title": None, "description": None, "organization": None, "location": None, "source": None, "source_url": None, "deadline": None, "email": None, "phone": None}
    return spark.createDataFrame([tuple((base | {"pos": i} | r).values()) for i, r in enumerate(rows)], COLS)


def test_relevance(spark):
    strong = {"title": "Tender for structural audit and proof checking consultancy", "description": "Selection of structural consultant", "organization": "CPWD", "location": "Delhi", "source": "gem", "source_url": "https://gem.gov.in/x", "deadline": "2026-03-20", "email": "a@b.c", "phone": "1"}
    rows = opp(spark, strong, strong | {"description": "airport works"}, {"title": "warehouse building"}, {"title": "nothing here"}, strong | {"location": "Kerala", "deadline": "2026-01-01"}, {})
    got = {r.pos: r for r in score.relevance(rows, day()).collect()}
    assert got[0].score >= 0.6 and got[0].reasons[-1].startswith("Final Score = ")
    assert got[1].score == 0 and got[1].reasons == ["Blocked keyword: airport"]
    assert 0 < got[2].score < 0.5 and got[3].score == 0 and len(got[3].reasons) == 1 and got[5].score == 0
    assert "Non-preferred region (kerala)" in got[4].reasons and "Preferred region (delhi)" in got[0].reasons


def test_freshness(spark):
    days = [-1, 0, 7, 8, 30, 31, None]
    rows = spark.createDataFrame([(d,) for d in days], "d int").withColumn("due", F.date_add(day(), F.col("d")))
    assert [r.x for r in rows.select(score.freshness(F.col("due"), day()).alias("x")).collect()] == [0.0, 0.08, 0.08, 0.12, 0.12, 0.15, 0.02]


def test_qualify(spark):
    good = {"title": "Notice inviting tender for structural audit", "organization": "PWD", "source_url": "http://x", "deadline": "2026-03-01"}
    rows = opp(spark, good, {"title": "RFP", "deadline": "01/01/2026"}, good | {"description": "registration form"}).withColumn("score", F.when(F.col("pos") == 1, 0.3).otherwise(0.6))
    got = {r.pos: r for r in qualify.qualify(rows, day()).collect()}
    assert got[0].qualified and got[0].qualification_reasons == ["Passed qualification"]
    assert got[1].qualification_reasons == ["Invalid or low-quality tender document", "Title too short", "Missing source URL", "Expired tender", "No clear active opportunity signal", "Score below minimum threshold (0.30 < 0.60)"]
    assert got[2].qualification_reasons == ["Reference/application document, not an active opportunity"]


def plain_greedy(rows):
    norm = lambda x: " ".join("".join(c if c.isalnum() or c == "_" else " " for c in (x or "").lower()).split())
    kept = []
    for p, t, o, d, u in sorted(rows):
        t, o, d, u = norm(t), norm(o), norm(d), (u or "").strip().lower()
        if not any(u and u == y[4] or t and o and d and (t, o, d) == y[1:4] or o and d and (o, d) == y[2:4] and t and difflib.SequenceMatcher(None, t, y[1]).ratio() >= 0.92 for y in kept):
            kept.append((p, t, o, d, u))
    return [k[0] for k in kept]


@pytest.mark.parametrize("seed", range(4))
def test_greedy_equals_the_sequential_pass(spark, seed):
    rng = random.Random(seed)
    titles = ["structural audit of bridge block a", "structural audit of bridge block b", "structural audit of bridge block ab", "proof checking of tower", "", None]
    rows = [(i, rng.choice(titles), rng.choice(["o1", "o2", ""]), rng.choice(["d1", "d2", None]), rng.choice([f"u{k}" for k in range(12)] + ["", None])) for i in range(40)]
    df = spark.createDataFrame(rows, "pos long, title string, organization string, deadline string, source_url string")
    assert sorted(r.pos for r in dedup.greedy(df).collect()) == plain_greedy(rows)


def test_first_per_key_and_store_duplicates(spark):
    rows = opp(spark, {"title": "A b", "source_url": "u"}, {"title": "a B ", "source_url": "U"}, {"title": "", "source_url": "u"}, {"title": "c", "source_url": None})
    assert sorted(r.pos for r in dedup.distinct_urls(rows).collect()) == [0, 1]
    stored = spark.createDataFrame([("a b", "u"), ("", "")], "Title string, Source_Link string")
    assert sorted(r.pos for r in dedup.new_rows(rows, stored).collect()) == [2, 3]


def test_cleaner(spark):
    t = "Home\nScope of work\nPage 3 of 9\nrepeat me\nrepeat me\nrepeat me\nItem | 5\nItem | 5\nItem | 5\nWe use cookies here\nab\n----\n1.2 Clause\nIndex\nIntro .... 7\nReal   line\tof text\n"
    rows = spark.createDataFrame([(1, t), (2, "404 page\npage not found"), (3, None), (4, "donâ€™t")], "id int, text string")
    got = {r.id: r.text for r in clean.clean(rows).collect()}
    assert got[1] == "Scope of work\nItem | 5\nItem | 5\nItem | 5\n1.2 Clause\nReal line of text"
    assert got[2] == "" and got[3] == "" and got[4] == "don't"


def test_line_rules(spark):
    x = lambda v: F.array(*[F.lit(y) for y in v])
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(dedup.consecutive(x(["a", "a", "b", "a"]))) == ["a", "b", "a"]
    assert one(clean.without_pairs(x(["a", "b", "a", "b", "c", "a", "b"]))) == ["a", "b", "c", "a", "b"]
    assert one(clean.without_blocks(x(["Hi!"] * 4 + [str(i) for i in range(18)]))) == [str(i) for i in range(18)]
    p = ["Head\nbody one\nFoot", "Head\nbody two\nFoot", "Head\nbody three\nlast"]
    assert one(pages.without_headers(x(p))) == ["body one", "body two", "body three\nlast"]
    assert one(pages.without_headers(x(p[:2]))) == p[:2]
    assert one(pages.tidy(F.lit("a\r\nPage 4 of 28\n\n\n\nb  c"))) == "a\n\nb c"


def test_html(spark):
    body = "<html><body><nav>Menu</nav><main><h1>Head</h1><p>Para one<br>line<dl><dt>Term<dd>value</dl><div style='display:none'>no</div><ul><li>x<li>y</ul>" + "<p>tender text " * 20 + "</main><footer>f</footer></body></html>"
    rows = spark.createDataFrame([(1, "http://h/p/", body), (2, "http://h/", None)], "page_id long, url string, html string")
    got = {r.page_id: r.text.split("\n") for r in html.to_text(rows).collect()}
    assert got[1][:6] == ["Head", "Para one", "line", "Term : value", "• x", "• y"] and got[2] == [""]
    links = '<title>T</title><a href="/a.pdf#x">Tender document download</a><a href="mailto:x">m</a><a href="/a.pdf">again</a><table><tr><td>Road works</td><td><a href="b.html">view</a></td></tr></table><a href="/">home</a>'
    found = html.links(spark.createDataFrame([(1, "http://h/p/", links)], "page_id long, url string, html string"))
    assert [(r.url, r.label) for r in found.orderBy("n").collect()] == [("http://h/a.pdf", "Tender document download"), ("http://h/p/b.html", "Road works view")]
    assert html.best_link(found).first().best == "http://h/a.pdf"


def test_gates(spark):
    rows = spark.createDataFrame([
        ("u1", "text/html; charset=x", 200, b"<html>good</html>"), ("u2", "application/pdf", 200, b"<html>x"), ("u3", "application/pdf", 200, b"nope"), ("u4", "image/png", 200, b"x"), ("u5", "text/html", 404, b"x"),
        ("u6", "text/html", 200, b""), ("u7", "text/html", 200, b"<html>please login"), ("u8", "text/html", 200, b"<html>captcha"), ("u9", "application/octet-stream", 200, b"%PDF-1.4"), ("u10", None, 204, None),
    ], "url string, content_type string, status_code int, content binary")
    got = {r.url: (r.success, r.error_type, r.mime_type) for r in gates.fetched(rows).collect()}
    assert got["u1"] == (True, None, "text/html") and got["u9"] == (True, None, "application/pdf")
    assert {k: v[1] for k, v in got.items() if not v[0]} == {"u2": "fake_pdf_html", "u3": "invalid_pdf", "u4": "unsupported_content_type", "u5": "http_404", "u6": "empty_response", "u7": "login_page", "u8": "captcha_page", "u10": "empty_response"}
    texts = ["short", "page not found " * 20, "%%%%$$$$" * 30 + "a" * 50, "a plain text of words " * 20, "tender for bid " * 20]
    why = [r.x for r in spark.createDataFrame([(t,) for t in texts], "t string").select(gates.text_reject(F.col("t")).alias("x")).collect()]
    assert why == ["text_too_short", "error_page", "garbled_text", "no_document_signal", None]


TENDER = """Notice Inviting Tender
Name of work: Structural audit and retrofitting of administrative building
Issued by:
Public Works Department, Punjab
Published on 01/01/2026
Last date of submission: 15/03/2026
EMD: Rs. 25,000/-
Tender fee: 1,500
Location: Sector 17, Chandigarh
Contact: office@pwd.example.org, +91 9876543210
Scope of work
The consultant examines the structure and prepares drawings for the retrofit of all blocks.
Eligibility
Ten years."""


def test_parser(spark):
    rows = spark.createDataFrame([(1, TENDER), (2, None), (3, "   ")], "id int, text string")
    got = {r.id: r for r in parse.parse(rows).collect()}
    p = got[1].parsed
    assert p.title == "Structural audit and retrofitting of administrative building"
    assert p.organization == "Public Works Department, Punjab" and p.deadline == "2026-03-15" and p.location == "Sector 17, Chandigarh"
    assert (p.emd, p.document_fee, p.email, p.phone, p.tender_type) == ("25000", "1500", "office@pwd.example.org", "+91 9876543210", "NIT")
    assert p.description.startswith("The consultant examines") and "Ten years" not in p.description
    assert got[1].confidence == 1.0 and got[2].confidence == got[3].confidence == 0 and set(got[2].parsed) == {""}


def test_store(spark, tmp_path):
    path, now = f"{tmp_path}/store", F.lit("2026-02-01 10:00:00")
    rows = opp(spark, {"title": "First tender", "source_url": "http://a"}, {"title": "First tender ", "source_url": "http://A"}, {"title": "Second", "source_url": "ftp://b"}, {"title": "Third tender", "source_url": "http://c"})
    out = qualify.transform(rows.withColumn("score", F.lit(0.8)))
    assert store.save(spark, out, path, now) == {"saved": 2, "duplicates": 1, "invalid": 1}
    assert store.save(spark, out, path, now)["saved"] == 0
    saved = spark.read.parquet(path)
    assert sorted(r.Opportunity_ID for r in saved.collect()) == ["OPP-000001", "OPP-000002"] and len(saved.columns) == 21
    assert spark.range(1).select(store.identifier("X", F.lit(12345678)).alias("x")).first().x == "X-12345678"
    watch = spark.createDataFrame([(1, "Acme", "", ""), (2, "acme ", "", "")], "pos long, Company string, Last_Opportunity string, Last_Checked string")
    new = spark.createDataFrame([("ACME", "t")], "company string, title string")
    assert [r.Last_Opportunity for r in store.watch(watch, new, now).orderBy("pos").collect()] == ["t", ""]
    store.by_priority(saved, f"{tmp_path}/sheets")
    assert spark.read.parquet(f"{tmp_path}/sheets").select("sheet").distinct().first().sheet == "HIGH"


def test_insight(spark):
    s = spark.createDataFrame([("HIGH", "2026-03-01", True, "2026-01-05"), ("LOW", "2005-08-01", False, "2026-01-05T10:00:00"), ("MEDIUM", "x", True, "bad"), ("HIGH", "", False, "2026-01-06")], "Priority string, Deadline string, Qualified boolean, Date_Added string")
    k = insight.kpis(s, day()).first()
    assert (k.total, k.qualified, k.high_priority, k.upcoming) == (4, 2, 2, 1)
    assert [(str(r.day), r.n, r.qualified, r.rate) for r in insight.qualification_trend(s).collect()] == [("2026-01-05", 2, 1, 50.0), ("2026-01-06", 1, 0, 0.0)]
    assert [(r.priority, r.n) for r in insight.priority_distribution(s).collect()] == [("HIGH", 2), ("MEDIUM", 1), ("LOW", 1)]
    st = [tuple(r.x) for r in s.select(insight.deadline_status(F.col("Deadline"), day()).alias("x")).collect()]
    assert st == [("UPCOMING", 28, "28 days left"), ("EXPIRED", (datetime.date(2005, 8, 1) - datetime.date(2026, 2, 1)).days, "Expired"), ("INVALID", None, "Invalid deadline"), ("MISSING", None, "No deadline")]
    log = spark.createDataFrame([("2026-01-02", "SYSTEM", "DAILY_RUN", 1, "Queries=55 | Qualified=2 | Saved=2 | Duplicates=0 | Failed=0 | Reason=a=b; c"), ("2026-01-03", "SYSTEM", "DAILY_RUN", 1, "Queries=x")], "Timestamp string, Agent string, Action string, Records_Added int, Notes string")
    assert [(r.ts, r.queries, r.reason) for r in insight.run_audit(log).collect()] == [("2026-01-02", 55, "a=b; c")]


def test_discover(spark):
    v = [r.variant for r in discover.expand(spark.createDataFrame([("q",)], "query string"), 2026).orderBy("n").collect()]
    assert v[:4] == ["q tender 2026", "q 2026", "q", "q tender"] and len(v) == 12 and "q RFP PDF" in v
    b = discover.Budget(3)
    child = discover.Budget(1, b)
    assert child.consume() and not child.consume() and b.remaining == 2
    child.disable()
    assert not b.can_use()
    with pytest.raises(ValueError):
        discover.Budget(True)
    links = spark.createDataFrame([("a", "b", 1), ("a", "c", 2), ("b", "d", 3), ("d", "e", 4), ("c", "a", 5)], "from_url string, to_url string, pos long")
    got = [(r.url, r.depth) for r in discover.crawl(spark.createDataFrame([("s", "a")], "source string, url string"), links).orderBy("n").collect()]
    assert got == [("a", 0), ("b", 1), ("c", 1), ("d", 2)]


def test_assist(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(assist.strict_json(F.lit('```json\nso: {"a": 1}\n```')))["ok"] and not one(assist.strict_json(F.lit("none")))["ok"]
    assert one(assist.fallback(F.lit(" "), F.lit(None).cast("string"), F.lit("x"))) == "x" and one(assist.estimate(F.lit("abcdefgh"))) == 2
    assert one(assist.valid_response(F.lit('{"opportunities": []}'))) and not one(assist.valid_response(F.lit('{"opportunities": 1}')))


def test_intelligence_and_router(spark):
    rows = opp(spark, {"title": "Tender: structural audit of building"}, {"title": "HVAC retrofit tender"}, {"title": "Top 10 structural consultants"}, {"title": "Road bridge highway tender with retrofit of structure"}, {"title": "Structural audit"}, {})
    got = [r.intelligence for r in score.intelligence(rows).orderBy("pos").collect()]
    assert [g.is_relevant for g in got] == [True, False, False, False, False, False] and got[0].service_category == "structural audit" and got[0].confidence == 1.0
    assert [r.accepted for r in score.router(rows).orderBy("pos").collect()][:2] == [True, True]
