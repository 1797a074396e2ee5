import datetime
import difflib

from pyspark.sql import functions as F

from docweave.functions import dates, num, urls
from docweave.functions import text as tx
from docweave.functions.lexicon import Lexicon


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


def test_round2_is_half_even_on_the_binary_value(spark):
    xs = [0.105 + 0.55 + 0.2, 0.125, 0.135, 2.675, 1.005, 0.015, 1234567.895, -0.125, 0.0]
    got = [r.x for r in spark.createDataFrame([(x,) for x in xs], "v double").select(num.round2(F.col("v")).alias("x")).collect()]
    assert got == [round(x, 2) for x in xs]


def test_word_boundaries_are_unicode(spark):
    x = Lexicon.of(["port", "été", "owner's engineer"])
    rows = spark.createDataFrame([("airport",), ("the port.",), ("port_1",), ("l'été!",), ("étés",), ("Owner's Engineer",), (None,)], "t string")
    assert [r.n for r in rows.select(x.count(x.prepared(tx.text("t"))).alias("n")).collect()] == [0, 1, 0, 1, 0, 1, 0]


def test_lexicon_forms(spark):
    x = Lexicon.of({"a b": 0.25, "c": 0.5})
    t = x.prepared(F.lit("C and A B"))
    r = spark.range(1).select(x.sum_(t).alias("s"), x.first(t).alias("f"), x.list_(t).alias("l"), x.any_(t).alias("a"), x.first_weight(t).alias("w"), x.without("c").count(t).alias("n")).first()
    assert (r.s, r.f, r.l, r.a, r.w, r.n) == (0.75, "a b", ["a b", "c"], True, 0.25, 1)
    h = Lexicon.of(["pre-engineered building"], "word_nohyphen")
    assert one(spark, h.any_(h.prepared(F.lit("Pre engineered-building"))))
    assert [r.term for r in x.table(spark, "l").orderBy("ord").collect()] == ["a b", "c"]


def test_dates(spark):
    cases = {"2026-07-01": (2026, 7, 1), "2026-7-1": (2026, 7, 1), "1/7/2026": (2026, 7, 1), "01.07.26": (2026, 7, 1), "1-7-69": (1969, 7, 1), "1 July 2026": (2026, 7, 1), "1 Jul 2026": (2026, 7, 1), "July 1, 2026": (2026, 7, 1), "1-JUL-2026": (2026, 7, 1), "31/02/2026": None, "soon": None, "": None}
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", dates.parse(F.col("t"), "parser").alias("d")).collect()
    assert {r.t: r.d and (r.d.year, r.d.month, r.d.day) for r in rows} == cases
    assert one(spark, dates.iso(F.lit("2026-7-1"))) is None and one(spark, dates.iso(F.lit("2026-07-01T10:00:00"))) == datetime.date(2026, 7, 1)


def test_ratio_is_difflibs_in_its_order(spark):
    rows = spark.createDataFrame([("tide", "diet"), ("diet", "tide"), (None, "x")], "a string, b string")
    assert [r.x for r in rows.select(tx.ratio(F.col("a"), F.col("b")).alias("x")).collect()] == [difflib.SequenceMatcher(None, a, b).ratio() for a, b in (("tide", "diet"), ("diet", "tide"), ("", "x"))]


def test_strip_and_forms(spark):
    assert one(spark, tx.strip(F.lit("\t a b  "))) == "a b"
    assert one(spark, tx.canonical(F.lit(" A-b,  C_d! "))) == "a b c_d"
    assert one(spark, tx.no_punctuation(F.lit("A-b, c"))) == "ab c"
    assert one(spark, tx.token_overlap(F.lit("a b c"), F.lit("b c d"))) == 2 / 3
    assert one(spark, tx.nfkc(F.lit("ﬁne"))) == "fine" and one(spark, tx.repaired(F.lit("cafÃ©"))) == "café"


def test_urls(spark):
    u = "HTTP://Ex.org/A//b/?utm_source=x&b=2&a=1&ref=z#top"
    assert one(spark, urls.canonical(F.lit(u))) == one(spark, urls.canonical_plain(F.lit(u))) == "http://ex.org/a//b?a=1&b=2"
    assert one(spark, urls.normalized(F.lit(" http://e.org//a//b/#x"))) == "http://e.org/a/b"
    assert one(spark, urls.is_document(F.lit("http://e.org/x.PDF?y"))) and not one(spark, urls.is_bad(F.lit("http://e.org/archive/x.pdf"))) and one(spark, urls.is_bad(F.lit("http://e.org/archive/x")))
