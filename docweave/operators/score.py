"""Scoring and classification, each as one staged expression (multiplications happen between additions, so order is part of the result)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, urls
from ..functions import lexicons as lx
from ..functions.lexicon import Lexicon, hits
from ..functions.num import flags, round2, text2
from ..functions.text import contained, contains_any, no_hyphen, once, squeeze, strip, text

FIELDS = ("title", "description", "summary", "location", "organization", "source", "source_url")
METADATA = ("title", "organization", "location", "deadline", "description", "email", "phone", "source_url")


@dataclass(frozen=True)
class Policy:
    """The lexicons and weights of the relevance score."""

    blocked: Lexicon = field(default_factory=lambda: Lexicon.of(lx.BLOCKED).without(*lx.BLOCK_EXEMPT))
    core: Lexicon = field(default_factory=lambda: Lexicon.of(lx.CORE))
    secondary: Lexicon = field(default_factory=lambda: Lexicon.of(lx.SECONDARY))
    procurement: Lexicon = field(default_factory=lambda: Lexicon.of(lx.PROCUREMENT))
    service: Lexicon = field(default_factory=lambda: Lexicon.of(lx.SERVICE))
    boost: Lexicon = field(default_factory=lambda: Lexicon.of(lx.REGION_BOOST))
    penalty: Lexicon = field(default_factory=lambda: Lexicon.of(lx.REGION_PENALTY))
    organizations: Lexicon = field(default_factory=lambda: Lexicon.of(lx.ORGANIZATIONS))
    sources: Lexicon = field(default_factory=lambda: Lexicon.of(lx.SOURCES))
    negative: Lexicon = field(default_factory=lambda: Lexicon.of(lx.NEGATIVE))
    title_terms: Lexicon = field(default_factory=lambda: Lexicon.of(lx.TITLE_TERMS))


def freshness(deadline: Column, as_of: Column) -> Column:
    """By days left: none known .02, past 0, up to 7 .08, up to 30 .12, more .15."""
    days = F.datediff(deadline, as_of)
    return F.when(deadline.isNull(), 0.02).when(days < 0, 0.0).when(days <= 7, 0.08).when(days <= 30, 0.12).otherwise(0.15)


def metadata(df_columns: Sequence[str], names: Sequence[str] = METADATA) -> Column:
    filled = flags(*[strip(text(n)) != "" for n in names if n in df_columns])
    return F.least(filled * F.lit(0.015), F.lit(0.12))


def region(prepared: Column, policy: Policy) -> Column:
    """The first boosted region's weight, else minus the first penalised one's, else 0."""
    return F.coalesce(policy.boost.first_weight(prepared), -policy.penalty.first_weight(prepared), F.lit(0.0))


def relevance(df: DataFrame, as_of: Column, policy: Policy | None = None) -> DataFrame:
    """Adds score (0 to 1, two decimals) and reasons (array) to rows with the opportunity columns; the deadline is a date or text.

    Absent columns and nulls count as empty. Intermediate columns are dropped.
    """
    p, have = policy or Policy(), set(df.columns)
    zones = _zones(have)
    rows = df.withColumn("_t", zones["all"])
    t = F.col("_t")
    rows = rows.withColumns({
        "_blocked": p.blocked.first(t), "_cores": p.core.list_(t), "_seconds": p.secondary.list_(t), "_proc": p.procurement.any_(t), "_services": p.service.list_(t),
        "_up": p.boost.first(t), "_down": p.penalty.first(t), "_org": F.coalesce(p.organizations.first_weight(zones["organization"]), F.lit(0.0)), "_src": F.coalesce(p.sources.first_weight(zones["source"]), F.lit(0.0)),
        "_negs": p.negative.list_(t), "_title": p.title_terms.count(zones["title"]),
    })
    one = lambda lexicon, c: lexicon.weigh(F.array_compact(F.array(c)))
    rows = rows.withColumns({
        "_core": p.core.weigh(F.col("_cores")), "_second": p.secondary.weigh(F.col("_seconds")), "_neg": p.negative.weigh(F.col("_negs")),
        "_region": F.when(F.col("_up").isNotNull(), one(p.boost, F.col("_up"))).when(F.col("_down").isNotNull(), -one(p.penalty, F.col("_down"))).otherwise(0.0),
    })
    out = _scored(rows, as_of, df.columns).withColumn("_s", F.struct("score", "reasons")).drop("score", "reasons")
    return once(out, F.array("_s"), "_once").select(*df.columns, "_once.score", "_once.reasons")


#: The lexicons of a policy, and the part of a row that each is looked up in.
ZONES = {
    "blocked": "all", "core": "all", "secondary": "all", "procurement": "all", "service": "all", "boost": "all", "penalty": "all", "negative": "all",
    "organizations": "organization", "sources": "source", "title_terms": "title",
}


def policy_table(spark: SparkSession, policy: Policy | None = None) -> DataFrame:
    """(lexicon, ord, term, weight) of a policy."""
    p = policy or Policy()
    rows = [(name, i, t.lower(), float(w)) for name in ZONES for i, (t, w) in enumerate(getattr(p, name).terms)]
    return spark.createDataFrame(rows, "lexicon string, ord int, term string, weight double").coalesce(1)


def relevance_by_table(df: DataFrame, as_of: Column, lexicons: DataFrame, key: str = "pos") -> DataFrame:
    """relevance() with its lexicons in a table (lexicon, ord, term, weight) of any size; key tells the rows of df apart.

    The texts' word stretches are joined with the terms once for all lexicons. What comes back for a row is the terms it holds.
    """
    have = set(df.columns)
    zones = _zones(have)
    put = F.create_map(*[F.lit(x) for pair in ZONES.items() for x in pair])
    terms = lexicons.where(F.col("lexicon").isin(*ZONES)).withColumn("_zone", F.element_at(put, F.col("lexicon")))
    found = [hits(df.select(F.col(key).alias("_key"), c.alias("_text")), "_key", F.col("_text"), terms.where(F.col("_zone") == z)) for z, c in zones.items()]
    each = reduce(DataFrame.unionByName, found).groupBy("_key").agg(F.array_sort(F.collect_list(F.struct("lexicon", "ord", "term", F.col("weight").cast("double").alias("weight")))).alias("_hits"))
    rows = df.join(each, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
    of = lambda name: F.filter("_hits", lambda h: h["lexicon"] == name)
    names = lambda name: F.coalesce(F.transform(of(name), lambda h: h["term"]), F.array().cast("array<string>"))
    total = lambda name: F.coalesce(F.aggregate(of(name), F.lit(0.0), lambda a, h: a + h["weight"]), F.lit(0.0))
    first = lambda name, field: F.get(of(name), F.lit(0))[field]
    rows = rows.withColumns({
        "_blocked": first("blocked", "term"), "_cores": names("core"), "_seconds": names("secondary"), "_proc": F.size(names("procurement")) > 0, "_services": names("service"),
        "_up": first("boost", "term"), "_down": first("penalty", "term"), "_org": F.coalesce(first("organizations", "weight"), F.lit(0.0)), "_src": F.coalesce(first("sources", "weight"), F.lit(0.0)),
        "_negs": names("negative"), "_title": F.size(names("title_terms")), "_core": total("core"), "_second": total("secondary"), "_neg": total("negative"),
        "_region": F.coalesce(first("boost", "weight"), -first("penalty", "weight"), F.lit(0.0)),
    })
    return _scored(rows, as_of, df.columns)


def _zones(have: set[str]) -> dict[str, Column]:
    """The lower-cased texts that lexicons are looked up in."""
    col = lambda n: text(F.col(n).cast("string")) if n in have else F.lit("")
    return {
        "all": F.lower(F.concat_ws(" ", *[col(n) for n in FIELDS])), "organization": F.lower(col("organization")),
        "source": F.lower(F.concat(col("source"), F.lit(" "), col("source_url"))), "title": F.lower(col("title")),
    }


def _scored(rows: DataFrame, as_of: Column, have: Sequence[str]) -> DataFrame:
    """Score and reasons from what the lexicons found."""
    due = dates.parse(text(F.col("deadline").cast("string")) if "deadline" in have else F.lit(""), "score")
    rows = rows.withColumns({"_core": F.least("_core", F.lit(0.55)), "_neg": F.least("_neg", F.lit(0.30)), "_area": F.coalesce("_up", "_down"), "_fresh": freshness(due, as_of), "_meta": metadata(have)})
    s = F.when(F.size("_cores") > 0, F.col("_core")).otherwise(F.col("_second"))
    s = F.when(F.col("_proc"), s + F.lit(0.20)).otherwise(s * F.lit(0.80))
    n = F.size("_services")
    s = F.when(n > 0, s + F.least(n * F.lit(0.04), F.lit(0.20))).otherwise(s * F.lit(0.90))
    s = s + F.col("_region") + F.col("_org") + F.col("_src") + F.col("_fresh") + F.col("_meta") - F.col("_neg")
    s = s + F.when(F.col("_title") >= 3, 0.10).when(F.col("_title") == 2, 0.08).when(F.col("_title") == 1, 0.05).otherwise(0.0)
    s = F.when((F.size("_negs") > 0) & (n == 0), s * F.lit(0.85)).otherwise(s)
    none = (F.size("_cores") == 0) & (F.size("_seconds") == 0)
    score = F.when(F.col("_blocked").isNotNull() | none, F.lit(0.0)).otherwise(round2(F.greatest(F.lit(0.0), F.least(F.lit(1.0), s))))
    rows = rows.withColumn("score", score)
    told = F.array_compact(F.array(
        F.when(F.size("_cores") > 0, F.concat(F.lit("Core: "), F.array_join("_cores", ", "))).otherwise(F.concat(F.lit("Secondary: "), F.array_join("_seconds", ", "))),
        F.when(F.col("_proc"), F.lit("Procurement signal")).otherwise(F.lit("No procurement signal")),
        F.when(n > 0, F.concat(F.lit("Service: "), F.array_join("_services", ", "))).otherwise(F.lit("No service signal")),
        F.when(F.col("_region") > 0, F.concat(F.lit("Preferred region ("), F.col("_area"), F.lit(")"))).when(F.col("_region") < 0, F.concat(F.lit("Non-preferred region ("), F.col("_area"), F.lit(")"))),
        F.when(F.col("_org") > 0, F.lit("Preferred organization")), F.when(F.col("_src") > 0, F.lit("Official source")),
        F.when(F.size("_negs") > 0, F.concat(F.lit("Negative: "), F.array_join("_negs", ", "))), F.when(F.col("_title") > 0, F.concat(F.lit("Title terms: "), F.col("_title").cast("string"))),
        F.concat(F.lit("Final Score = "), text2(F.col("score"))),
    ))
    reasons = F.when(F.col("_blocked").isNotNull(), F.array(F.concat(F.lit("Blocked keyword: "), F.col("_blocked")))).when(none, F.array(F.lit("No structural relevance found"))).otherwise(told)
    return rows.withColumn("reasons", reasons).drop(*[c for c in rows.columns if c.startswith("_") and c not in have])


def discovery(title: Column, snippet: Column, url: Column) -> Column:
    """Additive substring score of a search hit; -1 for one to skip is left to skip_hit()."""
    u, t = F.lower(text(url)), F.lower(F.concat_ws(" ", text(title), text(snippet)))
    official = F.when(contains_any(u, lx.OFFICIAL_DOMAINS), 5).otherwise(0)
    return official + 2 * contained(u, lx.SEARCH_URL_HINTS) + 2 * contained(t, lx.SEARCH_POSITIVE) - 4 * contained(t, lx.SEARCH_NEGATIVE)


def skip_hit(title: Column, url: Column) -> Column:
    t, u = F.lower(text(title)), F.lower(text(url))
    return contains_any(t, lx.SEARCH_BAD_TITLES) | contains_any(u, lx.SEARCH_BAD_DOMAINS) | contains_any(u, lx.SEARCH_BAD_PATHS)


def router(df: DataFrame) -> DataFrame:
    """Adds discovery_score, discovery_reasoning and accepted (score >= 10) to search rows (title, snippet, description, source_url)."""
    strong, cons, tender, other = (Lexicon.of(x) for x in (lx.ROUTER_STRONG, lx.ROUTER_CONSULTANCY, lx.ROUTER_TENDER, lx.ROUTER_UNRELATED))
    rows = df.withColumn("_t", F.lower(F.concat_ws(" ", *[text(c) for c in ("title", "snippet", "description", "source_url") if c in df.columns]))).withColumn("_u", F.lower(text("source_url")))
    rows = rows.withColumns({"_s": strong.list_(F.col("_t")), "_c": cons.list_(F.col("_t")), "_d": tender.list_(F.col("_t")), "_x": other.list_(F.col("_t")), "_h": contains_any(F.col("_u"), lx.ROUTER_URL_HINTS), "_b": contains_any(F.col("_u"), lx.ROUTER_BAD_URLS)})
    n = {c: F.size(c) for c in ("_s", "_c", "_d", "_x")}
    gate = ~F.col("_b") & (n["_s"] > 0) & ((n["_d"] > 0) | (n["_c"] > 0) | F.col("_h"))
    total = F.least(30 * n["_s"], F.lit(120)) + F.least(15 * n["_c"], F.lit(60)) + F.least(10 * n["_d"], F.lit(40)) + F.when(F.col("_h"), 10).otherwise(0) - F.least(25 * n["_x"], F.lit(75))
    rows = rows.withColumn("discovery_score", F.when(gate, F.greatest(total, F.lit(0))).otherwise(0).cast("int"))
    why = F.concat_ws(" | ", *[F.when(n[c] > 0, F.concat(F.lit(f"{name}: "), F.array_join(c, ", "))) for c, name in (("_s", "Strong"), ("_c", "Consultancy"), ("_d", "Tender"), ("_x", "Unrelated"))])
    return rows.withColumns({"discovery_reasoning": why, "accepted": F.col("discovery_score") >= 10}).drop("_t", "_u", "_s", "_c", "_d", "_x", "_h", "_b")


def category(prepared: Column, categories: Mapping[str, Sequence[str]] = lx.CATEGORIES, default: str = lx.DEFAULT_CATEGORY) -> Column:
    """The first category, in order, any of whose words occur."""
    return F.coalesce(*[F.when(Lexicon.of(words, "word_nohyphen").any_(prepared), F.lit(name)) for name, words in categories.items()], F.lit(default))


def intelligence(df: DataFrame) -> DataFrame:
    """Adds the struct intelligence (is_relevant, service_category, summary, why_selected, confidence) by a cascade of gates."""
    lex = lambda x: Lexicon.of(x, "word_nohyphen")
    part = lambda c: no_hyphen(text(c)) if c in df.columns else F.lit("")
    rows = df.withColumns({"_t": part("title"), "_d": part("description"), "_s": part("snippet"), "_u": F.lower(text("source_url")) if "source_url" in df.columns else F.lit("")})
    rows = rows.withColumn("_all", F.concat_ws(" ", *[F.when(F.col(c) != "", F.col(c)) for c in ("_t", "_d", "_s", "_u")]))
    a = F.col("_all")
    tender = lex(lx.TENDER_SIGNALS).any_(a) | contains_any(F.col("_u"), lx.TENDER_URLS)
    rows = rows.withColumn("_tender", tender)
    listing = lex(lx.DIRECTORY)
    context = lex(lx.STRUCTURAL_CONTEXT).any_(a)
    direct = [t for t in lx.STRUCTURAL if t not in lx.CONTEXT_DEPENDENT]
    rows = rows.withColumns({
        "_dir": listing.any_(F.col("_t")) | (~F.col("_tender") & (contains_any(F.col("_u"), lx.DIRECTORY_URLS) | listing.any_(F.col("_d")))),
        "_ctx": context, "_neg": lex(lx.INTELLIGENCE_NEGATIVE).list_(a), "_direct": lex(direct).list_(a), "_soft": lex(lx.CONTEXT_DEPENDENT).list_(a),
        "_other": lex(lx.OTHER_RETROFIT).list_(a), "_cat": category(a), "_info": contains_any(a, lx.INFORMATIONAL),
    })
    rows = rows.withColumn("_pos", F.array_distinct(F.concat("_direct", F.when(F.col("_ctx"), F.col("_soft")).otherwise(F.array().cast("array<string>")))))
    swap = lex(["retrofit", "retrofitting", "rehabilitation", "strengthening"]).any_(a) & (F.size("_other") > 0) & ~F.col("_ctx")
    pos, neg = F.size("_pos"), F.size("_neg")
    confidence = round2(pos / F.greatest(pos + neg, F.lit(1)))
    title = F.concat(F.lit(" Title: "), F.col("_t"))
    why = lambda reason: F.concat_ws(" | ", F.when(pos > 0, F.concat(F.lit("Positive signals: "), F.array_join("_pos", ", "))), F.when(neg > 0, F.concat(F.lit("Negative signals: "), F.array_join("_neg", ", "))), *([F.lit(reason)] if reason else []))
    made = lambda ok, cat, said, reason, conf: F.struct(F.lit(ok).alias("is_relevant"), cat.alias("service_category"), said.alias("summary"), reason.alias("why_selected"), conf.cast("double").alias("confidence"))
    no = F.lit(lx.DEFAULT_CATEGORY)
    zero = F.lit(0.0)
    out = (
        F.when((F.col("_t") == "") & (F.col("_d") == "") & (F.col("_s") == ""), made(False, no, F.lit("No usable tender information available."), F.lit("No usable title, description or snippet."), zero))
        .when(F.col("_dir"), made(False, no, F.concat(F.lit("Informational or directory listing."), title), F.lit("Rejected informational/directory/listing page."), zero))
        .when(swap, made(False, no, F.concat(F.lit("Non-structural retrofit work."), title), F.concat(F.lit("Rejected non-structural retrofit/service work: "), F.array_join("_other", ", ")), zero))
        .when(pos == 0, made(False, no, F.concat(F.lit("No clear structural relevance detected."), title), why(""), zero))
        .when((neg > 0) & (neg >= pos), made(False, no, F.concat(F.lit("Dominated by unrelated signals."), title), why("Negative service signals outweigh structural relevance."), zero))
        .when(~F.col("_tender"), made(False, F.col("_cat"), F.concat(F.lit("Structural relevance without a tender signal."), title), why("Rejected because no tender/procurement signal was detected."), zero))
        .when(F.col("_info"), made(False, no, F.concat(F.lit("Opportunity ("), no, F.lit(")."), title), why("Rejected informational/directory/listing page."), zero))
        .otherwise(made(True, F.col("_cat"), F.concat(F.lit("Opportunity ("), F.col("_cat"), F.lit(")."), title), why(""), confidence))
    )
    return rows.withColumn("intelligence", out).select(*df.columns, "intelligence")


def verdict(confidence: Column, service_category: Column, score: Column) -> Column:
    """struct(qualified, action, qualification_score): pursue, review or reject."""
    c = F.lower(strip(text(service_category)))
    conf, s = F.coalesce(confidence, F.lit(0.0)), F.coalesce(score, F.lit(0.0))
    pursue, review = c.isin(lx.PURSUE) & (conf >= 0.60), c.isin(lx.REVIEW) & (s >= 0.50)
    action = F.when(pursue, "PURSUE").when(review, "REVIEW").otherwise("REJECT")
    return F.struct((pursue | review).alias("qualified"), action.alias("action"), round2(conf * 0.60 + s * 0.40).alias("qualification_score"))


def experience(location: Column, title: Column, regions: Mapping = lx.EXPERIENCE) -> Column:
    """By region .35 for a place, .35 for a kind of project, .10 for a client; 1 at most."""
    place, name = F.lower(text(location)), F.lower(text(title))
    low = lambda xs: [x.lower() for x in xs]
    s = F.lit(0.0)
    for r in regions.values():
        s = s + F.when(contains_any(place, low(r["locations"])), 0.35).otherwise(0.0)
        s = s + F.when(contains_any(name, low(r["project_types"])), 0.35).otherwise(0.0)
        s = s + F.when(contains_any(name, low(r["clients"])), 0.10).otherwise(0.0)
    return F.least(s, F.lit(1.0))


def legacy(location: Column, title: Column, source: Column, domain: Mapping[str, float]) -> Column:
    """.45 experience + .45 domain words - .40 penalties, clamped, two decimals."""
    t = F.lower(F.concat_ws(" ", text(title), text(source)))
    words, off = F.lit(0.0), F.lit(0.0)
    for w, x in domain.items():
        words = words + F.when(F.contains(t, F.lit(w.lower())), x).otherwise(0.0)
    for ws, x in lx.LEGACY_PENALTIES:
        off = off + F.when(contains_any(t, ws), x).otherwise(0.0)
    s = experience(location, title) * 0.45 + F.least(words, F.lit(1.0)) * 0.45 - F.least(off, F.lit(1.0)) * 0.40
    return round2(F.greatest(F.least(s, F.lit(1.0)), F.lit(0.0)))


def rank(df: DataFrame, score: str = "score", pos: str = "pos") -> DataFrame:
    """Rows with a positive castable score, two decimals, with priority, best first; ties by position."""
    s = F.col(score).cast("string").try_cast("double")
    return df.withColumn(score, round2(s)).where(s > 0).withColumn("priority", priority(F.col(score))).orderBy(F.desc(score), pos)


def priority(score: Column) -> Column:
    return F.when(score >= 0.70, "HIGH").when(score >= 0.50, "MEDIUM").otherwise("LOW")


def source_score(tokens: Column, catalog: Column, weight: Column) -> Column:
    """2 for each query token in the catalog text, and half the priority."""
    return F.size(F.filter(tokens, lambda x: F.contains(catalog, x))) * 2 + F.coalesce(weight, F.lit(0)) * 0.5


def navigation_score(label: Column, url: Column) -> Column:
    t = F.lower(F.concat_ws(" ", text(label), text(url)))
    paths = [x for x in lx.CRAWL_NAVIGATION if " " not in x][:12]
    return contained(t, lx.CRAWL_NAVIGATION) + 2 * contained(F.lower(urls.path(url)), [f"/{p}" for p in paths])


def candidate_score(label: Column, url: Column, tokens: Column, context: Column) -> Column:
    """Query words, structural, tender and evidence words of a crawled link, and 2 for a document."""
    t = F.lower(F.concat_ws(" ", text(label), text(url), text(context)))
    asked = F.size(F.filter(tokens, lambda x: (F.length(x) >= 3) & F.contains(t, x)))
    buying = ["tender", "rfp", "rfq", "eoi", "bid", "procurement", "empanelment", "expression of interest", "request for proposal"]
    return asked + 2 * contained(t, lx.CRAWL_STRONG) + contained(t, lx.CRAWL_TENDER) + 2 * contained(t, buying) + contained(t, lx.CRAWL_EVIDENCE) + F.when(urls.is_document(url), 2).otherwise(0)


def link_score(link: Column, label: Column, page_url: Column) -> Column:
    """How likely a page's link is the document it announces."""
    u, t = F.lower(text(link)), F.lower(F.concat_ws(" ", text(link), text(label)))
    pdf, near, home = urls.is_pdf(link), urls.same_domain(link, page_url), contains_any(urls.host(link), lx.GOVERNMENT_DOMAINS)
    action = contains_any(F.lower(squeeze(text(label))), ["download", "view tender", "tender document", "view document", "bid document"])
    wanted = F.least(12 * contained(t, lx.LINK_TENDER), F.lit(60))
    words = Lexicon.of(lx.LINK_IRRELEVANT).count(F.lower(F.concat_ws(" ", text(label), F.regexp_replace(u, "[_/.-]", " "))))
    s = F.when(pdf, 35).otherwise(0) + wanted + F.when(action, 25).otherwise(0) + F.when(home, 15).otherwise(0) + F.when(contains_any(t, lx.LINK_PDF), 10).otherwise(0)
    return s - 60 * words + F.when(near, 10).otherwise(0) - F.when(pdf & ~near & (wanted < 12), 40).otherwise(0)
