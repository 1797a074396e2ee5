"""Query expansion, source selection, bounded crawling over landed links, and quotas, set at a time."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicons as lx
from ..functions import urls
from ..functions.text import text
from ..session import durable


def expand(queries: DataFrame, year: int, column: str = "query") -> DataFrame:
    """(query, n, variant): the ordered distinct variants of every query."""
    q = F.col(column)
    forms = [F.concat(q, F.lit(f" tender {year}")), F.concat(q, F.lit(f" {year}"))]
    for s in lx.SUFFIXES:
        forms.append(F.concat(q, F.lit(f" {s}")) if s else q)
        if s in ("RFP", "EOI"):
            forms.append(F.concat(q, F.lit(f" {s} PDF")))
    return queries.select(q.alias("query"), F.posexplode(F.array_distinct(F.array(*forms))).alias("n", "variant"))


def tokens(query: Column) -> Column:
    return F.regexp_extract_all(F.lower(text(query)), F.lit("[a-z0-9]+"), F.lit(0))


#: Phrases that a query may hold.
PHRASES = ["structural audit", "proof checking", "peer review", "structural consultant", "structural consultancy", "structural engineering", "structural design", "expression of interest", "request for proposal", "notice inviting tender", "design consultant", "engineering consultant"]


def phrases(query: Column) -> Column:
    q = F.array_join(tokens(query), " ")
    known = F.array(*[F.lit(p) for p in PHRASES])
    return F.array_distinct(F.concat(F.array(q), F.filter(known, lambda p: F.contains(q, p))))


def select_sources(queries: DataFrame, catalog: DataFrame, most: int = 15) -> DataFrame:
    """(query, n, url, score): for every query its best sources by score, ties by catalog order; a query that no source fits takes the catalog's first.

    Queries meet sources through words alone: a token scores where it is part of a word of the source's text, so distinct words give their stretches of the tokens' lengths, which are joined with the
    distinct tokens. A source without a token of a query can only be chosen for its priority, and then it is one of the catalog's `most` best by that; no other pair is made.
    """
    base = F.greatest(F.col("_priority") * 0.5, F.lit(0.0))
    sources = catalog.select("url", "pos", F.lower(text("text")).alias("_text"), F.coalesce("priority", F.lit(0)).cast("double").alias("_priority"))
    asked = queries.select(F.col("query").alias("_q")).distinct()
    asked_tokens = asked.select("_q", F.explode(tokens(F.col("_q"))).alias("t")).groupBy("_q", "t").agg(F.count("*").alias("times"))
    sizes = [r.n for r in asked_tokens.select(F.length("t").alias("n")).distinct().collect()]  # no more than the longest token has letters
    words = sources.select("url", "pos", "_priority", F.explode(F.array_distinct(F.regexp_extract_all("_text", F.lit("[a-z0-9]+"), F.lit(0)))).alias("w"))
    every = words.sparkSession.range(0).select(F.lit("").alias("_q"), F.lit("").alias("url"), F.lit(0).alias("pos"), F.lit(0.0).alias("_priority"), F.lit(0).cast("long").alias("c"))
    if sizes:
        stretch = lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.length("w") - n + 1, F.lit(1))), lambda i: F.substring("w", i, F.lit(n)))
        parts = words.select("w").distinct().select("w", F.explode(F.array_distinct(F.concat(*[stretch(n) for n in sizes]))).alias("t"))
        met = parts.join(asked_tokens.select("t").distinct(), "t")
        held = words.join(met, "w").select("url", "pos", "_priority", "t").distinct()
        every = held.join(asked_tokens, "t").groupBy("_q", "url", "pos", "_priority").agg(F.sum("times").alias("c"))
    best = sources.select("url", "pos", "_priority").orderBy(F.desc(base), "pos", "url").limit(most).collect()
    if best:
        told = F.from_json(F.lit(json.dumps([[r.url, r.pos, r._priority] for r in best])), "array<array<string>>")
        own = asked.select("_q", F.explode(told).alias("s")).select("_q", F.col("s")[0].alias("url"), F.col("s")[1].cast(catalog.schema["pos"].dataType).alias("pos"), F.col("s")[2].cast("double").alias("_priority"), F.lit(0).cast("long").alias("c"))
        every = every.unionByName(own) if sizes else own
    score = F.greatest(F.max("c") * 2 + F.col("_priority") * 0.5, F.lit(0.0))
    scored = every.groupBy("_q", "url", "pos", "_priority").agg(score.alias("score"))
    w = Window.partitionBy("_q")
    ranked = scored.withColumn("_k", F.row_number().over(w.orderBy(F.desc("score"), "pos", "url"))).where(F.col("_k") <= most)
    fits = ranked.withColumn("_most", F.max("score").over(w)).where("score > 0 or _most = 0")
    return queries.select("query").join(fits, F.col("query").eqNullSafe(F.col("_q"))).select("query", (F.col("_k") - 1).alias("n"), "url", "score")


def flatten(nested: DataFrame, category: str = "category", sources: str = "sources", order: str = "pos") -> DataFrame:
    """A nested catalog (order, category, sources: array of schema.SOURCE) as rows in its order: pos, category, name, url, text, priority and pages, the source's own page and those that its paths name.

    text is what select_sources() looks in: category, keywords, services and sectors. Sources without a URL or switched off go; of sources with one URL the first stays. Pages are normalised,
    without repeats, in order.
    """
    rows = nested.select(F.col(order).alias("_o"), F.col(category).alias("_c"), F.posexplode(sources).alias("_i", "_s")).where("coalesce(_s.enabled, true) and trim(coalesce(_s.url, '')) <> ''")
    home = urls.normalized(F.col("_s.url"))
    lists = [F.coalesce(F.col(f"_s.{n}"), F.array().cast("array<string>")) for n in ("keywords", "services", "sectors")]
    told = F.lower(F.array_join(F.concat(F.array(F.coalesce(F.col("_s.category"), F.col("_c"), F.lit(""))), *lists), " "))
    paths = F.coalesce(F.col("_s.paths"), F.array().cast("array<string>"))
    pages = F.filter(F.array_distinct(F.concat(F.array(home), F.transform(paths, lambda p: urls.normalized(F.concat(F.regexp_replace(home, "/+$", ""), F.lit("/"), F.ltrim(p, F.lit("/"))))))), lambda u: u != "")
    flat = rows.where(home != "").select("_o", "_i", F.col("_c").alias("category"), F.col("_s.name").alias("name"), home.alias("url"), told.alias("text"), F.coalesce("_s.priority", F.lit(0)).alias("priority"), pages.alias("pages"))
    first = flat.groupBy("url").agg(F.min(F.struct("_o", "_i")).alias("f")).select("url", "f._o", "f._i")
    flat = flat.join(first, ["url", "_o", "_i"], "left_semi")
    return flat.select((F.col("_o") * (1 << 20) + F.col("_i")).cast("long").alias("pos"), "category", "name", "url", "text", "priority", "pages")


def crawl(start: DataFrame, links: DataFrame, depth: int = 2, most_pages: int = 12) -> DataFrame:
    """(source, url, depth, n): pages visited from start (source, url) over links (from_url, to_url, pos), breadth first, each once, at most so many a source.

    Pages of a round stand in the order in which their parents were visited, then of the links (ties by url). A source's front never
    holds more than most_pages pages, so a hub costs its own links once a source, not those of all pages around it.
    """
    order = Window.partitionBy("source").orderBy("parent", "pos", "url")
    first = start.select("source", "url", F.lit(0).alias("parent"), F.lit(0).cast("long").alias("pos")).distinct()
    seen = front = durable(first.withColumn("n", F.row_number().over(order)).where(F.col("n") <= most_pages).select("source", "url", F.lit(0).alias("depth"), "n"))
    for d in range(1, depth + 1):
        met = front.join(links.select("from_url", "to_url", F.col("pos").cast("long").alias("pos")), front.url == F.col("from_url")).select("source", F.col("to_url").alias("url"), F.col("n").alias("parent"), "pos")
        met = met.groupBy("source", "url").agg(F.min(F.struct("parent", "pos")).alias("by")).select("source", "url", "by.parent", "by.pos")
        new = met.join(seen.select("source", "url"), ["source", "url"], "left_anti")
        new = new.withColumn("k", F.row_number().over(order)).where(F.col("k") <= most_pages)
        held = seen.groupBy("source").agg(F.max("n").alias("held"))
        new = new.join(held, "source").select("source", "url", F.lit(d).alias("depth"), (F.col("held") + F.col("k")).alias("n")).where(F.col("n") <= most_pages)
        front = durable(new)
        seen = seen.unionByName(front)
    return seen


def guided(start: DataFrame, expand: Callable[[DataFrame, bool], tuple[DataFrame, DataFrame]], depth: int = 2, most_pages: int = 12, most_found: int = 25) -> tuple[DataFrame, DataFrame]:
    """Pages (source, url, depth, n) and finds (source, k, link, score, n): a crawl that goes where links score best and gathers candidates on its way.

    expand(front, deeper) gives, for pages of a front (url), where to go on (url, to_url, score, pos; none needed unless deeper) and what is offered there (url, link, score, pos). A source's pages queue
    up page after page, each page's links by score, then pos; a URL is queued once, and most_pages are visited. Finds are taken page by page in the same way, the first of each link; the page
    that fills most_found is the last one visited. Every front is at most most_pages pages a source, so only visited pages are read and parsed.
    """
    order = Window.partitionBy("source").orderBy("parent", "down", "pos", "url")
    first = start.select("source", "url", F.lit(0).alias("parent"), F.lit(0.0).alias("down"), F.lit(0).cast("long").alias("pos")).distinct()
    seen = front = durable(first.withColumn("n", F.row_number().over(order)).where(F.col("n") <= most_pages).select("source", "url", F.lit(0).alias("depth"), "n"))
    finds = []
    for d in range(depth + 1):
        links, found = expand(front.select("url").distinct(), d < depth)
        finds.append(durable(front.join(found.select("url", "link", F.col("score").cast("double").alias("score"), F.col("pos").cast("long").alias("pos")), "url").select("source", "n", "link", "score", "pos")))
        if d == depth:
            break
        met = front.join(links.select("url", "to_url", (-F.col("score").cast("double")).alias("down"), F.col("pos").cast("long").alias("pos")), "url")
        met = met.groupBy("source", F.col("to_url").alias("url")).agg(F.min(F.struct(F.col("n").alias("parent"), "down", "pos")).alias("by")).select("source", "url", "by.*")
        new = met.join(seen.select("source", "url"), ["source", "url"], "left_anti")
        new = new.withColumn("k", F.row_number().over(order)).where(F.col("k") <= most_pages)
        held = seen.groupBy("source").agg(F.max("n").alias("held"))
        front = durable(new.join(held, "source").select("source", "url", F.lit(d + 1).alias("depth"), (F.col("held") + F.col("k")).alias("n")).where(F.col("n") <= most_pages))
        seen = seen.unionByName(front)
    every = reduce(DataFrame.unionByName, finds)
    once = every.groupBy("source", "link").agg(F.min(F.struct("n", (-F.col("score")).alias("down"), "pos")).alias("by")).select("source", "link", "by.*")
    ranked = once.withColumn("k", F.row_number().over(Window.partitionBy("source").orderBy("n", "down", "pos", "link"))).where(F.col("k") <= most_found)
    ranked = durable(ranked.select("source", "k", "link", (-F.col("down")).alias("score"), "n"))
    full = ranked.where(F.col("k") == most_found).select("source", F.col("n").alias("last"))
    return seen.join(full, "source", "left").where("last is null or n <= last").drop("last"), ranked


def quota(calls: DataFrame, key: str, order: str, per_key: int, in_all: int) -> DataFrame:
    """calls with allowed: within the key's limit and, of those, within the limit of all, in order. order tells calls apart; calls that share it are allowed or not together.

    Of each key only per_key calls can pass, so the global rank runs over in_all candidates: the top-k of the order.
    """
    w = Window.partitionBy(key).orderBy(order)
    first = calls.select(key, order).withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= per_key)
    passed = first.orderBy(order).limit(in_all).select(order).distinct().withColumn("allowed", F.lit(True))
    return calls.join(passed, order, "left").withColumn("allowed", F.coalesce("allowed", F.lit(False)))


class Budget:
    """A driver-side allowance, possibly within a parent's."""

    def __init__(self, limit: int, parent: Budget | None = None) -> None:
        if isinstance(limit, bool) or not isinstance(limit, int) or limit < 0:
            raise ValueError("a budget is a non-negative integer")
        self.limit, self.used, self.parent, self.enabled = limit, 0, parent, True

    @property
    def remaining(self) -> int:
        return max(self.limit - self.used, 0)

    def can_use(self) -> bool:
        return self.enabled and self.used < self.limit and (self.parent is None or self.parent.can_use())

    def consume(self) -> bool:
        if not self.can_use():
            return False
        self.used += 1
        return self.parent is None or self.parent.consume()

    def disable(self) -> None:
        self.enabled = False
        if self.parent:
            self.parent.disable()
