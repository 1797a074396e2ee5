"""Where landed responses lead: redirect chains by pointer doubling, and the source that a search result stands for."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from ..functions.text import text
from ..session import durable, forget
from . import html


def chase(redirects: DataFrame, most: int | None = None) -> DataFrame:
    """(url, final_url, hops, state) of every URL in redirects (url, to_url), as either.

    state: `direct` (redirects nowhere), `redirected`, `loop` (on a cycle or leading into one), `too_many` (more than most hops); the last two stay where they are and loops have no hops.
    Of several targets of a URL the smallest counts; blank ones are none. Each round doubles the steps of the open URLs, so a chain of n hops
    takes log2(n) rounds, and only open URLs are joined. A chain holds chains of every shorter length: a round that settles nothing leaves loops alone.
    """
    edges = durable(redirects.where("coalesce(url, '') <> '' and coalesce(to_url, '') <> ''").groupBy("url").agg(F.min("to_url").alias("at")))
    ends = edges.select(F.col("at").alias("url")).distinct().join(edges.select("url"), "url", "left_anti")
    ends = durable(ends.select("url", F.col("url").alias("at"), F.lit(0).cast("long").alias("hops")))
    step = edges.join(ends.select(F.col("url").alias("at"), F.lit(True).alias("done")), "at", "left")
    now = durable(step.select("url", "at", F.lit(1).cast("long").alias("hops"), F.coalesce("done", F.lit(False)).alias("done")))
    settled, rest = [ends, now.where("done").drop("done")], now.where("not done").drop("done")
    before = 0
    while (left := rest.count()) != before and left:
        before = left
        known = reduce(DataFrame.unionByName, [x.withColumn("done", F.lit(True)) for x in settled], rest.withColumn("done", F.lit(False)))
        known = known.select(F.col("url").alias("at"), F.col("at").alias("next"), F.col("hops").alias("more"), "done")
        now = durable(rest.join(known, "at").select("url", F.col("next").alias("at"), (F.col("hops") + F.col("more")).alias("hops"), "done"))
        settled.append(now.where("done").drop("done"))
        rest = now.where("not done").drop("done")
    forget(edges)
    told = reduce(DataFrame.unionByName, settled)
    state = F.when(F.col("hops") == 0, "direct").when(F.lit(most is not None) & (F.col("hops") > F.lit(most)), "too_many").otherwise("redirected")
    told = told.select("url", F.when(state == "too_many", F.col("url")).otherwise(F.col("at")).alias("final_url"), "hops", state.alias("state"))
    return told.unionByName(rest.select("url", F.col("url").alias("final_url"), F.lit(None).cast("long").alias("hops"), F.lit("loop").alias("state")))


#: Fixed value: redirects that a fetch follows.
MOST_HOPS = 30


def resolve(asked: DataFrame, landed: DataFrame, most: int = MOST_HOPS) -> DataFrame:
    """(url, final_url, hops, state, source) of every distinct URL of asked (url), from landed responses (url, redirect_to, status, content_type, html).

    A PDF stands for itself; a failed fetch (not landed, status 400 or more, a loop, too many hops) leaves the URL as it was; what a fetch ends at is the source
    unless it is HTML with a link that clearly scores as its document. Only pages that some URL ends at are parsed, each once. Of repeated responses of a URL the smallest by
    redirect, then status, counts. state is that of chase(), `failed`, or `pdf`. Blank URLs give blank sources.
    """
    plain = lambda c: urls.no_fragment(F.trim(text(c)))
    wanted = asked.select(plain("url").alias("url")).distinct()
    pages = landed.groupBy(plain("url").alias("page")).agg(F.min(F.struct(plain("redirect_to").alias("to"), F.coalesce("status", F.lit(200)).alias("status"), F.lower(text("content_type")).alias("kind"), F.col("html").cast("string").alias("html"))).alias("r"))
    pages = pages.select("page", "r.*")
    chased = chase(pages.select(F.col("page").alias("url"), F.col("to").alias("to_url")), most)
    ways = wanted.where(~urls.is_pdf(F.col("url"))).join(chased, "url", "left")
    ways = ways.select("url", F.coalesce("final_url", "url").alias("final_url"), F.coalesce("hops", F.when(F.coalesce("state", F.lit("direct")) != "loop", F.lit(0).cast("long"))).alias("hops"), F.coalesce("state", F.lit("direct")).alias("state"))
    ends = ways.where(F.col("state").isin("direct", "redirected") & ~urls.is_pdf(F.col("final_url"))).select(F.col("final_url").alias("page")).distinct()
    ended = durable(pages.join(ends, "page").where("status < 400").select("page", F.contains("kind", F.lit("html")).alias("is_html"), "html"))
    best = html.best_link(html.links(ended.where("is_html").select("page", "html"), url="page", keep=()), keep=())
    found = ended.select("page", "is_html").join(best.select(F.col("page_url").alias("page"), "best"), "page", "left").select(F.col("page").alias("final_url"), F.lit(True).alias("got"), "best")
    ways = ways.join(found, "final_url", "left")
    pdf, lost = urls.is_pdf(F.col("final_url")), F.col("state").isin("loop", "too_many")
    failed = ~lost & ~pdf & F.col("got").isNull()
    source = F.when(lost | failed, F.col("url")).when(pdf, F.col("final_url")).otherwise(F.coalesce("best", "final_url"))
    ways = ways.select("url", F.when(failed, F.col("url")).otherwise(F.col("final_url")).alias("final_url"), "hops", F.when(failed, "failed").otherwise(F.col("state")).alias("state"), source.alias("source"))
    own = wanted.where(urls.is_pdf(F.col("url"))).select("url", F.col("url").alias("final_url"), F.lit(0).cast("long").alias("hops"), F.lit("pdf").alias("state"), F.col("url").alias("source"))
    return ways.unionByName(own)
