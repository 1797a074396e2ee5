"""The daily batch as one plan: discover, merge, extract, score, deduplicate, qualify, save, count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls
from ..functions.text import canonical, text
from ..operators import clean, dedup, gates, html, insight, pages, parse, qualify, score, store
from ..schema import AUTHORITATIVE
from ..session import durable


def discover(searched: DataFrame, crawled: DataFrame) -> DataFrame:
    """Both providers' rows, first of each canonical URL or title, scored, accepted ones with intelligence. Relevance is a column, not a filter."""
    both = searched.withColumn("discovery_source", F.lit("serp")).unionByName(crawled.withColumn("discovery_source", F.lit("scraper")), allowMissingColumns=True)
    once = dedup.router_dedup(both, urls.canonical(F.col("source_url")), canonical(text("title")))
    return score.intelligence(score.router(once).where("accepted"))


def extract(fetches: DataFrame) -> DataFrame:
    """Fetch records to parsed fields, with reject_reason where a gate stopped a row (its fields are empty then). PDF pages come as column pages, where landed."""
    rows = fetches.withColumn("kind", gates.route(F.col("final_url"), F.col("mime_type")))
    paged = pages.to_text(F.col("pages")) if "pages" in fetches.columns else F.lit("")
    web = html.to_text(rows.withColumn("html", F.when(F.col("success") & (F.col("kind") == "html"), F.make_valid_utf8(F.col("content").cast("string")))))
    # Python functions don't nest inside array functions: the page text is worked out first
    rows = durable(web.select("url", "success", "error_type", "kind", "text", *(["pages"] if "pages" in fetches.columns else []))).withColumn("text", F.when(F.col("kind") == "pdf", paged).otherwise(F.col("text")))
    # the clean text is read by many expressions below
    rows = durable(clean.clean(rows.select("url", "success", "error_type", "kind", "text")))
    why = F.coalesce(F.when(~F.col("success"), F.coalesce(F.col("error_type"), F.lit("fetch_failed"))), gates.url_reject(F.col("url")), F.when(F.col("kind") == "html", gates.boilerplate_reject(F.col("text"))), gates.text_reject(F.col("text")))
    rows = rows.withColumn("reject_reason", why)
    rows = parse.parse(rows.withColumn("text", F.when(F.col("reject_reason").isNull(), F.col("text"))))
    rows = rows.withColumn("reject_reason", F.coalesce("reject_reason", gates.structured_reject(F.col("parsed.title"))))
    return rows.select("url", "reject_reason", "confidence", "parsed.*", F.col("url").alias("source_url"))


def run(spark: SparkSession, discovered: DataFrame, fetches: DataFrame, path: str, as_of: Column, now: Column) -> dict[str, int]:
    """Saves what qualifies and returns the run's counts. discovered has pos and source_url."""
    found = durable(dedup.distinct_urls(discovered))
    good = durable(extract(fetches)).where("reject_reason is null").drop("url", "reject_reason", "confidence")
    merged = store.merge(found, good, "source_url", AUTHORITATIVE)
    kept = dedup.greedy(durable(merged))
    judged = durable(qualify.qualify(durable(score.relevance(kept, as_of)), as_of))
    passed = judged.where("qualified")
    saved = store.save(spark, qualify.transform(passed), path, now)
    return {"found": passed.count(), "processed": judged.count(), "failed": found.count() - merged.count(), **saved}


def reason(spark: SparkSession, counts: dict[str, int]) -> str:
    row = spark.range(1).select(insight.outcome(*[F.lit(counts[k]) for k in ("found", "saved", "duplicates", "failed")]).alias("r"))
    return row.first().r
