"""Aggregates and views over the store table, as a monitoring dashboard needs them. Today is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..functions import lexicons as lx
from ..functions.num import round2
from ..functions.text import contains_any, strip, text


def is_true(c: Column) -> Column:
    return F.coalesce(F.upper(strip(c.cast("string"))) == "TRUE", F.lit(False))


def kpis(store: DataFrame, as_of: Column) -> DataFrame:
    """One row: total, qualified, high priority, deadlines not passed."""
    due = dates.parse(F.col("Deadline"), "strict")
    return store.agg(
        F.count("*").alias("total"), F.count_if(is_true(F.col("Qualified"))).alias("qualified"),
        F.count_if(F.upper(strip(text("Priority"))) == "HIGH").alias("high_priority"), F.count_if(F.coalesce(due >= as_of, F.lit(False))).alias("upcoming"),
    )


def quality(store: DataFrame) -> DataFrame:
    """One row of data-quality counts."""
    due, place = strip(text(F.col("Deadline").cast("string"))), F.lower(strip(text("Location")))
    return store.agg(
        F.count_if(due == "").alias("missing_deadlines"), F.count_if((due != "") & dates.parse(due, "strict").isNull()).alias("invalid_deadlines"),
        F.count_if((place != "") & contains_any(place, lx.SUSPICIOUS_LOCATIONS)).alias("suspicious_locations"), F.count_if(strip(text("Source_Link")) == "").alias("missing_source_links"),
    )


def trend(store: DataFrame, column: str = "Date_Added") -> DataFrame:
    """Rows a day; unreadable days are left out."""
    return store.select(dates.iso(F.col(column)).alias("day")).where("day is not null").groupBy("day").agg(F.count("*").alias("n")).orderBy("day")


def qualification_trend(store: DataFrame) -> DataFrame:
    rows = store.select(dates.iso(F.col("Date_Added")).alias("day"), is_true(F.col("Qualified")).alias("q")).where("day is not null")
    out = rows.groupBy("day").agg(F.count("*").alias("n"), F.count_if("q").alias("qualified"))
    return out.withColumn("rate", round2(F.col("qualified") / F.col("n") * 100.0)).orderBy("day")


def priority_distribution(store: DataFrame) -> DataFrame:
    """Counts of HIGH, MEDIUM and LOW in this order; absent ones are left out."""
    p = F.upper(strip(text("Priority")))
    order = F.when(F.col("priority") == "HIGH", 1).when(F.col("priority") == "MEDIUM", 2).otherwise(3)
    return store.select(p.alias("priority")).where(F.col("priority").isin("HIGH", "MEDIUM", "LOW")).groupBy("priority").agg(F.count("*").alias("n")).orderBy(order)


def deadline_distribution(store: DataFrame, as_of: Column) -> DataFrame:
    due = dates.iso(F.col("Deadline"))
    return store.where(due.isNotNull()).groupBy(F.when(due >= as_of, "UPCOMING").otherwise("EXPIRED").alias("status")).agg(F.count("*").alias("n")).orderBy(F.desc("status"))


def deadline_status(deadline: Column, as_of: Column) -> Column:
    """struct(status, days, label) of a deadline's text."""
    t = strip(text(deadline.cast("string")))
    days = F.datediff(dates.parse(t, "strict"), as_of)
    made = lambda s, d, label: F.struct(F.lit(s).alias("status"), d.cast("int").alias("days"), label.alias("label"))
    left = F.concat(days.cast("string"), F.when(days == 1, " day left").otherwise(" days left"))
    return F.when(t == "", made("MISSING", F.lit(None), F.lit("No deadline"))).when(days.isNull(), made("INVALID", F.lit(None), F.lit("Invalid deadline"))).when(days < 0, made("EXPIRED", days, F.lit("Expired"))).when(days == 0, made("TODAY", days, F.lit("Due today"))).otherwise(made("UPCOMING", days, left))


SEARCHED = ("Title", "Organization", "Location", "Source", "Service_Category", "Summary")


def find(store: DataFrame, priority: str | None = None, status: str | None = None, search: str | None = None, least_score: float | None = None) -> DataFrame:
    """Rows that pass every condition given; search is a substring of any one of the searched columns."""
    out = store
    same = lambda c, v: F.upper(strip(text(c))) == v.strip().upper()
    if priority:
        out = out.where(same("Priority", priority))
    if status:
        out = out.where(same("Opportunity_Status", status))
    if least_score is not None:
        out = out.where(score_value(F.col("Score")) >= least_score)
    if search and search.strip():
        hit = F.lit(False)
        for c in SEARCHED:
            if c in store.columns:
                hit = hit | F.contains(F.lower(text(c)), F.lit(search.strip().lower()))
        out = out.where(hit)
    return out


def by_deadline(store: DataFrame, pos: str, limit: int | None = None) -> DataFrame:
    """Soonest first, unreadable deadlines last, ties by position."""
    out = store.orderBy(dates.parse(F.col("Deadline"), "strict").asc_nulls_last(), pos)
    return out.limit(limit) if limit else out


def facet(store: DataFrame, column: str) -> DataFrame:
    return store.select(strip(text(column)).alias("value")).where("value <> ''").distinct().orderBy("value")


def score_value(c: Column) -> Column:
    return F.coalesce(c.cast("string").try_cast("double"), F.lit(0.0))


def shortened(c: Column, limit: int | None = None) -> Column:
    t = strip(text(c))
    out = F.when(t == "", "—")
    if limit:
        out = out.when(F.length(t) > limit, F.concat(F.rtrim(F.substring(t, 1, limit - 1)), F.lit("…")))
    return out.otherwise(t)


COUNTS = ("Queries", "Qualified", "Saved", "Duplicates")


def run_audit(activity: DataFrame) -> DataFrame:
    """Daily runs from the activity log: notes `k=v | k=v` as counts and reason; of a repeated key the last stands; rows with a count that is no integer go. Newest first."""
    rows = activity.where((F.upper(strip(text("Agent"))) == "SYSTEM") & (F.upper(strip(text("Action"))) == "DAILY_RUN"))
    parts = F.filter(F.split(text("Notes"), r" \| "), lambda x: F.contains(x, F.lit("=")))
    rows = rows.withColumn("_n", F.transform(parts, lambda x: F.struct(strip(F.substring_index(x, "=", 1)).alias("k"), strip(F.substring(x, F.locate("=", x) + 1, F.length(x))).alias("v"))))
    note = lambda name: F.try_element_at(F.filter("_n", lambda e: e["k"] == name), F.lit(-1))["v"]
    out = rows.select(F.col("Timestamp").alias("ts"), *[note(c).try_cast("int").alias(c.lower()) for c in COUNTS], F.coalesce(note("Failed").try_cast("int"), F.lit(0)).alias("failed"), F.coalesce(note("Reason"), F.lit("")).alias("reason"))
    return out.dropna(subset=[c.lower() for c in COUNTS]).orderBy(F.desc("ts"))


def outcome(found: Column, saved: Column, duplicates: Column, failed: Column) -> Column:
    """What a run's counts amount to."""
    return (
        F.when(saved > 0, "Opportunities saved successfully")
        .when((found == 0) & (failed > 0), F.concat(F.lit("No qualified opportunities; pipeline failures="), failed.cast("string")))
        .when(found == 0, "No qualified opportunities")
        .when(duplicates == found, "All qualified opportunities were duplicates")
        .when(failed > 0, "No opportunities saved; pipeline failures occurred")
        .otherwise("No opportunities saved")
    )


def totals(df: DataFrame, by: str, counters: list[str]) -> DataFrame:
    """Sums by key and over all (null key)."""
    return df.rollup(by).agg(*[F.sum(c).alias(c) for c in counters])
