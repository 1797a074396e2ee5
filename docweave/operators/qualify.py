"""Gates, qualification with all failing reasons, and the shapes that are stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..functions import lexicons as lx
from ..functions.num import round2, text2
from ..functions.text import contains_any, repaired, strip, text
from .score import priority

LEAST_SCORE = 0.60


def valid_tender(title: Column, organization: Column) -> Column:
    t = F.lower(strip(text(title)))
    return ~t.isin(lx.GENERIC_TITLES) & ~contains_any(t, lx.JUNK_TITLES) & (strip(text(organization)) != "")


def expired(deadline: Column, as_of: Column) -> Column:
    """A deadline that can't be read has not passed."""
    return F.coalesce(dates.parse(deadline, "pipeline") < as_of, F.lit(False))


def _body(title: Column, description: Column) -> Column:
    return F.lower(F.concat(text(title), F.lit(" "), text(description)))


def reference_document(title: Column, description: Column) -> Column:
    return contains_any(_body(title, description), lx.REFERENCE_PHRASES)


def active_signal(title: Column, description: Column) -> Column:
    return contains_any(_body(title, description), lx.ACTIVE_PHRASES)


def qualify(df: DataFrame, as_of: Column, least: float = LEAST_SCORE) -> DataFrame:
    """Adds qualified and qualification_reasons: every gate that fails, in order, or `Passed qualification`."""
    s = F.coalesce(F.col("score"), F.lit(0.0))
    t, d = F.col("title"), F.col("description")
    failed = F.array_compact(F.array(
        F.when(~valid_tender(t, F.col("organization")), "Invalid or low-quality tender document"),
        F.when(F.length(strip(text(t))) < 15, "Title too short"),
        F.when(strip(text("source_url")) == "", "Missing source URL"),
        F.when(expired(F.col("deadline"), as_of), "Expired tender"),
        F.when(reference_document(t, d), "Reference/application document, not an active opportunity"),
        F.when(~active_signal(t, d), "No clear active opportunity signal"),
        F.when(s < least, F.concat(F.lit("Score below minimum threshold ("), text2(s), F.lit(f" < {least:.2f})"))),
    ))
    rows = df.withColumn("qualification_reasons", failed)
    return rows.withColumn("qualified", F.size("qualification_reasons") == 0).withColumn("qualification_reasons", F.when(F.col("qualified"), F.array(F.lit("Passed qualification"))).otherwise(F.col("qualification_reasons")))


def valid_opportunity(title: Column, url: Column) -> Column:
    t, u = strip(text(title)), strip(text(url))
    return (F.length(t) >= 5) & ((u == "") | u.rlike("^https?://")) & title.isNotNull() & url.isNotNull()


def valid_email(email: Column) -> Column:
    return F.contains(text(email), F.lit("@")) & F.contains(text(email), F.lit("."))


def extraction_confidence(organization: Column, deadline: Column, location: Column) -> Column:
    lack = lambda c, w: F.when(text(c.cast("string")) == "", w).otherwise(0.0)
    return round2(F.lit(1.0) - lack(organization, 0.20) - lack(deadline, 0.10) - lack(location, 0.10))


def transform(df: DataFrame, repair: bool = True) -> DataFrame:
    """The output shape of scored, qualified rows. Text is repaired (mis-decoded UTF-8, then NFKC) unless repair is off."""
    have = set(df.columns)
    fix = (lambda c: repaired(c)) if repair else (lambda c: c)
    col = lambda n: text(F.col(n).cast("string")) if n in have else F.lit("")
    smart = (lambda n: F.coalesce(F.col(f"intelligence.{n}"), F.lit(""))) if "intelligence" in have else (lambda n: F.lit(""))
    either = lambda n: F.when(col(n) != "", col(n)).otherwise(smart(n))
    s = F.coalesce(F.col("score"), F.lit(0.0))
    keep = [c for c in ("pos",) if c in have]
    return df.select(
        *keep, fix(col("tender_type")).alias("type"), fix(col("title")).alias("title"), fix(col("organization")).alias("organization"), fix(either("service_category")).alias("service_category"),
        fix(col("location")).alias("location"), fix(col("source")).alias("source"), col("source_url").alias("source_url"), fix(col("deadline")).alias("deadline"), fix(either("summary")).alias("summary"),
        F.lit("NOT_CONTACTED").alias("contact_status"), F.lit("NEW").alias("opportunity_status"), priority(s).alias("priority"), round2(s).alias("score"),
        (F.concat_ws(" | ", "reasons") if "reasons" in have else F.lit("")).alias("reasoning"),
        (F.concat_ws(" | ", "qualification_reasons") if "qualification_reasons" in have else F.lit("")).alias("qualification_reasoning"), F.lit("").alias("assigned_to"),
        (F.col("qualified") if "qualified" in have else F.lit(False)).alias("qualified"), F.when(F.col("qualified") if "qualified" in have else F.lit(False), "QUALIFIED").otherwise("REJECTED").alias("qualification_status"),
        (F.coalesce(F.col("qualification_score"), s) if "qualification_score" in have else s).alias("qualification_score"), col("recommended_action").alias("recommended_action"),
        extraction_confidence(col("organization"), col("deadline"), col("location")).alias("extraction_confidence"), F.lit("v2").alias("parser_version"),
    )


#: Output column -> store column, in the store's order.
STORED = dict(zip(
    ["opportunity_id", "type", "title", "organization", "service_category", "location", "source", "source_url", "deadline", "contact_status", "opportunity_status", "priority", "score", "qualified",
     "qualification_score", "recommended_action", "qualification_reasoning", "summary", "assigned_to", "last_updated", "date_added"], lx.STORE_COLUMNS, strict=True,
))


def store_format(df: DataFrame) -> DataFrame:
    """The 21 store columns; the two timestamps are blank until rows are saved."""
    rows = df.withColumns({"last_updated": F.lit(""), "date_added": F.lit("")})
    return rows.select(*[F.col(a).alias(b) for a, b in STORED.items()])
