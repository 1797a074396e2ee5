"""The store table: new rows only, ids, append, audit, contacts and the watch list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import strip, text
from ..session import durable
from .dedup import new_rows
from .qualify import store_format, valid_opportunity


def identifier(prefix: str, n: Column) -> Column:
    """`OPP-000001`; wider numbers are not cut."""
    return F.format_string(f"{prefix}-%06d", n)


def numbered(df: DataFrame, prefix: str, base: int, pos: str = "pos", out: str = "opportunity_id") -> DataFrame:
    """Ids from base + 1 in order of pos. Rows are range-partitioned by pos; only partition counts are gathered, no row meets all others."""
    at = durable(df.repartitionByRange(pos).sortWithinPartitions(pos).withColumn("_at", F.monotonically_increasing_id()))
    at = at.withColumns({"_part": F.shiftright("_at", 33).cast("int"), "_i": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
    counts = at.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return at.join(F.broadcast(before), "_part").withColumn(out, identifier(prefix, F.col("_before") + F.col("_i") + 1 + base)).drop("_at", "_part", "_i", "_before")


def save(spark: SparkSession, incoming: DataFrame, path: str, now: Column, pos: str = "pos") -> dict[str, int]:
    """Appends valid rows that the store lacks, with ids, and returns the counts saved, duplicates and invalid. A key that comes twice is saved once."""
    try:
        stored = spark.read.parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        stored = None
    good = durable(incoming.where(valid_opportunity(F.col("title"), F.col("source_url"))))
    fresh = new_rows(good, stored) if stored is not None else good
    t, u = F.lower(strip(text("title"))), F.lower(strip(text("source_url")))
    firsts = fresh.groupBy(t.alias("_t"), u.alias("_u"), F.when((t == "") | (u == ""), F.col(pos)).alias("_b")).agg(F.min(pos).alias(pos)).select(pos)
    fresh = numbered(fresh.join(firsts, pos, "left_semi"), "OPP", stored.count() if stored is not None else 0, pos)
    rows = durable(store_format(fresh).withColumns({"Last_Updated": now, "Date_Added": now}))
    rows.write.mode("append").parquet(path)
    saved, all_good, all_in = rows.count(), good.count(), incoming.count()
    return {"saved": saved, "duplicates": all_good - saved, "invalid": all_in - all_good}


def by_priority(df: DataFrame, path: str) -> None:
    """One folder a priority; an unknown one is LOW."""
    p = F.upper(strip(text("Priority")))
    df.withColumn("sheet", F.when(p.isin("HIGH", "MEDIUM"), p).otherwise("LOW")).write.mode("overwrite").partitionBy("sheet").parquet(path)


def activity(spark: SparkSession, path: str, ts: str, agent: str, action: str, added: int, notes: str = "") -> None:
    spark.createDataFrame([(ts, agent, action, added, notes)], "Timestamp string, Agent string, Action string, Records_Added int, Notes string").write.mode("append").parquet(path)


def contacts(df: DataFrame, base: int, now: Column, pos: str = "pos") -> DataFrame:
    have = set(df.columns)
    col = lambda n: text(F.col(n)) if n in have else F.lit("")
    rows = numbered(df, "CNT", base, pos, "Contact_ID")
    return rows.select("Contact_ID", *[col(n.lower()).alias(n) for n in ("Name", "Designation", "Company", "Email", "Phone", "LinkedIn", "Source", "Notes")], now.alias("Date_Added"))


def watch(watchlist: DataFrame, updates: DataFrame, now: Column, pos: str = "pos") -> DataFrame:
    """The watch list with Last_Opportunity and Last_Checked set on the first row, by pos, of each updated company (compared without case)."""
    key = lambda c: F.lower(strip(text(c)))
    first = watchlist.groupBy(key("Company").alias("_k")).agg(F.min(pos).alias("_p"))
    new = updates.groupBy(key("company").alias("_k")).agg(F.max("title").alias("_title"))
    hit = first.join(new, "_k").select("_p", "_title")
    rows = watchlist.join(hit, watchlist[pos] == hit._p, "left")
    found = F.col("_p").isNotNull()
    return rows.withColumns({"Last_Opportunity": F.when(found, F.coalesce("_title", F.lit(""))).otherwise(F.col("Last_Opportunity")), "Last_Checked": F.when(found, now).otherwise(F.col("Last_Checked"))}).drop("_p", "_title")


def merge(discovered: DataFrame, extracted: DataFrame, key: str, authoritative: list[str]) -> DataFrame:
    """Extracted rows with what discovery adds: authoritative columns come from extraction alone (null is empty), others from extraction, else discovery.

    Each extracted row gets one discovered row: of a repeated key the least by its columns in order.
    """
    rest = [c for c in discovered.columns if c != key]
    discovered = discovered.groupBy(key).agg(F.min(F.struct(*rest)).alias("_d")).select(key, *[F.col("_d").getField(c).alias(c) for c in rest]) if rest else discovered.distinct()
    both = list(dict.fromkeys([*extracted.columns, *discovered.columns]))
    e, d = extracted.alias("e"), discovered.alias("d")
    out = []
    for c in both:
        if c == key:
            out.append(F.col(f"e.{c}"))
        elif c in authoritative:
            out.append((text(F.col(f"e.{c}")) if c in extracted.columns else F.lit("")).alias(c))
        else:
            out.append(F.coalesce(*[F.col(f"{s}.{c}") for s, f in (("e", extracted), ("d", discovered)) if c in f.columns]).alias(c))
    return e.join(d, F.col(f"e.{key}") == F.col(f"d.{key}"), "left").select(*out)
