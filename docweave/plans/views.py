"""The driver tables as the engine's inputs: an opportunity view of documents and a store view of orders, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import text

AS_OF = "2026-02-01"
STORE_AS_OF = "1998-01-01"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def opportunities(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("pos"), F.substring_index(text("text"), "\n", 1).alias("title"), text("text").alias("description"), text("source").alias("organization"), text("lang").alias("location"),
        text("source").alias("source"), F.concat(F.lit("https://"), text("source"), F.lit(".example/"), (F.col("doc_id") % 400).cast("string")).alias("source_url"),
        F.date_format(F.date_add(F.lit("2026-01-01").cast("date"), (F.col("doc_id") % 120).cast("int")), "yyyy-MM-dd").alias("deadline"),
    )


OPPORTUNITIES = """
    SELECT doc_id AS pos, split_part(coalesce(text, ''), chr(10), 1) AS title, coalesce(text, '') AS description, coalesce(source, '') AS organization, coalesce(lang, '') AS location,
           coalesce(source, '') AS source, 'https://' || coalesce(source, '') || '.example/' || (doc_id % 400) AS source_url,
           strftime(DATE '2026-01-01' + CAST(doc_id % 120 AS INTEGER), '%Y-%m-%d') AS deadline
    FROM documents"""


def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    p = F.substring("o_orderpriority", 1, 1)
    rows = o.join(c, o.o_custkey == c.c_custkey, "left")
    k = F.col("o_orderkey")
    due = F.date_format(F.date_add(F.col("o_orderdate").cast("date"), 30), "yyyy-MM-dd")
    return rows.select(
        k.alias("pos"), F.format_string("OPP-%06d", k).alias("Opportunity_ID"), F.when(p.isin("1", "2"), "HIGH").when(p == "3", "MEDIUM").otherwise("LOW").alias("Priority"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Date_Added"), F.when(F.col("o_orderstatus") == "F", "TRUE").otherwise("FALSE").alias("Qualified"),
        F.when(k % 17 == 0, "").when(k % 19 == 0, "soon").otherwise(due).alias("Deadline"), F.col("c_name").alias("Organization"),
        F.when(k % 23 == 0, "see www.example.org").otherwise(F.col("o_orderpriority")).alias("Location"), F.when(k % 29 == 0, "").otherwise(F.concat(F.lit("https://store.example/"), k.cast("string"))).alias("Source_Link"),
        F.concat(F.lit("Order "), k.cast("string")).alias("Title"), F.col("o_orderstatus").alias("Opportunity_Status"), (F.col("o_totalprice") / 500000.0).alias("Score"), F.col("o_orderpriority").alias("Service_Category"),
    )


STORE = """
    SELECT o_orderkey AS pos, CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'HIGH' WHEN substr(o_orderpriority, 1, 1) = '3' THEN 'MEDIUM' ELSE 'LOW' END AS Priority,
           strftime(o_orderdate, '%Y-%m-%d') AS Date_Added, CASE WHEN o_orderstatus = 'F' THEN 'TRUE' ELSE 'FALSE' END AS Qualified,
           CASE WHEN o_orderkey % 17 = 0 THEN '' WHEN o_orderkey % 19 = 0 THEN 'soon' ELSE strftime(CAST(o_orderdate AS DATE) + 30, '%Y-%m-%d') END AS Deadline, c_name AS Organization,
           CASE WHEN o_orderkey % 23 = 0 THEN 'see www.example.org' ELSE o_orderpriority END AS Location,
           CASE WHEN o_orderkey % 29 = 0 THEN '' ELSE 'https://store.example/' || o_orderkey END AS Source_Link,
           'Order ' || o_orderkey AS Title, o_orderstatus AS Opportunity_Status, o_totalprice / 500000.0 AS Score, o_orderpriority AS Service_Category
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey"""


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An activity log from events: one daily run an hour, some with broken or repeated counts."""
    e = read(spark, sf_dir, "events")
    k = F.col("event_id")
    notes = F.concat(F.lit("Queries="), (k % 60).cast("string"), F.lit(" | Qualified="), (k % 7).cast("string"), F.lit(" | Saved="), F.when(k % 31 == 0, "x").otherwise((k % 5).cast("string")), F.lit(" | Duplicates="), (k % 3).cast("string"), F.lit(" | Failed="), (k % 2).cast("string"), F.lit(" | Reason=a=b; "), F.col("event_type"), F.when(k % 16 == 0, " | Saved=9").otherwise(""))
    return e.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("Timestamp"), F.when(k % 4 == 0, "system ").otherwise("USER").alias("Agent"), F.when(k % 8 == 0, "daily_run").otherwise("SAVE").alias("Action"), (k % 5).cast("int").alias("Records_Added"), notes.alias("Notes"))
