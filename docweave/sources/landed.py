"""Readers of landed inputs. Nothing here goes to a network: fetching is another system's task, this engine reads what it left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.gates import fetched


def documents(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files as fetch records, with the path as URL and the type by magic."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    kinds = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1))
    declared = F.when(kinds == "pdf", "application/pdf").when(kinds.isin("html", "htm"), "text/html").when(kinds == "xml", "text/xml").otherwise("application/octet-stream")
    return fetched(rows.select(F.col("path").alias("url"), declared.alias("content_type"), F.col("length").alias("declared_size"), "content"))


def pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages as Parquet; of repeated fetches of a URL the first by fetch order stands, failures too."""
    return spark.read.parquet(path)


def hits(spark: SparkSession, path: str, schema: str = "query string, title string, snippet string, link string, position int") -> DataFrame:
    """Landed answers of a search service, as JSON lines; broken lines are kept apart in _broken."""
    full = StructType.fromDDL(schema).add("_broken", "string")
    return spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_broken").json(path)


def table(spark: SparkSession, path: str, kind: str = "parquet", **options: str) -> DataFrame:
    """parquet, orc, csv (with header), json, text or avro (where its package is)."""
    reader = spark.read.options(**({"header": "true"} if kind == "csv" else {}), **options)
    return reader.format(kind).load(path)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").option("quoteAll", "true").csv(path)
