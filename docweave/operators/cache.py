"""Landed copies with an expiry: what a reader at a time would have found in the cache."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def as_of(asked: DataFrame, landed: DataFrame, ttl: int, key: str = "key", at: str = "at", value: str = "value") -> DataFrame:
    """asked (key, at, ...) with hit, landed_at and value: the last landed (key, at, value) of the key that is no later and younger than ttl, all in one unit of time.

    Time is cut into stretches of ttl, so a copy can only serve its own stretch and the next, into which the last copy of each stretch is carried. A window over key and stretch then
    finds every request's copy: linear in the rows, and a key that everything asks for is spread over time. A copy that lands at the time of a request serves it; of several at one time the
    largest value does. Null keys and times find nothing. An empty table gives no rows.
    """
    stretch = lambda c: F.floor(c / ttl).cast("long")
    copies = landed.where(f"`{key}` is not null and `{at}` is not null").select(F.col(key).alias("_k"), F.col(at).cast("long").alias("_at"), F.struct(F.col(at).cast("long").alias("at"), F.col(value).alias("value")).alias("_v")).withColumn("_b", stretch(F.col("_at")))
    carried = copies.groupBy("_k", "_b").agg(F.max("_v").alias("_v")).select("_k", F.col("_v.at").alias("_at"), "_v", (F.col("_b") + 1).alias("_b"))
    row = F.struct(*[F.col(f"`{c}`") for c in asked.columns])
    wanted = asked.select(row.alias("_row"), F.col(key).alias("_k"), F.col(at).cast("long").alias("_at")).withColumn("_b", stretch(F.col("_at")))
    every = wanted.unionByName(copies, allowMissingColumns=True).unionByName(carried, allowMissingColumns=True)
    order = Window.partitionBy("_k", "_b").orderBy("_at", F.col("_row").isNotNull(), "_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = every.withColumn("_f", F.last("_v", ignorenulls=True).over(order)).where("_row is not null")
    hit = F.coalesce((F.col("_f.at") > F.col("_at") - ttl) & F.col("_k").isNotNull(), F.lit(False))
    out = [F.col("_row").getField(c).alias(c) for c in asked.columns]
    return found.select(*out, hit.alias("hit"), F.when(hit, F.col("_f.at")).alias("landed_at"), F.when(hit, F.col("_f.value")).alias("found"))
