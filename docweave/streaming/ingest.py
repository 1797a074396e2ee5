"""Incremental mode: landed opportunities as a stream, saved batch by batch, and windowed trends."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.urls import canonical_plain
from ..operators import qualify, score, store
from ..operators.dedup import greedy
from ..session import durable


def distinct_pages(stream: DataFrame, time: str = "ts", late: str = "1 day") -> DataFrame:
    """The first row of each canonical URL within the watermark."""
    return stream.withWatermark(time, late).withColumn("canonical_url", canonical_plain(F.col("source_url"))).dropDuplicatesWithinWatermark(["canonical_url"])


def trend(stream: DataFrame, time: str = "ts", width: str = "1 day", late: str = "1 day") -> DataFrame:
    return stream.withWatermark(time, late).groupBy(F.window(time, width)).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "n")


def saver(path: str, as_of: Callable[[], Column], now: Callable[[], Column], policy: score.Policy | None = None, told: Callable[[dict], None] | None = None) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: score, qualify, greedy deduplication inside the batch, then the store's own anti-join and append. A batch that is run again adds nothing."""

    def run(batch: DataFrame, number: int) -> None:
        scored = durable(score.relevance(batch.withColumn("deadline", F.col("deadline").cast("string")), as_of(), policy))
        kept = greedy(durable(qualify.qualify(scored, as_of()).where("qualified")))
        counts = store.save(batch.sparkSession, qualify.transform(kept), path, now())
        if told:
            told(counts | {"batch": number})

    return run


def start(stream: DataFrame, run: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = True) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
