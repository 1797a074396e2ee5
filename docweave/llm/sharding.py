"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has CELLS cells; each shard has VNODES virtual nodes on it, and a cell belongs to the next virtual node clockwise. A
row's place is the hash of its text, so equal texts stand side by side. Each shard takes rows up to its bound; what
overflows a full shard goes on clockwise to the next virtual node whose shard has room. With bounds of floor(n/k) and
ceil(n/k) the counts are at most one apart, and only overflowing rows leave their own arc.

Rows are ordered by one range shuffle of ids and hashes (no text); a hot cell is many ranges, not one task. Only counts of
cells and of partitions reach the driver.
"""

from __future__ import annotations

import bisect
import json

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, small_table

CELLS, VNODES = 4096, 64


def ring(shards: int) -> list[int]:
    """The shard that owns each cell: that of the first virtual node at or after it, clockwise; of virtual nodes in one cell the smallest shard's stands."""
    nodes: dict[int, int] = {}
    for s in range(shards):
        for v in range(VNODES):
            at = xxhash.xxh64_intdigest(f"{s}/{v}") % CELLS
            nodes[at] = min(s, nodes.get(at, s))
    places = sorted(nodes)
    return [nodes[places[bisect.bisect_left(places, c) % len(places)]] for c in range(CELLS)]


def route(loads: list[int], owner: list[int], shards: int) -> list[tuple[int, int, int]]:
    """Splits each cell's rows: (cell, shard, rows) in ring order, within bounds that sum to all rows."""
    total = sum(loads)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    out, over = [], []
    for c, n in enumerate(loads):
        took = min(n, room[owner[c]])
        room[owner[c]] -= took
        if took:
            out.append((c, owner[c], took))
        if n > took:
            over.append((c, n - took))
    for c, n in over:
        at = c
        while n:
            at += 1
            s = owner[at % CELLS]
            if took := min(n, room[s]):
                room[s] -= took
                n -= took
                out.append((c, s, took))
            if at > c + CELLS:  # shards without a cell of their own, if any
                s = max(range(shards), key=room.__getitem__)
                took = min(n, room[s])
                room[s] -= took
                n -= took
                out.append((c, s, took))
    return sorted(out, key=lambda x: x[0])  # stable: a cell's own shard first, then clockwise


def assign(docs: DataFrame, shards: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of docs (doc_id, text), and the further columns keep; others are ignored, whatever their names.

    A null text counts as empty. Slots of a shard run from 0 without gaps in ring order; ties (equal texts) go by doc_id, null first.
    Repeated rows are each placed. An empty table gives no rows. Counts of any two shards differ by one at most.
    """
    spark = docs.sparkSession
    owner = ring(shards)
    text = F.coalesce("text", F.lit(""))
    cell = F.pmod(F.col("place"), F.lit(CELLS)).cast("int")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept") if keep else F.lit(None).cast("int").alias("kept"), "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("place")).withColumn("cell", cell)
    rows = rows.repartitionByRange("cell", "place", "doc_id").sortWithinPartitions("cell", "place", "doc_id")
    rows = durable(rows.withColumn("at", F.monotonically_increasing_id()))
    rows = rows.select("*", F.shiftright("at", 33).cast("int").alias("part"), F.col("at").bitwiseAND(F.lit((1 << 33) - 1)).alias("i"))
    offset, seen = [], 0
    for r in rows.groupBy("part").count().orderBy("part").collect():  # as many as partitions
        offset.append([r["part"], seen])
        seen += r["count"]
    loads = [0] * CELLS
    for r in rows.groupBy("cell").count().collect():  # CELLS at most
        loads[r["cell"]] = r["count"]
    start = [0]
    for n in loads:
        start.append(start[-1] + n)
    slots, ranges, cell_at = [0] * shards, [], {}
    for c, s, n in route(loads, owner, shards):
        lo = cell_at.get(c, start[c])
        ranges.append([c, lo, lo + n, s, slots[s] - lo])
        cell_at[c] = lo + n
        slots[s] += n
    # both tables are bounded: one row for each partition, and CELLS + shards ranges
    offsets = F.broadcast(small_table(spark, offset, "part int, before bigint"))
    parts = F.broadcast(small_table(spark, ranges, "cell int, lo bigint, hi bigint, shard int, shift bigint"))
    placed = rows.join(offsets, "part").withColumn("rank", F.col("before") + F.col("i"))
    placed = placed.join(parts, "cell").where("rank >= lo and rank < hi")
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("rank") + F.col("shift")).alias("slot"), *[F.col("kept").getField(c).alias(c) for c in keep])


def home(text: Column, shards: int) -> Column:
    """The shard that owns a text's place on the ring before any overflow."""
    table = F.from_json(F.lit(json.dumps(ring(shards))), "array<int>")
    return F.element_at(table, (F.pmod(F.xxhash64(F.coalesce(text, F.lit(""))), F.lit(CELLS)) + 1).cast("int"))
