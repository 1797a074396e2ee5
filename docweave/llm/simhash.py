"""SimHash near-duplicates, found by covering locality-sensitive hashing.

A map phi gives each of the 64 bits a non-zero vector of GF(2)^4. For each of the 15 non-zero v the mask keeps the bits i
with <phi(i), v> = 1. Any three bit positions leave some v orthogonal to all three, so two fingerprints at three or fewer
differing bits agree under at least one mask: no pair within the radius is missed. Buckets with many members are split by
a further covering family over the bits their mask leaves free; after three levels so few bits are free that a bucket
is bounded, hence every bucket is resolved exactly and without emitting its pairs (each yields a spanning forest only).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from .common import durable, packed, pieces, small_batches, unpacked

RADIUS = 3
#: A bucket up to this size is resolved in one task, larger ones go to the next level. The masks of the third level leave ten bits free, so no bucket there is larger.
BUCKET = 1024


def _masks(bits: list[int]) -> list[int]:
    """15 masks over the given bit positions, each as nearly half of them as can be."""
    out = []
    for v in range(1, 16):
        out.append(sum(1 << b for k, b in enumerate(bits) if bin((k % 15 + 1) & v).count("1") & 1))
    return out


def covering(levels: int = 3) -> list[list[int]]:
    """Masks by level; mask p of a level refines mask p // 15 of the level before."""
    out = [_masks(list(range(64)))]
    for _ in range(levels - 1):
        out.append([m | x for m in out[-1] for x in _masks([b for b in range(64) if not m >> b & 1])])
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def simhash(text: bytes | None) -> int:
    """The 64-bit fingerprint of one text: majority of the XXH64 (seed 42) bits of its 3-word shingles; zero without words."""
    words = (text or b"").lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    shingles = map(b" ".join, zip(words, words[1:], words[2:])) if len(words) > 3 else iter([b" ".join(words)])
    n = max(1, len(words) - 2)
    h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 4096):
        ones += np.unpackbits(h[at : at + 4096].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("text").cast(pa.binary())
        out = np.empty(batch.num_rows, np.uint64)
        for lo, hi in pieces(column):
            for i, t in enumerate(column[lo:hi].to_pylist(), lo):
                out[i] = simhash(t)
        rest = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(out.view(np.int64))], names=[*rest, "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed long."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_prints, "doc_id long, fp long")


def _resolve(fp: np.ndarray, doc: np.ndarray, links: list) -> None:
    """Adds a spanning forest of one bucket's links."""
    left = np.arange(len(fp))
    while len(left) > 1:
        reached, left = left[:1], left[1:]
        while len(reached) and len(left):
            u, reached = reached[0], reached[1:]
            near = np.bitwise_count(fp[left] ^ fp[u]) <= RADIUS
            links.append((np.full(near.sum(), doc[u]), doc[left[near]]))
            reached, left = np.concatenate([reached, left[near]]), left[~near]


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (path, key, doc) -> links (a, b), and the rows of oversized buckets with path set."""
    held = [np.empty(0, np.int64)] * 4
    over = None  # the oversized bucket that is passing through

    def emit(links: list, big: list) -> Iterator[pa.RecordBatch]:
        a, b = (np.concatenate([x[i] for x in links]) if links else np.empty(0, np.int64) for i in (0, 1))
        path, fp, doc = (np.concatenate([x[i] for x in big]) if big else np.empty(0, np.int64) for i in (0, 1, 2))
        n, m = len(a), len(path)
        if n + m:
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([a, doc])), pa.array(np.concatenate([b, fp])),
                pa.array(np.concatenate([np.full(n, -1), path])),
            ], names=["a", "b", "path"])

    def work(cols: list, last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal held, over
        path, key, fp, doc = (np.concatenate(x) for x in zip(held, cols))
        links, big = [], []
        if len(path):
            new = np.flatnonzero((path[1:] != path[:-1]) | (key[1:] != key[:-1])) + 1
            starts, ends = np.concatenate([[0], new]), np.concatenate([new, [len(path)]])
            sizes = ends - starts
            if over is not None and over != (path[0], key[0]):
                over = None
            done = len(starts) if last else len(starts) - 1
            two = starts[:done][sizes[:done] == 2]
            if over is not None:
                two = two[two > 0]
            two = two[np.bitwise_count(fp[two].view(np.uint64) ^ fp[two + 1].view(np.uint64)) <= RADIUS]
            links.append((doc[two], doc[two + 1]))
            for g in np.flatnonzero(sizes[:done] > (1 if over is not None else 2)):
                s, e = starts[g], ends[g]
                if sizes[g] > BUCKET or g == 0 and over is not None:
                    big.append((path[s:e], fp[s:e], doc[s:e]))
                elif sizes[g] > 2:
                    _resolve(fp[s:e].view(np.uint64), doc[s:e], links)
            if over is not None and done and sizes[0] == 1:
                big.append((path[:1], fp[:1], doc[:1]))
            s = starts[-1]
            if last:
                held = [np.empty(0, np.int64)] * 4
            elif sizes[-1] > BUCKET or over is not None and len(starts) == 1:
                big.append((path[s:], fp[s:], doc[s:]))
                over, held = (path[s], key[s]), [np.empty(0, np.int64)] * 4
            else:
                held = [x[s:] for x in (path, key, fp, doc)]
                if done:
                    over = None
        yield from emit(links, big)

    for batch in batches:
        yield from work([batch.column(c).to_numpy(zero_copy_only=False) for c in ("path", "key", "fp", "doc")], False)
    yield from work([np.empty(0, np.int64)] * 4, True)


def links(nodes: DataFrame) -> DataFrame:
    """Links (a, b) of doc numbers that join all nodes (fp, doc; distinct in both) within the radius, as forests of the buckets."""
    rows, found = nodes.select(F.lit(0).cast("long").alias("up"), "fp", "doc"), None
    family = covering()
    for masks in family:
        several = F.from_json(F.lit(str([_signed(m) for m in masks])), "array<bigint>")
        spread = rows.select("up", "fp", "doc", F.explode(F.sequence(F.lit(0), F.lit(14))).alias("v"))
        path = F.col("up") * 15 + F.col("v")
        spread = spread.select(path.alias("path"), (F.col("fp").bitwiseAND(F.element_at(several, (path + 1).cast("int")))).alias("key"), "fp", "doc")
        out = durable(spread.repartition("path", "key").sortWithinPartitions("path", "key", "doc").mapInArrow(_linked, "a long, b long, path long"))
        edges = out.where("path < 0").select("a", "b")
        found = edges if found is None else found.unionByName(edges)
        rows = out.where("path >= 0").select(F.col("path").alias("up"), F.col("b").alias("fp"), F.col("a").alias("doc"))
        if rows.isEmpty():
            break
    else:
        raise AssertionError("three levels bound every bucket")
    return found


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in an edge (a, b); root is the smallest node reachable. Alternates large-star and small-star steps until nothing changes."""
    e = durable(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    said = None
    while True:
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (now.n, now.h) == said or not now.n:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        said = (now.n, now.h)
        both = e.select(F.col("a").alias("u"), F.col("b").alias("w")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("w")))
        least = durable(both.groupBy("u").agg(F.min("w").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.join(least, "u").where("w > u and w <> m").select(F.col("w").alias("a"), F.col("m").alias("b")).distinct()
        large = durable(large)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        e = durable(large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b"))).distinct())


def labels(prints: DataFrame, by_id: bool, more: DataFrame | None = None) -> DataFrame:
    """(fp, doc, root) of every fingerprint of prints (doc_id, fp), once: its least doc_id and the least fingerprint of its component; by_id joins the fingerprints of one doc_id too, more gives further links (a, b)."""
    nodes = durable(prints.groupBy("fp").agg(F.min("doc_id").alias("doc")))
    edges = links(nodes.select("fp", F.col("fp").alias("doc")))
    if by_id:
        several = prints.where("doc_id is not null").groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a <> z").select("doc_id", "a")
        edges = edges.unionByName(prints.join(several, "doc_id").select("a", F.col("fp").alias("b")).where("a <> b").distinct())
    root = components(edges if more is None else edges.unionByName(more))
    return durable(nodes.join(root, nodes.fp == root.node, "left").select("fp", "doc", F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) of every row of docs (doc_id, text); extra columns are ignored, whatever their names.

    Null, empty and white-space texts have fingerprint zero and are linked like any other. Equal fingerprints are one node, so groups of
    copies cost nothing further. Rows link if their fingerprints differ by three bits at most, or if they share a doc_id; component_id is the smallest
    doc_id reachable. Rows with a null doc_id are nodes like others; a component of such rows alone has a null component_id. Repeated rows are kept, long texts
    read whole. An empty table gives no rows.
    """
    prints = durable(fingerprints(docs))
    rooted = labels(prints, True)
    least = rooted.join(rooted.groupBy("root").agg(F.min("doc").alias("component_id")), "root").select("fp", "component_id")
    return prints.join(least, "fp", "left").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, also: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The columns of docs, whatever their names, of one row of each component of near copies (by doc_id and text).

    also, if given, tells of further near copies: from rows (th, text) the classes (th, root) of texts by their hash. Fingerprints of a class are linked like those within the radius.
    The row with the smallest doc_id stays, rows without a doc_id come last; ties go by the hash of the text, then of the row. Components are formed by
    texts alone: rows that share a doc_id but no text both stay, and of fully equal rows one stays. Rows whose text is null, empty or white space
    are copies of each other. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    whole = F.xxhash64(*[F.to_json(c) if isinstance(t, (MapType, VariantType)) else c for c, t in ((F.col(f"`{f.name}`"), f.dataType) for f in docs.schema)])
    rows = docs.select(packed(docs).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"), whole.alias("k"))
    prints = durable(rows.select("doc_id", "text", "h", "k").mapInArrow(_prints, "doc_id long, h long, k long, fp long"))
    more = None
    if also:
        named = prints.select(F.col("h").alias("th"), "fp").distinct().join(also(rows.select(F.col("h").alias("th"), "text")), "th")
        first = durable(named.groupBy("root").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a <> z").select("root", "a"))
        more = named.join(first, "root").select("a", F.col("fp").alias("b")).where("a <> b").distinct()
    rooted = labels(prints, False, more).select("fp", "root")
    rank = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "h", "k"))
    first = prints.groupBy("fp").agg(rank.alias("r")).join(rooted, "fp").groupBy("root").agg(F.min("r").alias("r")).select("r.h", "r.k")
    kept = rows.select("row", "h", "k").join(first, ["h", "k"], "left_semi")
    return kept.dropDuplicates(["h", "k"]).select(*unpacked(rows, "row"))
