"""Centroid clustering of integer vectors by Lloyd's rounds with exponion search.

Vectors are kept in blocks (one row holds up to BLOCK vectors as binary, two bytes a component where they fit), each with its current
centroid a, an upper bound u of the distance to it and a lower bound l of the distance to any other. After a round the
bounds move by how far the centroids moved. A vector whose bounds meet looks only at centroids inside the ball of radius 2u + s(a) around
a, s(a) being a's distance to its nearest neighbour: both its nearest and second nearest centroid lie there. Each centroid has
its neighbours sorted by distance, so the ball is a prefix of that list; prefixes are read up to the next power of two. Radii include
their edge and bounds are rounded outwards, distances themselves are exact integers: ties go to the smaller number always.

A round is one pass without a shuffle of vectors. Each task reports what entered and left its clusters since the round before; those
reports are summed by Spark and only one total for each centroid reaches the driver.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, forget, small_table

#: Vectors of a row of the blocks.
BLOCK = 4096
#: Centroids are held by every task and their mutual distances too, hence a bound.
MOST = 4096
#: Distances of components below these stay exact in doubles, in longs; beyond them Python's own integers count.
IN_DOUBLE, IN_LONG = 1 << 22, 1 << 27
#: Bounds are rounded outwards by this share.
SLACK = 1e-9

STATE = "n int, width int, ids binary, gone binary, v binary, a binary, u binary, l binary, dist array<bigint>"
MOVED = "moved array<struct<c:int, n:bigint, s:array<decimal(38,0)>>>, near array<struct<c:int, d:decimal(38,0)>>"


def numbers(embedding: Column) -> Column:
    """floor(256 x) of the components, as doubles (exact: a power of two only shifts)."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * 256).cast("double"))


def fits(embedding: Column, dims: int) -> Column:
    """Whether a vector has exactly dims components, none null, none infinite or not a number, and none beyond a long when scaled."""
    return (F.size(embedding) == dims) & ~F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double") * 256) >= 2.0**63))


def exact(v: np.ndarray) -> np.ndarray:
    """Vectors of longs in the cheapest type whose squared distances stay exact."""
    most = max(abs(int(v.max())), abs(int(v.min()))) if v.size else 0
    return v.astype(np.float64) if most < IN_DOUBLE else v.astype(np.int64) if most < IN_LONG else v.astype(object)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of x to all rows of c; both as exact() gives them."""
    kind = max((x.dtype, c.dtype), key=lambda t: (t == np.int64) + 2 * (t == object))
    x, c = x.astype(kind), c.astype(kind)
    return (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None, :]


def roots(d: np.ndarray) -> np.ndarray:
    return np.sqrt(d.astype(np.float64))


class Ball:
    """What a pass needs of the centroids: themselves, their neighbours by distance, and how far each has moved."""

    def __init__(self, centres: np.ndarray, before: np.ndarray | None):
        self.c = exact(centres)
        between = squared(self.c, self.c)
        np.fill_diagonal(between, 0)
        far = roots(between)
        self.order = np.argsort(far, axis=1, kind="stable")
        self.order[:, 0], swap = np.arange(len(far)), self.order[:, 0].copy()  # equal centroids: each comes first in its own list
        for i in np.flatnonzero(swap != np.arange(len(far))):
            self.order[i, 1:][self.order[i, 1:] == i] = swap[i]
        self.far = np.take_along_axis(far, self.order, 1)
        self.near = self.far[:, 1] if len(far) > 1 else np.full(len(far), np.inf)
        self.moved = np.zeros(len(far)) if before is None else roots(((exact(centres).astype(object) - before.astype(object)) ** 2).sum(1))


def assign(x: np.ndarray, a: np.ndarray, u: np.ndarray, low: np.ndarray, ball: Ball, counted: list[int] | None = None) -> None:
    """Moves each vector to its nearest centroid (ties: the smaller number), in place. a is -1 where nothing is known yet. counted[0] grows by the distances worked out."""
    k = len(ball.c)
    tell = counted if counted is not None else [0]

    def settle(rows: np.ndarray, some: np.ndarray) -> None:
        """rows look at the centroids some (ascending), which hold their two nearest."""
        d = squared(x[rows], ball.c[some])
        tell[0] += d.size
        best = d.argmin(1)  # the first of equals, so the smaller number
        a[rows] = some[best]
        least = d[np.arange(len(rows)), best]
        u[rows] = roots(least) * (1 + SLACK)
        if len(some) > 1:
            d = roots(d)
            d[np.arange(len(rows)), best] = np.inf
            low[rows] = d.min(1) * (1 - SLACK)
        else:
            low[rows] = np.inf

    if len(new := np.flatnonzero(a < 0)):
        settle(new, np.arange(k))
    old = np.setdiff1d(np.arange(len(a)), new, assume_unique=True)
    u[old] = (u[old] + ball.moved[a[old]]) * (1 + SLACK)
    low[old] = (low[old] - ball.moved.max(initial=0)) * (1 - SLACK)
    bound = lambda rows: np.maximum(low[rows], ball.near[a[rows]] / 2 * (1 - SLACK))
    rows = old[u[old] >= bound(old)]
    for c in np.unique(a[rows]):  # the distance to the own centroid first: it may settle the matter
        own = rows[a[rows] == c]
        u[own] = roots(squared(x[own], ball.c[c : c + 1])[:, 0]) * (1 + SLACK)
        tell[0] += len(own)
    rows = rows[u[rows] >= bound(rows)]
    was = a[rows]
    for c in np.unique(was):
        own = rows[was == c]
        inside = np.searchsorted(ball.far[c], (2 * u[own] + ball.near[c]) * (1 + SLACK), side="right")
        width = np.minimum(1 << np.ceil(np.log2(np.maximum(inside, 1))).astype(int), k)
        for w in np.unique(width):
            settle(own[width == w], np.sort(ball.order[c, :w]))  # what lies outside of the ball is further than the second nearest inside


def _blocks(dims: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (vec_id, v array<double>) to blocks without a centroid yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            v = flat.astype(np.int64)
            ids, gone = batch.column("vec_id"), batch.column("vec_id").is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(v), BLOCK):
                part = v[at : at + BLOCK]
                n = len(part)
                most = max(abs(int(part.max())), abs(int(part.min())))
                width = next((w for w in (2, 4) if most < 1 << (8 * w - 1)), 8)
                yield _row(n, width, ids[at : at + n], gone[at : at + n], part, np.full(n, -1, np.int32), np.zeros(n), np.zeros(n), None, [], [])

    return run


_SCHEMA = pa.schema([
    ("n", pa.int32()), ("width", pa.int32()), *[(c, pa.binary()) for c in ("ids", "gone", "v", "a", "u", "l")], ("dist", pa.list_(pa.int64())),
    ("moved", pa.list_(pa.struct([("c", pa.int32()), ("n", pa.int64()), ("s", pa.list_(pa.decimal128(38, 0)))]))), ("near", pa.list_(pa.struct([("c", pa.int32()), ("d", pa.decimal128(38, 0))]))),
])


def _row(n, width, ids, gone, v, a, u, low, dist, moved, near) -> pa.RecordBatch:
    held = [n, width, ids.astype("<i8").tobytes(), gone.astype(np.uint8).tobytes(), v.astype(f"<i{width}").tobytes(), a.astype("<i4").tobytes(), u.astype("<f8").tobytes(), low.astype("<f8").tobytes(), dist, moved, near]
    return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(held, _SCHEMA, strict=True)], schema=_SCHEMA)


def _pass(dims: int, centres: np.ndarray, before: np.ndarray | None, last: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks to blocks after one assignment. At its end a task adds a row without vectors: what entered (+) and left (-) each cluster, or after the last pass the distances summed by cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ball = Ball(centres, before)
        counts, sums, near = Counter(), {}, Counter()
        for batch in batches:
            for r in batch.to_pylist():
                n = r["n"]
                if not n:
                    continue
                v = np.frombuffer(r["v"], f"<i{r['width']}").astype(np.int64).reshape(n, dims)
                a, u, low = (np.frombuffer(r[c], t).copy() for c, t in (("a", "<i4"), ("u", "<f8"), ("l", "<f8")))
                x, was, dist = exact(v), a.copy(), None
                assign(x, a, u, low, ball)
                if last:
                    d = [int(y) for y in _own(x, a, ball.c)]
                    dist = [y if y < 1 << 63 else None for y in d]
                    for c, y in zip(a.tolist(), d, strict=True):
                        near[c] += y
                else:
                    changed = np.flatnonzero(was != a)
                    for c in np.unique(np.concatenate([was[changed], a[changed]])).tolist():
                        if c >= 0:
                            come, left = changed[a[changed] == c], changed[was[changed] == c]
                            w = v.astype(object) if r["width"] == 8 else v
                            counts[c] += len(come) - len(left)
                            sums[c] = sums.get(c, 0) + (w[come].sum(0) - w[left].sum(0)).astype(object)
                yield _row(n, r["width"], np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["gone"], np.uint8), v, a, u, low, dist, [], [])
        moved = [{"c": c, "n": counts[c], "s": [Decimal(y) for y in s]} for c, s in sums.items()]
        none = np.empty(0)
        yield _row(0, 2, none, none, none, none, none, none, None, moved, [{"c": c, "d": Decimal(y)} for c, y in near.items()])

    return run


def _own(x: np.ndarray, a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row to its own centroid."""
    out = np.empty(len(x), object)
    for k in np.unique(a):
        own = np.flatnonzero(a == k)
        out[own] = squared(x[own], c[k : k + 1])[:, 0]
    return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks to one row a vector."""
    for batch in batches:
        for i in range(batch.num_rows):
            r = {c: batch.column(c)[i] for c in ("n", "ids", "gone", "a", "dist")}
            if not r["n"].as_py():
                continue
            ids, gone, a = (np.frombuffer(r[c].as_py(), t) for c, t in (("ids", "<i8"), ("gone", np.uint8), ("a", "<i4")))
            yield pa.RecordBatch.from_arrays([pa.array(ids, mask=gone.astype(bool)), pa.array(a), r["dist"].values], names=["vec_id", "cluster", "distance"])


def first_centres(kept: DataFrame, k: int, prefix: str) -> np.ndarray:
    """The k vectors with the smallest sha256 of prefix and vec_id, in that order (equal hashes: by the vector). k rows reach the driver."""
    key = F.sha2(F.concat(F.lit(prefix), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    got = kept.select(key.alias("key"), F.transform("v", lambda x: x.cast("long")).alias("v")).orderBy("key", "v").limit(k).collect()
    return np.array([r.v for r in got], np.int64)


def cluster(embeddings: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, prefix: str = "2:") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector of embeddings (vec_id, embedding) that is kept.

    Kept are vectors with exactly dims components, none null or non-finite (nor so large that 256 times it leaves a long). Repeated rows each count and each stay, a null vec_id
    hashes as the empty text. Fewer than k kept vectors give as many centroids; an empty table gives no rows. Equal distances go to
    the smaller number. Columns other than the two are not read, so their names cannot clash. A distance or a sum beyond a long is null.
    """
    if not 1 <= k <= MOST:
        raise ValueError(f"1 to {MOST} centroids")
    spark = embeddings.sparkSession
    kept = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("e")).where(fits(F.col("e"), dims)).select("vec_id", numbers(F.col("e")).alias("v"))
    centres = first_centres(kept, k, prefix)
    if not len(centres):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    schema = f"{STATE}, {MOVED}"
    state, before = kept.mapInArrow(_blocks(dims), schema), None
    counts, sums = [0] * len(centres), [[0] * dims for _ in centres]
    for turn in range(rounds + 1):
        new = durable(state.mapInArrow(_pass(dims, centres, before, turn == rounds), schema))
        if turn:
            forget(state)
        state, before = new, centres
        if turn < rounds:
            moved = state.select(F.inline("moved")).groupBy("c").agg(F.sum("n").alias("n"), *[F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(dims)])
            for r in moved.collect():  # one row a centroid
                counts[r.c] += r.n
                sums[r.c] = [x + int(r[f"s{i}"]) for i, x in enumerate(sums[r.c])]
            centres = np.array([[x // n for x in s] if n else list(c) for s, n, c in zip(sums, counts, centres.tolist(), strict=True)], np.int64)
    near = {r.c: int(r.d) for r in state.select(F.inline("near")).groupBy("c").agg(F.sum("d").alias("d")).collect()}  # one row a centroid
    total = sum(near.values())
    told = small_table(spark, [[c, str(near.get(c, 0)), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()] for c, x in enumerate(centres.tolist())], "cluster int, part string, centroid_sha256 string")
    rows = state.mapInArrow(_rows, "vec_id long, cluster int, distance long")
    long = lambda x: x.try_cast("long")
    return rows.join(F.broadcast(told), "cluster").select(
        "vec_id", "cluster", "distance", long(F.col("part")).alias("cluster_inertia"), long(F.lit(str(total))).alias("inertia"), "centroid_sha256",
    )
