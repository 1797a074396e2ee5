"""Jaccard join of documents on their sets of word n-grams, by T-occurrence search with DivideSkip.

Two sets of sizes x and y with Jaccard similarity of at least share/100 have an overlap of at least T = ceil(share (x + y) / (100 + share)) and differ in at most
k = (x + y)(100 - share) / (100 + share) members. Three steps use that:

1. Blocks. Sizes fall into classes with upper bounds U growing by half; members are hashed into some 5/4 k(U) parts, and every part begins a stretch of parts that holds a few members, so that
   no key rests on one or two common members. Each set sends one key a stretch (a set near its class's bound also those of the next class). A part in which two sets differ spoils the stretches that
   cover it; if the k most covered parts leave a stretch whole, a linked pair shares a key. A set for which they don't also sends its
   prefix, the smallest n - ceil(share n / 100) + 1 hashes, of which a linked pair shares one. Keys with one set are gone after the first aggregation; sets that share a key are joined
   to the key's smallest set, a star, never to each other. What is connected then is a block: no link leaves it.
2. Search. A block is indexed by inverted lists. A query's n - L shortest lists are merged, keeping who occurs T - L times at least; those are looked up in the
   L longest lists by binary search, and stay if they reach T. Lists that run through a whole block, as those of a passage common to it, are so never merged.
   Small blocks share a task; a block beyond CHUNK members is cut into chunks: each is searched by itself, then by all others in the first chunk, and
   then sets outside of the block's largest component (which need every chunk) are searched in all. Pairs inside a component are never worked out again.
3. Components, by large-star and small-star steps.

Equal sets are one node throughout. Members and sets are told apart by hashes of 64 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, forget, pieces, sieve, sifted, small_batches
from .simhash import components



@dataclass(frozen=True)
class Rule:
    """Percent of the union that a linked pair has in common at least, words of a member, and members that a block key rests on at least.

    With sure, every linked pair shares a block key. Without, keys rest on a twentieth of a set's members, up to least: where much of a set may differ (a low share), keys that few members
    make would chain unlike texts into one block, so a pair at the very edge may be missed: at 80 percent about one of a hundred (tested).
    """

    share: int = 90
    words: int = 3
    least: int = 4
    sure: bool = True

    def weight(self, top: int) -> int:
        return self.least if self.sure else min(max(top // 25, 3), self.least)


EXACT, NEAR = Rule(), Rule(80, 5, 8, False)
#: Members that a task indexes: 8 bytes each, some ten times as much while it works.
CHUNK = 1 << 20
#: Fixed value: DivideSkip's weight, with which L = T / (WEIGHT log2(longest list) + 1).
WEIGHT = 0.0085
#: Words whose hashes a task remembers.
REMEMBERED = 200_000
#: Odd multipliers of the mixing steps.
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


class Sets:
    """Texts to sorted distinct member hashes."""

    def __init__(self, size: int) -> None:
        self.size, self.known = size, {}

    def of(self, text: bytes | None) -> np.ndarray:
        words = (text or b"").lower().split()  # bytes: ASCII letters and ASCII white space only
        if len(words) < self.size:
            return np.array([xxhash.xxh64_intdigest(b" ".join(words), len(words))] if words else [], np.uint64)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = len(h) - self.size + 1
        x = np.zeros(n, np.uint64)
        for i in range(self.size):
            x = mixed((x + h[i : i + n]) * _M1)
        return np.unique(x)


def least_overlap(x, y, share: int):  # noqa: ANN001, ANN201
    """T of two sizes."""
    return -(-share * (x + y) // (100 + share))


def bounds(most: int) -> list[int]:
    """Upper bounds of the size classes, up to the first at or above most."""
    out = [10]
    while out[-1] < most:
        out.append(out[-1] * 3 // 2)
    return out


def keys(s: np.ndarray, rule: Rule = EXACT) -> np.ndarray:
    """The block keys of a set. Sets of fewer than 100 / (100 - share) members link with equal sets only and have none."""
    n, share = len(s), rule.share
    if n * (100 - share) < 100:
        return np.empty(0, np.uint64)
    own, most = bounds(n)[-1], n * 100 // share  # most: the largest partner
    out, sure = [], True
    for top in [own, own * 3 // 2][: 1 + (most > own)]:
        parts = 2 * top * (100 - share) // (100 + share) * 5 // 4 + 2
        part = (s % np.uint64(parts)).astype(np.int64)
        held = np.bincount(part, minlength=parts)
        total = np.zeros(parts, np.uint64)
        np.add.at(total, part, mixed(s))
        ahead = np.concatenate([[0], np.cumsum(np.tile(held, 2))])
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(np.tile(total, 2), dtype=np.uint64)])
        first = np.arange(parts)
        end = np.searchsorted(ahead, ahead[first] + min(rule.weight(top), n), side="left")  # the stretch [first, end) holds so many members
        out.append(mixed(sums[end] - sums[first] + np.uint64(top * int(_M1) % 2**64) + first.astype(np.uint64) * _M3 + (end - first).astype(np.uint64)))
        cover = np.cumsum(np.bincount(first, minlength=2 * parts + 1) - np.bincount(end, minlength=2 * parts + 1))
        cover = cover[:parts] + cover[parts : 2 * parts]
        worst = (n + min(top, most)) * (100 - share) // (100 + share)  # parts that a partner can differ in
        sure &= int(np.sort(cover)[::-1][:worst].sum()) < parts
    if rule.sure and not sure:
        out.append(mixed(s[: n - -(-share * n // 100) + 1] * _M1))
    return np.concatenate(out)


def _described(rule: Rule) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = Sets(rule.words)
        for batch in batches:
            column = batch.column("text").cast(pa.binary())
            n, sig, found = [], [], []
            for lo, hi in pieces(column):
                for t in column[lo:hi].to_pylist():
                    s = sets.of(t)
                    n.append(len(s))
                    sig.append(xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63))
                    found.append(keys(s, rule).view(np.int64))
            at = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            flat = np.concatenate(found) if found else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), pa.array(n, pa.int64()), pa.array(sig, pa.int64()), pa.ListArray.from_arrays(pa.array(at), pa.array(flat))], names=["doc_id", "th", "n", "sig", "keys"])

    return run


class Joined:
    """Components of the sets of a task, smaller ones renamed into larger."""

    def __init__(self, known: np.ndarray):
        names, self.of = np.unique(known, return_inverse=True)
        order = np.argsort(self.of, kind="stable")
        ends = np.cumsum(np.bincount(self.of, minlength=len(names)))
        self.members = dict(enumerate(np.split(order, ends[:-1]))) if len(known) else {}

    def join(self, a: int, b: int) -> None:
        x, y = int(self.of[a]), int(self.of[b])
        if len(self.members[x]) < len(self.members[y]):
            x, y = y, x
        gone = self.members.pop(y)
        self.of[gone] = x
        self.members[x] = np.concatenate([self.members[x], gone])


class Index:
    """Inverted lists of some sets, which stand in ascending order of size."""

    def __init__(self, sets: list[np.ndarray], share: int):
        self.share = share
        self.sizes = np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(flat, kind="stable")  # owners stay ascending in a list
        self.terms, self.start = np.unique(flat[order], return_index=True)
        self.owner = owner[order]
        self.length = np.diff(np.append(self.start, len(flat)))
        self.place = np.repeat(np.arange(len(self.terms)), self.length) * len(sets) + self.owner  # (list, owner) as one ascending number

    def search(self, s: np.ndarray, until: int, joined: Joined, me: int, at: np.ndarray, inside: bool) -> Iterator[int]:
        """Sets of the index among the first `until` that reach the overlap with s, at least one of each component but that of s; at: the index's sets in joined, me: s in it; inside: s is in the index."""
        n = len(s)
        least = -(-self.share * n // 100)
        low = int(np.searchsorted(self.sizes, least))
        need = int(least_overlap(n, least, self.share))
        if low >= until:
            return
        where = np.searchsorted(self.terms, s)
        where[where == len(self.terms)] = 0
        lists = where[self.terms[where] == s] if len(self.terms) else where[:0]
        lists = lists[self.length[lists] > inside]
        if len(lists) < need:
            return
        lists = lists[np.argsort(self.length[lists], kind="stable")]
        longest = int(self.length[lists[-1]])
        skip = min(need - 1, int(need / (WEIGHT * np.log2(max(longest, 2)) + 1)), len(lists) - 1)
        short, far = lists[: len(lists) - skip], lists[len(lists) - skip :]
        size = self.length[short]
        ends = np.cumsum(size)
        met = self.owner[np.repeat(self.start[short] - (ends - size), size) + np.arange(ends[-1])]
        met = np.sort(met[(met >= low) & (met < until)], kind="stable")  # merges the sorted lists
        if not len(met):
            return
        first = np.flatnonzero(np.append(True, met[1:] != met[:-1]))
        who, often = met[first], np.diff(np.append(first, len(met)))
        enough = often >= need - skip
        who, often = who[enough], often[enough]
        order = np.argsort(-often, kind="stable")
        who, often = who[order], often[order]
        step = 8
        while True:
            other = joined.of[at[who]] != joined.of[me]
            who, often = who[other], often[other]
            if not len(who):
                return
            now, count = who[:step], often[:step]
            if len(far):
                probe = far[:, None] * len(self.sizes) + now[None, :]
                found = np.searchsorted(self.place, probe)
                found[found == len(self.place)] = 0
                count = count + (self.place[found] == probe).sum(0)
            for j in now[count >= least_overlap(n, self.sizes[now], self.share)].tolist():
                yield j
            who, often, step = who[step:], often[step:], step * 2


def _resolve(rule: Rule) -> Callable[[pa.Table], pa.Table]:
    """Links (a, b) that join the components of a task's texts as far as links between queries (ask) and the index do; without queries the index searches itself."""

    def run(table: pa.Table) -> pa.Table:
        nodes, comps, ask = (table.column(c).to_pylist() for c in ("node", "comp", "ask"))
        column, sets, of = table.column("text").combine_chunks().cast(pa.binary()), [], Sets(rule.words).of
        for lo, hi in pieces(column):
            sets += [of(t) for t in column[lo:hi].to_pylist()]
        joined = Joined(np.array(comps, np.int64))
        indexed = sorted((i for i in range(len(sets)) if not ask[i]), key=lambda i: (len(sets[i]), nodes[i]))
        queries = [i for i in range(len(sets)) if ask[i]]
        index, at = Index([sets[i] for i in indexed], rule.share), np.array(indexed, np.int64)
        out: list[tuple[int, int]] = []

        def ask_for(i: int, until: int) -> None:
            for j in index.search(sets[i], until, joined, i, at, not queries):
                k = int(at[j])
                if joined.of[i] != joined.of[k]:
                    joined.join(i, k)
                    out.append((nodes[i], nodes[k]))

        if queries:
            for i in queries:
                ask_for(i, int(np.searchsorted(index.sizes, len(sets[i]) * 100 // rule.share, side="right")))
        else:
            for k, i in enumerate(indexed):
                ask_for(i, k)
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    return run


def _links(blocks: DataFrame, rows: DataFrame, rule: Rule) -> DataFrame:
    """Links (a, b) that join all linked sets of each block (node, root, n members, th and k of a row that has it); rows (th, k, text)."""
    whole = durable(blocks.groupBy("root").agg(F.sum("n").alias("total")).withColumn("chunks", F.ceil(F.col("total") / CHUNK).cast("long")))
    packs = int((whole.where("chunks = 1").agg(F.sum("total")).first()[0] or 0) * 2 // CHUNK) + 1
    mod = lambda c, n: F.pmod(F.xxhash64(c), n)
    home = F.when(F.col("chunks") == 1, mod("root", F.lit(packs))).otherwise(F.col("root"))
    placed = durable(blocks.join(whole, "root").select("th", "k", "root", "node", "n", "chunks", home.alias("home"), mod("node", F.col("chunks")).alias("chunk")))
    near = sifted(rows, "th", sieve(placed, "th"))

    def texts(some: DataFrame) -> DataFrame:
        return near.join(some, ["th", "k"]).dropDuplicates(["th", "k"]).drop("th", "k")  # rows that are the same stand for one; dealt by these keys already

    shape = "a long, b long"
    alone = texts(placed).select(F.col("chunks").alias("chunks"), "home", "chunk", "node", "text", F.col("node").alias("comp"), F.lit(False).alias("ask"))
    found = durable(alone.groupBy((F.col("chunks") == 1).alias("small"), "home", "chunk").applyInArrow(_resolve(rule), shape))
    if placed.where("chunks > 1").isEmpty():
        forget(whole, placed)
        return found
    large = durable(texts(placed.where("chunks > 1")).select("root", "chunk", "chunks", "node", "n", "text"))

    def with_comps(links: DataFrame) -> DataFrame:
        known = components(links).withColumnRenamed("root", "comp_")
        return large.join(known, "node", "left").withColumn("comp", F.coalesce("comp_", "node")).drop("comp_")

    now = durable(with_comps(found))
    targets = now.where("chunk = 0").withColumn("chunk", F.explode(F.sequence(F.lit(1).cast("long"), F.col("chunks") - 1)))
    asked = now.where("chunk > 0").withColumn("ask", F.lit(True)).unionByName(targets.withColumn("ask", F.lit(False)))
    found = found.unionByName(durable(asked.groupBy("root", "chunk").applyInArrow(_resolve(rule), shape)))
    forget(now)
    now = durable(with_comps(found))
    size = now.groupBy("root", "comp").agg(F.count("*").alias("c"))
    main = size.groupBy("root").agg(F.max(F.struct("c", "comp")).alias("m")).select("root", F.col("m.comp").alias("main"))
    rest = durable(now.join(main, "root").where("comp <> main").drop("main"))
    if not rest.isEmpty():
        lots = rest.groupBy("root").agg(F.ceil(F.sum("n") / CHUNK).cast("long").alias("lots"))
        put = rest.join(lots, "root").withColumn("lot", mod("node", F.col("lots"))).drop("lots")
        put = put.withColumn("own", F.col("chunk")).withColumn("chunk", F.explode(F.sequence(F.lit(1).cast("long"), F.col("chunks") - 1))).where("chunk <> own").drop("own").withColumn("ask", F.lit(True))
        base = now.where("chunk > 0").join(lots, "root").withColumn("lot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lots") - 1))).drop("lots").withColumn("ask", F.lit(False))
        found = found.unionByName(durable(put.unionByName(base).groupBy("root", "chunk", "lot").applyInArrow(_resolve_lot(rule), shape)))
    forget(whole, placed, large, now, rest)
    return found


def _resolve_lot(rule: Rule) -> Callable[[pa.Table], pa.Table]:
    """_resolve, but a chunk whose lot asks nothing has been searched already."""
    run = _resolve(rule)
    none = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    return lambda table: run(table) if any(table.column("ask").to_pylist()) else none


def _row_key(doc: Column) -> Column:
    return F.coalesce(doc.cast("string"), F.lit(""))


def _linked(rows: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """(doc_id, th, n, sig) of rows (doc_id, th, text), sig standing for the set, and links (a, b) of sets."""
    told = durable(rows.mapInArrow(_described(rule), "doc_id long, th long, n long, sig long, keys array<bigint>"))
    pairs = told.select(F.explode("keys").alias("key"), "sig")
    shared = durable(pairs.groupBy("key").agg(F.min("sig").alias("a"), F.max("sig").alias("z")).where("a <> z").select("key", "a"))
    stars = sifted(pairs, "key", sieve(shared, "key")).join(shared, "key").where("sig <> a").select("a", F.col("sig").alias("b")).distinct()
    blocks = components(stars)
    one = told.where("n > 0").groupBy("sig").agg(F.min(F.struct(_row_key(F.col("doc_id")).alias("k"), "th", "n")).alias("r"))
    blocks = durable(blocks.join(one, blocks.node == one.sig).select("node", "root", "r.k", "r.th", "r.n"))
    forget(shared)
    return told.drop("keys"), _links(blocks, rows.select("text", "th", _row_key(F.col("doc_id")).alias("k")), rule)


def text_classes(rows: DataFrame, rule: Rule = NEAR) -> DataFrame:
    """(th, root) of every text of rows (th, text) with a member: texts with one root are linked, or linked to such."""
    told, links = _linked(rows.select(F.lit(None).cast("long").alias("doc_id"), "th", "text"), rule)
    root = components(links)
    return told.where("n > 0").select("th", "sig").distinct().join(root, F.col("sig") == root.node, "left").select("th", F.coalesce("root", "sig").alias("root"))


def join(docs: DataFrame, rule: Rule = EXACT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs (doc_id, text): rows whose sets have the rule's share of their union in common are linked.

    A text with fewer words than a member is one member; null, empty and white-space texts have none, are linked with nothing and their component is their doc_id. Equal sets
    are linked; rows that share a doc_id are one document, so their components join (save rows without members). A row without a doc_id is a node like others; a
    component of such rows alone has a null component_id. Repeated rows each stay. Texts are read whole; extra columns are not read. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    told, links = _linked(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("th")), rule)
    filled = told.where("n > 0")
    several = filled.where("doc_id is not null").groupBy("doc_id").agg(F.min("sig").alias("a"), F.max("sig").alias("z")).where("a <> z").select("doc_id", "a")
    links = links.unionByName(filled.join(several, "doc_id").select("a", F.col("sig").alias("b")).where("a <> b").distinct())
    root = components(links)
    least = filled.groupBy("sig").agg(F.min("doc_id").alias("d"))
    least = least.join(root, least.sig == root.node, "left").select("sig", "d", F.coalesce("root", "sig").alias("root"))
    named = least.select("sig", "root").join(least.groupBy("root").agg(F.min("d").alias("component_id")), "root").select("sig", "component_id")
    out = told.select("doc_id", "n", F.when(F.col("n") > 0, F.col("sig")).alias("sig")).join(named, "sig", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
