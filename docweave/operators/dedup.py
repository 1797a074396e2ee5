"""Duplicates: first row of a key, fingerprints, and the order-dependent greedy pass over conflicts."""

from __future__ import annotations

import difflib
import functools
import math
import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import canonical, let, ratio, strip, text
from ..session import durable, forget

SIMILAR = 0.92


def first_per_key(df: DataFrame, key: Column, pos: str = "pos", keep_blank: bool = False) -> DataFrame:
    """The first row by pos of every non-blank key; rows with a blank key go, or stay with keep_blank. Aggregated before the shuffle, so a hot key is one row a task; of rows that share key and position one stays."""
    keyed = df.withColumn("_k", key)
    first = keyed.where("_k <> ''").groupBy("_k").agg(F.min(pos).alias("_first"))
    firsts = keyed.where("_k <> ''").join(first, "_k").where(F.col(pos) == F.col("_first")).drop("_first").dropDuplicates(["_k"])
    out = firsts.unionByName(keyed.where("coalesce(_k, '') = ''")) if keep_blank else firsts
    return out.drop("_k")


def distinct_urls(df: DataFrame, pos: str = "pos") -> DataFrame:
    """One row for each source URL, case-sensitive; rows without a URL go."""
    return first_per_key(df, strip(text("source_url")), pos)


def fingerprint(title: Column, organization: Column, deadline: Column) -> Column:
    parts = [canonical(text(c)) for c in (title, organization, deadline)]
    whole = parts[0] != ""
    for p in parts[1:]:
        whole = whole & (p != "")
    return F.when(whole, F.sha2(F.concat_ws("|", *parts), 256)).otherwise("")


def _keyed(df: DataFrame, pos: str) -> DataFrame:
    """(p, u, f, t, o, d): position, URL, fingerprint, and the canonical title, organisation and deadline. The fingerprint is blank where one of these three is."""
    return df.select(
        F.col(pos).alias("p"), F.lower(strip(text("source_url"))).alias("u"), fingerprint(F.col("title"), F.col("organization"), F.col("deadline")).alias("f"),
        canonical(text("title")).alias("t"), canonical(text("organization")).alias("o"), canonical(text("deadline")).alias("d"),
    )


def _linked(rows: DataFrame) -> DataFrame:
    """Rows that titles can link: those with an organisation and a deadline. Blank titles have a fingerprint here too, as their ratio is 1."""
    return rows.where("o <> '' and d <> ''").withColumn("f", F.sha2(F.concat_ws("|", "t", "o", "d"), 256))


#: Characters of a gram at the least similarities that are indexed, longest grams used, and characters of titles that meet in one cell.
GRAM, LONGEST, CELL = 3, 5, 1_000_000


def _edits(similar: float) -> float:
    """Insertions and deletions for each character of a title that a partner of this similarity can take."""
    return 2 * (1 - similar) / similar


def _indexable(similar: float) -> bool:
    """Whether every title that allows an edit has as many grams as its prefix: GRAM edits + 1 of length - GRAM + 1."""
    c = _edits(similar)
    return 0 < c < 1 / GRAM and all(GRAM * (int(n * c + 1e-9) + 1) <= n for n in range(math.ceil(1 / c - 1e-9), math.ceil(GRAM / (1 - GRAM * c))))


def _needed(both: np.ndarray, q: int, similar: float) -> np.ndarray:
    """Grams of q characters that two titles of so many characters together share at least: an unmatched character of a title breaks q of its grams, one of the partner's q - 1."""
    return (2 * q - 1) * np.ceil(similar * both / 2 - 1e-9).astype(np.int64) - (q - 1) * (both + 1)


def _gram(shortest: int, similar: float) -> int:
    """The longest grams of which two titles of at least this length share a fair part."""
    both = np.array([2 * shortest])
    return next((q for q in range(LONGEST, 1, -1) if _needed(both, q, similar)[0] * 5 >= shortest), 1)


def _grams(title: str, q: int, seed: int) -> np.ndarray:
    """Hashes of the grams, in which a gram's further occurrences differ from its first; equal hashes of unlike grams only make the filter wider."""
    codes = np.frombuffer(title.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    h = np.full(len(codes) - q + 1, seed * 0xD1B54A32D192ED03 % (1 << 64), np.uint64)
    for i in range(q):
        h = (h ^ codes[i : len(codes) - q + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    h.sort()
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    nth = np.arange(len(h)) - np.repeat(first, np.diff(np.append(first, len(h))))
    return h + nth.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)


def _common(masks: dict[str, int], n: int, other: str) -> int:
    """Length of the longest common subsequence (bit-parallel) of other and a title of n characters, given where each character stands in that. No ratio matches more."""
    full = (1 << n) - 1
    v = full
    for x in other:
        if m := masks.get(x):
            u = v & m
            v = (v + u | v - u) & full
    return n - v.bit_count()


def _cells_pairs(rows: list[tuple], similar: float) -> Iterator[tuple[str, str, bool, bool]]:
    """(a, b, ab, ba) of the rows (cell, shortest, u, t, own, side) of whole cells. Shared grams are counted by an inverted index; what shares enough goes on to the common subsequence, and then to the ratio."""
    cells: dict[tuple, int] = {}
    cell = np.array([cells.setdefault(r[0], len(cells)) for r in rows])
    n, own, side = np.array([len(r[3]) for r in rows]), np.array([r[4] for r in rows]), np.array([r[5] for r in rows])
    grams = [_grams(r[3], _gram(r[1], similar), c) for r, c in zip(rows, cell.tolist())]
    begin = np.concatenate([[0], np.cumsum([len(g) for g in grams])])
    _, key = np.unique(np.concatenate(grams), return_inverse=True)
    of = np.repeat(np.arange(len(rows)), np.diff(begin))[np.argsort(key, kind="stable")]
    ptr = np.concatenate([[0], np.cumsum(np.bincount(key))])
    edge = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
    bounds = dict(zip(cell[edge].tolist(), zip(edge.tolist(), [*edge[1:].tolist(), len(rows)])))
    for i, (_, shortest, u, t, _, _) in enumerate(rows):
        lo, hi = i + 1, bounds[int(cell[i])][1]
        if lo == hi:
            continue
        k = key[begin[i] : begin[i + 1]]
        size = ptr[k + 1] - ptr[k]
        met = of[np.repeat(ptr[k] - np.cumsum(size) + size, size) + np.arange(size.sum())]
        count = np.bincount(met[(met > i) & (met < hi)] - lo, minlength=hi - lo)
        both = n[i] + n[lo:hi]
        # two visitors of a cell meet in their own class; where two parts of a class meet, only unlike ones are compared
        near = (count >= _needed(both, _gram(shortest, similar), similar)) & (2 * np.minimum(n[i], n[lo:hi]) >= similar * both - 1e-9) & (own[i] | own[lo:hi]) & ((side[i] < 0) | (side[i] != side[lo:hi]))
        masks: dict[str, int] = {}
        for j in (np.flatnonzero(near) + lo).tolist():
            if not masks:
                for at, x in enumerate(t):
                    masks[x] = masks.get(x, 0) | 1 << at
            v, w = rows[j][2:4]
            if 2 * _common(masks, len(t), w) < similar * (len(t) + len(w)) - 1e-9:
                continue
            (a, ta), (b, tb) = sorted([(u, t), (v, w)])
            ab, ba = (difflib.SequenceMatcher(None, *x).ratio() >= similar for x in ((tb, ta), (ta, tb)))
            if ab or ba:
                yield a, b, ab, ba


def title_pairs(titles: DataFrame, similar: float) -> DataFrame:
    """(a, b), a < b, of titles (u, g, t) that share the group g, where either order has at least the similarity.

    Titles of a group meet by classes of length: each stands in its own and visits the next. A class of many characters is cut into parts by hash, and each two parts
    meet in a cell of their own, so no task holds more than two parts. Within cells titles are found by how many grams they share (_cells_pairs).
    """
    step = -math.log(similar / (2 - similar)) + 1e-9
    # titles that allow no edit have no partner but themselves
    rows = titles.withColumn("n", F.length("t")).where(F.floor(F.col("n") * F.lit(_edits(similar)) + F.lit(1e-9)) > 0).withColumn("c", F.floor(F.log(F.col("n").cast("double")) / step).cast("int"))
    placed = rows.select("u", "g", "t", "n", F.inline(F.array(F.struct("c", F.lit(True).alias("own")), F.struct((F.col("c") + 1).alias("c"), F.lit(False).alias("own")))))
    sizes = placed.groupBy("g", "c").agg(F.sum("n").alias("held"), F.count("*").alias("titles"), F.min("n").alias("shortest"), F.max("own").alias("any")).where("titles > 1 and any")
    sizes = durable(sizes.select("g", "c", "shortest", F.ceil(F.col("held") / CELL).cast("int").alias("parts")))
    met = placed.join(sizes, ["g", "c"]).withColumn("part", F.pmod(F.xxhash64("u"), F.col("parts")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cell = F.struct("g", "c", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
    side = F.when(F.col("part") == F.col("other"), -1)
    # a part alone meets itself in the cell (i, i); a cell (i, j) takes part i as one side and j as the other
    met = met.select(cell.alias("cell"), "shortest", "u", "t", "own", F.coalesce(side, F.when(F.col("part") < F.col("other"), 0).otherwise(1)).alias("side"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def given(held: list[tuple]) -> Iterator[pa.RecordBatch]:
            found = list(_cells_pairs(held, similar))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*found)], names=["a", "b", "ab", "ba"])

        held: list[tuple] = []
        chars = 0
        for batch in batches:
            key = zip(*(batch.column("cell").field(i).to_pylist() for i in range(4)))
            for r in zip(key, *(batch.column(c).to_pylist() for c in ("shortest", "u", "t", "own", "side"))):
                if held and r[0] != held[-1][0] and chars >= CELL:
                    yield from given(held)
                    held, chars = [], 0
                held.append(r)
                chars += len(r[3])
        if held:
            yield from given(held)

    out = durable(met.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "a string, b string, ab boolean, ba boolean"))
    forget(sizes)
    return out


def _like_classes(rows: DataFrame, similar: float) -> DataFrame:
    """(a, b, ab, ba), a < b, of fingerprints with equal organisation and deadline and titles at least similar: ab where a's rows come first, ba where b's do. Needs a similarity that _indexable() allows."""
    named = rows.where("f <> ''")
    return title_pairs(named.select(F.col("f").alias("u"), F.xxhash64("o", "d").alias("g"), "t", "o", "d").distinct().select("u", "g", "t"), similar)


def _alike(rows: DataFrame, similar: float) -> DataFrame:
    """Pairs (earlier, later) of rows with unlike fingerprints, equal organisation and deadline, and titles at least similar."""
    if similar > 1:
        return rows.select(F.col("p").alias("earlier"), F.col("p").alias("later")).limit(0)
    named = rows.where("f <> ''")
    if not _indexable(similar):
        return _alike_by_length(named, similar)
    of = lambda i, c: named.select(F.col("p").alias(f"p{i}"), F.col("f").alias(c))
    met = _like_classes(rows, similar).join(of(1, "a"), "a").join(of(2, "b"), "b")
    return met.where("(p1 < p2 and ab) or (p2 < p1 and ba)").select(F.least("p1", "p2").alias("earlier"), F.greatest("p1", "p2").alias("later"))


def _alike_by_length(named: DataFrame, similar: float) -> DataFrame:
    """_alike() for similarities too low for the index: rows meet by classes of length, which a ratio keeps within similar / (2 - similar) of each other."""
    step = -math.log(similar / (2 - similar)) + 1e-9
    named = named.withColumn("c", F.floor(F.log(F.length("t").cast("double")) / step).cast("int"))
    a, b = (named.select(*[F.col(c).alias(f"{c}{i}") for c in ("p", "f", "t", "o", "d", "c")]) for i in (1, 2))
    b = b.withColumn("c2", F.explode(F.array(F.col("c2") - 1, F.col("c2"), F.col("c2") + 1)))
    near = (F.col("o1") == F.col("o2")) & (F.col("d1") == F.col("d2")) & (F.col("c1") == F.col("c2")) & (F.col("p1") < F.col("p2")) & (F.col("f1") != F.col("f2"))
    near &= 2 * F.least(F.length("t1"), F.length("t2")) >= similar * (F.length("t1") + F.length("t2"))
    return a.join(b, near).where(ratio(F.col("t2"), F.col("t1")) >= similar).select(F.col("p1").alias("earlier"), F.col("p2").alias("later"))


def conflicts(df: DataFrame, pos: str = "pos", similar: float = SIMILAR) -> DataFrame:
    """Pairs (earlier, later): equal URL, equal fingerprint, or titles at least similar (two blank ones are) with equal organisation and deadline.

    All pairs of an equal key are given, as asked; greedy() and classes() work without them.
    """
    rows = _keyed(df, pos)
    linked = _linked(rows) if similar <= 1 else rows
    sides = lambda x: (x.select(*[F.col(c).alias(f"{c}{i}") for c in ("p", "u", "f")]) for i in (1, 2))
    (a, b), (c, d) = sides(rows), sides(linked)
    by_url = a.join(b, (F.col("u1") == F.col("u2")) & (F.col("u1") != "") & (F.col("p1") < F.col("p2")))
    by_print = c.join(d, (F.col("f1") == F.col("f2")) & (F.col("f1") != "") & (F.col("p1") < F.col("p2")))
    pairs = [x.select(F.col("p1").alias("earlier"), F.col("p2").alias("later")) for x in (by_url, by_print)]
    return pairs[0].unionByName(pairs[1]).unionByName(_alike(linked, similar)).distinct()


def classes(df: DataFrame, pos: str = "pos", similar: float = SIMILAR) -> DataFrame:
    """conflicts() by fingerprint and title without their expansion: (earlier, later, kind, forward, backward, class, other).

    Rows equal in title, blank ones too, organisation and deadline are a class, named by its first position. `copy`: later is a further row of the class of earlier, which conflicts with every row of it; rows
    that share a position count each. `similar`: rows of the classes of earlier and later conflict, forward where the row of earlier's class comes first, backward where the other does (a ratio depends on the
    order). class and other are the hashes of the two classes, which tell them apart where positions repeat. Rows with a blank organisation or deadline are in no class.
    """
    if not (similar <= 1 and _indexable(similar)):
        raise ValueError("too low a similarity for the index of titles")
    rows = durable(_linked(_keyed(df.withColumn("source_url", F.lit("")), pos)).withColumn("row", F.monotonically_increasing_id()))
    first = durable(rows.groupBy("f").agg(F.min(F.struct("p", "row")).alias("first")).select("f", F.col("first.p").alias("first"), F.col("first.row").alias("head")))
    copies = rows.join(first, "f").where("row <> head").select(F.col("first").alias("earlier"), F.col("p").alias("later"), F.lit("copy").alias("kind"), F.lit(True).alias("forward"), F.lit(True).alias("backward"), F.col("f").alias("class"), F.col("f").alias("other"))
    of = lambda i, c: first.select(F.col("first").alias(f"p{i}"), F.col("f").alias(c))
    met = _like_classes(rows, similar).join(of(1, "a"), "a").join(of(2, "b"), "b")
    turned = lambda x, y: F.when(F.col("p1") > F.col("p2"), F.col(y)).otherwise(F.col(x))
    like = met.select(turned("p1", "p2").alias("earlier"), turned("p2", "p1").alias("later"), F.lit("similar").alias("kind"), turned("ab", "ba").alias("forward"), turned("ba", "ab").alias("backward"), turned("a", "b").alias("class"), turned("b", "a").alias("other"))
    return copies.unionByName(like)


def greedy(df: DataFrame, pos: str = "pos", similar: float = SIMILAR) -> DataFrame:
    """Rows that a sequential pass by pos keeps: a row goes if it conflicts with a kept earlier row, and dropped rows drop nothing. Rows with a blank title conflict by URL alone.

    Rows equal in URL, title, organisation and deadline conflict with the same rows, and the first of them, kept or not, settles the
    others, so one stands for all. Then, round by round: dropped if an earlier neighbour is kept, kept if all are dropped. Of the rows of one URL or one
    fingerprint only the first kept and the first open one matter to the others, so a key of many rows is two numbers, never its pairs; pairs are made of fingerprints with like titles alone.
    """
    key = ["source_url", "title", "organization", "deadline"]
    same = df.select(F.col(pos).alias("_p"), *[text(c).alias(f"_{c}") for c in key]).groupBy(*[f"_{c}" for c in key]).agg(F.min("_p").alias("_p"))
    heads = durable(df.join(same.select(F.col("_p").alias(pos)), pos, "left_semi"))
    rows = durable(_keyed(heads, pos))
    # what an earlier row of one fingerprint does to the later rows of another is the same for all of them
    by_class = similar <= 1 and _indexable(similar)
    if by_class:
        like = _like_classes(rows, similar)
        edges = durable(like.where("ab").select(F.col("a").alias("from"), F.col("b").alias("f")).unionByName(like.where("ba").select(F.col("b").alias("from"), F.col("a").alias("f"))))
        forget(like)
    else:
        edges = durable(_alike(rows, similar).distinct())
    state = durable(rows.select("p", "u", "f", F.lit(None).cast("boolean").alias("kept")))
    while True:
        told = state.where("kept is null")
        tests = []
        firsts = {}
        for k in ("u", "f"):
            first = firsts[k] = state.where(F.col(k) != "").groupBy(k).agg(F.min(F.when(F.col("kept"), F.col("p"))).alias(f"{k}_kept"), F.min(F.when(F.col("kept").isNull(), F.col("p"))).alias(f"{k}_open"))
            told = told.join(first, k, "left")
            tests += [(F.col(f"{k}_kept") < F.col("p"), F.col(f"{k}_open") < F.col("p"))]
        if by_class:
            near = edges.join(firsts["f"].withColumnRenamed("f", "from"), "from").groupBy("f").agg(F.min("f_kept").alias("near_kept"), F.min("f_open").alias("near_open"))
            told = told.join(near, "f", "left")
            tests += [(F.col("near_kept") < F.col("p"), F.col("near_open") < F.col("p"))]
        else:
            near = edges.join(state.select(F.col("p").alias("earlier"), "kept"), "earlier").groupBy(F.col("later").alias("p"))
            told = told.join(near.agg(F.coalesce(F.max("kept"), F.lit(False)).alias("hit"), (F.count_if(F.col("kept").isNull()) > 0).alias("open")), "p", "left")
            tests += [(F.col("hit"), F.col("open"))]
        hit, open_ = (functools.reduce(operator.or_, [F.coalesce(t[i], F.lit(False)) for t in tests]) for i in (0, 1))
        new = told.select("p", "u", "f", F.when(hit, F.lit(False)).when(~open_, F.lit(True)).alias("kept")).where("kept is null or kept")  # dropped rows drop nothing
        new = durable(new.unionByName(state.where("kept")))
        forget(state)
        state, left = new, new.where("kept is null").limit(1).count()
        if not left:
            break
    forget(edges, rows)
    kept = heads.join(state.where("kept").select(F.col("p").alias(pos)), pos, "left_semi")
    # a blank URL and a blank part make no conflict: further copies of such a row stay
    u, f = F.lower(strip(text("source_url"))), fingerprint(F.col("title"), F.col("organization"), F.col("deadline"))
    more = df.where((u == "") & (f == "")).join(heads.select(pos), pos, "left_anti")
    return kept.unionByName(more)


def router_dedup(df: DataFrame, url_key: Column, title_key: Column, pos: str = "pos") -> DataFrame:
    """The greedy pass where rows conflict by canonical URL or canonical title alone."""
    named = df.withColumns({"_u": url_key, "_t": title_key})
    work = named.select(pos, F.col("_u").alias("source_url"), F.col("_t").alias("title"), F.lit("x").alias("organization"), F.lit("x").alias("deadline"))
    return df.join(greedy(work, pos, 1.1).select(pos), pos, "left_semi")


def new_rows(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Incoming rows (title, source_url) that the store (Title, Source_Link) lacks; a row with a blank key is never a duplicate."""
    norm = lambda c: F.lower(strip(text(c)))
    have = stored.select(norm("Title").alias("_t"), norm("Source_Link").alias("_u")).distinct()
    rows = incoming.withColumns({"_t": norm("title"), "_u": norm("source_url")})
    return rows.join(have, (rows._t == have._t) & (rows._u == have._u) & (rows._t != "") & (rows._u != ""), "left_anti").drop("_t", "_u")


def consecutive(lines: Column) -> Column:
    """Lines without those equal to the line before."""
    return let(lines, lambda v: F.filter(v, lambda x, i: (i == 0) | ~F.get(v, i - 1).eqNullSafe(x)))


def window_first(df: DataFrame, keys: list[str], pos: str = "pos") -> DataFrame:
    """The first row by pos of composite keys, for keys of few rows each."""
    w = Window.partitionBy(*keys).orderBy(pos)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
