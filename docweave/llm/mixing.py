"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources that hold them, or their text). Word capacity flows from each pattern, once
for every repetition at a convex cost (0 for the first pass, 1 for the second, ...), to the quotas of its sources. The
flow fixes how many words each pattern gives to each source; whole passes take every document, the rest is a seeded draw of documents
in the order of their hashes, refined by histograms of hash prefixes, so no group is ever sorted or collected.

Where several sources hold the same texts, the first pass over a text is free whichever source takes it, so sources share out their common
texts before they repeat any. Patterns that share no source are independent flows.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, durable, packed, small_table, unpacked

#: Bits by which a hash prefix grows, and the candidates of a pattern among which the last documents are chosen.
STEP, LAST = 12, 64
#: Patterns of several sources that are told apart, those of most words first; rows of others count for their own source alone.
MOST_PATTERNS = 10_000
NULL_SOURCE = "\U0010ffff"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: dict[str | None, int], share: float = 1.5, weights: tuple[int, ...] = (5, 2, 1), most: float = 2.0) -> dict[str | None, float]:
    """share of all sizes by repeating weights (sources by code point, null last); a target stops at most times its source's size, the excess is reshared."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, total, out = list(names), share * sum(sizes.values()), {}
    while left:
        rest = total - sum(out.values())
        whole = sum(weight[s] for s in left)
        full = [s for s in left if rest * weight[s] / whole > most * sizes[s]]
        if not full:
            return out | {s: rest * weight[s] / whole for s in left}
        out |= {s: most * sizes[s] for s in full}
        left = [s for s in left if s not in full]
    return out


def min_cost_flow(steps: dict[str, list[tuple[int, int]]], reach: dict[str, dict[str, int]], quota: dict[str, int]) -> dict[str, dict[str, int]]:
    """Words each pattern sends to each of its sources: a maximum flow of least repetition cost (cheapest paths first, with potentials).

    steps gives a pattern's passes as (words, cost of each), reach the most words it may send to each source.
    """
    root: dict[str, str] = {}

    def find(x: str) -> str:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for p, to in reach.items():
        for s in to:
            root[find("s" + s)] = find("p" + p)
    parts: dict[str, list[str]] = {}
    for p in reach:
        parts.setdefault(find("p" + p), []).append(p)
    flow: dict[str, dict[str, int]] = {}
    for part in parts.values():
        flow |= _flow({p: steps[p] for p in part}, {p: reach[p] for p in part}, quota)
    return flow


def _blocking(out: dict, to: list, cap: list[int], open_: Callable[[object, int], bool]) -> bool:
    """Sends a blocking flow from S to T over open arcs by shortest numbers of arcs, and tells whether there was a path."""
    level, front = {"S": 0}, ["S"]
    while front and "T" not in level:
        after = []
        for u in front:
            for e in out[u]:
                if cap[e] > 0 and to[e] not in level and open_(u, e):
                    level[to[e]] = level[u] + 1
                    after.append(to[e])
        front = after
    if "T" not in level:
        return False
    at = dict.fromkeys(level, 0)  # each node's next arc to try; it stays on an arc until that is of no more use
    path, u = [], "S"
    while True:
        if u == "T":
            n = min(cap[e] for e in path)
            for e in path:
                cap[e] -= n
                cap[e ^ 1] += n
            cut = next(i for i, e in enumerate(path) if not cap[e])
            u = to[path[cut] ^ 1]
            del path[cut:]
            continue
        arcs = out[u]
        while at[u] < len(arcs) and not (cap[e := arcs[at[u]]] > 0 and level.get(to[e]) == level[u] + 1 and open_(u, e)):
            at[u] += 1
        if at[u] < len(arcs):
            path.append(e)
            u = to[e]
        elif path:
            u = to[path.pop() ^ 1]
            at[u] += 1
        else:
            return True


def _flow(steps: dict[str, list[tuple[int, int]]], reach: dict[str, dict[str, int]], quota: dict[str, int]) -> dict[str, dict[str, int]]:
    to, cap, cost, out = [], [], [], {}

    def arc(u: object, v: object, c: int, w: int) -> int:
        for a, b, x, y in ((u, v, c, w), (v, u, 0, -w)):
            out.setdefault(a, []).append(len(to))
            to.append(b)
            cap.append(x)
            cost.append(y)
        return len(to) - 2

    pairs = {}
    for p, passes in steps.items():
        for n, w in passes:
            arc("S", ("p", p), n, w)
        for s, n in reach[p].items():
            pairs[p, s] = arc(("p", p), ("s", s), n, 0)
    for s in {s for x in reach.values() for s in x}:
        arc(("s", s), "T", quota.get(s, 0), 0)
    number = {x: i for i, x in enumerate(sorted(out, key=str))}
    height = dict.fromkeys(out, 0)
    while "S" in out and "T" in out:
        far, heap = {"S": 0}, [(0, number["S"], "S")]
        while heap:
            d, _, u = heapq.heappop(heap)
            if d > far[u]:
                continue
            for e in out[u]:
                v = to[e]
                if cap[e] > 0 and (x := d + cost[e] + height[u] - height[v]) < far.get(v, float("inf")):
                    far[v] = x
                    heapq.heappush(heap, (x, number[v], v))
        if "T" not in far:
            break
        top = max(far.values())
        for v in height:
            height[v] += far.get(v, top)
        # all paths of this cost at once: blocking flows over the arcs that lie on a cheapest path
        while _blocking(out, to, cap, lambda u, e: not cost[e] + height[u] - height[to[e]]):
            pass
    flow: dict[str, dict[str, int]] = {p: {} for p in steps}
    for (p, s), e in pairs.items():
        if cap[e ^ 1]:
            flow[p][s] = cap[e ^ 1]
    return flow


def passes_of(distinct: int, most: int) -> list[tuple[int, int]]:
    """Passes over so many distinct words until most are sent: the first is free, each further one costs more, all from the fourth on alike."""
    return [(distinct, k) for k in range(3)] + [(max(0, most - 3 * distinct), 3)]


def _fill(units: list[tuple[int, int]], want: int) -> list[int]:
    """Hashes of the units (hash, size) taken: in hash order each that fits, then the one that brings the sum nearest."""
    taken = []
    for h, n in units:
        if n <= want:
            taken.append(h)
            want -= n
    rest = [(abs(want - n), h) for h, n in units if h not in set(taken)]
    if rest and min(rest)[0] < want:
        taken.append(min(rest)[1])
    return taken


def draw(rows: DataFrame, amount: dict[str, int], total: dict[str, int]) -> DataFrame:
    """How much of each cell of rows (cell, size, h) is taken: whole passes, and where the seeded draw of the rest is cut. One row a cell."""
    spark = rows.sparkSession
    plan = {p: {"whole": (f // total[p] if total[p] else 0), "rest": (f % total[p] if total[p] else 0), "cut": 0, "chosen": []} for p, f in amount.items()}
    open_ = {p: x["rest"] for p, x in plan.items() if x["rest"]}
    at, bits = rows.where("size > 0"), 0
    while open_:
        bits += STEP
        cut = small_table(spark, [[p, str(plan[p]["cut"])] for p in open_], "cell string, cut string").select("cell", F.col("cut").cast("long").alias("cut"))
        at = at.join(F.broadcast(cut) if len(open_) <= 10_000 else cut, "cell").where(F.lit(bits == STEP) | (F.shiftrightunsigned("h", 64 - bits + STEP) == F.col("cut"))).drop("cut")
        sums = at.groupBy("cell", F.shiftrightunsigned("h", 64 - bits).alias("b")).agg(F.sum("size").alias("n"), F.count("*").alias("rows")).collect()  # 2**STEP a cell at most
        by: dict[str, list] = {}
        for r in sorted(sums, key=lambda r: (r.cell, r.b)):
            by.setdefault(r.cell, []).append(r)
        few = set()
        for p in list(open_):
            for r in by[p]:
                if r.n > open_[p]:
                    plan[p]["cut"] = r.b
                    if r["rows"] <= LAST or bits + STEP > 63:
                        few.add(p)
                    break
                open_[p] -= r.n
            else:
                raise AssertionError("the rest is less than the cell's words")
        if few:
            pick = small_table(spark, [[p, str(plan[p]["cut"])] for p in sorted(few)], "cell string, cut string").select("cell", F.col("cut").cast("long").alias("cut"))
            last = at.join(F.broadcast(pick) if len(few) <= 10_000 else pick, "cell").where(F.shiftrightunsigned("h", 64 - bits) == F.col("cut"))
            units: dict[str, list] = {}
            for r in last.groupBy("cell", "h").agg(F.sum("size").alias("n")).orderBy("cell", "h").collect():  # LAST a cell at most
                units.setdefault(r.cell, []).append((r.h, r.n))
            for p in few:
                # the place of the cut in unsigned order, and of the chosen hashes
                plan[p]["bits"], plan[p]["chosen"] = bits, _fill(sorted(units[p], key=lambda u: u[0] % 2**64), open_.pop(p))
    table = [[p, x["whole"], str(x["cut"]), 64 - x.get("bits", 64), json.dumps([str(h) for h in x["chosen"]])] for p, x in plan.items()]
    made = small_table(spark, table, "cell string, whole bigint, cut string, shift int, chosen string")
    made = made.select("cell", "whole", F.col("cut").cast("long").alias("cut"), "shift", F.from_json("chosen", "array<string>").cast("array<bigint>").alias("chosen"))
    return F.broadcast(made) if len(plan) <= 10_000 else made


def take(rows: DataFrame, drawn: DataFrame) -> DataFrame:
    """rows (cell, size, h, ...) with taken."""
    got = rows.join(drawn, "cell", "left")
    # a cut at shift 0 stands for a cell without a draw: no prefix is below 0
    below = (F.col("shift") > 0) & (F.expr("shiftrightunsigned(h, shift)") < F.col("cut"))
    part = F.when(below | F.array_contains("chosen", F.col("h")), F.col("size")).otherwise(0)
    return got.withColumn("taken", F.coalesce(F.col("whole") * F.col("size") + part, F.lit(0)).cast("long")).drop("whole", "cut", "shift", "chosen")


def _quotas(sizes: dict[str, int], quota: dict[str, int] | None, passes: int) -> dict[str, float]:
    if quota is not None:
        return dict(quota)
    real = targets({None if s == NULL_SOURCE else s: n for s, n in sizes.items()}, most=passes)
    return {NULL_SOURCE if s is None else s: t for s, t in real.items()}


def mix(docs: DataFrame, members: Column, size: Column, quota: dict[str, int] | None = None, passes: int = 2, seed: int = 42) -> DataFrame:
    """(doc_id, size, source_size, target, taken, members) of every row of docs.

    members is the array of a row's sources (duplicates count once; an empty or null array is the null source); size its words (null: 0).
    quota gives words by source; unset, it follows targets(). No document is taken more than passes times; rows without words take
    none. source_size and target are those of the first source by code point. The draw depends on doc_id and seed only; rows
    with equal ids are drawn together. No rows give no rows. Extra columns are ignored, whatever their names. Sources and patterns reach the driver: a row each.
    """
    name = F.array_sort(F.array_distinct(F.transform(F.coalesce(members, F.array().cast("array<string>")), lambda x: F.coalesce(x, F.lit(NULL_SOURCE)))))
    name = F.when(F.size(name) == 0, F.array(F.lit(NULL_SOURCE))).otherwise(name)
    rows = docs.select("doc_id", F.coalesce(size, F.lit(0)).cast("long").alias("size"), F.xxhash64(F.lit(seed), F.col("doc_id")).alias("h"), name.alias("members"))
    rows = durable(rows.withColumn("cell", F.to_json("members")))
    total = {r.cell: r.n for r in rows.groupBy("cell").agg(F.sum("size").alias("n")).collect()}  # one row a pattern
    sizes: dict[str, int] = {}
    for p, n in total.items():
        for s in json.loads(p):
            sizes[s] = sizes.get(s, 0) + n
    aim = _quotas(sizes, quota, passes)
    steps = {p: [(n, k) for k in range(passes)] for p, n in total.items()}
    flow = min_cost_flow(steps, {p: dict.fromkeys(json.loads(p), n * passes) for p, n in total.items()}, {s: round(aim.get(s, 0)) for s in sizes})
    drawn = draw(rows, {p: sum(f.values()) for p, f in flow.items()}, total)
    out = take(rows, drawn).withColumn("source", F.get("members", F.lit(0)))
    return _with_facts(out, sizes, aim).select("doc_id", "size", "source_size", "target", "taken", "members")


def _with_facts(rows: DataFrame, sizes: dict[str, int], aim: dict[str, float]) -> DataFrame:
    facts = small_table(rows.sparkSession, [[s, n, float(aim.get(s, 0))] for s, n in sizes.items()], "source string, source_size bigint, target double")
    return rows.join(F.broadcast(facts) if len(sizes) <= 10_000 else facts, "source", "left")


def _slim(docs: DataFrame, kept: Column, seed: int) -> DataFrame:
    """(kept, size, source, th, h) of docs: words, source, and the hashes of text and doc_id."""
    source = F.coalesce(F.col("source").cast("string"), F.lit(NULL_SOURCE))
    return docs.select(kept.alias("kept"), word_count(F.col("text")).alias("size"), source.alias("source"), F.xxhash64(F.lit(seed), F.coalesce("text", F.lit(""))).alias("th"), F.xxhash64(F.lit(seed), F.col("doc_id")).alias("h"))


def _common_texts(rows: DataFrame) -> DataFrame:
    """(th, pattern, members) of the texts that several sources hold."""
    texts = rows.where("size > 0").groupBy("th", "source").agg(F.max("size").alias("each"))
    several = texts.groupBy("th").agg(F.array_sort(F.collect_set("source")).alias("members"), F.max("each").alias("each")).where("size(members) > 1")
    several = durable(several.withColumn("pattern", F.to_json("members")))
    most = several.groupBy("pattern").agg(F.sum("each").alias("n")).orderBy(F.desc("n"), "pattern").limit(MOST_PATTERNS).select("pattern")
    return several.join(F.broadcast(most), "pattern", "left_semi").select("th", "pattern", "members")  # broadcast: MOST_PATTERNS names


def _celled(rows: DataFrame, several: DataFrame) -> DataFrame:
    """rows with cell, the texts of one pattern in one of its sources, and the h by which they are drawn."""
    rows = rows.join(several, "th", "left")
    pattern = F.coalesce("pattern", F.to_json(F.array("source")))
    # common texts are drawn in the order of their hashes, from the other end by every second source, so that they are shared out
    turned = F.when(F.array_position("members", F.col("source")) % 2 == 0, F.bitwise_not("th")).otherwise(F.col("th"))
    order = turned.bitwiseAND(F.lit(-(1 << 32))).bitwiseOR(F.col("h").bitwiseAND(F.lit((1 << 32) - 1)))
    return rows.select("kept", "size", "source", "th", F.when(F.col("pattern").isNull(), F.col("h")).otherwise(order).alias("h"), pattern.alias("pattern"), F.to_json(F.array(pattern, "source")).alias("cell"))


def _plan(rows: DataFrame, passes: int) -> tuple[DataFrame, dict[str, int], dict[str, float]]:
    """The draw for celled rows, sizes of sources and their targets."""
    # each text of a cell once; a text of several sources is a part of each
    texts = rows.groupBy("pattern", "source", "cell", "th").agg(F.sum("size").alias("n"), F.max("size").alias("each"))
    part = F.col("each") / F.size(F.from_json("pattern", "array<string>"))
    cells = texts.groupBy("pattern", "source", "cell").agg(F.sum("n").alias("n"), F.sum(part).alias("part")).collect()  # MOST_PATTERNS times their sources, and one a source
    total, cell, sizes, distinct = {}, {}, {}, {}
    reach: dict[str, dict[str, int]] = {}
    for r in sorted(cells, key=lambda r: r.cell):
        total[r.cell], cell[r.pattern, r.source] = r.n, r.cell
        reach.setdefault(r.pattern, {})[r.source] = passes * r.n
        distinct[r.pattern] = distinct.get(r.pattern, 0) + r.part
        sizes[r.source] = sizes.get(r.source, 0) + r.n
    aim = _quotas(sizes, None, passes)
    flow = min_cost_flow({p: passes_of(round(distinct[p]), sum(to.values())) for p, to in reach.items()}, reach, {s: round(t) for s, t in aim.items()})
    return draw(rows, {cell[p, s]: n for p, to in flow.items() for s, n in to.items()}, total), sizes, aim


def mix_by_source(docs: DataFrame, passes: int = 2, seed: int = 42) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row of docs (doc_id, text, source).

    Sources overlap in the texts that several of them hold; each row counts for its own source (null: the null source), and common texts are shared out
    before any is repeated. No document is taken more than passes times; rows without words take none; a null text counts as empty. Rows with equal ids
    are drawn together, equal texts of one source may be. Results depend on the rows and seed only, not on their order. No rows give no rows. Extra columns
    are ignored, whatever their names.
    """
    rows = durable(_slim(docs, F.col("doc_id"), seed))
    rows = durable(_celled(rows, _common_texts(rows)))
    drawn, sizes, aim = _plan(rows, passes)
    out = _with_facts(take(rows, drawn), sizes, aim)
    return out.select(F.col("kept").alias("doc_id"), "size", "source_size", "target", "taken")


def repeated(docs: DataFrame, passes: int = 2, seed: int = 42) -> DataFrame:
    """The columns of docs, whatever their names, each row as often as mix_by_source() takes it; rows without words go. No rows give no rows."""
    rows = durable(_slim(docs, F.lit(0), seed))
    several = durable(_common_texts(rows))
    drawn, _, _ = _plan(durable(_celled(rows, several)), passes)
    whole = _celled(_slim(docs, packed(docs), seed), several)
    times = F.when(F.col("size") > 0, F.expr("taken div size")).otherwise(0).cast("int")
    taken = take(whole, drawn).withColumn("times", times).where("times > 0").select("kept", F.explode(F.array_repeat(F.lit(0), F.col("times"))))
    return taken.select(*unpacked(taken, "kept"))
