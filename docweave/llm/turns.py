"""Structure repair of conversations by a min-plus matrix scan.

Role initials must read (s?(ua)+)?, an automaton of four states: nothing yet, after s, after u, after a. Each turn is a 4x4 matrix whose entry
(i, j) is the cheapest (cost, audit) that leads from state i to j over this turn and any number of inserts after it (the closure of the insert
matrix). Products take the smallest pair and join audits. Pairs of equal cost over the same turns hold equally many letters, so none is a proper
prefix of another and the order of audits survives joining on either side: the product is associative and its result the cheapest, ASCII-least audit.

Turns are put in order once, by range, without their texts; a conversation may cross any number of partitions. Each task multiplies the runs it holds (balanced, short
runs from a cache) and finishes the conversations that lie inside; only the first and last run of a partition enter a tree of groups of FAN neighbours.
Then the audit is read along the conversation's texts, streamed in order: SHA-256 of a conversation has no other way than one after another,
but nothing of it is held beyond one batch and its audit (one letter a turn, which the result holds anyway).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, forget, small_batches

#: Costs of the edits, what an undeleted truncated turn adds, and the moves of the automaton (states 0 to 3).
REROLE, DELETE, INSERT, CUT = 1, 2, 5, 5
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ENDS = (0, 3)
ROLES = {2: "user", 3: "assistant"}

#: Partitions whose runs one step of the tree multiplies.
FAN = 32
#: Runs up to this length are remembered.
SHORT = 8
BLANK, DUPLICATE, TRUNCATED = "b", "d", "t"

Pair = tuple[int, str] | None
Matrix = tuple[Pair, ...]


def times(x: Matrix, y: Matrix) -> Matrix:
    """The min-plus product: entry (i, j) is the least of x(i, m) then y(m, j)."""
    out: list[Pair] = []
    for i in range(0, 16, 4):
        row = [(m, p) for m, p in enumerate(x[i : i + 4]) if p]
        for j in range(4):
            out.append(min(((p[0] + q[0], p[1] + q[1]) for m, p in row if (q := y[4 * m + j])), default=None))
    return tuple(out)


def _matrix(edges: dict[tuple[int, int], Pair]) -> Matrix:
    return tuple(edges.get((i, j)) for i in range(4) for j in range(4))


def _closure() -> Matrix:
    """No insert, one, or two: longer ones come back to a state at a price."""
    one = _matrix({(i, i): (0, "") for i in range(4)} | {(i, j): (INSERT, "I") for (i, _), j in STEP.items() if j in ROLES})
    return times(one, one)


UNIT = _matrix({(i, i): (0, "") for i in range(4)})
CLOSURE = _closure()


@lru_cache(1024)
def turn(initial: str, fault: str) -> Matrix:
    """The matrix of one turn, inserts after it included."""
    edges: dict[tuple[int, int], Pair] = {(i, i): (DELETE, "D") for i in range(4)}
    if fault not in (BLANK, DUPLICATE):
        more = CUT if fault == TRUNCATED else 0
        for (i, c), j in STEP.items():
            for pair in [(more, "K")] * (c == initial) + [(more + REROLE, "R")] * (j in ROLES):
                edges[i, j] = min(edges.get((i, j)) or pair, pair)
    return times(_matrix(edges), CLOSURE)


@lru_cache(50_000)
def _short(kinds: tuple[tuple[str, str], ...]) -> Matrix:
    if len(kinds) == 1:
        return turn(*kinds[0])
    half = len(kinds) // 2
    return times(_short(kinds[:half]), _short(kinds[half:]))


def scan(kinds: list[tuple[str, str]]) -> Matrix:
    """The product of a run of turns (initial, fault), balanced."""
    level = [_short(tuple(kinds[at : at + SHORT])) for at in range(0, len(kinds), SHORT)]
    while len(level) > 1:
        level = [times(*level[at : at + 2]) if at + 1 < len(level) else level[at] for at in range(0, len(level), 2)]
    return level[0] if level else UNIT


def best(m: Matrix) -> tuple[int, str]:
    """The cheapest edits of a whole conversation with this product."""
    whole = times(CLOSURE, m)
    return min(p for j in ENDS if (p := whole[j]))


class Run:
    """Neighbouring turns of one conversation: their product, and what counts are made of. Runs join in order."""

    def __init__(self, n: int, lo: int | None, hi: int | None, distinct: int, faults: tuple[int, int, int], illegal: int, first: str, last: str, m: Matrix):
        self.n, self.lo, self.hi, self.distinct, self.faults, self.illegal, self.first, self.last, self.m = n, lo, hi, distinct, faults, illegal, first, last, m

    @staticmethod
    def of(turns: list[int | None], kinds: list[tuple[str, str]]) -> Run:
        real = [t for t in turns if t is not None]
        bad = sum(a[0] + b[0] not in LEGAL for a, b in zip(kinds, kinds[1:], strict=False))
        count = [f for _, f in kinds].count
        return Run(len(kinds), real[0] if real else None, real[-1] if real else None, len(set(real)), (count(BLANK), count(DUPLICATE), count(TRUNCATED)), bad, kinds[0][0], kinds[-1][0], scan(kinds))

    def join(self, o: Run) -> Run:
        lo, hi = (self.lo if self.lo is not None else o.lo), (o.hi if o.hi is not None else self.hi)
        distinct = self.distinct + o.distinct - (self.hi is not None and self.hi == o.lo)
        faults = tuple(a + b for a, b in zip(self.faults, o.faults, strict=True))
        return Run(self.n + o.n, lo, hi, distinct, faults, self.illegal + o.illegal + (self.last + o.first not in LEGAL), self.first, o.last, times(self.m, o.m))

    def row(self, conv: int | None, part: int, whole: bool) -> dict:
        cost, audit = best(self.m) if whole else (None, None)
        gaps = self.hi - self.lo + 1 - self.distinct if self.lo is not None else 0
        stats = {"gaps": gaps, "blank": self.faults[0], "duplicate": self.faults[1], "truncated": self.faults[2], "illegal": self.illegal, "cost": cost, "audit": audit}
        mine = None if whole else {"n": self.n, "lo": self.lo, "hi": self.hi, "distinct": self.distinct, "first": self.first, "last": self.last, "costs": [p and p[0] for p in self.m], "audits": [p and p[1] for p in self.m]}
        return {"conv_id": conv, "part": part, "stats": stats, "run": mine}

    @staticmethod
    def from_row(r: dict) -> Run:
        s, x = r["stats"], r["run"]
        m = tuple(None if c is None else (c, a) for c, a in zip(x["costs"], x["audits"], strict=True))
        return Run(x["n"], x["lo"], x["hi"], x["distinct"], (s["blank"], s["duplicate"], s["truncated"]), s["illegal"], x["first"], x["last"], m)


#: Pairs of neighbouring initials that are in order.
LEGAL = ("su", "ua", "au")

_STATS = "gaps:bigint,blank:bigint,duplicate:bigint,truncated:bigint,illegal:bigint,cost:bigint,audit:string"
_RUN = "n:bigint,lo:bigint,hi:bigint,distinct:bigint,first:string,last:string,costs:array<bigint>,audits:array<string>"
_PART = f"conv_id long, part long, stats struct<{_STATS}>, run struct<{_RUN}>"
_whole = [(c, pa.string() if c == "audit" else pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")]
_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int64()), ("stats", pa.struct(_whole)),
    ("run", pa.struct([*((c, pa.int64()) for c in ("n", "lo", "hi", "distinct")), ("first", pa.string()), ("last", pa.string()), ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))])),
])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns in order to runs: one for each conversation of the partition, finished unless it may go on in a neighbouring one."""
    part = TaskContext.get().partitionId()
    none = object()
    conv, held, stack, ready = none, ([], []), [], []  # stack: (level, run), levels falling: a balanced product of any length
    first = True

    def fold() -> None:
        level, run = 0, Run.of(*held)
        held[0].clear()
        held[1].clear()
        while stack and stack[-1][0] == level:
            run, level = stack.pop()[1].join(run), level + 1
        stack.append((level, run))

    def close(last: bool) -> None:
        nonlocal first
        if held[1]:
            fold()
        run = stack.pop()[1]
        while stack:
            run = stack.pop()[1].join(run)
        ready.append(run.row(conv, part, not first and not last))
        first = False

    for batch in batches:
        for c, t, i, f in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "turn", "initial", "fault")), strict=True):
            if c != conv:
                if conv is not none:
                    close(False)
                conv = c
            held[0].append(t)
            held[1].append((i, f))
            if len(held[1]) == 1024:
                fold()
        if ready:
            yield pa.RecordBatch.from_pylist(ready, _ARROW)
            ready.clear()
    if conv is not none:
        close(True)
        yield pa.RecordBatch.from_pylist(ready, _ARROW)


def _joined(finish: bool) -> Callable[[pa.Table], pa.Table]:
    """At most FAN runs of one conversation to one."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        level = [Run.from_row(r) for r in rows]
        while len(level) > 1:
            level = [level[at].join(level[at + 1]) if at + 1 < len(level) else level[at] for at in range(0, len(level), 2)]
        return pa.Table.from_pylist([level[0].row(rows[0]["conv_id"], rows[0]["part"] // FAN, finish)], _ARROW)

    return run


def ordered_keys(turns: DataFrame) -> list[Column]:
    """A conversation's order: by turn (null first), then by role and by the hash of the text; rows equal in all of that are the same."""
    return [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("sha").asc()]


def prepared(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, sha) of every turn; a null role or text is one space. Other columns are not read."""
    text = F.coalesce(F.col("text"), F.lit(" "))
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"), F.sha2(text.cast("binary"), 256).alias("sha"))


def audits(rows: DataFrame) -> DataFrame:
    """(conv_id, stats) of every conversation of prepared rows: gaps, blank, duplicate, truncated, illegal, cost, audit."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    fault = F.when(blank, BLANK).when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), TRUNCATED).otherwise("")
    keyed = rows.select("conv_id", "turn", "role", "sha", fault.alias("fault"), F.monotonically_increasing_id().alias("salt"))  # the salt parts rows that are the same
    slim = durable(keyed.repartitionByRange("conv_id", *ordered_keys(rows), "salt").sortWithinPartitions("conv_id", *ordered_keys(rows), "salt").withColumn("pos", F.monotonically_increasing_id()).drop("salt"))
    new = slim.where(F.col("fault") != BLANK).groupBy("conv_id", "role", "sha").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("new"))
    said = F.when((F.col("fault") != BLANK) & F.col("new").isNull(), DUPLICATE).otherwise(F.col("fault"))
    told = slim.join(new, "pos", "left").select("pos", "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), said.alias("fault"))
    parts = durable(told.repartitionByRange("pos").sortWithinPartitions("pos").drop("pos").mapInArrow(_runs, _PART))
    forget(slim)
    done, open_ = parts.where("run is null"), parts.where("run is not null")
    width = (open_.agg(F.max("part").alias("p")).first().p or 0) + 1
    while True:
        finish = width <= FAN
        open_ = open_.groupBy("conv_id", F.floor(F.col("part") / FAN).alias("group")).applyInArrow(_joined(finish), _PART)
        if finish:
            return done.unionByName(open_).select("conv_id", "stats")
        open_, width = durable(open_), -(-width // FAN)


class Replay:
    """Reads an audit along a conversation's turns."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, 0

    def inserted(self) -> Iterator[tuple[str, str]]:
        """The roles inserted before the next turn, or at the end."""
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self.state = next(j for (i, _), j in STEP.items() if i == self.state and j in ROLES)
            yield "I", ROLES[self.state]

    def turn(self, role: str) -> tuple[str, str]:
        """The edit of the next turn and its role after it."""
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            self.state = next(j for (i, _), j in STEP.items() if i == self.state and j in ROLES)
            role = ROLES[self.state]
        elif edit == "K":
            self.state = STEP[self.state, role[:1]]
        return edit, role


class Digest:
    """Hashes a repaired conversation while it passes."""

    SCHEMA = f"conv_id long, stats struct<{_STATS}>, repaired_sha256 string"
    ARROW = pa.schema([("conv_id", pa.int64()), ("stats", pa.struct(_whole)), ("repaired_sha256", pa.string())])

    def __init__(self, conv: int | None, stats: dict):
        self.conv, self.stats, self.sha, self.any = conv, stats, hashlib.sha256(), False

    def edit(self, letter: str, turn: int | None, role: str, text: str) -> list[dict]:
        if letter != "D":
            self.sha.update(f"{chr(10) * self.any}{role}:{text}".encode())
            self.any = True
        return []

    def close(self) -> list[dict]:
        return [{"conv_id": self.conv, "stats": self.stats, "repaired_sha256": self.sha.hexdigest()}]


class Rows:
    """Numbers the turns of a repaired conversation while they pass."""

    SCHEMA = "conv_id long, place long, edit string, turn long, role string, text string"
    ARROW = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def __init__(self, conv: int | None, stats: dict):
        self.conv, self.place = conv, 0

    def edit(self, letter: str, turn: int | None, role: str, text: str) -> list[dict]:
        if letter == "D":
            return []
        self.place += 1
        return [{"conv_id": self.conv, "place": self.place, "edit": letter, "turn": turn, "role": role, "text": text}]

    def close(self) -> list[dict]:
        return []


def _replayed(kind: type) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Headers, each before its conversation's turns in order, to what kind makes of the edits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay = maker = None

        def end() -> list[dict]:
            return [] if maker is None else [x for letter, role in replay.inserted() for x in maker.edit(letter, None, role, "")] + maker.close()

        for batch in batches:
            out: list[dict] = []
            for c, h, t, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "head", "turn", "role", "text")), strict=True):
                if h is not None:
                    out += end()
                    replay, maker = Replay(h["audit"]), kind(c, h)
                else:
                    for letter, r in replay.inserted():
                        out += maker.edit(letter, None, r, "")
                    letter, r = replay.turn(role)
                    out += maker.edit(letter, t, r, text)
            if out:
                yield pa.RecordBatch.from_pylist(out, kind.ARROW)
        if out := end():
            yield pa.RecordBatch.from_pylist(out, kind.ARROW)

    return run


def _replay(rows: DataFrame, heads: DataFrame, kind: type) -> DataFrame:
    small_batches(rows.sparkSession)
    stream = heads.select("conv_id", F.col("stats").alias("head")).unionByName(rows, allowMissingColumns=True)
    ordered = stream.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("head").isNull(), *ordered_keys(rows))
    return ordered.select("conv_id", "head", "turn", "role", "text").mapInArrow(_replayed(kind), kind.SCHEMA)


def repaired(turns: DataFrame) -> DataFrame:
    """(conv_id, place, edit, turn, role, text) of the turns that the cheapest repair of each conversation leaves: kept (K), with another role (R) or inserted (I, no turn, no text)."""
    rows = prepared(turns)
    return _replay(rows, audits(rows), Rows)


def reports(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conv_id of ids, once; those without turns have zeros, no audit and the empty text's hash.

    Rows with a null conv_id are one conversation; null turns come first and count for no gap; a null role or text is one space. Equal
    turns go by role, then by the text's hash, so reruns agree; rows equal in all stay (later ones are duplicates). Empty texts are blank faults, long ones are
    streamed. Extra columns are not read, whatever their names. Empty tables give no rows.
    """
    rows = prepared(turns)
    zeros = F.from_json(F.lit('{"gaps":0,"blank":0,"duplicate":0,"truncated":0,"illegal":0,"cost":0,"audit":""}'), f"struct<{_STATS}>")
    every = ids.select(F.col("conv_id").cast("long").alias("id")).distinct()
    found = audits(rows)
    heads = every.join(found, every.id.eqNullSafe(found.conv_id), "left").select(F.col("id").alias("conv_id"), F.coalesce("stats", zeros).alias("stats"))
    return _replay(rows, heads, Digest).select("conv_id", "stats.*", "repaired_sha256")


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with planted faults, by crc32(conv_id:turn) % 20: 0 drops the row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes it the user's. Nulls are one space."""
    part = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    kind = F.crc32(F.concat(part[0], F.lit(":"), part[1]).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(part[3], ".!?", "")).otherwise(part[3])
    rows = turns.where(kind != 0).select("conv_id", "turn", F.when(kind == 4, "user").otherwise(part[2]).alias("role"), text.alias("text"), F.when(kind == 3, 2).otherwise(1).alias("times"))
    return rows.withColumn("times", F.explode(F.array_repeat("times", F.col("times")))).drop("times")
