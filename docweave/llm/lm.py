"""Language-model scoring by deleted interpolation of word n-grams.

P_1(w) = l_1 f(w) + (1 - l_1) / (V + 1), and for each further order k up to `order` P_k(w | h) = l_k f(w | h) + (1 - l_k) P_{k-1}(w | h'), where h is the k - 1
words before w, h' those but the first, f are maximum-likelihood estimates from the counts of all training texts, and l_k depends on the bucket of
h's own count (buckets are powers of two, without an upper end). The mixture weights are learned by expectation-maximisation on held-out counts: a ninth of the
training texts is taken out of the counts, the weights are fitted to it, and its counts are put back.

Every n-gram is counted, by its 64-bit hash; the tables grow with the corpus and stay distributed. A task gathers the texts it reads
into runs of about RUN tokens, written as word numbers. A run sends each distinct n-gram once, with its count, to the partition of the n-gram's
hash; there the counts of all runs are added up, and each run gets back the sums for what it sent, in the order sent. So no row is moved
for a token, and a hot n-gram is one entry a run, whatever its count. Trigrams go second: one that holds a bigram which occurs once in all texts occurs
once itself, so its count is known where it stands and it is not sent.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import bucketed, durable, fold, forget, pieces, small_batches

ADD = 0.1
#: Tokens of a run, and bytes of text whose n-grams one partition of hashes holds: they bound what a worker keeps.
RUN, PART = 1_250_000, 16_000_000
#: Steps an octave of the estimates in the held-out counts, the first for single words, the second for longer n-grams.
STEPS = (1, 2)
_END = b"\n"  # no word holds white space
_START = np.uint64(0x9E3779B97F4A7C15)
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(29))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(32))


class Numbers(dict):
    """Words by number, in the order met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def tokens(text: bytes | None) -> list[bytes]:
    return [*text.lower().split(), _END] if text else [_END]  # bytes: A-Z and ASCII white space only


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(42)), _U, len(words))


def pack(a: np.ndarray) -> bytes:
    """Numbers of 0 or more by byte planes, as many as the largest needs; planes that compress are compressed."""
    planes = np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    out = [np.array([len(a)], "<u8").tobytes()]
    for p in planes:
        if p.any():
            plain = p.tobytes()
            small = zlib.compress(plain, 1) if len(zlib.compress(plain[:4096], 1)) < 0.9 * min(4096, len(plain)) else plain
            out += [np.array([min(len(plain), len(small))], "<u4").tobytes(), small if len(small) < len(plain) else plain]
        else:
            out.append(np.zeros(1, "<u4").tobytes())
    return b"".join(out)


def unpack(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data, "<u8", 1)[0])
    planes, at = np.zeros((8, n), np.uint8), 8
    for p in planes if n else ():
        size = int(np.frombuffer(data, "<u4", 1, at)[0])
        part = data[at + 4 : at + 4 + size]
        at += 4 + size
        if size:
            p[:] = np.frombuffer(part if size == n else zlib.decompress(part), np.uint8)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


class Run:
    """The n-grams of texts whose tokens are numbers ids into words (hashes), with sizes tokens each; learn marks the texts to learn from.

    keys are those of words and bigrams (the last two bits of a key tell its order), keys3 those of the trigrams that are sent.
    """

    def __init__(self, words: np.ndarray, ids: np.ndarray, sizes: np.ndarray, learn: np.ndarray, order: int) -> None:
        self.sizes, self.order = sizes, order
        self.first = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        self.learn = np.repeat(learn.astype(bool), sizes)
        self.token = words[ids]
        every = [mix(words) << _U(2) | _U(1)]
        if order > 1:
            every.append(mix(self._gram(2)) << _U(2) | _U(2))
        self.keys, at = np.unique(np.concatenate(every), return_inverse=True)
        #: by order, the place of each token's n-gram among the keys
        self.at = [at[: len(words)][ids], at[len(words) :]][:order]
        self.keys3, self.at3, self.sent = np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(len(ids), bool)

    def _gram(self, order: int) -> np.ndarray:
        grams = back = self.token
        for k in range(2, order + 1):
            back = np.roll(back, 1)
            back[self.first] = _START
            grams = mix(grams) + mix(back + _U(k))
        return grams

    def trigrams(self, again: np.ndarray) -> None:
        """Fixes which trigrams are sent: those whose bigrams both occur again in some text (at a text's start the trigram is the bigram)."""
        own = again[self.at[1]]
        self.sent = own & np.roll(own, 1)
        self.sent[self.first] = False
        self.keys3, self.at3 = np.unique(mix(self._gram(3)[self.sent]) << _U(2) | _U(3), return_inverse=True)

    def counts(self, learn: np.ndarray) -> np.ndarray:
        """How often the tokens that learn marks end in each key."""
        return np.bincount(np.concatenate([x[learn] for x in self.at]), minlength=len(self.keys))

    def counts3(self) -> np.ndarray:
        return np.bincount(self.at3[self.learn[self.sent]], minlength=len(self.keys3))

    def by_token(self, low: np.ndarray, high: np.ndarray, alone: np.ndarray) -> list[np.ndarray]:
        """Counts of each token's n-grams by order, from the sums of the keys; alone counts the trigrams that are not sent."""
        out = [low[x] for x in self.at]
        if self.order > 2:
            three = alone.astype(np.int64)
            three[self.sent] = high[self.at3]
            three[self.first] = out[1][self.first]
            out.append(three)
        return out


def parts(keys: np.ndarray, many: int) -> Iterator[tuple[int, np.ndarray]]:
    """(partition, places of its keys), in the order in which keys are sent and sums come back."""
    part = (keys >> _U(2)) % _U(many)
    order = np.argsort(part, kind="stable")
    part = part[order]
    cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(part) else np.zeros(1, int)
    for lo, hi in zip(cut[:-1], cut[1:]):
        yield int(part[lo]), order[lo:hi]


def _batch(schema: pa.Schema, row: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)


def _gather(schema: pa.Schema):  # noqa: ANN202
    """Batches of (doc_id, text, train, held) -> a row for each run: kind 1, words and word numbers (a), tokens of each text (b), its ids and whether each is learned from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = 0
        # texts and word numbers of held-out texts and of the others
        runs = {held: ([], Numbers()) for held in (True, False)}
        size = dict.fromkeys(runs, 0)

        def flush(held: bool) -> Iterator[pa.RecordBatch]:
            nonlocal made
            texts, number = runs[held]
            if texts:
                # frequent words have small numbers, which pack well
                used, ids, n = np.unique(np.concatenate([x[1] for x in texts]), return_inverse=True, return_counts=True)
                order = np.argsort(-n, kind="stable")
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order))
                body = np.array([len(used)], "<u8").tobytes() + hashes(list(number))[used[order]].astype("<u8").tobytes() + pack(rank[ids])
                key = (TaskContext.get().partitionId() << 24) + made
                made += 1
                yield _batch(schema, (key, 0, held, 1, body, pack(np.array([len(x[1]) for x in texts])), None, [x[0] for x in texts], [x[2] for x in texts]))
                texts.clear()
                number.clear()
                size[held] = 0

        for b in batches:
            column = b.column("text").cast(pa.binary())
            doc, train, held = (b.column(c).to_pylist() for c in ("doc_id", "train", "held"))
            for lo, hi in pieces(column):
                for i, t in enumerate(column[lo:hi].to_pylist(), lo):
                    words = tokens(t)
                    texts, number = runs[held[i]]
                    texts.append((doc[i], np.fromiter(map(number.__getitem__, words), np.int32, len(words)), train[i]))
                    size[held[i]] += len(words)
                for k in runs:
                    if size[k] > RUN:
                        yield from flush(k)
        for k in runs:
            yield from flush(k)

    return run


def _body(b: pa.RecordBatch | pa.Table, i: int, order: int) -> Run:
    a, sizes = b.column("a")[i].as_py(), unpack(b.column("b")[i].as_py()).astype(np.int64)
    n = int(np.frombuffer(a, "<u8", 1)[0])
    return Run(np.frombuffer(a, "<u8", n, 8).astype(_U), unpack(a[8 + 8 * n :]).astype(np.int64), sizes, np.array(b.column("learn")[i].as_py(), bool), order)


REQUEST = pa.schema([("part", pa.int32()), ("run", pa.int64()), ("held", pa.bool_()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])


def _ask(run: int, held: bool, keys: np.ndarray, n: np.ndarray, others: np.ndarray, many: int) -> Iterator[pa.RecordBatch]:
    """A run's keys of each partition in steps from one to the next (a), their counts in texts to learn from (b) and in others (c)."""
    for part, at in parts(keys, many):
        yield _batch(REQUEST, (part, run, held, pack(np.diff(keys[at], prepend=_U(0))), pack(n[at]), pack(others[at])))


def _requests(order: int, many: int):  # noqa: ANN202
    """Runs -> what they ask about words and bigrams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                r = _body(b, i, order)
                yield from _ask(b.column("run")[i].as_py(), b.column("held")[i].as_py(), r.keys, r.counts(r.learn), r.counts(~r.learn), many)

    return run


def _sum(schema: pa.Schema, kind: int):  # noqa: ANN202
    """Requests sorted by (part, run) -> what each run asked for, as rows of the kind: the counts of all other runs (a), for held-out runs those of the runs that aren't (b),
    and whether a key occurs again in any text (c). With kind 0 also tokens and distinct words of each part (kind 2)."""

    def done(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        every, at = np.unique(np.concatenate([np.cumsum(unpack(r[3]), dtype=_U) for r in rows]), return_inverse=True)
        cuts = np.concatenate([[0], np.cumsum([int(np.frombuffer(r[3], "<u8", 1)[0]) for r in rows])])
        main, rest, others = (np.zeros(len(every), np.int64) for _ in range(3))
        for r, lo, hi in zip(rows, cuts, cuts[1:]):
            (rest if r[2] else main)[at[lo:hi]] += unpack(r[4]).astype(np.int64)  # each key once a run
            others[at[lo:hi]] += unpack(r[5]).astype(np.int64)
        total = main + rest
        again = total + others > 1
        for (part, run, held, _, n, _), lo, hi in zip(rows, cuts, cuts[1:]):
            place = at[lo:hi]
            yield _batch(schema, (run, part, held, kind, pack(total[place] - unpack(n).astype(np.int64)), pack(main[place]) if held else None, pack(again[place]) if kind == 0 else None, None, None))
        if kind == 0:
            words = every & _U(3) == 1
            facts = [total[words].sum(), (total[words] > 0).sum(), main[words].sum(), (main[words] > 0).sum()]
            yield _batch(schema, (-1, rows[0][0], False, 2, np.array(facts, "<i8").tobytes(), None, None, None, None))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for b in batches:
            for r in zip(*(b.column(c).to_pylist() for c in REQUEST.names)):
                if rows and rows[0][0] != r[0]:
                    yield from done(rows)
                    rows = []
                rows.append(r)
        if rows:
            yield from done(rows)

    return run


def _sums(replies: pa.Table, kind: int, keys: np.ndarray, many: int) -> list[np.ndarray]:
    """The replies' numbers of each key: those of columns a, b and c."""
    rows = sorted((r for r in replies.select(["kind", "part", "a", "b", "c"]).to_pylist() if r["kind"] == kind), key=lambda r: r["part"])
    out = [np.zeros(len(keys), np.int64) for _ in range(3)]
    for r, (_, at) in zip(rows, parts(keys, many), strict=True):
        for sums, c in zip(out, "abc"):
            if r[c] is not None:
                sums[at] = unpack(r[c]).astype(np.int64)
    return out


def joined(body: pa.Table, replies: pa.Table, order: int, many: int) -> tuple[list, Run, list[np.ndarray], list[np.ndarray]]:
    """(doc_ids, run, counts by token and order over all training texts, the same without held-out texts for a held-out run) of one run."""
    run = _body(body, 0, order)
    low, low_main, again = _sums(replies, 0, run.keys, many)
    low += run.counts(run.learn)
    high = high_main = np.zeros(0, np.int64)
    if order > 2:
        run.trigrams(again > 0)
        high, high_main, _ = _sums(replies, 3, run.keys3, many)
        high += run.counts3()
    return body.column("ids")[0].as_py(), run, run.by_token(low, high, run.learn), run.by_token(low_main, high_main, np.zeros_like(run.learn))


class Model:
    """Mixture weights by order (the first has one, the others one a bucket), given the size of the counts."""

    def __init__(self, n: int, kinds: int, order: int) -> None:
        self.n, self.kinds, self.order = n, kinds, order
        self.lowest = 0.9 if n else 0.0
        self.weights = np.full((order + 1, 64), 0.5)
        self.weights[:, 0] = 0  # an unseen context has no estimate

    def estimates(self, run: Run, counts: list[np.ndarray], ends: int) -> tuple[np.ndarray, np.ndarray]:
        """Context buckets and estimates of every token, by order (the first has no context); ends is the number of texts counted, each an open context at its start."""
        b, f = [np.zeros(len(run.token), np.int64)], [counts[0] / max(1, self.n)]
        for lower, c in zip(counts, counts[1:]):
            n = np.roll(lower, 1)
            n[run.first] = ends
            b.append(np.where(n > 0, np.floor(np.log2(np.maximum(n, 1))) + 1, 0).astype(np.int64))
            f.append(c / np.maximum(n, 1) * (n > 0))
        return np.array(b), np.array(f)

    def p(self, b: np.ndarray, f: np.ndarray) -> np.ndarray:
        out = self.lowest * f[0] + (1 - self.lowest) / (self.kinds + 1)
        for k in range(1, self.order):
            w = self.weights[k][b[k]]
            out = w * f[k] + (1 - w) * out
        return out

    def learn(self, b: np.ndarray, f: np.ndarray, n: np.ndarray, rounds: int = 50) -> None:
        """Expectation-maximisation over held-out tokens, n of each sort. A bucket without any takes the weight of the one below."""
        for _ in range(rounds if len(n) else 0):
            # the share of each order in each sort's tokens, from the highest down
            left, shares = n / self.p(b, f), []
            for k in range(self.order - 1, 0, -1):
                w = self.weights[k][b[k]]
                shares.append((k, left * w * f[k]))
                left = left * (1 - w)
            one, none = (left * self.lowest * f[0]).sum(), left * (1 - self.lowest) / (self.kinds + 1)
            below = left * self.lowest * f[0] + none
            self.lowest = min(0.9999, max(0.01, one / max(1e-300, one + none.sum())))
            for k, mine in reversed(shares):
                top, whole = np.bincount(b[k], mine, 64), np.bincount(b[k], mine + below, 64)
                below = below + mine
                for j in range(1, 64):
                    self.weights[k, j] = min(0.999, max(1e-4, top[j] / whole[j])) if whole[j] > 0 else self.weights[k, j - 1] if j > 1 else self.weights[k, j]


def _steps(f: np.ndarray) -> np.ndarray:
    return np.array([[STEPS[0]], *[[STEPS[1]]] * (len(f) - 1)])


def _coded(f: np.ndarray) -> np.ndarray:
    """Estimates in steps of an octave's STEPS; 0 stands for none."""
    with np.errstate(divide="ignore"):
        return np.where(f > 0, 1 + np.rint(-_steps(f) * np.log2(np.maximum(f, 1e-18))), 0).astype(np.int64)


def _decoded(q: np.ndarray) -> np.ndarray:
    return np.where(q > 0, np.exp2(-(q - 1) / _steps(q)), 0.0)


def score(docs: DataFrame, train: Column, held_out: Column, order: int = 3) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row of docs (doc_id, text), by n-grams of up to order (1 to 3) words.

    train marks the rows to learn from; those of them that held_out marks give the mixture weights. A null or empty text is one end.
    A word that training lacks counts 0 in both models; every log is finite. Repeated rows are each scored (and each counted), long texts whole. Without
    training rows N and V are 0 and every token has an equal share; without held-out rows the weights are one half. Extra columns are ignored, whatever their names. No rows
    give no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    many = max(1, -(-size // PART))
    doc_type = docs.schema["doc_id"].dataType
    train, held_out = F.coalesce(train, F.lit(False)), F.coalesce(held_out, F.lit(False))
    read = docs.select("doc_id", "text", train.alias("train"), (train & held_out).alias("held"))
    shape = StructType.fromDDL(f"run long, part int, held boolean, kind int, a binary, b binary, c binary, ids array<{doc_type.simpleString()}>, learn array<boolean>")
    arrow = spark.createDataFrame([], shape).toArrow().schema
    # about as many buckets as runs: what is written by run is read by run without a shuffle
    bodies, drop = bucketed(read.mapInArrow(_gather(arrow), shape), "run", min(4096, max(1, size // (8 * RUN))))
    request = "part int, run long, held boolean, a binary, b binary, c binary"

    def answered(asked: DataFrame, kind: int) -> DataFrame:
        return durable(asked.repartition(min(many, 100_000), "part").sortWithinPartitions("part", "run").mapInArrow(_sum(arrow, kind), shape))

    def by_run(answers: DataFrame, rows: Column, work, kind: str) -> DataFrame:  # noqa: ANN001
        return bodies.where(rows).groupBy("run").cogroup(answers.where((F.col("kind") != 2) & rows).groupBy("run")).applyInArrow(work, kind)

    def ask3(body: pa.Table, answers: pa.Table) -> pa.Table:
        run = _body(body, 0, order)
        run.trigrams(_sums(answers, 0, run.keys, many)[2] > 0)
        return pa.Table.from_batches(_ask(body.column("run")[0].as_py(), body.column("held")[0].as_py(), run.keys3, run.counts3(), np.zeros(len(run.keys3), np.int64), many), REQUEST)

    replies = low = answered(bodies.mapInArrow(_requests(order, many), request), 0)
    if order > 2:
        high = answered(by_run(low, F.lit(True), ask3, request), 3)
        replies = low.unionByName(high)
    facts = replies.where("kind = 2").select("a").toLocalIterator()  # one row a partition, taken in turn
    total, kinds, main_total, main_kinds = (int(x) for x in np.sum([np.zeros(4, np.int64), *(np.frombuffer(bytes(r.a), "<i8") for r in facts)], axis=0))
    ends, main_ends = docs.agg(F.count_if(train), F.count_if(train & ~held_out)).first()
    model = Model(main_total, main_kinds, order)

    def weigh(body: pa.Table, sums: pa.Table) -> pa.Table:
        _, run, _, main = joined(body, sums, order, many)
        b, f = model.estimates(run, main, main_ends)
        cell, n = np.unique(np.concatenate([b[1:], _coded(f)]), axis=1, return_counts=True)
        return pa.table([pa.array(list(cell.T), pa.list_(pa.int64())), pa.array(n)], names=["cell", "n"])

    held = by_run(replies, F.col("held"), weigh, "cell array<long>, n long")
    cells = held.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # cells of a grid: buckets x steps of the estimates
    if cells.num_rows:
        grid = np.array(cells.column("cell").to_pylist()).T
        model.learn(np.concatenate([np.zeros((1, grid.shape[1]), np.int64), grid[: order - 1]]), _decoded(grid[order - 1 :]), cells.column("n").to_numpy())
    model.n, model.kinds = total, kinds

    def judge(body: pa.Table, sums: pa.Table) -> pa.Table:
        ids, run, every, _ = joined(body, sums, order, many)
        c1 = every[0]
        base = np.log10(c1 + ADD) - np.log10(total + ADD * (kinds + 1))
        cols = [np.add.reduceat(x, run.first) for x in ((c1 > 0).astype(np.int64), base, np.log10(model.p(*model.estimates(run, every, ends))))]
        return pa.table([pa.array(ids, arrow.field("ids").type.value_type), pa.array(run.sizes), *map(pa.array, cols)], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    out = durable(by_run(replies, F.lit(True), judge, f"doc_id {doc_type.simpleString()}, n_tokens long, n_known long, base_score double, score double"))
    forget(low, *([high] if order > 2 else []))
    drop()
    return out.select("doc_id", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def score_fold(docs: DataFrame, order: int = 3) -> DataFrame:
    """score() with rows of fold 0 of 10 left out of training and fold 1 kept for the weights, and held_out."""
    part = fold(F.col("doc_id"), 10)
    out = score(docs, part != 0, part == 1, order)
    return out.select("doc_id", (fold(F.col("doc_id"), 10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
