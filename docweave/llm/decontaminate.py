"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of the benchmark's terms are counted over all documents.
2. The TF-IDF matrix of benchmark passages is factored by a randomised SVD whose products run over the distributed rows. The latent space has SHARE as
   many axes as there are passages, RANK at most; a passage that keeps less than KEPT of its norm there gets its residual as an axis of its own.
3. Every whole document is cut into overlapping windows; a window is a candidate of the passages whose cosine in the latent
   space reaches LEAST_COSINE, or what a copy with PARAPHRASE of its words would reach where that is less (Index.weigh). Words are no rarer
   than RAREST and words outside the benchmark weigh no more than the average word of the plainest passage, so neither bound nor weights move with
   the number of documents. A window's cosine is at most the root of its share of TF-IDF mass in benchmark terms; where that is below the least bound it is skipped,
   and so it is where the most that each of its words adds to any passage, as a share of that passage's bound, comes to less than the whole.
4. Candidates are verified: the longest common subsequence must cover OVERLAP of the passage, or, for paraphrases, PARAPHRASE of it
   together with its answer's words in order and a cosine of PARAPHRASE_COSINE over a stretch as long as the passage (a window of WINDOW words
   sees sqrt(WINDOW / m) of a verbatim copy of m words at most). FEWEST words are needed in any case, of shorter passages all.

The benchmark is worked off in blocks of TERMS terms, so what the driver holds and what is sent is bounded; GROUP blocks share one scan of the documents.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, small_batches, texts, unpacked, with_row, with_text

WINDOW, STRIDE, PASSAGE = 16, 8, 64
LEAST_COSINE, OVERLAP, PARAPHRASE, PARAPHRASE_COSINE, ANSWER = 0.3, 0.8, 0.65, 0.5, 0.9
FEWEST = 7
#: Terms of a block (one latent space), and blocks of a scan.
TERMS, GROUP = 40_000, 4
RANK, SHARE, KEPT = 128, 0.75, 0.8
#: The idf of a word in one of so many documents; rarer words weigh the same.
RAREST = math.log(1_000)
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def tokens(text: bytes | None) -> list[bytes]:
    """Lower-case words of letters, digits and non-ASCII characters; ASCII punctuation separates."""
    text = text or b""
    if not text.isascii():
        text = text.decode("utf-8", "replace").lower().encode()
    return text.translate(_TABLE).split()


def common(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence (bit-parallel)."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for x in b:
        if m := masks.get(x):
            u = v & m
            v = (v + u | v - u) & full
    return len(a) - v.bit_count()


class Words(dict):
    """Numbers of words: a benchmark term's own, others from the number of terms on, in the order met."""

    def __init__(self, terms: dict[bytes, int]) -> None:
        self.terms = terms

    def __missing__(self, word: bytes) -> int:
        n = self.terms.get(word)
        if n is None:
            n = len(self.terms) + self.setdefault(b"", 0)
            self[b""] += 1
        self[word] = n
        return n


class Index:
    """What the executors need of a block of the benchmark."""

    def __init__(self, items: Iterable[tuple[int, str, str | None]] = ()) -> None:
        self.terms: dict[bytes, int] = {}
        self.owner, self.passages, self.answers = [], [], []
        for x in items:
            self.add(*x)

    def add(self, item: int, text: str, answer: str | None) -> None:
        words = tokens(text.encode())
        last = tokens(answer.encode()) if answer else words[-max(3, len(words) // 5) :]
        cuts = list(range(0, max(1, len(words) - PASSAGE // 4), PASSAGE)) + [len(words)]
        for lo, hi in zip(cuts, cuts[1:]):
            if words[lo:hi]:
                self.owner.append(item)
                self.passages.append([self.terms.setdefault(w, len(self.terms)) for w in words[lo:hi]])
                self.answers.append([self.terms.setdefault(w, len(self.terms)) for w in last])

    def weigh(self, docs: int, df: dict[int, int]) -> None:
        """Word weights, and each passage's candidate bound: the cosine of a window with PARAPHRASE of the passage's words of average weight, all others of the greatest."""
        self.idf = np.array([min(RAREST, math.log((docs + 1) / (df.get(i, 0) + 1))) + 0.05 for i in range(len(self.terms))] + [0.0])
        m = np.array([len(set(p)) for p in self.passages])
        r = np.array([math.sqrt(sum(self.idf[t] ** 2 for t in set(p))) for p in self.passages]) / np.sqrt(m)
        self.idf[-1] = r.min()
        n = PARAPHRASE * np.minimum(m, WINDOW)
        reached = n * r / np.sqrt(m * (n * r**2 + (WINDOW - n) * self.idf.max() ** 2))
        self.least = np.minimum(LEAST_COSINE, KEPT**2 * reached).astype(np.float32)

    def rows(self) -> list[tuple[list[int], list[float]]]:
        """Unit TF-IDF rows of the passages; a term counts once however often it occurs, here and in windows, so that filler repeated between words doesn't hide them."""
        out = []
        for p in self.passages:
            n = list(dict.fromkeys(p))
            w = self.idf[n]
            out.append((n, (w / np.linalg.norm(w)).tolist()))
        return out

    def fit(self, docs: DataFrame) -> None:
        """Right singular vectors of the passage matrix by randomised SVD, and residual axes of the passages that they keep too little of."""
        spark, rows = docs.sparkSession, self.rows()
        parts = max(1, min(64, len(rows) // 256))
        table = spark.createDataFrame([(i, t, w) for i, (t, w) in enumerate(rows)], "p int, t array<int>, w array<double>").repartition(parts)
        n, rank = len(self.terms), max(1, min(RANK, math.ceil(SHARE * len(rows))))

        def times(right: np.ndarray) -> np.ndarray:
            """(A'A) right, from partial sums of the partitions, added up by term."""
            sent = spark.sparkContext.broadcast(right.astype(np.float32))

            def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                total: dict[int, np.ndarray] = {}
                for b in batches:
                    for t, w in zip(b.column("t").to_pylist(), b.column("w").to_pylist()):
                        w = np.array(w)
                        for i, v in zip(t, np.outer(w, w @ sent.value[t])):
                            total[i] = total[i] + v if i in total else v
                yield from whole(total)

            def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                total: dict[int, np.ndarray] = {}
                for b in batches:
                    for t, v in zip(b.column("t").to_pylist(), b.column("v").to_pylist()):
                        v = np.frombuffer(v)
                        total[t] = total[t] + v if t in total else v
                yield from whole(total)

            def whole(total: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
                yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["t", "v"])

            sums = table.mapInArrow(part, "t int, v binary")
            if parts > 1:
                sums = sums.repartition("t").mapInArrow(add, "t int, v binary")
            out = np.zeros(right.shape)
            for r in sums.toLocalIterator():  # TERMS (and one item's) rows of RANK + 16 numbers at most
                out[r.t] = np.frombuffer(bytes(r.v))
            sent.unpersist()
            return out

        q = np.random.default_rng(42).standard_normal((n, min(n, rank + 16)))
        for _ in range(2):
            q, _ = np.linalg.qr(times(q))
        small = q.T @ times(q)
        values, vectors = np.linalg.eigh((small + small.T) / 2)
        basis = q @ vectors[:, np.argsort(-values)[:rank]]
        more: list[np.ndarray] = []
        for t, w in rows:
            x = np.zeros(n)
            x[t] = w
            kept = np.concatenate([basis[t].T @ w, [m[t] @ w for m in more]])
            if np.linalg.norm(kept) < KEPT:
                rest = x - basis @ kept[: basis.shape[1]] - sum(k * m for k, m in zip(kept[basis.shape[1] :], more))
                more.append(rest / np.linalg.norm(rest))
        self.own_axes = len(more)
        basis = np.column_stack([basis, *more])
        self.latent = np.array([np.array(w) @ basis[t] for t, w in rows]).astype(np.float32)
        self.basis = np.vstack([basis * self.idf[:n, None], np.zeros((1, basis.shape[1]))]).astype(np.float32)
        # the most that a term can add to the cosine of any passage, as a share of that passage's bound
        self.most = np.concatenate([(self.basis[at : at + 256] @ (self.latent / self.least[:, None]).T).max(1) for at in range(0, n + 1, 256)])

    def likeness(self, p: int, near: list[int]) -> float:
        """The best latent cosine of passage p and a stretch of near with as many words. near numbers words outside the benchmark from len(terms) on."""
        n, m = len(self.terms), min(len(self.passages[p]), len(near))
        dots = (self.basis[np.minimum(near, n)] @ self.latent[p]).tolist()
        held, mass, dot, best = Counter(), 0.0, 0.0, -1.0
        for i, t in enumerate(near):
            if not held[t]:
                mass += self.idf[min(t, n)] ** 2
                dot += dots[i]
            held[t] += 1
            if i >= m:
                t = near[i - m]
                held[t] -= 1
                if not held[t]:
                    mass -= self.idf[min(t, n)] ** 2
                    dot -= dots[i - m]
            if i >= m - 1:
                best = max(best, dot / math.sqrt(max(mass, 1e-12)))
        return best

    def windows(self, ids: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of every window of texts with size words each: its text, its first word there, its places, its norm, its share of mass in benchmark terms, and how often the word of each place stands in it."""
        n = len(self.terms)
        begin = np.concatenate([[0], np.cumsum(size)])
        count = np.where(size > 0, np.maximum(1, -(-(size - WINDOW) // STRIDE) + 1), 0)
        owner = np.repeat(np.arange(len(size)), count)
        first = (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)) * STRIDE
        end = np.minimum(first + WINDOW, size[owner])
        first = np.maximum(0, np.minimum(first, size[owner] - WINDOW))
        lo, hi = begin[owner] + first, begin[owner] + end
        norm, share, often = np.zeros(len(owner)), np.zeros(len(owner)), np.zeros((len(owner), WINDOW), np.uint8)
        square = np.append(self.idf**2, 0.0)
        for at in range(0, len(owner), 4096):
            k = slice(at, at + 4096)
            place = lo[k, None] + np.arange(WINDOW)
            t = np.where(place < hi[k, None], ids[np.minimum(place, len(ids) - 1)], -1)
            often[k] = (t[:, :, None] == t[:, None, :]).sum(2, dtype=np.uint8)
            mass = square[np.minimum(t, n)] / often[k]  # the places of a term share its weight
            every = mass.sum(1)
            norm[k], share[k] = np.sqrt(every), np.where(t < n, mass, 0).sum(1) / np.maximum(every, 1e-12)
        return owner, first, lo, hi, norm, share, often

    def find(self, texts: list[bytes | None]) -> list[list[tuple[int, float, float, int, int]]]:
        """For each text (item, cosine, overlap, first word, end) of what it holds, best passage of each item."""
        n, out = len(self.terms), [[] for _ in texts]
        words = [tokens(t) for t in texts]
        size = np.array([len(w) for w in words])
        if not size.sum() or not self.passages:
            return out
        number = Words(self.terms)
        ids = np.fromiter(map(number.__getitem__, itertools.chain.from_iterable(words)), np.int32, int(size.sum()))
        begin = np.concatenate([[0], np.cumsum(size)])
        owner, first, lo, hi, norm, share, often = self.windows(ids, size)
        live = np.flatnonzero(share >= float(self.least.min()) ** 2 * (1 - 1e-6))
        found = []
        for at in range(0, len(live), 1024):
            k = live[at : at + 1024]
            place = lo[k, None] + np.arange(WINDOW)
            t = np.where(place < hi[k, None], np.minimum(ids[np.minimum(place, len(ids) - 1)], n), n)
            near = np.flatnonzero((self.most[t] / often[k]).sum(1) >= norm[k] * (1 - 1e-3))
            k, t = k[near], t[near]
            vector = (self.basis[t] / often[k, :, None]).sum(1)
            cosine = (vector @ self.latent.T) / norm[k, None]
            w, p = np.nonzero(cosine >= self.least)
            found += zip(owner[k[w]].tolist(), p.tolist(), first[k[w]].tolist(), cosine[w, p].tolist())
        found.sort()
        i = 0
        best: dict[tuple[int, int], tuple] = {}
        while i < len(found):
            d, p, at, c = found[i]
            stop, j = at, i
            m = len(self.passages[p])
            # one stretch of neighbouring windows, no longer than a copy would be
            while j < len(found) and found[j][:2] == (d, p) and found[j][2] - stop <= STRIDE and found[j][2] <= at + 2 * m:
                stop, c, j = found[j][2], max(c, found[j][3]), j + 1
            i = j
            a, b = max(0, at - m), min(int(size[d]), stop + WINDOW + m)
            near = ids[begin[d] + a : begin[d] + b].tolist()
            words_held = common(self.passages[p], near)
            share = words_held / m
            held = words_held >= min(m, FEWEST) and share >= OVERLAP
            if not held and words_held >= min(m, FEWEST) and share >= PARAPHRASE and common(self.answers[p], near) >= ANSWER * len(self.answers[p]):
                c = max(c, self.likeness(p, near))
                held = c >= PARAPHRASE_COSINE
            key = (d, self.owner[p])
            if held and (share, c) > best.get(key, (0, 0))[:2]:
                best[key] = (share, c, a, b)
        for (d, item), (share, c, a, b) in best.items():
            out[d].append((item, c, share, a, b))
        return out


def _counted(docs: DataFrame, blocks: list[Index]) -> tuple[int, dict[bytes, int]]:
    """The number of documents, and how many hold each term of the blocks."""
    sent = docs.sparkSession.sparkContext.broadcast(frozenset(t for b in blocks for t in b.terms))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, df, known = 0, Counter(), sent.value
        for b in batches:
            column = b.column("text").cast(pa.binary())
            n += len(column)
            for x in column:
                df.update(known.intersection(tokens(x.as_py())))
        yield pa.RecordBatch.from_arrays([pa.array([None, *df], pa.binary()), pa.array([n, *df.values()], pa.int64())], names=["term", "n"])

    got = {r.term if r.term is None else bytes(r.term): r.n for r in docs.select("text").mapInArrow(count, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}  # terms of a scan's blocks
    sent.unpersist()
    return got.pop(None, 0), got


FOUND = "array<struct<item_id:bigint,cosine:double,overlap:double,first_word:int,end_word:int>>"


def _blocks(benchmark: DataFrame, answer: str | None) -> Iterator[list[Index]]:
    """The benchmark's blocks, as many at a time as share a scan."""
    items = benchmark.where("text is not null").select(F.col("item_id").cast("long"), "text", F.col(answer) if answer else F.lit(None).cast("string")).orderBy("item_id", "text")
    group = [Index()]
    for r in items.toLocalIterator():
        if len(group[-1].terms) >= TERMS:
            if len(group) == GROUP:
                yield group
                group = []
            group.append(Index())
        group[-1].add(*r)
    if group[-1].passages:
        yield group


def marked(docs: DataFrame, benchmark: DataFrame, keep: list[str], answer: str | None = None) -> DataFrame:
    """(row, leaks) of every row of docs: its columns keep, packed, and what benchmark items its whole text holds."""
    spark = docs.sparkSession
    small_batches(spark)
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("cosine", pa.float64()), ("overlap", pa.float64()), ("first_word", pa.int32()), ("end_word", pa.int32())]))
    names = [f.name for f in kind.value_type]
    chosen = with_text(docs, keep)
    schema, column_names = with_row(chosen.schema["row"].dataType, ("" if "text" in keep else "text string, ") + f"leaks {FOUND}"), chosen.columns
    out = chosen.withColumn("leaks", F.array().cast(FOUND))
    for group in _blocks(benchmark, answer):
        n, df = _counted(docs, group)
        for index in group:
            index.weigh(n, {i: df.get(t, 0) for t, i in index.terms.items()})
            index.fit(docs)
        sent = [spark.sparkContext.broadcast(index) for index in group]  # GROUP blocks of TERMS terms

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for b in batches:
                column, leaks = texts(b).cast(pa.binary()), b.column("leaks").to_pylist()
                for lo, hi in pieces(column):
                    read = column[lo:hi].to_pylist()
                    for index in sent:
                        for i, found in enumerate(index.value.find(read), lo):
                            leaks[i] = leaks[i] + [dict(zip(names, x)) for x in sorted(found)]
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in column_names), pa.array(leaks, kind)], names=[*column_names, "leaks"])

        out = out.mapInArrow(run, schema)
    return out


def scan(docs: DataFrame, benchmark: DataFrame, keep: list[str], answer: str | None = None) -> DataFrame:
    """The columns keep of every row of docs, and leaks: what benchmark items (item_id, text) its whole text holds.

    Null and empty texts hold nothing; null and empty items are skipped. Repeated rows are each judged, long texts whole; of repeated items each counts. An empty
    benchmark finds nothing, no rows give no rows. answer names the column of an item's answer; without one an item's last words (a fifth, three at least) stand
    for it. Columns outside keep are ignored, whatever their names.
    """
    out = marked(docs, benchmark, keep, answer)
    return out.select(*unpacked(out, "row"), "leaks")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that hold no benchmark item as scan() finds them, with all their columns, whatever their names."""
    out = marked(docs, benchmark, docs.columns)
    return out.where(F.size("leaks") == 0).select(*unpacked(out, "row"))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, cosine, overlap, first_word, end_word) of every item that a row of docs holds; clean rows don't occur."""
    return scan(docs, benchmark, ["doc_id"]).select("doc_id", F.inline("leaks"))
