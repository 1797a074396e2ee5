"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features are rates over the whole text: densities of a fixed lexicon and of a lexicon learned from the labelled sample (words and
word beginnings), how near lexicon hits stand to second-person words, capitals, punctuation and obfuscated spellings. The
classifier is fitted on a bounded sample of labelled rows; every row is scored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, forget, pieces, small_batches

#: Bounds of the fit: labelled rows of the sample, entries of the learned lexicon.
SAMPLE, LEARNED = 10_000, 1_000
#: Lengths of learned word beginnings; share of toxic rows from which a word counts as a whole word.
STARTS, WHOLE = (8, 7, 6, 5, 4, 3), 0.05
#: Plain insults and hostile words.
LEXICON = frozenset("arse ass asshole bastard bitch bollocks bullshit clown coward crap creep cretin cunt damn degenerate dickhead disgusting dumb dumbass dumbfuck faggot filth filthy freak fuck fucked fucker fucking garbage gross hate hateful idiot idiotic idiots ignorant imbecile jackass jerk kill liar loser losers lowlife lunatic moron moronic morons motherfucker nasty nazi parasite pathetic pig prick psycho racist rat repulsive retard retarded scum scumbag shit shitty shut sicko slut spastic stfu stupid subhuman suck sucks terrible thug trash twat ugly useless vermin vile wanker weirdo whore worthless".split())
#: Second-person words of the four common languages.
SECOND = frozenset("you your yours yourself u ur ya du dich dir dein deine ihr euch tu toi te vous votre vos tes usted ustedes vosotros tus".split())
_LEET = str.maketrans("0134578@$!|", "oieastbasil")
_EDGE = re.compile(r"^\W+|\W+$")
_GAPPED = re.compile(r"[^\W\d_](?:[.*_\-+~^][^\W\d_]){2,}")
NAMES = ("words", "fixed", "learned", "starts", "twice", "hits", "obfuscated", "near_second", "second", "capitals", "shout", "exclaim", "punctuation", "digits", "mean_length", "distinct_hits")


def features(text: str | None, learned: dict[str, float], starts: dict[str, float], twice: dict[str, float]) -> list[float]:
    """Dense features of one whole text; all 0 for a null or empty one. Rates are logarithms of hits a thousand words, so long texts keep theirs."""
    words = text.split() if text else []
    threes, pairs = {k[:3] for k in starts}, {k[:3] for k in twice}
    n = len(words)
    if not n:
        return [0.0] * len(NAMES)
    fixed = by_word = by_start = obfuscated = second = shout = chars = 0
    weight = 0.0
    hits, seconds, kinds, begun = [], [], set(), {}
    for i, raw in enumerate(words):
        chars += len(raw)
        w = raw.lower()
        if not w.isalnum():
            w = _EDGE.sub("", w)
        if not w:
            continue
        x = learned.get(w)
        hit = w in LEXICON and x != 0
        fixed += hit
        if x:
            by_word += 1
            weight += x
            hit = True
        elif x is None and (x := next(filter(None, map(starts.get, [w[:k] for k in STARTS if k <= len(w)])), None) if w[:3] in threes else None):
            by_start += 1
            weight += x
            hit = True
        elif not hit and not w.isalpha():
            plain = re.sub(r"\W|_", "", w.translate(_LEET))
            if plain != w and (plain in LEXICON or plain in learned):
                obfuscated += 1
                hit = True
        if not x and w[:3] in pairs:
            b = next((w[:k] for k in STARTS if w[:k] in twice), None)
            if b:
                begun.setdefault(b, []).append(i)
        if hit:
            hits.append(i)
            kinds.add(w)
        if w in SECOND:
            second += 1
            seconds.append(i)
        shout += len(raw) > 2 and raw.isupper()
    again = 0
    for b, at in begun.items():
        if len(at) > 1:
            again += len(at)
            weight += len(at) * twice[b]
            hits += at
            kinds.add(b)
    near = 0
    if hits and seconds:
        s = np.array(seconds)
        at = np.searchsorted(s, hits)
        gap = np.minimum(np.abs(s[np.minimum(at, len(s) - 1)] - hits), np.abs(s[np.maximum(at - 1, 0)] - hits))
        near = float(np.exp2(-gap / 4.0).sum())
    rate = lambda k: math.log1p(1000.0 * k / n)
    letters = max(1, chars)
    return [
        math.log1p(n), rate(fixed), rate(by_word), rate(by_start), rate(again), weight / n * 1000.0, rate(obfuscated), rate(near), rate(second),
        sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")) / letters, rate(shout), rate(text.count("!")), sum(map(text.count, ".,;:?*#$%&")) / letters,
        sum(map(text.count, "0123456789")) / letters, chars / n, math.log1p(len(kinds)),
    ]


class Trees:
    """Gradient boosting of the logistic loss over binned features, and an isotonic map of its margin."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 32, least: float = 2.0) -> None:
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
        self.rate = rate
        b, y = self._bin(x), y.astype(float)
        self.grown = (rounds, depth, least, bins)
        # margins of rows that a model has not seen calibrate: each fifth is judged by trees of the other four
        fold, unseen = np.arange(len(y)) % 5, np.zeros(len(y))
        for k in range(5):
            self._fit(b[fold != k], y[fold != k])
            unseen[fold == k] = self._margin(b[fold == k])
        self._fit(b, y)
        order = np.argsort(unseen, kind="stable")
        self.at, self.to = self._isotonic(unseen[order], y[order])

    def _fit(self, b: np.ndarray, y: np.ndarray) -> None:
        rounds, depth, least, bins = self.grown
        p = min(max(y.mean() if len(y) else 0.0, 1e-3), 1 - 1e-3)
        self.bias, self.trees = math.log(p / (1 - p)), []
        f = np.full(len(y), self.bias)
        for _ in range(rounds if len(np.unique(y)) > 1 else 0):
            q = 1 / (1 + np.exp(-f))
            tree = self._grow(b, y - q, q * (1 - q), depth, least, bins)
            f += self.rate * self._walk(tree, b)
            self.trees.append(tree)

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, v, side="right") for c, v in zip(self.cuts, x.T)], 1).astype(np.int16)

    def _grow(self, b: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, least: float, bins: int) -> tuple | float:
        value = float(g.sum() / (h.sum() + 1.0))
        if not depth or h.sum() < 2 * least:
            return value
        best, gain = None, 1e-6 + g.sum() ** 2 / (h.sum() + 1.0)
        for j in range(b.shape[1]):
            gs, hs = (np.cumsum(np.bincount(b[:, j], v, bins + 1)) for v in (g, h))
            left, right = gs**2 / (hs + 1.0), (gs[-1] - gs) ** 2 / (hs[-1] - hs + 1.0)
            score = np.where((hs >= least) & (hs[-1] - hs >= least), left + right, 0)
            k = int(score.argmax())
            if score[k] > gain:
                best, gain = (j, k), score[k]
        if best is None:
            return value
        go = b[:, best[0]] <= best[1]
        return (*best, self._grow(b[go], g[go], h[go], depth - 1, least, bins), self._grow(b[~go], g[~go], h[~go], depth - 1, least, bins))

    def _walk(self, tree: tuple | float, b: np.ndarray) -> np.ndarray:
        if isinstance(tree, float):
            return np.full(len(b), tree)
        return np.where(b[:, tree[0]] <= tree[1], self._walk(tree[2], b), self._walk(tree[3], b))

    def _margin(self, b: np.ndarray) -> np.ndarray:
        return self.bias + self.rate * sum((self._walk(t, b) for t in self.trees), np.zeros(len(b)))

    @staticmethod
    def _isotonic(m: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pool-adjacent-violators, as points to interpolate between."""
        pools: list[list[float]] = []
        for x, v in zip(m, y):
            pools.append([v, 1.0, x, x])
            while len(pools) > 1 and (pools[-2][0] >= pools[-1][0] or pools[-2][3] == pools[-1][2]):
                v2, n2, _, hi = pools.pop()
                v1, n1, lo, _ = pools[-1]
                pools[-1] = [(v1 * n1 + v2 * n2) / (n1 + n2), n1 + n2, lo, hi]
        at = [e for p in pools for e in ((p[2],) if p[2] == p[3] else (p[2], p[3]))]
        to = [p[0] for p in pools for _ in range(1 if p[2] == p[3] else 2)]
        return np.array(at), np.array(to)

    def score(self, x: np.ndarray) -> np.ndarray:
        m = self._margin(self._bin(x))
        plain = 1 / (1 + np.exp(-m))
        # a twentieth of the uncalibrated score keeps an order within a pool
        return plain if not len(self.at) else np.clip(0.95 * np.interp(m, self.at, self.to) + 0.05 * plain, 0, 1)


def learn(docs: DataFrame, labels: DataFrame, train: Column, label: str = "toxic") -> tuple[Trees | None, dict[str, float], dict[str, float], dict[str, float]]:
    """The classifier and the learned lexicon (words, beginnings of words, beginnings that occur twice) from a sample of SAMPLE labelled rows of least hash; a row
    with several labels counts by the largest."""
    spark = docs.sparkSession
    small_batches(spark)
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & train).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    n = known.count()
    if n > SAMPLE:
        known = known.where(F.xxhash64("doc_id") <= int(2**64 * min(1.0, SAMPLE / n) - 2**63))
    # about SAMPLE rows of two numbers, whatever the input; written once, as everything below reads it
    drawn = durable(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("y", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("doc_id").alias("h")).repartition("h"))
    word = F.expr(r"regexp_replace(lower(w), '^[^\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+$', '')")
    words = drawn.select("y", "h", F.explode(F.split("text", r"\s+")).alias("w")).select("y", "h", word.alias("w")).where("w <> ''")
    # words of each text once, and how often
    every = durable(words.groupBy("y", "h", "w").agg(F.count("*").alias("k")))
    words = every.select("y", "w")
    sums = drawn.agg(F.sum("y").alias("y"), F.count("*").alias("n")).first()
    if not sums.n:
        return None, {}, {}, {}
    bad, good = max(1, sums.y), max(1, sums.n - sums.y)
    odds = F.log((F.col("bad") + 0.5) / bad) - F.log((F.col("good") + 0.5) / good)
    # a lower bound of the odds, so that rare words don't pass by chance
    sure = F.col("odds") - 1.64 * F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))

    def counts(rows: DataFrame, n: Column = F.lit(1)) -> DataFrame:
        return rows.groupBy("w").agg(F.sum(F.col("y") * n).alias("bad"), F.sum((1 - F.col("y")) * n).alias("good")).withColumn("odds", odds)

    def best(rows: DataFrame) -> list:
        return rows.where("bad >= 4").where(sure > 2.1).orderBy(F.desc(F.col("odds") * F.sqrt("bad")), "w").limit(LEARNED).collect()

    found = best(counts(words))
    learned = {r.w: r.odds for r in found}
    # a fixed word that clean texts hold as often is another language's word: it gets no weight
    for r in counts(words.where(F.col("w").isin(*LEXICON))).where("good >= 2 and odds < 1.5").collect():
        learned[r.w] = 0.0
    # beginnings, without what frequent whole words explain
    whole = [r.w for r in found if r.bad >= WHOLE * bad]
    heads = every.where(~F.col("w").isin(*whole)) if whole else every
    begun = heads.select("y", "h", "k", F.explode(F.filter(F.transform(F.array(*[F.lit(k) for k in STARTS]), lambda k: F.when(F.length("w") >= k, F.col("w").substr(F.lit(1), k))), lambda x: x.isNotNull())).alias("w"))
    begun = durable(begun.groupBy("y", "h", "w").agg(F.sum("k").alias("k")))
    starts = {r.w: r.odds for r in best(counts(begun))}
    twice = {r.w: r.odds for r in best(counts(begun, (F.col("k") >= 2).cast("int"))) if r.w not in starts}
    sent = spark.sparkContext.broadcast((learned, starts, twice))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t.as_py(), *sent.value) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("y"), b.column("h"), pa.array(x, pa.list_(pa.float64()))], names=["y", "h", "x"])

    rows = sorted(((r.h, r.y, r.x) for r in drawn.mapInArrow(run, "y int, h long, x array<double>").collect()))  # about SAMPLE rows of len(NAMES) numbers
    forget(drawn, every, begun)
    return Trees(np.array([r[2] for r in rows]), np.array([r[1] for r in rows])), learned, starts, twice


def score(docs: DataFrame, labels: DataFrame, train: Column) -> DataFrame:
    """(doc_id, score, predicted) of every row of docs (doc_id, text); train is over labels' doc_id.

    A null or empty text has the score of zero features. Without any labelled row all scores are 0. Repeated rows are each scored; extra columns are ignored.
    """
    trees, *words = learn(docs, labels, train)
    sent = docs.sparkSession.sparkContext.broadcast((trees, words))  # bounded by LEARNED and the trees' size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, words = sent.value
        for b in batches:
            column, scores = b.column("text"), []
            for lo, hi in pieces(column):
                x = np.array([features(t, *words) for t in column[lo:hi].to_pylist()])
                scores.append(trees.score(x) if trees else np.zeros(len(x)))
            s = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s), pa.array((s >= 0.3).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double, predicted int")
