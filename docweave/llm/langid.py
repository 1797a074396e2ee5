"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over a bounded sample of labelled text. A text is parsed greedily against each
automaton: the longest match from the current place is one phrase, and the next phrase starts after it. The number of
phrases times log2 of the sample's length, over the text's length, estimates the cross entropy (Ziv and Merhav); the least wins.

Texts are parsed in step: long ones are cut into lanes that all advance at once, and each lane but a text's first is then parsed again from the
state in which the lane before it ended, until both parses begin a phrase at the same place, from where they are one. So the phrases are those of a greedy parse of the whole text.

Only the sample's text is sent to the executors; each Python worker builds its automata once.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pieces, small_batches, small_table, texts, unpacked, with_row, with_text

#: The sample for the fit: symbols a language, shared out of ALL_SYMBOLS but LEAST_SYMBOLS at least (so beyond 480 languages it grows by as much
#: with each), symbols of one text (of a longer text a piece at a place that its hash names), texts drawn a language.
ALL_SYMBOLS, LANG_SYMBOLS, LEAST_SYMBOLS, TEXT_SYMBOLS, DRAWN = 240_000, 40_000, 500, 8_000, 60
#: Symbols in a lane.
LANE = 1024
#: Most symbols of a language with a column of their own in its table, and cells of all tables; transitions of rarer symbols are looked up.
DENSE, CELLS = 64, 1 << 24



def _letters() -> np.ndarray:
    """Folded code point of every letter, else 0."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if unicodedata.category(chr(c))[0] == "L":
            low = chr(c).lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


@lru_cache(1)
def letters() -> np.ndarray:
    return _letters()


def symbols(text: str) -> np.ndarray:
    """Lower-case letters of the whole text, each run of anything else as one break; no letter: empty."""
    a = letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
    keep = a != 0
    keep[1:] |= a[:-1] != 0
    a = a[keep]
    return a if a.any() else a[:0]


def transitions(s: list[int]) -> list[dict[int, int]]:
    """The suffix automaton of s: the transitions of each state, of which 0 is the start."""
    nxt: list[dict] = [{}]
    link, length, last = [-1], [0], 0
    for c in s:
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt


class Automaton:
    """The suffix automaton of a sample, with a table for its most frequent symbols and a sorted list for the rest.

    step() gives the next state if the match goes on; else minus one and minus the state after the phrase has been closed and the symbol starts
    the next one (state 0 if the sample lacks it).
    """

    def __init__(self, sample: np.ndarray, dense: int) -> None:
        known, n = np.unique(sample, return_counts=True)
        known = known[np.argsort(-n, kind="stable")]
        #: the symbols' own numbers: below width a column of the table, beyond it looked up; the last is any other symbol
        self.symbols, self.other = known, len(known)
        self.width = max(1, min(dense, len(known)))
        number = dict(zip(known.tolist(), range(len(known))))
        nxt = transitions([number[c] for c in sample.tolist()])
        first = np.zeros(self.other + 1, np.int32)
        for c, q in nxt[0].items():
            first[c] = q
        self.start = -1 - first
        table = np.tile(self.start[: self.width], (len(nxt), 1))
        keys, to = [], []
        for i, t in enumerate(nxt):
            for c, q in t.items():
                if c < self.width:
                    table[i, c] = q
                else:
                    keys.append(i * (self.other + 1) + c)
                    to.append(q)
        order = np.argsort(np.array(keys, np.int64))
        self.table, self.keys, self.to = table.ravel(), np.array(keys, np.int64)[order], np.array(to, np.int32)[order]

    def numbers(self, alphabet: np.ndarray) -> np.ndarray:
        """Own numbers of an alphabet's symbols."""
        order = np.argsort(self.symbols)
        at = order[np.minimum(np.searchsorted(self.symbols, alphabet, sorter=order), len(order) - 1)]
        return np.where(self.symbols[at] == alphabet, at, self.other).astype(np.int32)

    def step(self, state: np.ndarray, c: np.ndarray, rare: bool) -> np.ndarray:
        if not rare:
            return self.table[state * self.width + c]
        out = self.table[state * self.width + np.minimum(c, self.width - 1)]
        at = np.flatnonzero(c >= self.width)
        if len(self.keys):
            key = state[at].astype(np.int64) * (self.other + 1) + c[at]
            k = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            out[at] = np.where(self.keys[k] == key, self.to[k], self.start[c[at]])
        else:
            out[at] = self.start[c[at]]
        return out


class Parser:
    def __init__(self, samples: dict[str, list[str]]) -> None:
        self.langs = sorted(samples)
        coded = [np.concatenate([np.append(symbols(t), 0) for t in samples[k]] or [np.zeros(1, np.uint32)]) for k in self.langs]
        dense = max(1, min(DENSE, CELLS // max(1, 2 * sum(map(len, coded)))))
        self.automata = [Automaton(a, dense) for a in coded]
        # code points by their place in the alphabet of all samples (0: in none), and each language's numbers by that place
        alphabet = np.unique(np.concatenate([np.zeros(1, np.uint32), *coded]))
        self.place = np.zeros(0x110000, np.int32)
        self.place[alphabet] = np.arange(1, len(alphabet) + 1)
        self.numbers = [np.concatenate([[m.other], m.numbers(alphabet)]).astype(np.int32) for m in self.automata]
        self.cost = np.array([math.log2(max(2, len(a))) for a in coded])

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of the greedy parse of each whole text against each language; a symbol that the sample lacks is a phrase of its own."""
        out = np.zeros((len(texts), len(self.langs)))
        lanes = [(i, at, min(LANE, len(t) - at)) for i, t in enumerate(texts) for at in range(0, len(t), LANE)]
        if not lanes:
            return out
        lanes.sort(key=lambda x: -x[2])
        owner, size = np.array([x[0] for x in lanes]), np.array([x[2] for x in lanes])
        number = {x[:2]: k for k, x in enumerate(lanes)}
        # the lane before each lane but a text's first
        behind = np.array([number[i, at - LANE] if at else -1 for i, at, _ in lanes])
        whole = self.place[np.concatenate(texts)]
        begin = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        place = np.array([begin[i] + at for i, at, _ in lanes])
        live = np.searchsorted(-size, -np.arange(size[0]), side="left")  # lanes longer than t
        for j, m in enumerate(self.automata):
            code = self.numbers[j][whole]
            state = np.zeros(len(lanes), np.int32)
            begun = np.zeros((size[0], len(lanes)), bool)
            for t in range(size[0]):
                n = live[t]
                c = code[place[:n] + t]
                s = m.step(state[:n], c, bool((c >= m.width).any()))
                begun[t, :n] = (s < 0) | (state[:n] == 0)
                state[:n] = np.where(s < 0, -1 - s, s)
            count, alone = begun.sum(0), state.copy()
            todo = np.flatnonzero(behind >= 0)
            entered = np.full(len(lanes), -1, np.int32)
            while len(todo):
                # from the state that the lane before ends in, until a phrase begins in both parses
                entered[todo] = state[behind[todo]]
                now, s, mine = todo, entered[todo], np.zeros(len(todo), np.int64)
                t = 0
                while len(now):
                    c = code[place[now] + t]
                    x = m.step(s, c, bool((c >= m.width).any()))
                    over = (x < 0) | (s == 0)
                    s, mine = np.where(x < 0, -1 - x, x), mine + over
                    one = over & begun[t, now]
                    t += 1
                    end = ~one & (size[now] == t)
                    count[now[one]] = mine[one] + begun[t:, now[one]].sum(0)
                    count[now[end]] = mine[end]
                    state[now[one]], state[now[end & ~one]] = alone[now[one]], s[end & ~one]
                    go = ~(one | end)
                    now, s, mine = now[go], s[go], mine[go]
                # lanes that follow one whose end has changed
                todo = np.flatnonzero((behind >= 0) & (state[behind] != entered))
            np.add.at(out[:, j], owner, count)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        coded = [symbols(t) if t else np.zeros(0, np.uint32) for t in texts]
        score, best = np.zeros(len(texts)), ["und"] * len(texts)
        if self.langs:
            bits = self.phrases(coded) * self.cost
            order = bits.argmin(1)
            # posterior under a code of these lengths, tempered: phrases of one text are not independent
            gap = (bits - bits.min(1, keepdims=True)) / 8
            share = 1 / np.exp2(-np.minimum(gap, 60)).sum(1)
            for i, a in enumerate(coded):
                if len(a):
                    best[i], score[i] = self.langs[order[i]], share[i]
        return best, score


_parsers: dict[int, Parser] = {}


def parser_for(key: int, samples: dict[str, list[str]]) -> Parser:
    """A worker's parser, built once. As a function of the module it is sent by name, so that all tasks share the worker's own cache."""
    if key not in _parsers:
        _parsers.clear()
        _parsers[key] = Parser(samples)
    return _parsers[key]


def sample(docs: DataFrame, train: Column) -> dict[str, list[str]]:
    """A bounded sample of labelled texts: by language those of least hash, copies once, within the documented bounds."""
    text, h = F.col("text"), F.xxhash64("text")
    place = F.pmod(h, F.greatest(F.length(text) - TEXT_SYMBOLS, F.lit(0)) + 1).cast("int") + 1
    rows = docs.where(train & F.col("lang").isNotNull() & text.isNotNull()).select("lang", F.substring(text, place, F.lit(TEXT_SYMBOLS)).alias("text"), h.alias("h"))
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}  # one row a language
    if not sizes:
        return {}
    share = max(LEAST_SYMBOLS, min(LANG_SYMBOLS, ALL_SYMBOLS // len(sizes)))
    most = small_table(docs.sparkSession, [[k, str(int(min(2**63 - 1, 2**64 * min(1.0, DRAWN / max(1, n)) - 2**63)))] for k, n in sizes.items()], "of string, most string")
    drawn = rows.join(F.broadcast(most), F.col("lang") == F.col("of")).where(F.col("h") <= F.col("most").cast("long"))
    drawn = drawn.groupBy("lang", "h").agg(F.min("text").alias("text")).toLocalIterator()  # about DRAWN texts a language
    out: dict[str, list[str]] = {k: [] for k in sizes}
    held = dict.fromkeys(sizes, 0)
    for r in sorted(drawn, key=lambda r: (r.lang, r.h, r.text)):
        if held[r.lang] < share:
            out[r.lang].append(r.text[: share - held[r.lang]])
            held[r.lang] += len(out[r.lang][-1])
    return {k: v for k, v in out.items() if any(len(symbols(t)) for t in v)}


def judged(docs: DataFrame, samples: dict[str, list[str]], keep: list[str]) -> DataFrame:
    """(row, lang_pred, score) of every row of docs, the columns keep packed as row; every whole text is parsed."""
    spark = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(samples)  # bounded, see sample()
    key = xxhash.xxh64_intdigest(repr(sorted(samples.items())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = parser_for(key, sent.value)
        for batch in batches:
            column = texts(batch)
            langs, scores = [], []
            for lo, hi in pieces(column):
                a, b = parser.predict(column[lo:hi].to_pylist())
                langs += a
                scores.append(b)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(langs, pa.string()), pa.array(np.concatenate(scores) if scores else np.zeros(0))], names=["row", "lang_pred", "score"])

    chosen = with_text(docs, keep)
    return chosen.mapInArrow(run, with_row(chosen.schema["row"].dataType, "lang_pred string, score double"))


def identify(docs: DataFrame, train: Column, keep: list[str]) -> DataFrame:
    """keep, lang_pred (a label, or `und` if the text is null, empty or has no letter) and score (0 to 1) of every row of docs.

    docs has text and lang; train marks the rows to learn from (null langs and texts are skipped). Ties go to the first
    label in code-point order. Repeated rows are each judged, long texts parsed whole; without any labelled text all rows are `und` with score 0. Columns
    outside keep are ignored, whatever their names. No rows give no rows.
    """
    found = judged(docs, sample(docs, train), keep)
    return found.select(*unpacked(found, "row"), "lang_pred", "score")


def spoken(docs: DataFrame, train: Column) -> DataFrame:
    """The rows of docs that have a language as identify() finds it, with all their columns, whatever their names. No rows give no rows."""
    found = judged(docs, sample(docs, train), docs.columns)
    return found.where("lang_pred <> 'und'").select(*unpacked(found, "row"))
