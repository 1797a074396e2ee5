"""Clustering, conversation repair and the Jaccard join against plain versions."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from docweave.llm import exponion, ngramjoin, turns

from .test_operators import CLASH

EXTRA = ", ".join(f"`{c}` string" for c in CLASH)


def more(rows):
    return [(*r, *["x"] * len(CLASH)) for r in rows]


# ---- 11 ----


def plain_clusters(rows, k=40, rounds=5, dims=64, prefix="2:"):
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"{prefix}{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[:k]
    centres = [v for _, v in first]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    place = lambda: [min((square(v, c), j) for j, c in enumerate(centres)) for _, v in kept]
    for _ in range(rounds):
        at = place()
        for j in range(len(centres)):
            own = [v for (_, v), (_, c) in zip(kept, at, strict=True) if c == j]
            if own:
                centres[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    at = place()
    by = Counter()
    for d, j in at:
        by[j] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, j, d, by[j], sum(by.values()), sha[j]) for (i, _), (d, j) in zip(kept, at, strict=True)), key=repr)


def vectors(n, dims, seed, scale=1.0):
    rng = random.Random(seed)
    middle = [[rng.gauss(0, scale) for _ in range(dims)] for _ in range(7)]
    return [(i, [x + rng.gauss(0, scale / 4) for x in rng.choice(middle)]) for i in range(n)]


@pytest.mark.parametrize(("dims", "k", "scale"), [(4, 9, 0.02), (8, 5, 1.0), (3, 40, 0.01), (4, 1, 1.0), (3, 6, 1e6), (3, 6, 1e9)])
def test_clusters_equal_plain_lloyd(spark, dims, k, scale):
    rows = vectors(150, dims, k, scale) + [(500, [0.0] * dims), (501, [0.0] * dims), (501, [0.0] * dims), (None, [1.0] * dims), (None, [1.0] * dims)]
    rows += [(600, None), (601, []), (602, [1.0] * (dims + 1)), (603, [None] * dims), (604, [float("nan")] * dims), (605, [float("-inf")] * dims), (606, [1e30] * dims)]
    df = spark.createDataFrame(more(rows), f"vec_id long, embedding array<double>, {EXTRA}").repartition(3)
    got = sorted((tuple(r) for r in exponion.cluster(df, k, 5, dims).collect()), key=repr)
    want = plain_clusters([r for r in rows if r[0] != 606], k, 5, dims)  # scaled beyond a long: not kept
    long = lambda x: x if x < 1 << 63 else None
    assert got == sorted(((i, j, long(d), long(own), long(whole), s) for i, j, d, own, whole, s in want), key=repr)


def test_clusters_of_few_or_no_vectors(spark):
    assert exponion.cluster(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    got = exponion.cluster(spark.createDataFrame([(1, [0.5] * 64)], "vec_id long, embedding array<float>")).first()
    assert (got.vec_id, got.cluster, got.distance, got.inertia) == (1, 0, 0, 0)
    assert got.centroid_sha256 == hashlib.sha256(",".join(["128"] * 64).encode()).hexdigest()


def test_exponion_scans_fewer_centroids_than_all():
    rng = np.random.default_rng(1)
    middle = rng.integers(-5000, 5000, (60, 8))
    x = middle[rng.integers(0, 60, 3000)] + rng.integers(-30, 30, (3000, 8))
    a, u, low, told = np.full(3000, -1), np.zeros(3000), np.zeros(3000), [0]
    moved = middle + rng.integers(-20, 20, middle.shape)
    exponion.assign(exponion.exact(x), a, u, low, exponion.Ball(middle, None), told)
    all_of_them = told[0]
    exponion.assign(exponion.exact(x), a, u, low, exponion.Ball(moved, middle), told)
    assert all_of_them == 3000 * 60
    assert told[0] - all_of_them < 3000 * 6
    assert (a == ((x[:, None, :] - moved[None]) ** 2).sum(2).argmin(1)).all()


# ---- 12 ----


def plain_repair(rows):
    """Cheapest edits of one conversation's turns (turn, role, text) in order, by a table of all states."""
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        if bare:
            seen.add((role, text))
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def inserts(states):
        out = dict(states)
        for _ in range(3):
            for s, (c, a, t) in list(out.items()):
                for r in "ua":
                    if (s, r) in step:
                        way = (c + 5, a + "I", [*t, ({"u": "user", "a": "assistant"}[r], "")])
                        out[step[s, r]] = min(out.get(step[s, r], way), way, key=lambda w: w[:2])
        return out

    states = inserts({"": (0, "", [])})
    for (_, role, text), fault in zip(rows, faults, strict=True):
        new = {}
        for s, (c, a, t) in states.items():
            ways = [(s, (c + 2, a + "D", t))]
            if fault in ("", "truncated"):
                extra = 5 * (fault == "truncated")
                if (s, role[:1]) in step:
                    ways.append((step[s, role[:1]], (c + extra, a + "K", [*t, (role, text)])))
                ways += [(step[s, r], (c + 1 + extra, a + "R", [*t, (name, text)])) for r, name in (("u", "user"), ("a", "assistant")) if (s, r) in step]
            for to, way in ways:
                new[to] = min(new.get(to, way), way, key=lambda w: w[:2])
        states = inserts(new)
    cost, audit, out = min((states[s] for s in ("", "a") if s in states), key=lambda w: w[:2])
    ids = {t for t, _, _ in rows if t is not None}
    gaps = max(ids) - min(ids) + 1 - len(ids) if ids else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    count = Counter(faults)
    whole = "\n".join(f"{r}:{t}" for r, t in out)
    return (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256(whole.encode()).hexdigest()), out


def plain_damage(rows):
    out = []
    for c, t, role, text in rows:
        c_, t_, role, text = (" " if x is None else x for x in (c, t, role, text))
        kind = zlib.crc32(f"{c_}:{t_}".encode()) % 20
        if kind:
            row = (c, t, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
            out += [row] * (2 if kind == 3 else 1)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).hexdigest()))


def conversations(seed=3):
    rng = random.Random(seed)
    say = lambda: rng.choice(["Yes.", "No!", "Why?", "So then", "", " \n", "Well. ", "A longer turn of talk.", None])
    rows = [(c, t if rng.random() > 0.1 else None, rng.choice(["user", "assistant", "system", "tool", "User", "", None]), say()) for c in range(60) for t in range(rng.randint(1, 9)) if rng.random() > 0.1]
    rows += [(None, t, "user", "Hello.") for t in range(4)] + [(900, None, None, None)] * 3
    rows += [(901, t, ["user", "assistant"][t % 2], f"Turn {t // 3}." if t % 7 else "x") for t in range(3000)]  # long, over several partitions
    return rows


SCHEMA = f"conv_id long, turn long, role string, text string, {EXTRA}"


def test_repair_equals_plain_tables(spark):
    rows = conversations()
    df = spark.createDataFrame(more(rows), SCHEMA).repartition(5)
    got = {r.conv_id: tuple(r)[1:] for r in turns.reports(turns.damaged(df), df).collect()}
    by = {c: [] for c, *_ in rows}
    for r in plain_damage(rows):
        by[r[0]].append(r)
    assert len(got) == len(by)
    for c, own in by.items():
        assert got[c] == plain_repair([r[1:] for r in in_order(own)])[0], c


def test_repaired_turns(spark):
    rows = [(1, 0, "user", "A."), (1, 1, "user", "B."), (1, 2, "assistant", "C"), (2, 5, "assistant", "Hm."), (3, 1, "user", "")]
    got = [tuple(r) for r in turns.repaired(spark.createDataFrame(more(rows), SCHEMA)).orderBy("conv_id", "place").collect()]
    want = []
    for c in (1, 2, 3):
        (_, *_, audit, _), out = plain_repair([(t, r, x) for i, t, r, x in rows if i == c])
        want += [(c, i + 1, r, x) for i, (r, x) in enumerate(out)]
    assert [(c, p, r, x) for c, p, _, _, r, x in got] == want


def test_repair_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert turns.reports(none, none).count() == 0
    got = turns.reports(none, spark.createDataFrame([(7,), (7,)], "conv_id long")).collect()
    assert [tuple(r) for r in got] == [(7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_matrix_products_in_any_order():
    rng = random.Random(5)
    for _ in range(50):
        kinds = [(rng.choice("suax"), rng.choice(["", "", turns.TRUNCATED, turns.BLANK])) for _ in range(rng.randint(1, 40))]
        one = turns.UNIT
        for k in kinds:
            one = turns.times(one, turns.turn(*k))
        cut = rng.randint(0, len(kinds))
        assert one == turns.scan(kinds) == turns.times(turns.scan(kinds[:cut]), turns.scan(kinds[cut:]))


# ---- 13 ----


def shingles(text):
    words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", words) if w]
    return {tuple(words)} if 0 < len(words) < 3 else set(zip(words, words[1:], words[2:], strict=False))


def plain_join(rows):
    """(doc_id, n, component) by all pairs."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and (rows[i][0] is not None and rows[i][0] == rows[j][0] or 10 * min(len(a), len(b)) >= 9 * max(len(a), len(b)) and 100 * len(a & b) >= 90 * len(a | b)):
            up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def near_texts(seed=4):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    passage = rng.choices(words, k=80)
    rows, at = [], itertools.count()
    for size in (4, 9, 10, 11, 12, 15, 25, 60, 150, 400):
        for _ in range(6):
            base = rng.choices(words, k=size)
            for _ in range(rng.randint(1, 5)):
                text = list(base)
                for _ in range(rng.randint(0, max(1, size // 45))):
                    text[rng.randrange(len(text))] = rng.choice(words)
                rows.append((next(at), " ".join(text)))
    rows += [(next(at), " ".join(passage + rng.choices(words, k=rng.randint(5, 20)))) for _ in range(60)]
    chain = rng.choices(words, k=120)
    for i in range(80):  # each links with its neighbours in the chain only
        chain = [*chain[2:], *rng.choices(words, k=2)]
        rows.append((next(at), " ".join(chain)))
    rows += [(next(at), t) for t in (None, "", " \n", "one", "One", "one two", "ONE\ttwo", "one two three", "a a a a a", "a a a", "É é x", "é É x")]
    rows += [(5, "shares an id with another row and nothing else at all"), (None, rows[40][1]), (None, "no id here"), (None, "no id here"), rows[7], rows[7]]
    return rows


@pytest.mark.parametrize("chunk", [1 << 21, 3000])
def test_join_equals_all_pairs(spark, monkeypatch, chunk):
    monkeypatch.setattr(ngramjoin, "CHUNK", chunk)
    rows = near_texts()
    df = spark.createDataFrame(more(rows), f"doc_id long, text string, {EXTRA}").repartition(3)
    assert sorted((tuple(r) for r in ngramjoin.join(df).collect()), key=repr) == plain_join(rows)


def test_join_of_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((tuple(r) for r in ngramjoin.join(docs).collect()), key=repr) == plain_join(rows)


def test_join_of_nothing(spark):
    assert ngramjoin.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(2)
    for _ in range(400):
        n = int(rng.integers(10, 300))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        lost = int(rng.integers(0, n // 9 + 2))
        b = np.unique(np.concatenate([rng.permutation(a)[lost // 2 :], rng.integers(0, 1 << 63, lost - lost // 2).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 90 * (len(a) + len(b) - both):
            assert np.array_equal(a, b) or len(np.intersect1d(ngramjoin.keys(a), ngramjoin.keys(b)))


# ---- the near_dedup stage ----


def five(text):
    w = text.lower().split()
    return set(zip(*(w[i:] for i in range(5)), strict=False))


def planted(rng, n_base=60):
    """Texts of 40 to 500 words, and near copies of each by edits spread over it until about a tenth of its five-word shingles is gone."""
    vocabulary = [f"v{i}" for i in range(6000)]
    passage = rng.choices(vocabulary, k=55)
    rows, at = [], itertools.count()
    for b in range(n_base):
        base = rng.choices(vocabulary, k=rng.randint(40, 500))
        if b % 3 == 0:
            base = base[:20] + passage + base[20:]
        rows.append((next(at), b, " ".join(base)))
        for _ in range(3):
            text = list(base)
            for _ in range(rng.randint(1, max(1, len(base) // 60))):
                i = rng.randrange(len(text))
                text[i : i + rng.randint(0, 1)] = [rng.choice(vocabulary)]
            rows.append((next(at), b, " ".join(text)))
    return rows


def test_near_copies_of_four_fifths_are_found(spark):
    import corpus_pipeline

    rows = planted(random.Random(8))
    classes = {r.th: r.root for r in ngramjoin.text_classes(spark.createDataFrame([(i, t) for i, _, t in rows], "th long, text string")).collect()}
    sets = {i: five(t) for i, _, t in rows}
    near = [(i, j) for (i, b, _), (j, c, _) in itertools.combinations(rows, 2) if b == c and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    found = sum(classes[i] == classes[j] for i, j in near)
    assert len(near) > 150
    assert found >= 0.98 * len(near)
    assert all(len({b for i, b, _ in rows if classes[i] == c}) == 1 for c in set(classes.values()))  # texts that share a passage only stay apart
    docs = spark.createDataFrame([(i, t, "aa", "s", len(t)) for i, _, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    assert {i for i, b, _ in rows if i % 4 == 0} <= kept  # the first of each group
    assert sum((i in kept) + (j in kept) == 2 for i, j in near) <= 0.02 * len(near)


def test_shard_stage_keeps_clashing_columns(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([(1, "a", "aa", "s", 1, "x", "y"), (2, "b", "aa", "s", 1, "z", "w")], "doc_id long, text string, lang string, source string, n_chars long, shard string, shard_in string")
    got = {r.doc_id: r for r in corpus_pipeline.shard(spark, docs, "").collect()}
    assert (got[1].shard_in_in, got[1].shard_in, got[2].shard_in_in) == ("x", "y", "z") and isinstance(got[1].shard, int)
