"""Each operator against a plain version on small tables: nulls, empty texts, ties, repeated rows, empty tables, extra columns."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from docweave.llm import common, decontaminate, langid, lm, merkle, mixing, pagediff, queries, sharding, simhash, toxicity, urlfilter

#: Names that operators use for themselves or give to results.
CLASH = "_text _leaks _key _h _size _members _pattern _url lang_pred score leaks fp row size h pattern shard k place root kept cell th times taken n held learn c own s p guest".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)
VOWELS = {"aa": "the of and ing tion er an re", "bb": "der die und ung keit ch sch en", "cc": "le la que ment eux oi ai ou"}


def word(rng, lang):
    return "".join(rng.choice(VOWELS[lang].split()) for _ in range(rng.randint(1, 3)))


def corpus(n=60, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(VOWELS))
        rows.append((i * 3 + 1, " ".join(word(rng, lang) for _ in range(rng.randint(20, 120))) + ".\n" + " ".join(word(rng, lang) for _ in range(30)) + ".", lang, rng.choice(["s1", "s2", "s2", "s2", None])))
    copy = rows[3]
    rows += [(1000 + i, copy[1], copy[2], "s2") for i in range(8)]
    near = copy[1].split(" ")
    rows += [(1100 + i, " ".join([*near[: 10 + i], "zz", *near[11 + i :]]), copy[2], "s1") for i in range(6)]
    rows += [(2001, None, None, None), (2002, "", "aa", "s1"), (2003, "   \n", "aa", "s1"), (2004, "!!! 123", "aa", "s1"), (2005, "one", "aa", "s3"), (2006, "One  two\tTHREE", "aa", "s3"), (None, "no id here at all", "aa", "s1")]
    rows += [rows[5], rows[5]]
    rows.append((3000, "the and of " * 20_000, "aa", "s2"))
    return [(a, b, c, d, len(b) if b else 0, *["x"] * len(CLASH)) for a, b, c, d in rows]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("d") / "documents.parquet")
    spark.createDataFrame(corpus(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def rows_of(docs):
    return [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# ---- 1 ----

PIECE = re.compile(merkle.PIECE)


def plain_fingerprint(text):
    """The tree as a string, and its leaf tags."""
    md = lambda x: hashlib.md5(x.encode()).hexdigest()
    hashes, out, tags = [], [], set()
    for section in re.split(r"(?<=\n\n)", text):
        inner, parts = [], []
        for paragraph in re.split(r"(?<=\n)", section):
            leaf = [md(x) for x in PIECE.findall(paragraph)]
            tags |= {x[:8] for x in leaf}
            inner.append(md("".join(leaf)))
            parts.append(inner[-1][:8] + "~" + "".join(x[:8] for x in leaf))
        hashes.append(md("".join(inner)))
        out.append(hashes[-1][:16] + "=" + ".".join(parts))
    return hashlib.sha256("".join(hashes).encode()).hexdigest() + ":" + "/".join(out), tags


def in_order(data):
    """Rows (doc_id, text) by id, null first, ties by the text's hash."""
    h = lambda t: xxhash.xxh64_intdigest(t.encode(), seed=42)
    return sorted(data, key=lambda x: (x[0] if x[0] is not None else -(2**63), h(x[1]) - (h(x[1]) >> 63 << 64)))


def test_merkle_matches_plain_version(docs):
    got = merkle.edited_pairs(docs).collect()
    data = in_order([(r[0], r[1] or "") for r in rows_of(docs)])
    want = []
    for i, (k, t) in enumerate(data):
        following = data[(i + 1) % len(data)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        (f, a), (g, b), (_, c) = map(plain_fingerprint, (t, edited, following))
        dice = lambda x, y: 1.0 if not x and not y else 2 * len(x & y) / (len(x) + len(y))
        want.append((k or -1, len(t), hashlib.sha256(edited.encode()).hexdigest(), f, g, round(dice(a, b), 9), round(dice(a, c), 9)))
    assert sorted((r.doc_id or -1, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == sorted(want)
    assert all((r.changed is None) == (r.fingerprint == r.edited_fingerprint) for r in got)


def test_next_row_of_a_hot_key(spark):
    data = [(None if i % 3 else i, f"text {i * 7 % 100}") for i in range(400)]
    rows = spark.createDataFrame(data, "doc_id long, t string").withColumn("h", F.xxhash64("t"))
    got = merkle.with_next(rows, "doc_id", "h", ["t"], chunk=8).collect()
    ordered = in_order(data)
    want = [(k or -1, t, ordered[(i + 1) % len(ordered)][1]) for i, (k, t) in enumerate(ordered)]
    assert sorted((r.doc_id or -1, r.t, r.next_t) for r in got) == sorted(want)


def test_merkle_edges(spark):
    assert merkle.edited_pairs(empty(spark)).count() == 0
    one = spark.createDataFrame([(5, "abcd. efgh.")], "doc_id long, text string")
    r = merkle.edited_pairs(one).first()
    assert r.near_next == 1.0 and r.n_chars == 11
    at = lambda a, b: spark.range(1).select(merkle.changed(merkle.fingerprint(F.lit(a)), merkle.fingerprint(F.lit(b))).alias("x")).first().x
    assert at("a.\nb.\n\nc.", "a.\nb.\n\nc.") is None
    assert at("a.\nb.\n\nc.", "a.\nb.\n\nd.").sections == (1, 1, 1)
    # an inserted section is the only branch that differs
    assert at("a.\n\nc.\n\nd.", "a.\n\nb.\n\nc.\n\nd.").sections == (1, 0, 1)


# ---- 2 ----

def plain_simhash(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.findall(r"[^\x20\x09-\x0D]+", low)]
    if not words:
        return 0
    sh = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    ones = Counter()
    for s in sh:
        h = xxhash.xxh64_intdigest(s.encode(), seed=42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if ones[b] * 2 > len(sh))


def plain_components(items):
    root = list(range(len(items)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(items):
        for j in range(i):
            if bin(a ^ items[j][1]).count("1") <= 3 or items[i][0] is not None and items[i][0] == items[j][0]:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(items):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(items))]


def test_simhash_matches_brute_force(docs):
    got = simhash.near_duplicates(docs).collect()
    data = rows_of(docs)
    prints = {t: plain_simhash(t) for _, t, _, _ in data}
    want = plain_components([(d, prints[t]) for d, t, _, _ in data])
    assert sorted(((r.doc_id or -1), r.fp % 2**64, r.component_id) for r in got) == sorted(((d or -1), prints[t], c) for (d, t, _, _), c in zip(data, want))


def test_links_through_null_and_repeated_ids(spark, monkeypatch):
    # 10 - null - 20, and 7 on two fingerprints of which one is also 1's; 30 alone
    prints = [(10, 0), (None, 7), (20, 63), (7, 1023 << 12), (7, 1023 << 50), (1, 1023 << 50), (30, 31 << 20), (None, (1 << 63) | 127 << 30)]
    d = spark.createDataFrame([(i, simhash._signed(f)) for i, f in prints], "doc_id long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs: docs)
    got = simhash.near_duplicates(d).collect()
    want = plain_components(prints)
    assert sorted((r.doc_id or -1, r.fp % 2**64, r.component_id or -1) for r in got) == sorted((i or -1, f, c or -1) for (i, f), c in zip(prints, want))
    assert {r.component_id for r in got if r.doc_id in (7, 1)} == {1} and {r.component_id for r in got if r.doc_id in (10, 20)} == {10}


def test_one_of_each_keeps_unlike_texts_of_one_id(spark):
    text = lambda k: " ".join(f"{k}{i}" for i in range(50))
    rows = [(1, text("a")), (1, text("b")), (2, text("a")), (1, text("a")), (None, text("a")), (None, text("c")), (5, None), (4, "")]
    d = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, root string")
    got = sorted((r.doc_id or -1, r.text or "", r.root) for r in simhash.one_of_each(d).collect())
    assert got == sorted([(1, text("a"), "x"), (1, text("b"), "x"), (-1, text("c"), "x"), (4, "", "x")])
    assert simhash.one_of_each(d.where("false")).count() == 0


def test_covering_never_misses():
    rng = random.Random(3)
    for masks in simhash.covering(3)[:1]:
        for _ in range(3000):
            bits = rng.sample(range(64), 3)
            assert any(all(not m >> b & 1 for b in bits) for m in masks)
    deep = simhash.covering(3)
    for _ in range(300):
        bits = rng.sample(range(64), 3)
        for p, m in enumerate(deep[0]):
            if all(not m >> b & 1 for b in bits):
                assert any(all(not x >> b & 1 for b in bits) for x in deep[1][15 * p : 15 * p + 15])
    assert 1 << 64 - min(bin(m).count("1") for m in deep[2]) <= simhash.BUCKET


def test_links_of_crowded_buckets(spark, monkeypatch):
    rng = random.Random(5)
    fps, x = set(), rng.getrandbits(64)
    for _ in range(400):
        fps.add(x)
        x ^= 1 << rng.randrange(64)
        if rng.random() < 0.1:
            x = rng.getrandbits(64)
    items = list(enumerate(sorted(fps)))
    monkeypatch.setattr(simhash, "BUCKET", 24)
    big = simhash._linked
    nodes = spark.createDataFrame([(simhash._signed(f), d) for d, f in items], "fp long, doc long")
    import docweave.llm.simhash as m

    def linked(batches):
        m.BUCKET = 24
        yield from big(batches)

    monkeypatch.setattr(simhash, "_linked", linked)
    root = {r.node: r.root for r in simhash.components(simhash.links(nodes)).collect()}
    assert [root.get(d, d) for d, _ in items] == plain_components([(d, f) for d, f in items])


def test_components_of_a_chain(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in simhash.components(e).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    assert simhash.near_duplicates(empty(spark)).count() == 0


# ---- 3 ----

def test_url_filter(spark):
    urls = ["http://A.Example.NET/en/x", "https://example.net/de/", "http://shop.example.com/de/1?x", "http://x.org/fr/2", "http://x.org/en/2#a", None, "no scheme", "http://notexample.com/de/", "http://www.cheap-pills.example.com/a", "ftp://h?q", "a://b://c/d"]
    pages = spark.createDataFrame([(i, u, "html", "k") for i, u in enumerate(urls)] + [(0, urls[0], "html", "k"), (None, urls[1], "html", "k")], "page_id long, url string, html string, key string")
    rules, listed = common.small_table(spark, queries.RULES, "entry string, verdict string"), queries.listed(spark)
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge(pages, rules, listed).collect()}
    assert got == {
        (0, "a.example.net", "/en/x", "example.net/en/", "allow"), (1, "example.net", "/de/", "net/", "block"), (2, "shop.example.com", "/de/1", "example.com/de/", "block"),
        (3, "x.org", "/fr/2", "org/fr/", "allow"), (4, "x.org", "/en/2", None, "allow"), (5, "", "", None, "allow"), (6, "", "", None, "allow"), (7, "notexample.com", "/de/", None, "allow"),
        (8, "www.cheap-pills.example.com", "/a", None, "block"), (9, "h", "", None, "allow"), (10, "b:", "//c/d", None, "allow"), (None, "example.net", "/de/", "net/", "block"),
    }
    assert urlfilter.judge(pages, rules, listed).count() == len(urls) + 2
    assert urlfilter.judge(pages.where("false"), rules, listed).count() == 0


@pytest.mark.parametrize("words", [urlfilter.WORDS, 0])
def test_url_list_in_canonical_form(spark, monkeypatch, words):
    monkeypatch.setattr(urlfilter, "WORDS", words)
    rows = [("HTTP://b.example/x//y", "block"), ("c.example:80/dir/./", "block"), ("d.example", "block"), ("c.example/dir/sub/page", "allow"), (None, "block"), ("", "block")]
    listed = spark.createDataFrame(rows + [(f"z.example/{i}", "block") for i in range(500)], "entry string, verdict string")
    urls = {"http://b.example/x/y": "block", "http://u@www.b.example:8080//x/./y?q": "block", "http://b.example/x/y/z": "allow", "http://c.example/dir/other": "block", "http://c.example/dir": "allow",
            "http://c.example./dir/sub/page": "allow", "http://d.example": "block", "http://d.example/x": "block", "http://z.example/77": "block", "http://z.example/777": "allow", "http://nothing": "allow"}
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r.page_id: r.verdict for r in urlfilter.judge(pages, common.small_table(spark, queries.RULES, "entry string, verdict string"), listed).collect()}
    assert [got[i] for i in range(len(urls))] == list(urls.values())


def test_url_filter_stays_out_of_the_plan(spark):
    """A filter that stands in the plan as a constant is held once more with each copy and text of the plan that the driver makes."""
    pages = spark.createDataFrame([(1, "http://example.net/de/")], "page_id long, url string")
    sizes = []
    for n in (100, 20_000):
        listed = spark.range(n).select(F.concat(F.lit("z.example/"), F.col("id").cast("string")).alias("entry"), F.lit("block").alias("verdict"))
        found = urlfilter.judge(pages, common.small_table(spark, queries.RULES, "entry string, verdict string"), listed)
        sizes.append(len(found._jdf.queryExecution().optimizedPlan().toString()))
    assert sizes[1] < 1.2 * sizes[0]


# ---- 4 ----

def plain_phrases(sample, text):
    n = i = 0
    while i < len(text):
        n, j = n + 1, i
        while j < len(text) and text[i : j + 1] in sample:
            j += 1
        i = max(j, i + 1)
    return n


@pytest.mark.parametrize("dense", [64, 2, 1])
def test_phrases_are_those_of_a_greedy_parse_of_the_whole_text(monkeypatch, dense):
    monkeypatch.setattr(langid, "DENSE", dense)
    rng = random.Random(dense)
    plain = lambda a: "".join(chr(c) if c else " " for c in a)
    for _ in range(3):
        samples = {k: "".join(rng.choice("abcd xyz"[: rng.randint(2, 8)]) for _ in range(300)) for k in "pq"}
        texts = [langid.symbols("".join(rng.choice("abcd qxyz"[: rng.randint(1, 9)]) for _ in range(n))) for n in (1, 50, 1024, 1025, 5000)]
        parser = langid.Parser({k: [v] for k, v in samples.items()})
        want = [[plain_phrases(plain(langid.symbols(samples[k])) + " ", plain(t)) for k in "pq"] for t in texts]
        for lane in (1024, 7):
            monkeypatch.setattr(langid, "LANE", lane)
            assert parser.phrases(texts).tolist() == want


def test_languages_of_long_texts_are_learned(spark):
    rng = random.Random(12)
    rows = [(i, " ".join(word(rng, "aa") for _ in range(40)), "aa") for i in range(20)] + [(100 + i, " ".join(word(rng, "bb") for _ in range(4000)), "bb") for i in range(4)]
    rows += [(200 + i, " ".join(word(rng, "bb") for _ in range(60)), None) for i in range(5)]
    got = {r.doc_id: r.lang_pred for r in langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True), ["doc_id"]).collect()}
    assert all(got[200 + i] == "bb" for i in range(5))


def test_language_of_held_out_rows(docs):
    part = common.fold(F.col("doc_id"), 3)
    got = langid.identify(docs.withColumn("held_out", part == 1), part != 1, ["doc_id", "held_out"]).collect()
    truth = {r[0]: r[2] for r in rows_of(docs)}
    assert len(got) == docs.count()
    right = [r.lang_pred == truth[r.doc_id] for r in got if r.held_out and r.doc_id and r.doc_id < 2000]
    assert np.mean(right) > 0.9
    assert {r.doc_id: r.lang_pred for r in got if r.doc_id in (2001, 2002, 2003, 2004)} == dict.fromkeys((2001, 2002, 2003, 2004), "und")
    assert all(r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)


def test_language_without_samples(spark, docs):
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(none, F.lit(True), ["doc_id"]).collect()} == {"und"}
    assert langid.identify(empty(spark), F.lit(True), ["doc_id"]).count() == 0


# ---- 5 ----

def test_targets():
    t = mixing.targets({"a": 100, "b": 1000, "c": 1000, None: 10})
    assert math.isclose(sum(t.values()), 1.5 * 2110) and t["a"] == 200 and t[None] == 20 and all(t[k] <= 2 * {"a": 100, "b": 1000, "c": 1000, None: 10}[k] + 1e-9 for k in t)
    assert mixing.targets({}) == {}


def test_flow_is_optimal():
    """Against all ways to send words."""
    rng = random.Random(13)
    for _ in range(60):
        names = ["a", "b", "c"][: rng.randint(1, 3)]
        patterns = [x for x in ("a", "b", "c", "ab", "bc", "abc") if set(x) <= set(names)]
        patterns = rng.sample(patterns, min(len(patterns), 2))
        steps = {p: mixing.passes_of(rng.randint(1, 2), 5) for p in patterns}
        reach = {p: {s: rng.randint(0, 3) for s in p} for p in patterns}
        quota = {s: rng.randint(0, 4) for s in names}
        flow = mixing.min_cost_flow(steps, reach, quota)
        price = lambda p, n: sum(sorted(w for c, w in steps[p] for _ in range(c))[:n])  # noqa: E731, B023
        room = {p: sum(c for c, _ in steps[p]) for p in patterns}
        arcs = [(p, s) for p in patterns for s in p]
        best = (0, 0)
        for x in itertools.product(*[range(reach[p][s] + 1) for p, s in arcs]):
            out = {p: sum(n for n, (q, _) in zip(x, arcs) if q == p) for p in patterns}
            into = {s: sum(n for n, (_, t) in zip(x, arcs) if t == s) for s in names}
            if all(out[p] <= room[p] for p in patterns) and all(into[s] <= quota[s] for s in names):
                best = max(best, (sum(x), -sum(price(p, n) for p, n in out.items())))
        assert all(n <= reach[p][s] for p, f in flow.items() for s, n in f.items())
        assert (sum(n for f in flow.values() for n in f.values()), -sum(price(p, sum(f.values())) for p, f in flow.items())) == best


def test_common_texts_are_shared_out(spark):
    """Two sources hold the same 400 texts, and each may take half of its words: together they take all, none twice."""
    rows = [(s * 1000 + i, f"w{i} " * 10, "ab"[s]) for s in (0, 1) for i in range(400)] + [(5000 + i, f"v{i} " * 10, "c") for i in range(800)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weighed = mixing._quotas
    try:
        mixing._quotas = lambda sizes, quota, passes: {"a": 2000.0, "b": 2000.0, "c": 8000.0}
        got = mixing.mix_by_source(d).collect()
    finally:
        mixing._quotas = weighed
    taken = Counter()
    for r in got:
        if r.doc_id < 2000:
            taken[r.doc_id % 1000] += r.taken
    assert sum(r.taken for r in got if r.doc_id < 1000) == sum(r.taken for r in got if 1000 <= r.doc_id < 2000) == 2000
    assert max(taken.values()) <= 10 * 1.01 or sum(n > 10 for n in taken.values()) <= 2


def test_mix(docs):
    got = mixing.mix_by_source(docs).collect()
    again = mixing.mix_by_source(docs.repartition(7)).collect()
    key = lambda rs: sorted((r.doc_id or -1, r.size, r.taken) for r in rs)
    assert key(got) == key(again) and len(got) == docs.count()
    for r in got:
        assert r.taken in (0, r.size, 2 * r.size)
    taken, target = defaultdict(int), {}
    source = {r[0]: r[3] for r in rows_of(docs)}
    for r in got:
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    for s in taken:
        assert abs(taken[s] - target[s]) <= max(60, 0.02 * target[s]) or s == "s2"  # s2 holds one text of most of its words
    times = mixing.repeated(docs)
    assert times.columns == docs.columns and times.agg(F.sum(mixing.word_count(F.col("text")))).first()[0] == sum(r.taken for r in got)


def test_mix_overlapping(spark):
    rows = [(i, ["a"] if i % 3 == 0 else ["b", "a"] if i % 3 == 1 else None, 10 + i % 5) for i in range(3000)]
    d = spark.createDataFrame(rows, "doc_id long, m array<string>, n long")
    got = mixing.mix(d, F.col("m"), F.col("n"), {"a": 20_000, "b": 6_000, mixing.NULL_SOURCE: 500}).collect()
    sums = defaultdict(int)
    for r in got:
        sums[tuple(r.members)] += r.taken
    assert abs(sum(sums.values()) - 26_500) < 60 and abs(sums[(mixing.NULL_SOURCE,)] - 500) < 30
    assert mixing.mix_by_source(empty(spark)).count() == 0


# ---- 6 ----

PAGE = '<html><head><title>T</title><script>var t="</p>";</script></head><body><nav><ul><li><a href="/x">Menu</a></li></ul></nav><div class="ad">Buy</div><article><h1>Head &amp; more</h1><p><b>First  line<br><p>Second &eacute;<div class="comments">Nice</div></article><footer>&copy; me</footer>'


def test_page_lines():
    assert [t for t, k in pagediff.lines(PAGE) if k == 2] == ["Head & more", "First line", "Second é"]
    assert pagediff.lines(None) == [] and pagediff.lines("") == []


@pytest.mark.parametrize(
    "inside, kept",
    [
        ('<section id="related-work"><p>a</p></section><h2 id="search">b</h2><div class="social-effects">c</div>', "a b c"),
        ('<p class="promo">x<p>a</p><p>b</p>', "a b"), ('<ul><li class="share">x<li>a</ul><p>b', "a b"), ('<div class="promo"><p>x</div><p>a', "a"),
        ('<section><div class="ad">x</section><p>a</p>', "a"), ('<div class="box ad"><div>x</div>y</div><p>a', "a"), ('<div id=comments>x</div><table><tr><td class=ad>x<td>a</table>', "a"),
    ],
)
def test_skipped_elements_end_where_they_should(inside, kept):
    page = f"<html><body><nav>m</nav><article>{inside}</article><p>after</p></body></html>"
    assert [t for t, k in pagediff.lines(page) if k == 2] == kept.split()
    assert [t for t, k in pagediff.lines(page) if k == 1] == ["after"]


def test_shared_lines_are_a_longest_common_subsequence():
    rng = random.Random(4)
    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(12))] for _ in range(2))
        at = pagediff.shared(a, b)
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        assert len(at) == best[-1][-1] and at == sorted(set(at))
        it = iter(b)
        assert all(a[i] in it for i in at)


def test_extract(spark):
    plain = lambda body: f"<html><body><div>Our shop</div><p>{body}</p><div>All rights are ours</div></body></html>"
    rows = [(1, "http://h/a/1", plain("one text"), "x"), (2, "http://h/a/2", plain("two text"), "x"), (3, "http://h/b/2", PAGE, "x"), (4, "http://h/b/3", PAGE, "x"), (5, None, None, "x"), (6, "http://g/", plain("alone"), "x"), (6, "http://g/", plain("alone"), "x")]
    got = pagediff.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    text = {r.page_id: r.text for r in got.collect()}
    assert got.count() == 7
    assert text[1] == "one text" and text[2] == "two text"
    assert text[3] == text[4] == "Head & more\nFirst line\nSecond é"
    assert text[5] == "" and text[6] == "Our shop\nalone\nAll rights are ours"
    assert {r.page_id: (r.n_shared, r.n_tagged) for r in got.collect()}[1] == (2, 0)
    assert pagediff.extract(got.select("page_id", "url", F.lit("").alias("html")).where("false")).count() == 0


def apart(a, b):
    """Not the same lines, and fewer than three quarters of a's own text lines in b."""
    own = [x for x in a if x % 2 == 0]
    return a != b and (not own or len([x for x in own if x in b]) / len(own) < 0.75)


def plain_extract(rows):
    """Every page against the nearest on both sides, from the whole order."""
    parsed = {}
    keys = {}
    for i, (pid, url, text) in enumerate(rows):
        host, path = re.match(r"[a-z]+://([^/?#]*)([^?#]*)", url).groups()
        page = pagediff.parsed(text)
        parsed[i] = (host, path, pid), page, tuple(f for _, _, f in page)
        first = keys.setdefault(parsed[i][0], i)
        h = lambda k: xxhash.xxh64_intdigest(rows[k][2].encode(), seed=42) - (xxhash.xxh64_intdigest(rows[k][2].encode(), seed=42) >> 63 << 64)
        if h(i) < h(first):
            keys[parsed[i][0]] = i
    order = sorted(keys)
    out = {}
    for i, (key, page, hashes) in parsed.items():
        at, partners = order.index(key), []
        for side in (order[max(0, at - pagediff.LOOK) : at][::-1], order[at + 1 : at + 1 + pagediff.LOOK]):
            found = []
            for k in side:
                other = parsed[keys[k]][2]
                if k[0] == key[0] and apart(parsed[keys[key]][2], other) and other not in found and len(found) < pagediff.NEAR:
                    found.append(other)
            partners += [p for p in found if apart(hashes, p)]
        out.setdefault((key[2], rows[i][1]), []).append(pagediff.judged(page, hashes, partners))
    return out


def test_extract_matches_plain_version_over_stretches(spark, monkeypatch):
    rng = random.Random(14)
    monkeypatch.setattr(pagediff, "STRETCH", 150)
    rows = []
    for i in range(500):
        host = rng.choice(["h.example", "h.example", "g.example", f"one{i}.example"])
        body = "".join(f"<p>{word(rng, 'aa')} {rng.randrange(40)}</p>" for _ in range(rng.randint(1, 5)))
        page = f"<div>{rng.choice(['menu', 'menu', 'other'])}</div><nav>go {rng.randrange(3)}</nav><article><h1>{i}</h1>{body}<p>About the house</p></article><div>end</div>"
        rows.append((i, f"http://{host}/{rng.choice('abc')}/{rng.randrange(300)}", page))
    rows += [rows[3], rows[3], (rows[9][0], rows[9][1], "<p>second content</p>")]
    got = pagediff.extract(spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string").repartition(5)).collect()
    found = {}
    for r in got:
        found.setdefault((r.page_id, r.url), []).append((r.text, r.n_shared, r.n_tagged))
    want = plain_extract(rows)
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}
    # the house line stands in every article and stays in all of them
    assert sum("About the house" not in t for v in want.values() for t, _, _ in v) == 1 and sum(n for v in want.values() for _, n, _ in v) > 300


def test_no_article_text_is_lost(spark):
    five = "".join(f"<p>Paragraph {c} of the story goes on for a while.</p>" for c in "abcde")
    copies = [(i, f"http://h/news/{i}", f"<html><body>{five}<p>posted {i} May</p></body></html>") for i in (3, 4)]
    ends = [(100 + i, f"http://g/{i}", f"<html><body><nav><a href='/'>Home {i}</a></nav><article><p>Body of {i} with words of its own {i * 7}</p><h2>Conclusion</h2><p>Said {i * 3}</p></article></body></html>") for i in range(20)]
    text = {r.page_id: r.text for r in pagediff.extract(spark.createDataFrame(copies + ends, "page_id long, url string, html string")).collect()}
    assert all(len(text[i].split("\n")) == 6 and text[i].endswith(f"posted {i} May") for i in (3, 4))
    assert all(text[100 + i].split("\n") == [f"Body of {i} with words of its own {i * 7}", "Conclusion", f"Said {i * 3}"] for i in range(20))


def test_partners_decide_where_tags_say_nothing(spark):
    rng = random.Random(5)

    def page(i):
        menu = "".join(f"<div><a href='/{w}'>{w}</a> <a href='/{w}2'>{w} too</a></div>" for w in (f"m{rng.randrange(99)}" for _ in range(3)))
        body = "".join(f"<p>Story {i} says {rng.randrange(10**6)} and {word(rng, 'aa')} {word(rng, 'bb')}</p>" for _ in range(4))
        return f"<html><body>{menu}<div>Our shop since {1900 + i}</div><div>{body}</div><div>Call us, visitor {i}</div></body></html>"

    rows = [(i, f"http://h.example/a/{i}", page(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    with_ = {r.page_id: (r.text, r.n_shared, r.n_tagged) for r in pagediff.extract(df).collect()}
    alone = {r.page_id: r.text for r in pagediff.extract(df.where("page_id = 0")).collect()}
    assert all(len(t.split("\n")) == 4 and t.startswith(f"Story {i} ") and (n, m) == (5, 0) for i, (t, n, m) in with_.items())
    assert len(alone[0].split("\n")) == 9  # without partners the frame stays


def test_large_alignments_are_halved(monkeypatch):
    rng = random.Random(15)
    monkeypatch.setattr(pagediff, "TABLE_BITS", 40)
    for _ in range(60):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(30))] for _ in range(2))
        at = pagediff.shared(a, b)
        it = iter(b)
        assert len(at) == pagediff._lengths(a, b)[-1] and at == sorted(set(at)) and all(a[i] in it for i in at)


# ---- 7 ----

def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(6)
    docs, labels = [], []
    for i in range(900):
        words = [word(rng, rng.choice(list(VOWELS))) for _ in range(rng.randint(20, 80))]
        bad = i % 6 == 0
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "badxx" + word(rng, "aa"), "scum"]))
        docs.append((i, " ".join(words), "x"))
        labels.append((i, int(bad), "y"))
    docs += [(5000, None, "x"), (5001, "", "x"), (5002, "idiot you " * 20_000, "x")]
    d, lab = spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels + labels[:3], "doc_id long, toxic int, text string")
    part = common.fold(F.col("doc_id"), 4)
    got = {r.doc_id: r for r in toxicity.score(d, lab, part != 2).collect()}
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([got[i].predicted == (i % 6 == 0) for i in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    assert got[5000].predicted == got[5001].predicted == 0 and got[5002].predicted == 1
    assert {r.score for r in toxicity.score(d, lab.where("false"), part != 2).collect()} == {0.0}


# ---- 8 ----

def test_decontamination(spark):
    rng = random.Random(7)
    items = [(i, " ".join(word(rng, "aa") + word(rng, "bb") for _ in range(rng.choice([16, 30, 59, 150])))) for i in range(30)] + [(100, None), (101, "")]
    docs, truth = [], set()
    for d in range(120):
        words = [word(rng, "aa") + word(rng, rng.choice(["aa", "bb"])) for _ in range(rng.randint(1, 300))]
        if d % 4 == 0:
            i = rng.randrange(30)
            w = items[i][1].upper().split()
            if d % 8 == 0:
                w[len(w) // 2] = "other"
            words[len(words) // 2 : len(words) // 2] = [w[0] + ",", *w[1:]]
            truth.add((d, i))
        docs.append((d, " ".join(words), "x"))
    docs += [(500, None, "x"), (501, "", "x"), (502, "the of " * 30_000 + items[0][1], "x")]
    truth.add((502, 0))
    d, b = spark.createDataFrame(docs, "doc_id long, text string, leaks string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(d, b).collect()}
    assert got == truth
    assert decontaminate.leaks(d, b.where("false")).count() == 0 and decontaminate.leaks(d.where("false"), b).count() == 0


def dense_index(items, docs=1000):
    """An index, and the plain TF-IDF vector of a list of words."""
    index = decontaminate.Index(items)
    index.weigh(docs, {i: 1 + i % 50 for i in index.terms.values()})
    n = len(index.terms)

    def vector(words):
        out = Counter()
        for w in set(words):  # a word counts once
            out[w] = index.idf[min(index.terms.get(w, n), n)]
        return out

    return index, vector


def test_no_skipped_window_reaches_the_bound_and_cosines_are_true(spark):
    rng = random.Random(16)
    items = [(i, " ".join(word(rng, "aa") for _ in range(rng.randint(8, 60))), None) for i in range(40)]
    index, vector = dense_index(items)
    index.fit(spark.range(1))
    assert index.basis.shape[1] - index.own_axes < len(index.passages)
    texts = [[rng.choice([word(rng, "aa"), word(rng, "cc"), "the"]) for _ in range(rng.randint(1, 90))] for _ in range(60)]
    texts += [t.split()[:40] + ["filler"] * 9 for _, t, _ in items]
    words = decontaminate.Words(index.terms)
    read = [[w.encode() for w in t] for t in texts]
    ids = np.array([words[w] for t in read for w in t])
    owner, first, lo, hi, norm, share, _ = index.windows(ids, np.array([len(t) for t in read]))
    least = float(index.least.min()) ** 2 * (1 - 1e-6)
    for k in range(len(owner)):
        v = vector(read[owner[k]][first[k] : first[k] + hi[k] - lo[k]])
        assert math.isclose(norm[k], math.sqrt(sum(x * x for x in v.values())), rel_tol=1e-6)
        x = np.zeros(len(index.terms))
        for w, y in v.items():
            if w in index.terms:
                x[index.terms[w]] = y
        # basis rows hold the idf: undone here
        cosine = (x / index.idf[:-1]) @ index.basis[:-1] @ index.latent.T / norm[k]
        assert cosine.max() <= 1 + 1e-5
        if share[k] < least:
            assert (cosine < index.least).all()


def test_recall_of_candidates_in_the_latent_space(spark):
    """Windows of altered passages against the plain TF-IDF cosine: at least 0.9 of those that reach the bound there are candidates."""
    rng = random.Random(17)
    items = [(i, " ".join(word(rng, "aa") + word(rng, "bb") for _ in range(30)), None) for i in range(60)]
    index, vector = dense_index(items)
    index.fit(spark.range(1))
    rows = np.zeros((len(items), len(index.terms)))
    for i, (t, w) in enumerate(index.rows()):
        rows[i, t] = w
    met = reached = 0
    for i, (_, t, _) in enumerate(items):
        w = [x if rng.random() > 0.3 else "other" for x in t.split()][:16]
        v = vector([x.encode() for x in w])
        x = np.zeros(len(index.terms))
        for k, y in v.items():
            if k in index.terms:
                x[index.terms[k]] = y
        norm = math.sqrt(sum(y * y for y in v.values()))
        if rows[i] @ x / norm >= index.least[i]:
            reached += 1
            met += (x / index.idf[:-1]) @ index.basis[:-1] @ index.latent[i] / norm >= index.least[i]
    assert reached > 30 and met >= 0.9 * reached


def test_blocks_find_what_one_space_finds(spark, monkeypatch):
    rng = random.Random(18)
    items = [(i, " ".join(word(rng, "aa") + word(rng, "bb") for _ in range(20))) for i in range(30)]
    texts = [(i, "start " + t + " end") for i, t in items] + [(100, "nothing here")]
    d, b = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    one = {(r.doc_id, r.item_id) for r in decontaminate.leaks(d, b).collect()}
    monkeypatch.setattr(decontaminate, "TERMS", 60)
    assert one == {(r.doc_id, r.item_id) for r in decontaminate.leaks(d, b).collect()} == {(i, i) for i, _ in items}


def paraphrase(words, share, other):
    """Every (1 / share)th word but those of the answer replaced."""
    last = max(3, len(words) // 5)
    gone = [int(k / share) for k in range(int(share * len(words))) if int(k / share) < len(words) - last]
    return [other if i in gone else w for i, w in enumerate(words)]


def test_decontamination_bound_of_windows(spark):
    """No window that reaches a passage's bound is skipped by what its words add at most, and windows of a few common words are."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    index = decontaminate.Index([(i, " ".join(rng.sample(words, 30)), None) for i in range(30)])
    index.weigh(1000, {i: rng.randint(1, 30) for i in range(len(index.terms))})
    index.fit(spark.range(1))
    n, skipped = len(index.terms), 0
    for i in range(600):
        t = np.array(rng.sample(index.passages[i % 30], i % 17) + rng.choices(range(n), k=3) + [n] * 16)[:16]
        t = np.append(np.unique(t[t < n]), t[t == n])
        norm = math.sqrt((index.idf[t] ** 2).sum())
        reached = (index.latent @ index.basis[t].sum(0) / norm >= index.least).any()
        kept = index.most[t].sum() >= norm * (1 - 1e-3)
        assert kept or not reached
        skipped += not kept
    assert skipped > 50


def test_decontamination_finds_paraphrases_of_any_length(spark):
    rng = random.Random(9)
    items = [(m, " ".join(f"{word(rng, 'aa')}{m}{i}" for i in range(m))) for m in (16, 30, 45, 59, 75)]
    texts = [(m, " ".join(["filler"] * 40 + paraphrase(t.split(), 0.25, "filler") + ["filler"] * 40)) for m, t in items]
    docs = texts + [(1000 + i, " ".join(["filler"] * 50)) for i in range(200)]
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(m, m) for m, _ in items}
    assert any(r.overlap < decontaminate.OVERLAP for r in found)


@pytest.mark.parametrize("docs", [10_000, 3_000_000])
def test_candidates_do_not_depend_on_the_number_of_documents(spark, docs):
    rng = random.Random(10)
    items = [(m, " ".join(f"{word(rng, 'aa')}{m}{i}" for i in range(m)), None) for m in (8, 10, 16, 40, 79)]
    index = decontaminate.Index(items)
    index.weigh(docs, {t: int(docs * rng.choice([0.01, 0.03, 0.1])) for t in index.terms.values()})
    index.fit(spark.range(1))
    held = [" ".join(["filler"] * 40 + paraphrase(t.split(), 0.19, "filler") + ["filler"] * 40).encode() for _, t, _ in items]
    found = index.find([*held, b"filler " * 100])
    assert [[f[0] for f in x] for x in found] == [[8], [10], [16], [40], [79], []]


def test_common_subsequence_length():
    rng = random.Random(8)
    for _ in range(100):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(1, 15))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        assert decontaminate.common(a, b) == best[-1][-1]


# ---- 9 ----

def plain_lm(data, order, kept):
    """Scores by dictionaries: (id, n_tokens, n_known, base, score) of every row of (id, text, train, held), given the model's weights."""
    toks = lambda t: [*(t or "").lower().encode().split(), b"\n"]

    def grams(t):
        w = ["start"] * (order - 1) + toks(t)
        return [[tuple(w[i - k : i + 1]) for k in range(order)] for i in range(order - 1, len(w))]

    def counted(rows):
        c = Counter(g for _, t, *_ in rows for gs in grams(t) for g in gs)
        for k in range(1, order):
            c[("start",) * k] = len(rows)
        return c

    def estimates(c, n, gs):
        b, f = [0], [c[gs[0]] / max(1, n)]
        for g in gs[1:]:
            context = c[g[:-1]]
            b.append(int(math.log2(context)) + 1 if context else 0)
            f.append(c[g] / context if context else 0.0)
        return b, f

    every = counted([r for r in data if r[2]])
    learned = [w for _, t, train, _ in data if train for w in toks(t)]
    n, kinds = len(learned), len(set(learned))
    out = []
    for i, t, _, _ in data:
        base = score = 0.0
        known = 0
        for gs in grams(t):
            base += math.log10((every[gs[0]] + 0.1) / (n + 0.1 * (kinds + 1)))
            known += every[gs[0]] > 0
            b, f = estimates(every, n, gs)
            p = kept.lowest * f[0] + (1 - kept.lowest) / (kinds + 1)
            for k in range(1, order):
                p = kept.weights[k][b[k]] * f[k] + (1 - kept.weights[k][b[k]]) * p
            score += math.log10(p)
        out.append((i or -1, len(toks(t)), known, n, round(base, 4), round(score, 4)))
    return out, counted([r for r in data if r[2] and not r[3]]), [r for r in data if r[3]], grams, estimates


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_matches_plain_version(docs, monkeypatch, order):
    monkeypatch.setattr(lm, "RUN", 2_000)
    monkeypatch.setattr(lm, "PART", 40_000)
    kept, learn = [], lm.Model.learn
    monkeypatch.setattr(lm.Model, "learn", lambda self, *x: (learn(self, *x), kept.append(self)) and None)
    got = lm.score_fold(docs, order).collect()
    part = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10
    data = [(d, t, part(d) != 0, part(d) == 1) for d, t, _, _ in rows_of(docs)]
    want, main, held, grams, estimates = plain_lm(data, order, kept[0])
    assert sorted((r.doc_id or -1, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4), round(r.score, 4)) for r in got) == sorted(want)
    assert all(r.held_out == (part(r.doc_id) == 0) and r.score <= 0 for r in got)
    # the weights raise the likelihood of the held-out texts over equal ones
    n = sum(c for g, c in main.items() if len(g) == 1 and g != ("start",))
    kinds = sum(len(g) == 1 and g != ("start",) for g in main)

    def likelihood(lowest, weights):
        total = 0.0
        for _, t, *_ in held:
            for gs in grams(t):
                b, f = estimates(main, n, gs)
                p = lowest * f[0] + (1 - lowest) / (kinds + 1)
                for k in range(1, order):
                    p = weights[k][b[k]] * f[k] + (1 - weights[k][b[k]]) * p
                total += math.log(p)
        return total

    even = np.full((order + 1, 64), 0.5)
    even[:, 0] = 0
    best = likelihood(kept[0].lowest, kept[0].weights)
    assert held and best > likelihood(0.5, even)
    for k in range(1, order):  # a stationary point, up to the steps of the held-out counts
        for move in (0.9, 1.1):
            other = kept[0].weights.copy()
            other[k] = np.minimum(0.999, other[k] * move)
            assert likelihood(kept[0].lowest, other) <= best + 0.01 * abs(best)


def test_lm_is_a_distribution():
    """Over all known words and one unknown word, probabilities after a context sum to 1."""
    m = lm.Model(100, 5, 3)
    f = np.random.default_rng(0).dirichlet(np.ones(5), 3)
    f = np.concatenate([f, np.zeros((3, 1))], 1)
    b = np.array([[0] * 6, [3] * 6, [2] * 6])
    m.weights[1, 3], m.weights[2, 2] = 0.3, 0.8
    assert math.isclose(m.p(b, f).sum(), 1)


def test_lm_edges(spark, docs):
    assert lm.score_fold(empty(spark)).count() == 0
    none = lm.score(docs, F.lit(False), F.lit(False)).collect()
    assert len(none) == docs.count() and all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in none)


def test_packed_numbers():
    rng = np.random.default_rng(1)
    for a in (np.zeros(0), np.zeros(5), np.arange(10_000), rng.integers(0, 2**63, 5_000), rng.integers(0, 3, 9_000), np.array([2**64 - 1], np.uint64)):
        assert (lm.unpack(lm.pack(a.astype(np.uint64))) == a.astype(np.uint64)).all()


# ---- 10 ----

def test_sharding(docs):
    got = sharding.assign(docs, 16, ("lang", "row")).collect()
    data = rows_of(docs)
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in got) == sorted((d or -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _, _ in data)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert set(by) <= set(range(16)) and max(map(len, by.values())) - min(len(by[s]) for s in range(16)) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_sharding_moves_little(spark):
    d = spark.range(4000).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    a, b = ({r.doc_id: r.shard for r in sharding.assign(d, k).collect()} for k in (15, 16))
    home = {r.doc_id: r.s for r in d.select("doc_id", sharding.home(F.col("text"), 16).alias("s")).collect()}
    assert sum(a[i] != b[i] for i in a) < 800 and sum(b[i] == home[i] for i in b) > 2800
    hot = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    assert {r["count"] for r in sharding.assign(hot, 16).groupBy("shard").count().collect()} == {62, 63}
    assert sharding.assign(hot.where("false"), 16).count() == 0


def test_route_matches_row_by_row_version():
    """Rows in ring order: first each to its own shard while it has room, then the rest clockwise."""
    rng = random.Random(19)
    for shards in (1, 3, 16):
        owner = sharding.ring(shards)
        loads = [0] * sharding.CELLS
        for _ in range(500):
            loads[rng.choice([5, rng.randrange(sharding.CELLS)])] += 1
        room = [500 // shards + (s < 500 % shards) for s in range(shards)]
        want, late = Counter(), []
        for c, n in enumerate(loads):
            for _ in range(n):
                if room[owner[c]]:
                    room[owner[c]] -= 1
                    want[c, owner[c]] += 1
                else:
                    late.append(c)
        for c in late:
            at = next(x for x in range(c + 1, c + sharding.CELLS + 1) if room[owner[x % sharding.CELLS]])
            room[owner[at % sharding.CELLS]] -= 1
            want[c, owner[at % sharding.CELLS]] += 1
        got = Counter()
        for c, s, n in sharding.route(loads, owner, shards):
            got[c, s] += n
        assert got == want


def test_route_uses_all_room():
    owner = sharding.ring(5)
    loads = [0] * sharding.CELLS
    loads[17] = 103
    out = sharding.route(loads, owner, 5)
    total = Counter()
    for _, s, n in out:
        total[s] += n
    assert sorted(total.values()) == [20, 20, 21, 21, 21]


# ---- queries and pipeline ----

def firsts(rows):
    """The smallest doc_id of each group of near copies: fingerprints within three bits, or four fifths of all five-word shingles in common."""

    def five(t):
        w = (t or "").lower().split()
        return set(zip(*(w[i:] for i in range(5)))) if len(w) >= 5 else {tuple(w)} if w else set()

    prints, sets = [simhash.simhash((t or "").encode()) for _, t in rows], [five(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 3 or sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
            up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(least.values())


def test_pipeline(spark, docs, tmp_path):
    import corpus_pipeline

    rng = random.Random(9)
    item = " ".join(word(rng, "aa") + word(rng, "cc") for _ in range(30))
    d = docs.unionByName(spark.createDataFrame([(4000, "word one " + item + " more words", "aa", "s1", 10, *["x"] * len(CLASH))], SCHEMA))
    d.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    seen = {}
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = [r.doc_id for r in now.collect()]
        if i < 4:
            assert now.columns == d.columns
    assert not {2001, 2002, 2003, 2004} & set(seen["language_id"]) and len(seen["language_id"]) == d.count() - 4
    assert sorted(x for x in seen["near_dedup"] if x is not None) == firsts([(r.doc_id, r.text) for r in spark.read.parquet(f"{tmp_path}/language_id").collect()])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, d.where("false"), str(tmp_path)).count() == 0
    assert set(seen["near_dedup"]) - set(seen["decontamination"]) == {4000}
    assert set(seen["mix"]) <= set(seen["decontamination"]) and max(Counter(seen["mix"]).values()) <= 2
    assert sorted(map(str, seen["shard"])) == sorted(map(str, seen["mix"]))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(seen["shard"])


def test_registered():
    assert [q.split("_")[0] for q in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]
