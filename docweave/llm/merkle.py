r"""Merkle fingerprints of documents over sections and paragraphs, with DataFrame functions only.

A text is cut, losing nothing, into sections (after blank lines), paragraphs (after line ends) and pieces (after sentence
ends, 80 characters at most). Leaves hash pieces, inner nodes hash their children; the root tests equality. The fingerprint
is the tree itself: the root, a colon, and the sections between `/`, each as its hash, `=` and its paragraphs between `.`, each as its hash, `~` and the
tags of its leaves (8 hex digits each). Two trees are compared from the root down: the first and last branch that differ on each level tell where an edit is.
"""

from __future__ import annotations

import json
import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import small_table

PIECE = r"[^.!?\n]{0,80}[.!?\n]+|[^.!?\n]{1,80}"
TAG = 8
MOST_CUTS = 32_768


def leaves(text: Column) -> Column:
    """Leaf hashes as sections of paragraphs of pieces."""
    paragraph = lambda p: F.transform(F.regexp_extract_all(p, F.lit(PIECE), F.lit(0)), F.md5)
    section = lambda s: F.transform(F.split(s, r"(?<=\n)"), paragraph)
    return F.transform(F.split(text, r"(?<=\n\n)"), section)


def _bound(x: Column, f) -> Column:  # noqa: ANN001
    """f of x, where x is worked out once."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def fingerprint(text: Column) -> Column:
    """The tree of a text as a string."""
    paragraph = lambda p: F.struct(F.md5(F.array_join(p, "")).alias("h"), F.array_join(F.transform(p, lambda x: F.substring(x, 1, TAG)), "").alias("t"))
    section = lambda s: F.struct(F.md5(F.array_join(F.transform(s, lambda p: p["h"]), "")).alias("h"), F.array_join(F.transform(s, lambda p: F.concat(F.substring(p["h"], 1, TAG), F.lit("~"), p["t"])), ".").alias("t"))
    tree = F.transform(F.transform(leaves(text), lambda s: F.transform(s, paragraph)), section)
    root = lambda t: F.sha2(F.array_join(F.transform(t, lambda s: s["h"]), ""), 256)
    body = lambda t: F.array_join(F.transform(t, lambda s: F.concat(F.substring(s["h"], 1, 2 * TAG), F.lit("="), s["t"])), "/")
    return _bound(tree, lambda t: F.concat(root(t), F.lit(":"), body(t)))


def _body(print_: Column) -> Column:
    return F.substring_index(print_, ":", -1)


def tag_list(print_: Column) -> Column:
    """The leaf tags of a fingerprint."""
    # hashes have fixed lengths, so a pattern never runs along the tags
    flat = F.regexp_replace(_body(print_), f"[0-9a-f]{{{2 * TAG}}}=|[0-9a-f]{{{TAG}}}~|[./]", "")
    return F.regexp_extract_all(flat, F.lit(f".{{{TAG}}}"), F.lit(0))


def branches(print_: Column) -> tuple[Column, Column, Column]:
    """The hashes of a fingerprint's sections, of its paragraphs, and the tags of its leaves, each in the order of the text."""
    return F.regexp_extract_all(_body(print_), F.lit(f"([0-9a-f]{{{2 * TAG}}})="), F.lit(1)), F.regexp_extract_all(_body(print_), F.lit(f"([0-9a-f]{{{TAG}}})~"), F.lit(1)), tag_list(print_)


def _same(x: Column, y: Column) -> Column:
    """How many first places of two arrays are equal."""
    return _bound(F.array_position(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), F.lit(False)), lambda n: F.when(n > 0, n - 1).otherwise(F.least(F.size(x), F.size(y))).cast("int"))


def _span(a: Column, b: Column) -> Column:
    """First differing place of two arrays, and the last in each (below the first if an array has none); null if they are equal."""
    sides = F.struct(_same(a, b).alias("lead"), _same(F.reverse(a), F.reverse(b)).alias("tail"), F.size(a).alias("a"), F.size(b).alias("b"))
    ends = lambda s: F.struct(s["lead"].alias("lead"), F.least(s["tail"], F.least(s["a"], s["b"]) - s["lead"]).alias("tail"), s["a"].alias("a"), s["b"].alias("b"))
    span = lambda s: F.when((s["lead"] < s["a"]) | (s["lead"] < s["b"]), F.struct(s["lead"].alias("first"), (s["a"] - s["tail"] - 1).alias("last"), (s["b"] - s["tail"] - 1).alias("last_other")))
    return _bound(_bound(sides, ends), span)


def changed(a: Column, b: Column) -> Column:
    """Where two fingerprints differ, by level: the first and last section, paragraph and leaf (from 0) of the branches that differ; null if the roots are equal."""
    names = ("sections", "paragraphs", "leaves")
    # every array is worked out once, bound as a field
    both = F.struct(*[x.alias(f"{n}_{side}") for side, f in (("a", a), ("b", b)) for n, x in zip(names, branches(f))])
    return F.when(a != b, _bound(both, lambda s: F.struct(*[_span(s[f"{n}_a"], s[f"{n}_b"]).alias(n) for n in names])))


def likeness(a: Column, b: Column) -> Column:
    """Dice coefficient of two arrays of distinct leaf tags; 1 if both are empty."""
    both = F.size(a) + F.size(b)
    return F.when(both == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / both)


def with_next(rows: DataFrame, key: str, tie: str, carry: list[str], chunk: int = 128) -> DataFrame:
    """rows with next_<c> for c in carry: the values of the next row by key (nulls first) and tie (a hash), after the last the first.

    The order is cut at sampled quantiles that occur as keys; a key that fills several stretches is cut further by the tie. The rows that start a stretch
    also go to the stretch before it as guests, so each stretch is ordered by itself and no rows meet in one task but about chunk of them (and equal
    rows). At most MOST_CUTS cut points reach the driver, whatever the input; at greater sizes stretches are longer and their sort spills.
    """
    least = -(2**63)
    # one struct holds the caller's columns, whatever their names
    rows = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), F.coalesce(F.col(key).cast("long"), F.lit(least)).alias("k"), F.coalesce(tie, F.lit(least)).alias("h"))
    n, start = rows.agg(F.count("*"), F.min(F.struct("k", "h"))).first()
    cuts: list[tuple[int, int]] = []
    m = min(MOST_CUTS, math.ceil(n / chunk))
    if m > 1:
        found = rows.agg(F.percentile_approx("k", [i / m for i in range(1, m)], 8 * m)).first()[0]
        fills = Counter(found)
        cuts = [(x, least) for x in fills if x != start.k]
        if hot := {x: f for x, f in fills.items() if f > 1}:
            # the tie is a hash: equal ranges of it hold about equal parts of a key's rows, apart from equal rows
            parts = F.broadcast(small_table(rows.sparkSession, [[x, f] for x, f in hot.items()], "x bigint, f int"))  # MOST_CUTS rows at most
            slot = F.floor((F.col("h").cast("double") / 2.0**64 + 0.5) * F.col("f"))
            first = rows.join(parts, F.col("k") == F.col("x")).groupBy("k", slot.alias("slot")).agg(F.min("h").alias("h")).where("slot > 0").collect()
            cuts += [(r.k, r.h) for r in first]
        cuts = sorted(set(cuts) - {tuple(start)})
    # a row is compared with the heads of groups, then within its group
    each = max(1, math.isqrt(len(cuts)))
    groups = [[{"k": x, "h": y} for x, y in cuts[i : i + each]] for i in range(0, len(cuts), each)]
    one = "struct<k:bigint,h:bigint>"
    heads = F.from_json(F.lit(json.dumps([g[0] for g in groups])), f"array<{one}>")
    nested = F.from_json(F.lit(json.dumps(groups)), f"array<array<{one}>>")
    here = F.struct("k", "h")
    rows = rows.withColumn("c", F.size(F.filter(heads, lambda x: x <= here)))
    own = F.filter(F.coalesce(F.get(nested, F.col("c") - 1), F.array().cast(f"array<{one}>")), lambda x: x <= here)
    rows = rows.withColumn("own", own)
    rows = rows.withColumn("s", F.when(F.col("c") == 0, 0).otherwise((F.col("c") - 1) * each + F.size("own")).cast("int"))
    begin = F.get("own", F.size("own") - 1)
    guest = F.when((F.col("k") == F.lit(start.k if n else 0)) & (F.col("h") == F.lit(start.h if n else 0)), F.lit(len(cuts)))
    guest = guest.when((begin["k"] == F.col("k")) & ((begin["h"] == least) | (begin["h"] == F.col("h"))), F.col("s") - 1).cast("int")
    place = F.struct(F.col("s").alias("s"), F.lit(False).alias("guest"))
    both = F.when(guest.isNull(), F.array(place)).otherwise(F.array(place, F.struct(guest.alias("s"), F.lit(True).alias("guest"))))
    rows = rows.select("row", "k", "h", F.explode(both).alias("p"))
    w = Window.partitionBy("p.s").orderBy("p.guest", "k", "h")
    nexts = [F.lead(F.col("row").getField(c)).over(w).alias(f"next_{c}") for c in carry]
    return rows.select("row", F.col("p.guest").alias("guest"), *nexts).where("not guest").select("row.*", *[f"next_{c}" for c in carry])


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Fingerprints of all rows of docs (doc_id, text) and of their edited texts, with the likenesses and where the two trees differ.

    The edited text has its last floor(n_chars/2) code points replaced by the first as many (or all) of the next document by doc_id;
    after the last comes the first. A null text counts as empty; an empty text's tree has one empty paragraph. Rows with equal
    ids stand in the order of their text's hash, null ids first; one row alone is its own next. Extra columns are ignored, whatever their names. No rows give no rows.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).withColumns({"fingerprint": fingerprint(F.col("t")), "h": F.xxhash64("t")})
    rows = with_next(rows, "doc_id", "h", ["t", "fingerprint"])
    n = F.length("t").cast("long")
    rows = rows.withColumn("n_chars", n).withColumn("half", F.floor(n / 2).cast("int"))
    rows = rows.withColumn("edited", F.concat(F.col("t").substr(F.lit(1), (F.col("n_chars") - F.col("half")).cast("int")), F.col("next_t").substr(F.lit(1), F.col("half"))))
    rows = rows.withColumn("edited_fingerprint", fingerprint(F.col("edited")))
    rows = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "next_fingerprint")
    rows = rows.withColumns({f"_{c}": F.array_distinct(tag_list(F.col(f))) for c, f in (("a", "fingerprint"), ("b", "edited_fingerprint"), ("c", "next_fingerprint"))})
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("_a"), F.col("_b")).alias("near_edited"), likeness(F.col("_a"), F.col("_c")).alias("near_next"),
        changed(F.col("fingerprint"), F.col("edited_fingerprint")).alias("changed"),
    )
