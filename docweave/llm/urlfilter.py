"""URL filters: a blocked Bloom filter of listed canonical URLs, then an exact hash join.

Every URL yields candidate keys: its host and each parent domain, joined to heads of its path. Rules are looked up under the URL as it is, with heads of
the rules' lengths; the list under the canonical URL, with the heads that end in a slash and the whole path. A key reads one block (four words)
of the filter. Only keys that may be listed are exploded and go on to an exact join with the list, which removes false positives; URLs without any are
done but for one row that carries them. Of the entries that fit, the longest wins. DataFrame functions only; the filter is a table keyed by block and
the keys of a URL are joined to it, by broadcast while it has at most WORDS words. As a constant in the plan it would stand in every copy of the plan that the driver holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys a block of 256 bits holds on average; each sets one bit in each of its four words. Words of a filter that is broadcast (4 MB).
PER_BLOCK, WORDS = 12, 1 << 19


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of the column _url: host from after the first :// up to / ? # or the end, A-Z lower-cased; path then up to ? # or the end. Null or without ://: both empty."""
    rest = F.when(F.coalesce(F.instr(url, "://"), F.lit(0)) > 0, F.expr("substring(`_url`, instr(`_url`, '://') + 3)")).otherwise("")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1), upper, lower)
    return host, F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column) -> tuple[Column, Column]:
    """Canonical host (no user, port or final dot) and path (`/` at least, runs of slashes and `.` segments as one slash)."""
    host = F.regexp_replace(F.regexp_replace(host, r"(?s)\A.*@", ""), r"\.?(:[0-9]*)?\z", "")
    path = F.regexp_replace(F.regexp_replace(path, r"/(\./)+", "/"), "/{2,}", "/")
    return host, F.when(path == "", F.lit("/")).otherwise(path)


def _entries(listed: DataFrame, strict: bool) -> DataFrame:
    """(key, path, e) of a list (entry like `example.net/en/`, verdict): hosts lower-cased, no scheme, null and hostless entries dropped, of repeated ones the least verdict and entry."""
    e = F.regexp_replace(F.col("entry"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "")
    host, path = F.lower(F.regexp_extract(e, r"^([^/?#]*)", 1)), F.regexp_extract(e, r"^[^/?#]*([^?#]*)", 1)
    if not strict:
        host, path = canonical(host, path)
    rows = listed.select(host.alias("host"), F.when(path == "", F.lit("/")).otherwise(path).alias("path"), "entry", "verdict").where("host <> ''")
    return rows.groupBy("host", "path").agg(F.min(F.struct("verdict", "entry")).alias("e")).select(F.concat(F.lit("r " if strict else "l "), "host", "path").alias("key"), "path", "e")


def _bits(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    h, g = F.xxhash64(key), F.xxhash64(F.lit("second"), key)
    return F.pmod(h, F.lit(blocks)), [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(g, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(4)]


def bloom(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, w0..w3) of the keys."""
    block, bits = _bits(F.col("key"), blocks)
    return keys.select(block.alias("block"), *[b.alias(f"w{i}") for i, b in enumerate(bits)]).groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4)])


def _domains(host: Column) -> Column:
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def judge(pages: DataFrame, rules: DataFrame, listed: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict, entry) of every row of pages (page_id, url).

    rules and listed have (entry, verdict). A rule fits its host and all subdomains if the url's path starts with the rule's. A listed entry is compared in
    canonical form: it fits its host and all subdomains, if it ends in a slash for all paths below, else for that path. The longest
    rule's verdict stands; without one the longest listed entry's, and without either `allow`. rule and entry are null where none fits. Longest
    is by host and path together, ties by host. A null url or one without :// has an empty host and path and is allowed. Repeated rows are each judged; empty
    pages give no rows; extra columns are ignored, whatever their names.
    """
    both = _entries(rules, True).unionByName(_entries(listed, False))
    lengths = sorted(r[0] for r in both.where("key like 'r %'").select(F.length("path")).distinct().collect())  # lengths of the rules' paths, a few dozen
    n = both.count()
    blocks = max(1, -(-n // PER_BLOCK))
    rows = pages.select("page_id", F.col("url").alias("_url"))
    host, path = split_url(F.col("_url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    plain_host, plain_path = canonical(F.col("host"), F.col("path"))
    rows = rows.withColumns({"c_host": plain_host, "c_path": plain_path})
    heads = F.transform(F.filter(F.array(*[F.lit(k) for k in lengths]) if lengths else F.array().cast("array<int>"), lambda k: k <= F.length("path")), lambda k: F.col("path").substr(F.lit(1), k))
    # heads of the canonical path that end in a slash, and the whole of it
    ends = F.split("c_path", "/")
    folders = F.transform(F.sequence(F.lit(1), F.greatest(F.size(ends) - 1, F.lit(1))), lambda i: F.concat(F.array_join(F.slice(ends, F.lit(1), i), "/"), F.lit("/")))
    whole = F.array_distinct(F.concat(folders, F.array("c_path")))
    keys = F.concat(
        F.flatten(F.transform(_domains(F.col("host")), lambda h: F.transform(heads, lambda p: F.concat(F.lit("r "), h, p)))),
        F.flatten(F.transform(_domains(F.col("c_host")), lambda h: F.transform(whole, lambda p: F.concat(F.lit("l "), h, p)))),
    )
    keys = F.when(F.col("host") != "", keys).otherwise(F.array().cast("array<string>"))
    table = bloom(both.select("key"), blocks)
    table = F.broadcast(table) if 4 * blocks <= WORDS else table
    # the first key carries its url whether it may be listed or not
    keyed = rows.withColumn("row", F.monotonically_increasing_id()).select("*", F.posexplode_outer(keys).alias("nth", "key"))
    block, bits = _bits(F.col("key"), blocks)
    # a url without keys goes to a block of its own number, not to one with all its like
    keyed = keyed.withColumn("at", F.coalesce(block, -1 - F.col("row"))).join(table, F.col("at") == F.col("block"), "left")
    hit = F.lit(True)
    for i, b in enumerate(bits):
        hit &= F.col(f"w{i}").bitwiseAND(b) != 0
    hit = F.coalesce(hit, F.lit(False))
    open_ = keyed.where(hit | (F.coalesce("nth", F.lit(0)) == 0)).withColumn("key", F.when(hit, F.col("key")).otherwise(F.concat(F.lit("? "), F.col("row").cast("string"))))
    joined = open_.select("row", "page_id", "host", "path", "key").join(both.select("key", "e"), "key", "left")
    rank = F.struct(F.length("key").alias("n"), F.length(F.substring_index("key", "/", 1)).alias("h"), F.col("e.entry").alias("entry"), F.col("e.verdict").alias("verdict"))
    best = lambda kind: F.max(F.when(F.col("e").isNotNull() & F.col("key").startswith(kind), rank))
    out = joined.groupBy("row").agg(F.first("page_id").alias("page_id"), F.first("host").alias("host"), F.first("path").alias("path"), best("r ").alias("r"), best("l ").alias("l"))
    return out.select("page_id", "host", "path", F.col("r.entry").alias("rule"), F.coalesce("r.verdict", "l.verdict", F.lit("allow")).alias("verdict"), F.col("l.entry").alias("entry"))
