"""The queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, decontaminate, exponion, langid, lm, merkle, mixing, ngramjoin, pagediff, sharding, simhash, toxicity, turns, urlfilter
from .common import fold

SHARDS = 16
#: The rules of the url query, and its list of unwanted sites.
RULES = [["net/", "block"], ["example.net/en/", "allow"], ["example.com/de/", "block"], ["org/fr/", "allow"]]
LISTED = [[f"{name}.example.{top}/", "block"] for name in ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm") for top in ("com", "net", "org")]
#: The list's single pages, by rule: of these hosts and languages every tenth number.
PAGE_HOSTS, PAGE_LANGS, PAGE_NUMBERS = ["blog.tionsh.example.com", "tionble.example.org", "tiontion.example.net"], ["de", "en", "es", "fr"], 4_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edited_pairs(read(spark, sf_dir, "documents"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def listed(spark: SparkSession) -> DataFrame:
    """The list of the url query: sites, and pages by rule."""
    hosts, langs = (F.from_json(F.lit(json.dumps(x)), "array<string>") for x in (PAGE_HOSTS, PAGE_LANGS))
    pages = spark.range(PAGE_NUMBERS).select("id", F.explode(hosts).alias("h")).select("id", "h", F.explode(langs).alias("l"))
    pages = pages.select(F.concat_ws("/", "h", "l", (F.col("id") * 10).cast("string")).alias("entry"), F.lit("block").alias("verdict"))
    return common.small_table(spark, LISTED, "entry string, verdict string").unionByName(pages)


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = common.small_table(spark, RULES, "entry string, verdict string")
    return urlfilter.judge(read(spark, sf_dir, "pages"), rules, listed(spark)).drop("entry")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = fold(F.col("doc_id"), 3)
    docs = read(spark, sf_dir, "documents").withColumn("held_out", part == 1)
    return langid.identify(docs, ~F.col("held_out"), ["doc_id", "held_out"])


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_by_source(read(spark, sf_dir, "documents"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagediff.extract(read(spark, sf_dir, "pages"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = fold(F.col("doc_id"), 4)
    found = toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), part != 2)
    return found.select("doc_id", (part == 2).alias("held_out"), "score", "predicted")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_fold(read(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.assign(read(spark, sf_dir, "documents"), SHARDS)
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exponion.cluster(read(spark, sf_dir, "embeddings"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations")
    return turns.reports(turns.damaged(rows), rows)


def op13_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.join(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_document_fingerprints, op2_simhash_near_dedup, op3_url_filters, op4_language_id, op5_mixing,
        op6_html_extraction, op7_toxicity, op8_decontamination, op9_lm_scoring, op10_sharding,
        op11_centroid_clustering, op12_conversation_repair, op13_ngram_jaccard_join,
    )
}

_RULES, _LISTED = (", ".join(f"('{e}', '{v}')" for e, v in rows) for rows in (RULES, LISTED))


def _lloyd(k: int = 40, rounds: int = 5, dims: int = 64) -> str:
    """The rounds of op 11, one set of tables a round."""
    parts = [f"""
        WITH e AS MATERIALIZED (
            SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
        c0 AS MATERIALIZED (
            SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INTEGER) AS c, v
            FROM (SELECT sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM e ORDER BY h, v LIMIT {k}))"""]
    for r in range(rounds + 1):
        parts.append(f"""
        d{r} AS (
            SELECT n, vec_id, e.v, c, list_sum(list_transform(list_zip(e.v, m.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
            FROM e CROSS JOIN c{r} AS m),
        a{r} AS MATERIALIZED (
            SELECT n, vec_id, v, c, d FROM d{r} QUALIFY row_number() OVER (PARTITION BY n ORDER BY d, c) = 1)""")
        if r < rounds:
            parts.append(f"""
        s{r} AS (SELECT c, i, sum(v[i]) AS s, count(*) AS k FROM a{r}, range(1, {dims + 1}) AS t(i) GROUP BY c, i),
        c{r + 1} AS MATERIALIZED (
            SELECT c{r}.c, coalesce(m.v, c{r}.v) AS v
            FROM c{r} LEFT JOIN (SELECT c, list(CAST((s - ((s % k) + k) % k) // k AS BIGINT) ORDER BY i) AS v FROM s{r} GROUP BY c) AS m USING (c))""")
    return ",".join(parts) + f"""
        SELECT vec_id, c AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(m.v, ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} AS m USING (c)"""


ORACLE_SQL = {
    "op3_url_filters": rf"""
        WITH p AS (
            SELECT row_number() OVER () AS n, page_id,
                   CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
            FROM pages),
        u AS (
            SELECT n, page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM p),
        c AS (
            SELECT n, regexp_replace(regexp_replace(host, '(?s)\A.*@', ''), '\.?(:[0-9]*)?\z', '') AS host,
                   CASE WHEN path = '' THEN '/' ELSE regexp_replace(regexp_replace(path, '/(\./)+', '/', 'g'), '/{{2,}}', '/', 'g') END AS path
            FROM u WHERE host <> ''),
        rules AS (
            SELECT entry, verdict, split_part(entry, '/', 1) AS h, substr(entry, instr(entry, '/')) AS q FROM (VALUES {_RULES}) AS t(entry, verdict)),
        listed AS (
            SELECT entry, verdict, split_part(entry, '/', 1) AS h, substr(entry, instr(entry, '/')) AS q
            FROM (SELECT * FROM (VALUES {_LISTED}) AS t(entry, verdict) UNION ALL
                  SELECT h || '/' || l || '/' || k * 10, 'block'
                  FROM (SELECT unnest({PAGE_HOSTS}) AS h), (SELECT unnest({PAGE_LANGS}) AS l), range({PAGE_NUMBERS}) AS r(k))),
        m AS (
            SELECT n, arg_max(entry, length(entry)) AS rule, arg_max(verdict, length(entry)) AS verdict
            FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q)
            GROUP BY n),
        b AS (
            SELECT n, arg_max(verdict, length(entry)) AS verdict
            FROM c JOIN listed ON (host = h OR ends_with(host, '.' || h)) AND (path = q OR ends_with(q, '/') AND starts_with(path, q))
            GROUP BY n)
        SELECT page_id, host, path, rule, coalesce(m.verdict, b.verdict, 'allow') AS verdict FROM u LEFT JOIN m USING (n) LEFT JOIN b USING (n)""",
    "op11_centroid_clustering": _lloyd(),
    "op12_conversation_repair": r"""
        WITH RECURSIVE t AS (
            SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, b: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crc),
        src AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   xor(4294967295, list_reduce([4294967295] || list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT)),
                                               lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]))) % 20 AS kind
            FROM conversations, t),
        dam AS MATERIALIZED (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text
            FROM src, range(2) AS c(i) WHERE kind <> 0 AND (i = 0 OR kind = 3)),
        num AS MATERIALIZED (
            SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS k FROM dam),
        rws AS MATERIALIZED (
            SELECT conv_id, turn, role, text, k, substr(role, 1, 1) AS initial, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY k) AS before,
                   CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank'
                        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'duplicate'
                        WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 'truncated' ELSE '' END AS fault
            FROM num),
        step AS (SELECT * FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) AS v(st, initial, nx)),
        ins AS (SELECT * FROM (VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 5, 'I'), (0, 3, 10, 'II'), (1, 2, 5, 'I'), (1, 3, 10, 'II'), (2, 3, 5, 'I'), (3, 2, 5, 'I')) AS v(st, nx, cost, letters)),
        edge AS MATERIALIZED (
            SELECT conv_id, k, st, st AS nx, 2 AS cost, 'D' AS letter FROM rws, range(4) AS r(st)
            UNION ALL
            SELECT conv_id, k, st, nx, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END, 'K' FROM rws JOIN step USING (initial) WHERE fault NOT IN ('blank', 'duplicate')
            UNION ALL
            SELECT conv_id, k, st, nx, CASE WHEN fault = 'truncated' THEN 6 ELSE 1 END, 'R' FROM rws, step WHERE step.initial <> 's' AND fault NOT IN ('blank', 'duplicate')),
        ways AS (
            SELECT conv_id, CAST(0 AS BIGINT) AS k, nx AS st, {'c': CAST(cost AS BIGINT), 'a': letters, 'p': CASE letters WHEN '' THEN '' WHEN 'I' THEN '2' ELSE '23' END} AS way
            FROM (SELECT DISTINCT conv_id FROM dam), ins WHERE ins.st = 0
            UNION ALL
            SELECT w.conv_id, e.k, i.nx, min({'c': CAST(w.way.c + e.cost + i.cost AS BIGINT), 'a': w.way.a || e.letter || i.letters,
                                              'p': w.way.p || CAST(e.nx AS VARCHAR) || CASE WHEN i.letters = '' THEN '' WHEN i.letters = 'I' THEN CAST(i.nx AS VARCHAR) ELSE '23' END})
            FROM ways AS w JOIN edge AS e ON e.conv_id IS NOT DISTINCT FROM w.conv_id AND e.k = w.k + 1 AND e.st = w.st JOIN ins AS i ON i.st = e.nx
            GROUP BY w.conv_id, e.k, i.nx),
        best AS (
            SELECT w.conv_id, min(way) AS way
            FROM ways AS w JOIN (SELECT conv_id, count(*) AS n FROM rws GROUP BY conv_id) AS c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.k
            WHERE st IN (0, 3) GROUP BY w.conv_id),
        letters AS (
            SELECT conv_id, i, way.a[i] AS letter, way.p[i] AS st, length(replace(way.a[1:i], 'I', '')) AS k
            FROM (SELECT conv_id, way, unnest(range(1, length(way.a) + 1)) AS i FROM best)),
        rep AS (
            SELECT l.conv_id, string_agg(CASE WHEN letter = 'K' THEN r.role WHEN st = '2' THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE r.text END, chr(10) ORDER BY i) AS whole
            FROM letters AS l LEFT JOIN rws AS r ON r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.k = l.k WHERE letter <> 'D' GROUP BY l.conv_id),
        counts AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
            FROM rws GROUP BY conv_id)
        SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
               coalesce(way.c, 0) AS cost, coalesce(way.a, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) AS o LEFT JOIN counts AS c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
             LEFT JOIN best AS b ON b.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN rep AS r ON r.conv_id IS NOT DISTINCT FROM o.conv_id""",
}
