"""The surface of language-model calls: budgets of text, reading answers, ordered fallback. Calls themselves are columns that a provider filled."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import strip, text

MOST_TOKENS = 8000


def estimate(c: Column) -> Column:
    return F.expr("null") if c is None else F.floor(F.length(text(c)) / 4).cast("int")


def guarded(c: Column, most: int = MOST_TOKENS) -> Column:
    """At most so many tokens of four characters."""
    return F.substring(text(c), 1, most * 4)


def prompt(c: Column, template: str = "Extract the opportunities from the text below as JSON.\n\n%s") -> Column:
    return F.format_string(template, text(c))


def unfenced(c: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(text(c), r"(?im)^```[a-z]*\s*$", ""), "```", ""))


def strict_json(c: Column) -> Column:
    """struct(parsed, raw, ok): from the first brace to the last as a variant, if it is JSON."""
    body = F.regexp_extract(unfenced(c), r"(?s)(\{.*\})", 1)
    parsed = F.try_parse_json(F.when(body != "", body))
    return F.struct(parsed.alias("parsed"), F.when(parsed.isNull(), c).alias("raw"), parsed.isNotNull().alias("ok"))


def valid_response(c: Column) -> Column:
    """An object whose `opportunities` is a list."""
    return F.coalesce(F.schema_of_variant(F.try_variant_get(F.try_parse_json(c), "$.opportunities", "variant")).rlike("^ARRAY"), F.lit(False))


def fallback(*answers: Column) -> Column:
    """The first answer that is not blank."""
    return F.coalesce(*[F.when(strip(text(a)) != "", a) for a in answers])


def canned(task: Column) -> Column:
    return F.to_json(F.struct(F.lit("degraded").alias("status"), F.coalesce(task, F.lit("default")).alias("task"), F.lit("No provider answered").alias("message")))


def built_query(c: Column, words: tuple[str, ...], prefix: str) -> Column:
    """The query, after a prefix unless it holds a domain word."""
    q = F.lower(text(c))
    hit = F.lit(False)
    for w in words:
        hit = hit | F.contains(q, F.lit(w))
    return F.when(hit, text(c)).otherwise(F.concat(F.lit(prefix + " "), text(c)))
