"""Lexicons compiled to Catalyst expressions: no UDF, and a cheap substring test ahead of every boundary test."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import let, no_hyphen

_WORD = r"[\p{L}\p{N}_]"
#: Words of a table's terms at most; each number of words is one more pass over a text's tokens.
LONGEST = 12
#: Terms of a table that may have other edges than word characters.
ODD = 200


def has_word(lowered: Column, term: str) -> Column:
    """The term stands in the (lower-cased) text between word boundaries."""
    t = term.lower()
    return F.contains(lowered, F.lit(t)) & lowered.rlike(f"(?<!{_WORD}){re.escape(t)}(?!{_WORD})".replace("\\-", "-").replace("\\ ", " ").replace("\\/", "/").replace("\\'", "'"))


@dataclass(frozen=True)
class Lexicon:
    """Ordered terms with weights. mode: `word` between boundaries, `word_nohyphen` with hyphens as blanks on both sides, `substr` anywhere."""

    terms: tuple[tuple[str, float], ...]
    mode: str = "word"

    @classmethod
    def of(cls, terms: Sequence[str] | Mapping[str, float], mode: str = "word") -> Lexicon:
        return cls(tuple(terms.items()) if isinstance(terms, Mapping) else tuple((t, 1.0) for t in terms), mode)

    def without(self, *names: str) -> Lexicon:
        return Lexicon(tuple(x for x in self.terms if x[0] not in names), self.mode)

    def prepared(self, c: Column) -> Column:
        """The text that hit() reads; make it once where several terms are tested."""
        return no_hyphen(c) if self.mode == "word_nohyphen" else F.lower(c)

    def hit(self, prepared: Column, term: str) -> Column:
        if self.mode == "substr":
            return F.contains(prepared, F.lit(term.lower()))
        return has_word(prepared, " ".join(term.lower().replace("-", " ").split()) if self.mode == "word_nohyphen" else term)

    def any_(self, prepared: Column) -> Column:
        out = F.lit(False)
        for t, _ in self.terms:
            out = out | self.hit(prepared, t)
        return out

    def count(self, prepared: Column) -> Column:
        out = F.lit(0)
        for t, _ in self.terms:
            out = out + self.hit(prepared, t).cast("int")
        return out

    def sum_(self, prepared: Column) -> Column:
        """Sum of the weights, added in order."""
        out = F.lit(0.0)
        for t, w in self.terms:
            out = out + F.when(self.hit(prepared, t), F.lit(float(w))).otherwise(F.lit(0.0))
        return out

    def first(self, prepared: Column) -> Column:
        """The first term that hits, or null."""
        return F.coalesce(*[F.when(self.hit(prepared, t), F.lit(t)) for t, _ in self.terms])

    def first_weight(self, prepared: Column) -> Column:
        return F.coalesce(*[F.when(self.hit(prepared, t), F.lit(float(w))) for t, w in self.terms])

    def list_(self, prepared: Column) -> Column:
        """Terms that hit, in order."""
        return F.array_compact(F.array(*[F.when(self.hit(prepared, t), F.lit(t)) for t, _ in self.terms]))

    def weigh(self, found: Column) -> Column:
        """Sum of the weights of list_()'s terms, added in order: each term is searched once where both are wanted."""
        weights = F.create_map(*[F.lit(x) for t, w in self.terms for x in (t, float(w))])
        return F.aggregate(found, F.lit(0.0), lambda a, x: a + F.element_at(weights, x))

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        """The lexicon as rows (lexicon, ord, term, weight, mode)."""
        return spark.createDataFrame([(name, i, t, float(w), self.mode) for i, (t, w) in enumerate(self.terms)], "lexicon string, ord int, term string, weight double, mode string")


def grams(lowered: Column, sizes: Sequence[int]) -> Column:
    """The distinct stretches of a text from a word's beginning to a word's end, as they stand, with so many words: what terms between word boundaries can be."""

    def stretches(parts: Column, n: int) -> Column:
        last = F.size(parts) - 2 * (n - 1)
        starts = F.filter(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: (i <= last) & F.get(parts, i - 1).rlike(f"^{_WORD}"))
        return F.transform(starts, lambda i: F.array_join(F.slice(parts, i, F.lit(2 * n - 1)), ""))

    parts = F.regexp_extract_all(lowered, F.lit(f"{_WORD}+|[^\\p{{L}}\\p{{N}}_]+"), F.lit(0))
    return let(parts, lambda p: F.array_distinct(F.concat(*[stretches(p, n) for n in sizes])))


def hits(texts: DataFrame, key: str, lowered: Column, terms: DataFrame) -> DataFrame:
    """(key, and the columns of terms) for every row of terms whose term stands in the (lower-cased) text between word boundaries.

    One pass over the tokens of a text and one join, for any number of terms: terms is a table (term, ...) in lower case. A text gives each of its
    stretches once, however often it stands there. Terms that are no such stretch (odd edges, more than LONGEST words) are looked for one by one; there may be ODD of them.
    """
    words = F.size(F.regexp_extract_all("term", F.lit(f"{_WORD}+"), F.lit(0)))
    whole = F.col("term").rlike(f"^{_WORD}(?s:.*{_WORD})?$") & (words <= LONGEST)
    sizes = [r.n for r in terms.where(whole).select(words.alias("n")).distinct().collect()]  # at most LONGEST numbers
    odd = [r.term for r in terms.where(~whole).select("term").distinct().limit(ODD + 1).collect()]
    if len(odd) > ODD:
        raise ValueError(f"at most {ODD} terms may begin or end with something other than a word character, or have more than {LONGEST} words")
    found = [grams(lowered, sorted(sizes))] if sizes else []
    found += [F.array_compact(F.array(*[F.when(has_word(lowered, t), F.lit(t)) for t in odd]))] if odd else []
    if not found:
        return texts.select(key).limit(0).join(terms, F.lit(True)).select(key, *terms.columns)
    return texts.select(key, F.explode(F.concat(*found)).alias("term")).join(terms, "term").select(key, *terms.columns)
