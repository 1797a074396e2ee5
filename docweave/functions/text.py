r"""Text expressions. A word character is [\p{L}\p{N}_], white space is the Unicode property."""

from __future__ import annotations

import difflib
import unicodedata
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

#: Mis-decoded sequences and what they stand for, in order.
MOJIBAKE = (("â€™", "'"), ("â€˜", "'"), ("â€œ", '"'), ("â€\x9d", '"'), ("â€“", "-"), ("â€”", "-"), ("â€¦", "..."), ("â‚¹", "₹"), ("Â ", " "), (" ", " "))


def text(c: Column | str) -> Column:
    """Null counts as empty."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def let(c: Column, body: Callable[[Column], Column]) -> Column:
    """body with c bound to a variable: inside a lambda, a plain expression would be worked out again for every element."""
    return F.get(F.transform(F.array(c), body), F.lit(0))


def once(df: DataFrame, values: Column, name: str) -> DataFrame:
    """df with a row for each of the values (one, as a rule) in a further column. A generated column is worked out once, however often it is read; the optimiser would copy a plain one
    into each place that reads it. Conditions on the other columns still go below it."""
    return df.select("*", F.explode(values).alias(name))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    """White space runs as one blank, none at the ends."""
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def canonical(c: Column) -> Column:
    """Lower case, anything but word characters as one blank."""
    return squeeze(F.regexp_replace(F.lower(c), r"(?U)[^\p{L}\p{N}_\s]", " "))


def no_hyphen(c: Column) -> Column:
    return squeeze(F.replace(F.lower(c), F.lit("-"), F.lit(" ")))


def no_punctuation(c: Column) -> Column:
    """Lower case, punctuation deleted, blanks collapsed."""
    return squeeze(F.regexp_replace(F.lower(c), r"(?U)[^\p{L}\p{N}_\s]", ""))


def newlines(c: Column) -> Column:
    return F.regexp_replace(c, r"\r\n?", "\n")


def lines(c: Column) -> Column:
    """Lines by line feed."""
    return F.split(c, "\n")


def all_lines(c: Column) -> Column:
    """Lines by every line boundary of Unicode text."""
    return F.split(c, "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]")


def clean_lines(c: Column) -> Column:
    """Collapsed lines without the empty ones."""
    return F.filter(F.transform(lines(newlines(c)), lambda x: strip(F.regexp_replace(x, r"[ \t]+", " "))), lambda x: x != "")


def join_lines(c: Column) -> Column:
    return F.array_join(c, "\n")


def count_words(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"(?U)\S+"))


def count_letters(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"\p{L}"))


def count_digits(c: Column) -> Column:
    """Decimal digits, superscript and circled ones included."""
    return F.regexp_count(c, F.lit("[\\p{Nd}²³¹⁰⁴-⁹₀-₉①-⑨]"))


def symbol_share(c: Column) -> Column:
    n = F.length(c)
    return F.when(n > 0, F.length(F.regexp_replace(c, r"[^\p{P}\p{S}]", "")) / n).otherwise(0.0)


def contains_any(c: Column, phrases: Sequence[str]) -> Column:
    out = F.lit(False)
    for p in phrases:
        out = out | F.contains(c, F.lit(p))
    return out


def contained(c: Column, phrases: Sequence[str]) -> Column:
    """How many of the phrases occur."""
    out = F.lit(0)
    for p in phrases:
        out = out + F.contains(c, F.lit(p)).cast("int")
    return out


def matches_any(c: Column, patterns: Sequence[str], flags: str = "(?iU)") -> Column:
    return c.rlike(flags + "|".join(f"(?:{p})" for p in patterns))


def mojibake(c: Column) -> Column:
    """Repairs mis-decoded sequences; to be done before compatibility normalisation, which would hide some of them."""
    for bad, good in MOJIBAKE:
        c = F.replace(c, F.lit(bad), F.lit(good))
    return c


@pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFKC", x))


@pandas_udf(T.StringType())
def repaired(s: pd.Series) -> pd.Series:
    """UTF-8 read as Latin-1 is read again, then NFKC; null is empty."""

    def one(x: str | None) -> str:
        if not x:
            return ""
        if not x.isascii():
            try:
                x = x.encode("latin-1").decode("utf-8")
            except (UnicodeEncodeError, UnicodeDecodeError):
                pass
        return unicodedata.normalize("NFKC", x)

    return s.map(one)


@pandas_udf(T.DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio; the order of arguments matters."""
    return pd.Series([difflib.SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b)])


def token_overlap(candidate: Column, other: Column) -> Column:
    """Share of the candidate's distinct tokens that the other has; null under two tokens."""
    a, b = (F.array_distinct(F.filter(F.split(canonical(c), " "), lambda x: x != "")) for c in (candidate, other))
    return F.when(F.size(a) >= 2, F.size(F.array_intersect(a, b)) / F.size(a))
