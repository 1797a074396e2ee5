"""Texts that come as arrays of pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import count_digits, count_letters, count_words, let, newlines, strip, text
from .clean import line_counts


def useful(page: Column) -> Column:
    """Enough characters, words and letters, and not mostly digits or symbols."""
    letters, digits = count_letters(page), count_digits(page)
    symbols = F.regexp_count(page, F.lit(r"[^\p{L}\p{N}\s]"))
    enough = (F.length(strip(page)) >= 30) & (count_words(page) >= 5) & (letters >= 15)
    return enough & ~((digits > letters) & (letters < 50)) & ~((symbols > letters) & (letters < 40))


def useful_pages(pages: Column) -> Column:
    return F.filter(pages, lambda p: useful(text(p)))


def _edge(page: Column, first: bool) -> Column:
    lines = F.filter(F.split(page, "\n"), lambda x: strip(x) != "")
    return strip(F.get(lines, F.lit(0) if first else F.size(lines) - 1))


def without_headers(pages: Column) -> Column:
    """Of more than two pages, first and last lines that stand there on most pages are removed."""

    def common(edges: Column, most: Column) -> Column:
        return F.transform(F.filter(line_counts(edges), lambda c: c["n"] >= most), lambda c: c["line"])

    def cut(page: Column, heads: Column, feet: Column) -> Column:
        first, last = F.array_contains(heads, _edge(page, True)), F.array_contains(feet, _edge(page, False))
        lines = F.filter(F.split(page, "\n"), lambda x: strip(x) != "")
        start = F.when(first, 2).otherwise(1)
        return F.array_join(F.slice(lines, start, F.greatest(F.size(lines) - start + 1 - F.when(last, 1).otherwise(0), F.lit(0))), "\n")

    def edges(p: Column, first: bool) -> Column:
        return F.transform(p, lambda x: _edge(x, first))

    def all_pages(p: Column) -> Column:
        most = F.floor(F.size(p) / 2) + 1
        heads, feet = (common(edges(p, f), most) for f in (True, False))
        return let(F.struct(heads.alias("h"), feet.alias("f")), lambda e: F.transform(p, lambda x: cut(x, e["h"], e["f"])))

    return let(pages, lambda p: F.when(F.size(p) > 2, all_pages(p)).otherwise(p))


def tidy(c: Column) -> Column:
    """One kind of line end, no tabs, runs of blanks or blank lines, page marks or form feeds."""
    t = F.regexp_replace(newlines(text(c)), r"[\t\f]", " ")
    t = F.regexp_replace(t, r"(?im)^[ ]*page\s+\d+(\s+of\s+\d+)?[ ]*$", "")
    return strip(F.regexp_replace(F.regexp_replace(F.regexp_replace(t, " {2,}", " "), r"(?m)^ +| +$", ""), r"\n{3,}", "\n\n"))


def to_text(pages: Column) -> Column:
    """Useful pages without running heads, joined and tidied."""
    return tidy(F.array_join(without_headers(useful_pages(pages)), "\n"))


def split_pages(c: Column, mark: str = "\f") -> Column:
    return F.split(text(c), mark)
