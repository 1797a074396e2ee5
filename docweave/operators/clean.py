"""Line-oriented text cleaning, native but for compatibility normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicons as lx
from ..functions.num import flags
from ..functions.text import clean_lines, count_digits, count_letters, count_words, join_lines, let, matches_any, mojibake, newlines, nfkc, no_punctuation, strip, text

DATE_LIKE = r"\d{1,2}[/.-]\d{1,2}[/.-]\d{2,4}|\d{4}-\d{1,2}-\d{1,2}"
CURRENCY = r"(?i)₹|\brs\.?\b|\binr\b|\$|€|£"


def is_error_page(c: Column) -> Column:
    """At least two of the error signs in the first 5000 characters."""
    head = F.substring(text(c), 1, 5000)
    return flags(*[head.rlike(f"(?iU){p}") for p in lx.ERROR_PATTERNS]) >= 2


def not_navigation(lines: Column) -> Column:
    return F.filter(lines, lambda x: ~F.lower(x).isin(lx.NAVIGATION_LINES))


def not_matching(lines: Column, patterns: list[str]) -> Column:
    return F.filter(lines, lambda x: ~matches_any(x, patterns))


def not_whole(lines: Column, patterns: list[str]) -> Column:
    """Without lines that a pattern matches whole."""
    return F.filter(lines, lambda x: ~x.rlike("(?iU)^(?:" + "|".join(patterns) + ")$"))


def line_counts(lines: Column) -> Column:
    """Array of (line, n) for each distinct line, by one sort instead of comparing all pairs."""

    def count(ordered: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1), lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)))
        return let(F.concat(starts, F.array(F.size(ordered))), lambda at: F.transform(F.sequence(F.lit(0), F.size(at) - 2), lambda k: F.struct(F.get(ordered, F.get(at, k)).alias("line"), (F.get(at, k + 1) - F.get(at, k)).alias("n"))))

    none = F.array().cast("array<struct<line:string,n:int>>")
    return let(F.array_sort(lines), lambda x: F.when(F.size(x) > 0, count(x)).otherwise(none))


def repeated(lines: Column, least: int = 3, longest: int = 120) -> Column:
    """Short lines that occur at least so often and aren't protected (headings, tables, money, dates)."""
    often = F.filter(line_counts(lines), lambda c: (c["n"] >= least) & (F.length(c["line"]) <= longest))
    return F.filter(F.transform(often, lambda c: c["line"]), lambda x: ~F.lower(x).isin(lx.PROTECTED_HEADINGS) & ~F.contains(x, F.lit("|")) & ~x.rlike(CURRENCY) & ~x.rlike(DATE_LIKE))


def not_repeated(lines: Column) -> Column:
    return let(lines, lambda x: let(repeated(x), lambda gone: F.filter(x, lambda y: ~F.array_contains(gone, y))))


def not_noisy(x: Column) -> Column:
    """Whether a line is more than a run of symbols or a word of up to three letters; protected headings, table rows and numbered lines are."""
    safe = F.lower(x).isin(lx.PROTECTED_HEADINGS) | F.contains(x, F.lit("|")) | x.rlike(r"^\d+(\.\d+)*")
    noise = x.rlike(r"^\p{L}{1,3}$") | x.rlike(r"^[-_=*.]{3,}$") | x.rlike(r"^[^\p{L}\p{N}]+$")
    return safe | ~noise


def not_noise(lines: Column) -> Column:
    return F.filter(lines, not_noisy)


def clean_native(c: Column) -> Column:
    """clean() without compatibility normalisation: for text that is normalised already."""
    said = [*lx.BOILERPLATE_PATTERNS, *lx.COOKIE_PATTERNS, *lx.SCRIPT_PATTERNS]
    whole = lambda patterns: "(?iU)^(?:" + "|".join(patterns) + ")$"
    lines = F.filter(clean_lines(c), lambda x: ~F.lower(x).isin(lx.NAVIGATION_LINES) & ~matches_any(x, said) & ~x.rlike(whole(lx.PAGE_NUMBERS)))
    lines = F.filter(not_repeated(lines), lambda x: ~x.rlike(whole(lx.CONTENTS_LINES)) & not_noisy(x))
    return F.when(is_error_page(c), F.lit("")).otherwise(strip(join_lines(lines)))


def clean(df: DataFrame, column: str = "text", out: str | None = None) -> DataFrame:
    """The whole cleaner, into out (by default the column itself). Mis-decoded sequences are repaired before compatibility normalisation, which would hide some of them."""
    normal = df.withColumn("_normal", nfkc(mojibake(newlines(text(column)))))
    return normal.withColumn(out or column, clean_native(F.col("_normal"))).drop("_normal")


def without_pairs(lines: Column) -> Column:
    """A B A B becomes A B, from left to right in one pass."""
    start = F.struct(F.array().cast("array<int>").alias("out"), F.lit(0).alias("skip"))

    def fold(x: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            pair = (F.get(x, i) == F.get(x, i + 2)) & (F.get(x, i + 1) == F.get(x, i + 3)) & (F.get(x, i) != F.get(x, i + 1))
            # a pair keeps its first two lines and passes over the second two
            skip = F.when(acc["skip"] > 0, acc["skip"] - 1).when(F.coalesce(pair, F.lit(False)), 3).otherwise(0)
            kept = (acc["skip"] == 0) | (acc["skip"] == 3)
            return F.struct(F.when(kept, F.array_append(acc["out"], i)).otherwise(acc["out"]).alias("out"), skip.alias("skip"))

        at = F.aggregate(F.sequence(F.lit(0), F.size(x) - 1), start, step)["out"]
        return F.transform(at, lambda i: F.get(x, i))

    return let(lines, lambda x: F.when(F.size(x) > 3, fold(x)).otherwise(x))


def without_blocks(lines: Column, fewest: int = 20, longest: int = 80, most: int = 3) -> Column:
    """In texts of at least so many lines, short lines whose form without punctuation occurs more than so often all go."""

    def drop(x: Column, forms: Column) -> Column:
        often = F.transform(F.filter(line_counts(forms), lambda c: c["n"] > most), lambda c: c["line"])
        pairs = F.zip_with(x, forms, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        return let(often, lambda o: F.transform(F.filter(pairs, lambda p: (F.length(p["a"]) >= longest) | ~F.array_contains(o, p["b"])), lambda p: p["a"]))

    return let(lines, lambda x: F.when(F.size(x) >= fewest, let(F.transform(x, no_punctuation), lambda f: drop(x, f))).otherwise(x))


def statistics(c: Column) -> Column:
    """struct(characters, words, lines, letters, digits)."""
    t = text(c)
    n = F.when(t == "", 0).otherwise(F.regexp_count(t, F.lit("\n")) + F.when(F.endswith(t, F.lit("\n")), 0).otherwise(1))
    return F.struct(F.length(t).alias("characters"), count_words(t).alias("words"), n.alias("lines"), count_letters(t).alias("letters"), count_digits(t).alias("digits"))
