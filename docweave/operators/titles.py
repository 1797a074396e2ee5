"""A document's title: windows of one to four ordered lines, cleaned, scored and extended, all as expressions on one array of lines.

Boundaries are spelled out (no look-behind outside of Terms), so every rule reads the same in SQL.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import lexicons as lx
from ..functions.text import all_lines, let, nfkc, squeeze, text

WORD, OTHER = r"[\p{L}\p{N}_]", r"[^\p{L}\p{N}_]"


@dataclass(frozen=True)
class Terms:
    """Terms between word boundaries in lower-cased text; `more` are patterns of word characters only."""

    words: tuple[str, ...]
    more: tuple[str, ...] = ()

    @property
    def pattern(self) -> str:
        return "|".join([*self.more, *(re.sub(r"([.+*?()\[\]{}|^$\\])", r"\\\1", w) for w in sorted(self.words, key=len, reverse=True))])

    def near(self, low: Column) -> Column:
        """Whether any term can occur: a substring test of those that are part of no other, ahead of the patterns."""
        least = [w for w in self.words if not any(v != w and v in w for v in self.words)]
        return reduce(or_, [*(F.contains(low, F.lit(w)) for w in least), *(low.rlike(m) for m in self.more)])

    def count(self, low: Column) -> Column:
        return F.when(self.near(low), F.regexp_count(low, F.lit(f"(?<!{WORD})(?:{self.pattern})(?!{WORD})"))).otherwise(0)

    def distinct(self, low: Column) -> Column:
        found = F.regexp_extract_all(low, F.lit(f"(?<!{WORD})(?:{self.pattern})(?!{WORD})"), F.lit(0))
        return F.when(self.near(low), F.size(F.array_distinct(found))).otherwise(0)


# Lines of an opening that are read, lines of a window, and the terms and patterns of the rules.
OPENING, WINDOW, NOTICE_LINES = 80, 4, 3
TITLE = Terms(tuple(lx.TITLE_WORDS))
GOVERN = Terms(tuple(lx.GOVERNMENT))
ENGINEER = Terms(("structural", "engineering", "construction", "design", "building", "retrofitting", "rehabilitation", "architectural", "consultancy"))
USEFUL = Terms(("work", "works", "services", "project", "supply", "selection", "appointment", "empanelment", "development", "renovation"))
PROSE = Terms(("shall", "should", "hereby", "whereas", "is required", "are required", "will be", "has been", "have been", "may be", "in accordance", "subject to", "as per", "the bidder", "the tenderer", "applicant must"))
ADDRESS = Terms(("road", "street", "floor", "plot", "block", "sector", "near", "opp", "pin", "nagar", "marg", "house no", "district", "dist"), (r"\d{6}",))
CONTACT = Terms(("inr", "phone", "tel", "fax", "mobile", "email", "e-mail", "telephone"))
START = "^(?:request for|expression of interest|notice inviting|invitation for|tender for|selection of|appointment of|empanelment of|consultancy|construction of|supply of|providing|design)"
POOR_START = rf"^(?:the|a|an|this|that|these|and|or|of|in|to|for|by|with|if|note)(?:{OTHER}|$)"
GENERIC = "^(?:" + "|".join(lx.GENERIC_HEADINGS) + ")$"
LABEL = r"^(?:tender (?:no|id|ref|fee)|bid (?:no|id)|ref(?:erence)?(?: no)?|date|e-?mail|phone|tel|fax|website|emd|estimated cost|document fee|last date|closing date|due date)(?:[^\p{L}\p{N}_:-][^:]{0,29})?[:-]"
OWNER = r"^(?:name of (?:the )?)?(?:" + "|".join(sorted(lx.ORGANIZATION_LABELS, key=len, reverse=True)) + r")(?: name)?\s*[:-]"
MONEY = rf"₹|@|https?://|www\.|(?:^|{OTHER})rs\.?\s*[0-9]"
DATE = r"[0-9]{1,2}[/-][0-9]{1,2}[/-][0-9]{2,4}"
NUMBER = r"^[0-9]+(?:\.[0-9]+)*[.)]?\s"
LEAD = r"^(?:(?:[0-9]+(?:\.[0-9]+)*[.)]?|[-•*·]|\(?[a-z]\))\s+|(?:title|subject|sub|name of work|tender for the work of|description)\s*[:-]\s*)+"
TAIL = rf"\s+(?:tender (?:no|id)|bid (?:no|id)|ref(?:erence)? no|e-?mail|phone|last date|closing date|due date|emd|estimated cost)(?:{OTHER}.*)?$"
LEADERS = r"[.\s_-]{3,}[0-9]*$"
EDGES = r"""^[ :;,"'-]+|[ :;,"'-]+$"""
NOTICE = r"^(?:notice inviting (?:tender|offers|proposals?)|tender notice|invitation (?:for|to) tender)$"
WORK = r"^(?:[0-9]+[.)]?\s*)?name\s+of\s+(?:the\s+)?work\s*[:-]\s*(.*)$"
CONTENTS = r"^(?:table of contents|contents|index)$|\.{3,}\s*[0-9]+$|^[0-9]+$"


def lines(c: Column) -> Column:
    """The lines of a text, compatibility forms and dashes made plain, blanks collapsed, without empty ones and those of a table of contents."""
    plain = F.translate(nfkc(text(c)), "–—", "--")
    return F.filter(F.transform(all_lines(plain), squeeze), lambda x: (x != "") & ~F.lower(x).rlike(CONTENTS))


def words(t: Column) -> Column:
    return F.split(t, " ")


def without_repeat(t: Column) -> Column:
    """Without the second copy of the longest phrase of 8 to 2 words that stands twice in a row (of equally long ones the first); shorter titles than 8 words stay."""

    def twice(w: Column, low: Column) -> Column:
        def at(n: Column) -> Column:
            spots = F.sequence(F.lit(1), F.greatest(F.size(w) - 2 * n + 1, F.lit(1)))
            return F.transform(F.filter(spots, lambda i: (i <= F.size(w) - 2 * n + 1) & (F.slice(low, i, n) == F.slice(low, i + n, n))), lambda i: F.struct(n.alias("n"), i.alias("i")))

        return F.get(F.flatten(F.transform(F.sequence(F.lit(8), F.lit(2), F.lit(-1)), at)), F.lit(0))

    def cut(w: Column) -> Column:
        low = F.transform(w, F.lower)
        kept = let(let(low, lambda x: twice(w, x)), lambda s: F.concat(F.slice(w, F.lit(1), s["i"] + s["n"] - 1), F.slice(w, s["i"] + 2 * s["n"], F.size(w))))
        return F.coalesce(F.array_join(kept, " "), F.array_join(w, " "))

    # the pattern only spares the search where nothing stands twice
    return F.when(F.lower(t).rlike(r"(?:^| )(\S++(?: \S++){1,7}) \1(?: |$)") & (F.size(words(t)) >= 8), let(words(t), cut)).otherwise(t)


def clean(x: Column) -> Column:
    """A line or window as a title: without numbering, document prefixes, metadata that follows, leaders, and a repeated phrase; empty outside of 8 to 250 characters."""
    t = F.regexp_replace(F.regexp_replace(x, f"(?i){LEAD}", ""), f"(?i){TAIL}", "")
    t = F.regexp_replace(F.regexp_replace(t, LEADERS, ""), EDGES, "")
    return let(t, lambda y: F.when(F.length(y).between(8, 250), without_repeat(y)).otherwise(""))


def labelled(low: Column) -> Column:
    return low.rlike(LABEL) | low.rlike(OWNER)


def administrative(x: Column) -> Column:
    """A labelled line, or an authority's name without a word of a title."""
    return let(F.lower(x), lambda low: labelled(low) | (GOVERN.count(low) > 0) & (TITLE.count(low) == 0))


def contact(low: Column) -> Column:
    return low.rlike(MONEY) | (CONTACT.count(low) > 0)


def stops(x: Column) -> Column:
    """A line that no title goes on with."""

    def rule(low: Column) -> Column:
        long = F.size(words(low))
        prose = (PROSE.count(low) > 0) | F.endswith(low, F.lit(".")) & (long >= 12)
        return low.rlike(NUMBER) | low.rlike(GENERIC) | low.rlike(DATE) | contact(low) | (long > 18) | prose

    return (clean(x) == "") | administrative(x) | let(F.lower(x), rule)


def title_score(t: Column, i: Column) -> Column:
    """What speaks for a cleaned window that begins with line i (from 0); -100 for one that is no title."""

    def rule(low: Column) -> Column:
        n, size = F.size(words(low)), F.length(low)
        flag = lambda c, w: F.when(c, w).otherwise(0)
        govern = GOVERN.count(low)
        s = F.greatest(F.lit(0), 25 - i) + F.when(n.between(5, 18), 35).when(n.between(19, 25), 20).when(n == 4, 10).otherwise(-20)
        s += flag(size >= 35, 10) - flag(size > 180, 30) + flag(low.rlike(START), 25) - flag(low.rlike(POOR_START), 30)
        s += 8 * TITLE.distinct(low) + F.least(F.lit(35), 7 * ENGINEER.count(low)) + F.least(F.lit(30), 5 * USEFUL.count(low))
        s -= 35 * PROSE.count(low) + F.least(F.lit(50), 15 * ADDRESS.count(low)) + F.least(F.lit(45), 15 * govern) + flag((govern > 0) & (t == F.upper(t)) & (t != low), 15)
        s += flag(F.contains(low, F.lit(":")), 5) - flag(size - F.length(F.replace(low, F.lit(","), F.lit(""))) >= 2, 15) - flag(F.contains(low, F.lit(".")), 10)
        s -= flag(low.rlike("|".join(lx.SECTION_HINTS)), 20)
        s += flag(low.rlike(rf"(?:^|{OTHER})[0-9]{{4}}(?:{OTHER}|$)"), 2)
        for w in ("package", "work", "services"):
            s += flag(F.contains(low, F.lit(w)), 5)
        return F.when((low == "") | low.rlike(GENERIC) | labelled(low) | contact(low), -100).otherwise(s)

    return let(F.lower(t), rule)


def until(rows: Column, first: Column, halt) -> Column:  # noqa: ANN001
    """The rows from number first (1 is the first) to the one before the next that halts."""
    tail = F.slice(rows, first, F.greatest(F.size(rows) - first + 1, F.lit(0)))
    return let(tail, lambda r: let(F.array_position(F.transform(r, halt), True), lambda p: F.slice(r, F.lit(1), F.when(p > 0, (p - 1).cast("int")).otherwise(F.size(r)))))


def opening(c: Column) -> Column:
    """What the rules need of the first lines: struct(x, c, admin, stop) of the line, itself cleaned, whether it is administrative, whether a title stops before it."""
    return F.transform(F.slice(c, F.lit(1), F.lit(OPENING)), lambda x: F.struct(x.alias("x"), clean(x).alias("c"), administrative(x).alias("admin"), stops(x).alias("stop")))


def best_window(rows: Column, notices: bool = True) -> Column:
    """struct(down, i, kind, used, t): the best window of the opening's lines, or null if none scores above 0. Windows (kind 0) go before what follows a notice heading (kind 1)."""
    n = F.size(rows)

    def windows(i: Column) -> Column:
        def one(k: Column) -> Column:
            part = F.slice(rows, i + 1, k)
            fits = (i + k <= n) & ~F.exists(F.slice(rows, i + 2, F.greatest(k - 1, F.lit(0))), lambda r: r["admin"])
            t = F.when(fits, F.when(k == 1, F.get(part, F.lit(0))["c"]).otherwise(clean(F.array_join(F.transform(part, lambda r: r["x"]), " ")))).otherwise("")
            return let(t, lambda y: F.struct((-title_score(y, i)).alias("down"), i.alias("i"), F.lit(0).alias("kind"), k.alias("used"), y.alias("t")))

        return F.transform(F.sequence(F.lit(1), F.lit(WINDOW)), one)

    def notice(i: Column) -> Column:
        below = F.slice(until(rows, i + 2, lambda r: r["stop"]), F.lit(1), F.lit(NOTICE_LINES))
        t = F.array_join(F.transform(below, lambda r: r["c"]), " ")
        t = F.when(F.lower(F.get(rows, i)["x"]).rlike(NOTICE) & (F.size(words(t)) >= 4), t).otherwise("")
        return F.array(let(t, lambda y: F.struct((-title_score(y, i)).alias("down"), i.alias("i"), F.lit(1).alias("kind"), (F.size(below) + 1).alias("used"), y.alias("t"))))

    at = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))
    found = F.filter(F.flatten(F.transform(at, lambda i: F.concat(windows(i), notice(i)) if notices else windows(i))), lambda w: w["down"] < 0)
    return F.array_min(found)


def find_title(c: Column) -> Column:
    """The title of prepared lines, or the empty text: a labelled name of work with what follows it; else the best window, extended by the lines that go on with it; else the first line of four words that is no heading or label."""
    def named(rows: Column) -> Column:
        def work(i: Column) -> Column:
            x = F.get(rows, i)["x"]
            below = until(rows, i + 2, lambda r: r["admin"] | F.lower(r["x"]).rlike(NUMBER) | (r["c"] == ""))
            t = F.array_join(F.array_compact(F.concat(F.array(F.nullif(clean(F.regexp_extract(x, f"(?i){WORK}", 1)), F.lit(""))), F.transform(below, lambda r: r["c"]))), " ")
            return F.when(F.lower(x).rlike(WORK), F.rtrim(F.regexp_replace(t, f"(?i){TAIL}", ""), F.lit(" .")))

        at = F.sequence(F.lit(0), F.greatest(F.size(rows) - 1, F.lit(0)))
        return F.get(F.filter(F.transform(at, work), lambda t: F.size(words(t)) >= 4), F.lit(0))

    def extended(rows: Column) -> Column:
        def grow(w: Column) -> Column:
            more = until(rows, w["i"] + w["used"] + 1, lambda r: r["stop"])
            return without_repeat(F.rtrim(F.concat_ws(" ", w["t"], F.array_join(F.transform(more, lambda r: r["c"]), " ")), F.lit(" .")))

        return let(best_window(rows), lambda w: F.when(w.isNotNull(), grow(w)))

    def plain(rows: Column) -> Column:
        good = F.filter(rows, lambda r: (F.size(words(r["c"])) >= 4) & ~F.lower(r["c"]).rlike(GENERIC) & ~F.lower(r["c"]).rlike(LABEL))
        return F.get(good, F.lit(0))["c"]

    t = let(opening(c), lambda rows: F.coalesce(named(rows), extended(rows), plain(rows), F.lit("")))
    return let(t, lambda y: F.when(F.length(y).between(8, 500) & (F.size(words(y)) >= 3), y).otherwise(""))
