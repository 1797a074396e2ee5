"""A document's description: what follows a heading that announces it, else its introductory lines; a state scan over classed lines.

Lines are classed once. A scan is over at its first hard stop (contact, address of a page, form field), or at its first soft stop (index line, numbered section, section heading) once something
was collected; before that soft stops are passed over. So what a scan collects lies between two positions, which are found without walking line by line.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import lexicons as lx
from ..functions.text import contains_any, let
from .titles import OTHER, Terms, words

# Lengths of a description and of introductory text, lines looked at for it, and the terms and patterns of the classes.
LONGEST, LEAST, INTRO, INTRO_LINES, INTRO_LINE = 2500, 20, 1500, 120, 35
INDEX = rf"^[0-9]{{1,3}}\s+.+\s+[0-9]{{1,3}}$|(?:^|{OTHER})sl\.?\s*no(?:{OTHER}|$)|(?:^|{OTHER})page\s*no(?:{OTHER}|$)|remark/s|^table of content$"
ANNEXURE = rf"(?:^|{OTHER})annexure\s*[-:]?\s*[a-z0-9]+(?:{OTHER}|$)"
URL = r"https?://|www\."
REACH = Terms(("email", "e-mail", "phone", "mobile", "fax", "telephone", "contact details"))
CONTACT = Terms((*REACH.words, "contact"))
FORM = rf"^(?:name|address|mobile|phone|telephone|email|e-mail|fax|gst|gstin|pan|signature|designation|place|date)(?:{OTHER}|$)"
FIELD = rf"^(?:name|address|mobile|phone|telephone|email|e-mail|fax|gst|gstin|pan|signature|designation|place|organization|organisation|contact|tender\s+reference|tender\s+ref|reference\s+number|ref\.?\s*no|location|last\s+date|submission\s+date|tender\s+fee|document\s+fee|emd|earnest\s+money|bid\s+security)(?:{OTHER}|$)"
NUMBERED = r"^[0-9]{1,2}\s*[.):-]\s*[a-z]"
SECTION = rf"^[0-9]+(?:\.[0-9]+)*\s|^(?:eligibility|instructions|qualification|general conditions|special conditions|terms and conditions|important dates|critical dates|bid schedule|scope of work|evaluation|payment terms|annexure|appendix|schedule)(?:{OTHER}|$)"
PLAIN = Terms(("name of", "signature of", "designation", "date of issue", "place of issue"))


def header(low: Column) -> Column:
    """The first of the headings that the line holds between boundaries, or null."""
    return F.coalesce(*[F.when(F.contains(low, F.lit(h)) & low.rlike(rf"(?:^|{OTHER}){h}(?:{OTHER}|$)"), F.lit(h)) for h in lx.DESCRIPTION_HEADERS])


def index(low: Column) -> Column:
    """A line of a table of contents or the head of a table. Substring tests spare most lines the patterns."""
    odd = low.rlike("^[0-9]") | contains_any(low, ["sl", "page", "remark/s", "content"])
    return odd & low.rlike(INDEX) | F.contains(low, F.lit("annexure")) & low.rlike(ANNEXURE) & (F.size(words(low)) <= 15) | F.contains(low, F.lit("particulars")) & F.contains(low, F.lit("page"))


def meta(low: Column) -> Column:
    return F.contains(low, F.lit("@")) | low.rlike(URL) | (REACH.count(low) > 0) | low.rlike(FIELD)


def brief(low: Column) -> Column:
    return low.rlike("^[0-9]+$") | (F.length(low) < 20) & (F.size(words(low)) <= 2)


def noise(low: Column) -> Column:
    return index(low) | meta(low) | brief(low)


def classed(lines: Column) -> Column:
    """struct(x, head, hard, soft, good, section, intro) of every line: a heading or null, whether it ends a scan, ends it once something is collected, is worth collecting, begins a section, and can introduce."""

    def one(x: Column) -> Column:
        def told(low: Column) -> Column:
            hard = F.contains(low, F.lit("@")) | (CONTACT.count(low) > 0) | low.rlike(URL) | low.rlike(FORM)
            said = F.struct(index(low).alias("listed"), low.rlike(NUMBERED).alias("numbered"), low.rlike(SECTION).alias("section"), meta(low).alias("meta"), brief(low).alias("brief"))
            return let(said, lambda s: F.struct(
                x.alias("x"), F.when(~s["listed"], header(low)).alias("head"), hard.alias("hard"), (s["listed"] | s["numbered"] | s["section"]).alias("soft"), (~(s["listed"] | s["meta"] | s["brief"] | s["numbered"])).alias("good"),
                (~s["listed"] & s["section"]).alias("section"), (~s["listed"] & ~s["section"] & ~s["meta"] & (F.length(low) >= INTRO_LINE) & (PLAIN.count(low) == 0)).alias("intro"),
            ))

        return let(F.lower(x), told)

    return F.transform(lines, one)


def _first(rows: Column, test) -> Column:  # noqa: ANN001
    """The number of the first row that passes (1 is the first), or one more than there are."""
    at = F.array_position(F.transform(rows, test), True)
    return F.when(at > 0, at.cast("int")).otherwise(F.size(rows) + 1)


def _section(rows: Column, i: Column) -> Column:
    """What stands under the heading in row i (from 0): the rest of its line, and lines up to the stop; null if shorter than LEAST."""
    line = F.get(rows, i)

    def collect(below: Column) -> Column:
        rest = F.coalesce(*[F.when(line["head"] == h, F.regexp_extract(line["x"], rf"(?i)(?:^|{OTHER}){h}\s*[:-]\s*(.+)", 1)) for h in lx.DESCRIPTION_HEADERS])
        rest = let(F.lower(rest), lambda low: F.when((low != "") & ~noise(low), F.lit(True)).otherwise(F.lit(False)))
        inline = F.when(rest, F.coalesce(*[F.when(line["head"] == h, F.regexp_extract(line["x"], rf"(?i)(?:^|{OTHER}){h}\s*[:-]\s*(.+)", 1)) for h in lx.DESCRIPTION_HEADERS])).otherwise("")
        start = F.when(rest, F.lit(0)).otherwise(_first(below, lambda r: r["good"] & ~r["hard"] & ~r["soft"]))

        def between(span: Column) -> Column:
            soft = F.array_position(F.transform(below, lambda r, k: (k >= span) & r["soft"]), True)
            end = F.least(_first(below, lambda r: r["hard"]), F.when(soft > 0, soft.cast("int")).otherwise(F.size(below) + 1))
            found = F.filter(F.slice(below, F.lit(1), F.greatest(end - 1, F.lit(0))), lambda r: r["good"] & ~r["soft"])
            return F.trim(F.array_join(F.concat(F.filter(F.array(inline), lambda t: t != ""), F.transform(found, lambda r: r["x"])), " "))

        return let(start, between)

    t = let(F.slice(rows, i + 2, F.size(rows)), collect)
    return let(t, lambda y: F.when(F.length(y) >= LEAST, F.substring(y, 1, LONGEST)))


def _intro(rows: Column) -> Column:
    """Long lines of the beginning that are neither index, field nor form, up to the first section after one of them."""

    def told(top: Column) -> Column:
        def cut(good: Column) -> Column:
            first = F.array_position(good, True)
            stop = F.array_position(F.transform(top, lambda r, k: (first > 0) & (k >= first) & r["section"]), True)
            return F.transform(F.filter(F.zip_with(top, F.sequence(F.lit(1), F.size(top)), lambda r, k: F.struct(r["x"].alias("x"), (r["intro"] & ((stop == 0) | (k < stop))).alias("ok"))), lambda r: r["ok"]), lambda r: r["x"])

        return F.when(F.size(top) > 0, F.array_join(let(F.transform(top, lambda r: r["intro"]), cut), " ")).otherwise("")

    return F.substring(let(F.slice(rows, F.lit(1), F.lit(INTRO_LINES)), told), 1, INTRO)


def find_description(lines: Column) -> Column:
    """The description of prepared lines (titles.lines), or the empty text: under the heading that stands first in the list of headings (of equal ones the first line) and has enough below it."""

    def pick(rows: Column) -> Column:
        rank = F.array(*[F.lit(h) for h in lx.DESCRIPTION_HEADERS])
        heads = F.array_sort(F.filter(F.transform(rows, lambda r, i: F.struct(F.array_position(rank, r["head"]).alias("rank"), i.alias("i"))), lambda h: h["rank"].isNotNull()))
        found = F.filter(F.transform(heads, lambda h: _section(rows, h["i"])), lambda t: t.isNotNull())
        return F.coalesce(F.get(found, F.lit(0)), _intro(rows))

    t = let(classed(lines), pick)
    return let(t, lambda y: F.when(F.length(F.trim(y)) >= LEAST, F.trim(y)).otherwise(""))
