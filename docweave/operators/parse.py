"""Field extraction from cleaned document text.

E-mail, phone, money, type, dates, the title (titles.py) and the description (descriptions.py) are native expressions. Organisation and location
come from one Arrow-batched rule engine. Fields are texts, empty when absent.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from ..functions import dates
from ..functions import lexicons as lx
from ..functions.lexicon import has_word
from ..functions.num import round2
from ..functions.text import all_lines, let, once, strip, text
from . import descriptions, titles

# ---- native fields ----


def email(c: Column) -> Column:
    return F.regexp_extract(text(c), lx.EMAIL, 0)


def phone(c: Column) -> Column:
    """The first match with a valid number of digits, as written."""
    found = F.regexp_extract_all(text(c), F.lit(lx.PHONE), F.lit(0))
    digits = lambda x: F.regexp_replace(x, r"\D", "")
    good = F.filter(found, lambda x: digits(x).rlike(r"^(?:91)?[6-9]\d{9}$|^0\d{9,11}$"))
    return F.coalesce(F.get(good, F.lit(0)), F.lit(""))


def amount(c: Column) -> Column:
    return F.replace(text(c), F.lit(","), F.lit(""))


def _labelled_money(c: Column, labels: list[str]) -> Column:
    names = "|".join(labels)
    number = r"([0-9][0-9,]*(?:\.\d{1,2})?)"
    plain = F.regexp_extract(c, rf"(?i)(?:{names})\s*(?:\([^)]*\))?\s*[:=-]\s*(?:₹|rs\.?|inr)?\s*{number}", 1)
    near = F.regexp_extract(c, rf"(?i)(?:{names})[^.\n:;]{{0,100}}?(?:₹|rs\.?|inr)\s*{number}", 1)
    below = F.regexp_extract(c, rf"(?i)(?:{names})[^\n]*\n(?:[^\n]*\n)?[^\n]*?(?:₹|rs\.?|inr)\s*{number}", 1)
    return F.coalesce(*[F.when(x != "", amount(x)) for x in (plain, near, below)], F.lit(""))


def emd(c: Column) -> Column:
    return _labelled_money(text(c), [r"\bemd\b", r"earnest\s+money(?:\s+deposit)?", r"bid\s+security"])


def document_fee(c: Column) -> Column:
    return _labelled_money(text(c), [r"tender\s+(?:document\s+)?fee", r"document\s+(?:fee|cost)", r"cost\s+of\s+(?:tender|bid)\s+document", r"bid\s+document\s+fee", r"processing\s+fee"])


def money(c: Column) -> Column:
    """All amounts with a currency, digits only."""
    return F.transform(F.regexp_extract_all(text(c), F.lit(f"(?i){lx.MONEY}"), F.lit(1)), amount)


def all_dates(c: Column) -> Column:
    return F.regexp_extract_all(text(c), F.lit("|".join(lx.DATE_SHAPES)), F.lit(0))


def tender_type(c: Column) -> Column:
    """The longest term first, between word boundaries, over the whole text."""
    t = F.lower(text(c))
    order = sorted(lx.TENDER_TYPES, key=len, reverse=True)
    return F.coalesce(*[F.when(has_word(t, k), F.lit(lx.TENDER_TYPES[k])) for k in order], F.lit(""))


def deadline(c: Column) -> Column:
    """ISO text of the first date that reads: on lines that speak of a last date, then of submission or closing, then anywhere."""
    strong, weak = lx.DEADLINE_WORDS[:1] + [w for w in lx.DEADLINE_WORDS if len(w.split()) > 1], lx.DEADLINE_WORDS
    lines = all_lines(text(c))

    def first(found: Column) -> Column:
        read = F.array_compact(F.transform(found, lambda x: dates.parse(x, "parser")))
        return F.get(read, F.lit(0))

    def on(words: list[str]) -> Column:
        pattern = "(?i)" + "|".join(rf"\b{w}\b" for w in words)
        return first(F.flatten(F.transform(F.filter(lines, lambda x: x.rlike(pattern)), all_dates)))

    return F.coalesce(F.date_format(F.coalesce(on(strong), on(weak), first(all_dates(c))), "yyyy-MM-dd"), F.lit(""))


def known_place(c: Column) -> Column:
    """The longest name of the gazetteer that occurs, in title case."""
    t = F.lower(text(c))
    return F.coalesce(*[F.when(has_word(t, n), F.initcap(F.lit(n))) for n in sorted(lx.GAZETTEER, key=len, reverse=True)], F.lit(""))


# ---- the rule engine ----

_any = lambda words: re.compile(r"(?<!\w)(?:" + "|".join(sorted(map(re.escape, words), key=len, reverse=True)) + r")(?!\w)", re.I)
GOVERN = _any(lx.GOVERNMENT)
INSTITUTE = _any(lx.INSTITUTIONS)
MONEY_OR_CONTACT = re.compile(r"₹|\brs\.?\s*\d|\binr\b|@|https?://|www\.|\b(?:phone|tel|fax|mobile|e-?mail)\b", re.I)
ADDRESS = re.compile(r"\b(?:road|street|floor|plot|block|sector|near|opp|pin|nagar|marg|house no|p\.?o\.?|district|dist)\b|\b\d{6}\b", re.I)
PROSE = re.compile(r"\b(?:shall|should|hereby|whereas|is required|are required|will be|has been|have been|may be|in accordance|subject to|as per|the bidder|the tenderer|applicant must)\b", re.I)
LABEL = re.compile(r"^(?:tender (?:no|id|ref|fee)|bid (?:no|id)|ref(?:erence)?(?: no)?|date|e-?mail|phone|tel|fax|website|emd|estimated cost|document fee|last date|closing date|due date)\b[^:]{0,30}[:\-]", re.I)
NOTICE = re.compile(r"^(?:notice inviting tender|request for proposal|expression of interest|invitation for bids?|tender notice|notice|short term tender)\W*$", re.I)
NUMBERED = re.compile(r"^(?:\d+(?:\.\d+)*[.)]?|[-•*·]|\(?[a-z]\))\s+", re.I)
ORG_LABEL = re.compile(r"^(?:name of (?:the )?)?(" + "|".join(sorted(lx.ORGANIZATION_LABELS, key=len, reverse=True)) + r")\b(?: name)?\s*([:\-])?\s*(.*)$", re.I)
PLACE_LABEL = re.compile(r"^(?:\d+[.)]?\s*)?(" + "|".join(sorted(lx.LOCATION_LABELS, key=len, reverse=True)) + r")\s*(:|-)\s*(.+)$", re.I)
PLACE = _any(lx.GAZETTEER)
CONTENTS = re.compile(r"^(?:table of contents|contents|index)$|\.{3,}\s*\d+$|^\d+$", re.I)


def prepare(t: str | None) -> list[str]:
    s = unicodedata.normalize("NFKC", t or "").replace("–", "-").replace("—", "-")
    return [x for x in (" ".join(y.split()) for y in s.splitlines()) if x and not CONTENTS.search(x)]


def overlaps(a: str, b: str) -> bool:
    x, y = (set(re.findall(r"\w+", s.lower())) for s in (a, b))
    return len(x) >= 2 and len(x & y) / len(x) >= 0.6


def clean_organization(x: str) -> str:
    x = NUMBERED.sub("", x)
    x = re.sub(r"\(\s*an?\s+(?:statutory|autonomous|undertaking|govt|government)[^)]*\)", "", x, flags=re.I)
    x = " ".join(x.split()).strip(" :;,-.\"'")
    return x if 5 <= len(x) <= 220 and len(x.split()) <= 18 and not MONEY_OR_CONTACT.search(x) else ""


def organization_score(x: str, i: int) -> int:
    s = max(0, 35 - i) + 15 * len({y.lower() for y in GOVERN.findall(x)}) + 10 * (x.count(" ") >= 4) + 12 * len({y.lower() for y in INSTITUTE.findall(x)})
    s -= 60 * bool(re.match(r"(?:office of|to|from|dated?|ref)\b", x, re.I)) + 25 * bool(NOTICE.match(x)) + min(50, 18 * len(ADDRESS.findall(x)))
    s -= min(60, 20 * len(_BUYING.findall(x))) + 25 * (len(x.split()) > 18) + 20 * bool(re.search(r"\d{6,}", x)) + 50 * bool(PROSE.search(x))
    return s if GOVERN.search(x) or INSTITUTE.search(x) else s - 60


_BUYING = _any(["tender", "bid", "rfp", "eoi", "proposal", "quotation", "submission", "work", "supply"])


def find_organization(lines: list[str], title: str) -> str:
    for i, x in enumerate(lines[:150]):
        m = ORG_LABEL.match(x)
        if m and m[2]:
            value = m[3] or (lines[i + 1] if i + 1 < len(lines) else "")
            c = clean_organization(value)
            if c and not ADDRESS.search(c) and not PROSE.search(c) and (not overlaps(c, title) or m[1].lower() == "issued by"):
                return c
    best = (0.0, "")
    for i, x in enumerate(lines[:100]):
        m = INSTITUTE.search(x)
        if m and len(x.split()) <= 10 and len(x) <= 100 and (x.isupper() or m.start() == 0) and (c := clean_organization(x)) and not overlaps(c, title):
            best = max(best, (len(m[0]) + 20 * x.isupper() + max(0.0, 15 - i / 5), c), key=lambda y: y[0])
    if best[1]:
        return best[1]
    ranked = [(-organization_score(c, i), i, c) for i in range(min(len(lines), 100)) for k in range(1, 5) if i + k <= len(lines) and (c := clean_organization(" ".join(lines[i : i + k]))) and not overlaps(c, title)]
    return min(ranked)[2] if ranked and min(ranked)[0] < 0 else ""


def _place(x: str) -> str:
    x = x.strip(" :;,-.")
    bad = len(x) > 150 or len(x.split()) > 12 or MONEY_OR_CONTACT.search(x) or PROSE.search(x) or re.search(r"\d{10,}", x)
    return "" if bad or len(x) < 3 else x


def find_location(lines: list[str]) -> str:
    for x in lines:
        if (m := PLACE_LABEL.match(x)) and (m[1].lower() != "state" or m[2] == ":") and (p := _place(m[3])):
            return p
    found = PLACE.findall("\n".join(lines))
    if found:
        return max(found, key=len).title()
    for x in lines:
        if (m := re.search(r"\bat\s+([A-Z][\w-]+(?:[ ,]+[A-Z][\w-]+){0,7})", x)) and (p := _place(m[1])):
            return p
    return ""


def fields(t: str | None, title: str) -> dict[str, str]:
    lines = prepare(t)
    return {"organization": find_organization(lines, title), "location": find_location(lines)}


def _engine(series: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, titles in series:
        yield pd.DataFrame([fields(x, t) for x, t in zip(texts, titles, strict=True)], columns=["organization", "location"])


engine = pandas_udf(_engine, T.StructType([T.StructField(n, T.StringType()) for n in ("organization", "location")]))


def parse(df: DataFrame, column: str = "text") -> DataFrame:
    """Adds the struct parsed (ten texts) and confidence. A null or blank text parses to empty fields with confidence 0."""
    c = F.col(column)
    found = let(titles.lines(c), lambda x: F.struct(titles.find_title(x).alias("title"), descriptions.find_description(x).alias("description")))
    rows = once(df, F.array(found), "_found")
    rows = rows.withColumn("_e", engine(c, F.col("_found.title")))
    mail = email(c)
    parsed = F.struct(
        F.col("_found.title").alias("title"), F.col("_e.organization").alias("organization"), deadline(c).alias("deadline"), F.col("_e.location").alias("location"), F.col("_found.description").alias("description"),
        tender_type(c).alias("tender_type"), emd(c).alias("emd"), document_fee(c).alias("document_fee"), F.when(mail.rlike(f"^(?:{lx.EMAIL})$"), mail).otherwise("").alias("email"), phone(c).alias("phone"),
    )
    rows = rows.withColumn("parsed", parsed).drop("_e", "_found")
    weight = {"title": 0.35, "organization": 0.20, "deadline": 0.15, "location": 0.10, "tender_type": 0.05, "description": 0.15}
    total = F.lit(0.0)
    for k, w in weight.items():
        total = total + F.when(strip(F.col(f"parsed.{k}")) != "", w).otherwise(0.0)
    return rows.withColumn("confidence", round2(total))
