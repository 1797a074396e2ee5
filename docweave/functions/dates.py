"""Dates in the formats each rule accepts. None of these raises under ANSI."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

#: By profile the shape a text must have and the format it is read in, in order.
PROFILES = {
    "strict": ((r"\d{4}-\d{1,2}-\d{1,2}", "yyyy-M-d"),),
    "pipeline": ((r"\d{4}-\d{1,2}-\d{1,2}", "yyyy-M-d"), (r"\d{1,2}-\d{1,2}-\d{4}", "d-M-yyyy"), (r"\d{1,2}/\d{1,2}/\d{4}", "d/M/yyyy")),
    "score": (
        (r"\d{4}-\d{1,2}-\d{1,2}", "yyyy-M-d"), (r"\d{1,2}-\d{1,2}-\d{4}", "d-M-yyyy"), (r"\d{1,2}/\d{1,2}/\d{4}", "d/M/yyyy"),
        (r"\d{1,2}\.\d{1,2}\.\d{4}", "d.M.yyyy"), (r"\d{4}/\d{1,2}/\d{1,2}", "yyyy/M/d"),
    ),
    "parser": (
        (r"\d{4}-\d{1,2}-\d{1,2}", "yyyy-M-d"), (r"\d{1,2}/\d{1,2}/\d{4}", "d/M/yyyy"), (r"\d{1,2}/\d{1,2}/\d{2}", "d/M/yy"),
        (r"\d{1,2}-\d{1,2}-\d{4}", "d-M-yyyy"), (r"\d{1,2}-\d{1,2}-\d{2}", "d-M-yy"), (r"\d{1,2}\.\d{1,2}\.\d{4}", "d.M.yyyy"),
        (r"\d{1,2}\.\d{1,2}\.\d{2}", "d.M.yy"), (r"\d{1,2}\s+\p{L}+\s+\d{4}", "d MMMM yyyy"), (r"\d{1,2}\s+\p{L}+\s+\d{4}", "d MMM yyyy"),
        (r"\d{1,2}-\p{L}+-\d{4}", "d-MMMM-yyyy"), (r"\d{1,2}-\p{L}+-\d{4}", "d-MMM-yyyy"), (r"\p{L}+\s+\d{1,2},\s*\d{4}", "MMMM d, yyyy"), (r"\p{L}+\s+\d{1,2},\s*\d{4}", "MMM d, yyyy"),
    ),
}


def _date(value: Column, form: str) -> Column:
    return F.expr("null") if value is None else F.to_date(F.try_to_timestamp(value, F.lit(form)))


def parse(value: Column, profile: str) -> Column:
    """The first format that fits, as a date. Two-digit years turn at 69, as in C."""
    v = strip(value.cast("string"))
    tidy = F.regexp_replace(F.regexp_replace(v, r"\s+", " "), r", ?", ", ")
    found = []
    for shape, form in PROFILES[profile]:
        d = _date(tidy, form)
        if form.endswith("yy") and not form.endswith("yyyy"):
            d = F.when(F.year(d) >= 2069, F.add_months(d, -1200)).otherwise(d)
        found.append(F.when(v.rlike(f"^(?:{shape})$"), d))
    return F.coalesce(*found)


def iso(value: Column) -> Column:
    """ISO dates and timestamps (fixed two-digit fields), as a date."""
    v = strip(value.cast("string"))
    return F.when(v.rlike(r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}(?::\d{2}(?::\d{2}(?:\.\d{1,6})?)?)?(?:Z|[+-]\d{2}:\d{2})?)?$"), _date(F.substring(v, 1, 10), "yyyy-MM-dd")).when(v.rlike(r"^\d{8}$"), _date(v, "yyyyMMdd"))
