"""URL expressions and the two canonical forms."""

from __future__ import annotations

from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from . import lexicons as lx
from .text import contains_any, strip, text


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(text(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(text(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def query(url: Column) -> Column:
    return F.regexp_extract(text(url), r"\?([^#]*)", 1)


def no_fragment(url: Column) -> Column:
    return F.substring_index(text(url), "#", 1)


def normalized(url: Column) -> Column:
    """Trimmed, without fragment, doubled slashes of the path and closing slash; empty unless http(s)."""
    u = strip(no_fragment(url))
    scheme = F.regexp_extract(u, r"^(https?://[^/?]*)", 1)
    rest = F.regexp_extract(u, r"^https?://[^/?]*([^?]*)", 1)
    tail = F.regexp_extract(u, r"(\?.*)$", 1)
    return F.when(u.rlike("^https?://[^/?]"), F.concat(scheme, F.regexp_replace(F.regexp_replace(rest, "/{2,}", "/"), "/+$", ""), tail)).otherwise("")


@pandas_udf(T.StringType())
def canonical(urls: pd.Series) -> pd.Series:
    """Lower case, no tracking parameters, the others sorted by name, no fragment, no closing slash. Repeated URLs of a batch are worked once."""
    known: dict[str, str] = {}

    def one(u: str | None) -> str:
        u = (u or "").strip()
        if u not in known:
            try:
                p = urlsplit(u)
                kept = [(k, v) for k, v in parse_qsl(p.query, keep_blank_values=True) if k.lower() not in lx.TRACKING and not k.lower().startswith("utm_")]
                kept.sort(key=lambda x: x[0].lower())
                known[u] = urlunsplit((p.scheme, p.netloc, p.path.rstrip("/"), urlencode(kept), "")).lower()
            except ValueError:
                known[u] = u.lower()
        return known[u]

    return urls.map(one)


def canonical_plain(url: Column) -> Column:
    """canonical() without Python, for URLs whose query has no escapes or blanks."""
    u = F.lower(strip(text(url)))
    pairs = F.filter(F.split(query(u), "&"), lambda x: (x != "") & ~F.substring_index(x, "=", 1).isin(lx.TRACKING) & ~F.startswith(x, F.lit("utm_")))
    pairs = F.transform(pairs, lambda x: F.when(F.contains(x, F.lit("=")), x).otherwise(F.concat(x, F.lit("="))))
    # a stable sort by name
    numbered = F.array_sort(F.transform(pairs, lambda x, i: F.struct(F.substring_index(x, "=", 1).alias("k"), i.alias("i"), x.alias("x"))))
    tail = F.array_join(F.transform(numbered, lambda s: s["x"]), "&")
    base = F.regexp_replace(F.regexp_extract(u, "^([^?#]*)", 1), "/+$", "")
    return F.when(tail != "", F.concat(base, F.lit("?"), tail)).otherwise(base)


def same_domain(a: Column, b: Column) -> Column:
    return host(a) == host(b)


def is_document(url: Column) -> Column:
    return contains_any(F.lower(path(url)), lx.DOCUMENT_TYPES)


def is_pdf(url: Column) -> Column:
    u = F.lower(text(url))
    return F.endswith(u, F.lit(".pdf")) | contains_any(u, [".pdf?", "/pdf/", "application/pdf"])


def has_bad_query(url: Column) -> Column:
    return contains_any(F.lower(query(url)), lx.CRAWL_BAD_QUERIES)


def is_bad(url: Column) -> Column:
    """Empty, with a sorting or paging query, or with a bad pattern; archive patterns don't count against documents."""
    u = F.lower(text(url))
    archives = ["archive", "archived"]
    rest = [x for x in lx.CRAWL_BAD_LINKS if x not in archives]
    return (u == "") | has_bad_query(u) | contains_any(u, rest) | (~is_document(u) & contains_any(u, archives))


def is_valid(url: Column) -> Column:
    """Blank, or http(s)."""
    u = strip(text(url))
    return (u == "") | u.rlike("^https?://")
