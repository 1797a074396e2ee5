"""Landed fetches: validation, type routing, and text gates. Every rejection is a value, never only a log line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicons as lx
from ..functions import urls
from ..functions.num import flags
from ..functions.text import contained, contains_any, count_words, strip, symbol_share, text

MOST_BYTES = 50 * 1024 * 1024
LEAST_TEXT, MOST_SYMBOLS, LEAST_SCORE = 120, 0.40, 2


def content_type(declared: Column) -> Column:
    return F.lower(strip(F.substring_index(text(declared), ";", 1)))


def is_pdf_bytes(content: Column) -> Column:
    return F.coalesce(F.hex(F.substring(content, 1, 4)) == "25504446", F.lit(False))


def head_text(content: Column, n: int) -> Column:
    """The first n bytes as lower-case text, broken sequences left out."""
    return F.lower(F.replace(F.make_valid_utf8(F.substring(content, 1, n).cast("string")), F.lit("�"), F.lit("")))


def is_html_bytes(content: Column) -> Column:
    return F.coalesce(F.regexp_replace(head_text(content, 4096), r"(?U)^\s+", "").rlike(r"^(?:<!doctype html|<html)"), F.lit(False))


def mime(content: Column, declared: Column) -> Column:
    """By magic first, then what was declared."""
    d = content_type(declared)
    return F.when(is_pdf_bytes(content), "application/pdf").when(is_html_bytes(content), "text/html").when(d.isin("application/xml", "text/xml"), d).when(d == "", "application/octet-stream").otherwise(d)


def route(url: Column, mime_type: Column) -> Column:
    """`pdf` or `html`."""
    pdf = mime_type.isin("application/pdf", "application/x-pdf", "application/octet-stream") | F.startswith(text(mime_type), F.lit("application/pdf")) | F.endswith(F.lower(urls.path(url)), F.lit(".pdf"))
    return F.when(pdf, "pdf").otherwise("html")


def is_binary(content: Column) -> Column:
    """A zero byte or over 30% of other than text bytes in the first 4 KiB."""
    h = F.hex(F.substring(content, 1, 4096))
    pairs = F.regexp_extract_all(h, F.lit("(..)"), F.lit(1))
    odd = F.size(F.filter(pairs, lambda x: x.rlike("^(?:0[0-8BEF]|1[0-9A-F]|7F)$")))
    return F.array_contains(pairs, "00") | (odd > 0.3 * F.size(pairs))


def error_type(status: Column, declared: Column, declared_size: Column, content: Column, most: int = MOST_BYTES, screens: bool = True) -> Column:
    """Null for a good response, else why it is refused, first reason first."""
    d = content_type(declared)
    preview = head_text(content, 10_000)
    blocked = F.lit(False)
    for p in lx.UNSUPPORTED_TYPES:
        blocked = blocked | F.startswith(d, F.lit(p))
    says_pdf = F.startswith(d, F.lit("application/pdf"))
    out = (
        F.when(F.coalesce(status, F.lit(200)) >= 400, F.concat(F.lit("http_"), status.cast("string")))
        .when((F.coalesce(status, F.lit(200)) == 204) | (F.coalesce(declared_size, F.lit(1)) == 0), "empty_response")
        .when(F.coalesce(declared_size, F.lit(0)) > most, "content_too_large")
        .when(blocked, "unsupported_content_type")
        .when(F.coalesce(F.length(content), F.lit(0)) == 0, "empty_response")
        .when(F.length(content) > most, "content_too_large")
        .when(says_pdf & is_html_bytes(content), "fake_pdf_html")
        .when(says_pdf & ~is_pdf_bytes(content), "invalid_pdf")
        .when(~mime(content, declared).isin(lx.SUPPORTED_TYPES), "unsupported_binary")
    )
    if screens:
        html = is_html_bytes(content)
        out = out.when(html & contains_any(preview, lx.CAPTCHA_SIGNS), "captcha_page").when(html & contains_any(preview, lx.LOGIN_SIGNS), "login_page")
    return out


def fetched(landed: DataFrame) -> DataFrame:
    """The fixed fetch record from landed responses (url, final_url, status_code, content_type, content, headers, redirects, download_time); absent columns are null."""
    have = set(landed.columns)
    col = lambda n, t: F.col(n).cast(t) if n in have else F.lit(None).cast(t)
    rows = landed.withColumn("_e", error_type(col("status_code", "int"), col("content_type", "string"), col("declared_size", "long"), col("content", "binary")))
    ok = F.col("_e").isNull()
    c = F.when(ok, col("content", "binary"))
    return rows.select(
        ok.alias("success"), c.alias("content"), content_type(col("content_type", "string")).alias("content_type"), F.when(ok, mime(col("content", "binary"), col("content_type", "string"))).alias("mime_type"),
        F.sha2(c, 256).alias("content_hash"), F.coalesce(F.length(c), F.lit(0)).cast("long").alias("content_size"), col("url", "string").alias("url"), F.coalesce(col("final_url", "string"), col("url", "string")).alias("final_url"),
        col("status_code", "int").alias("status_code"), col("headers", "map<string,string>").alias("headers"), F.coalesce(col("redirects", "int"), F.lit(0)).alias("redirects"), col("download_time", "double").alias("download_time"),
        F.col("_e").alias("error"), F.col("_e").alias("error_type"),
    )


#: Exception class of a failed fetch -> its error type, first fitting first.
FAILURES = {
    "ConnectTimeout": "connect_timeout", "ReadTimeout": "read_timeout", "Timeout": "timeout", "TooManyRedirects": "too_many_redirects", "SSLError": "ssl_error",
    "ConnectionError": "connection_error", "InvalidURL": "invalid_url", "MissingSchema": "invalid_url",
}


def failure(exception: Column) -> Column:
    out = F.lit("request_error")
    for name, kind in reversed(FAILURES.items()):
        out = F.when(exception == name, kind).otherwise(out)
    return out


def document_score(c: Column) -> Column:
    t = F.lower(c)
    return 2 * contained(t, lx.REQUIRED_TERMS) + F.when(F.length(c) > 1000, 2).otherwise(0) + F.when(F.length(c) > 5000, 2).otherwise(0)


def looks_like_navigation(c: Column) -> Column:
    t = F.lower(c)
    return contains_any(t, lx.CONTEXT_BAD_PAGE) & (F.length(c) <= 1200) & (contained(t, lx.NAVIGATION_HEAVY) >= 3)


def text_reject(c: Column, terms: bool = True) -> Column:
    """Null for a text that may be a document, else the first gate it fails. terms=False leaves the domain's vocabulary out."""
    t = text(c)
    ends = F.lower(F.concat(F.substring(t, 1, 3000), F.lit(" "), F.substring(t, -1000, 1000)))
    out = F.when(F.length(strip(t)) < LEAST_TEXT, "text_too_short").when(contains_any(ends, lx.STRONG_BAD_PAGE), "error_page").when(looks_like_navigation(t), "navigation_page").when(symbol_share(t) > MOST_SYMBOLS, "garbled_text")
    return out.when(document_score(t) < LEAST_SCORE, "no_document_signal") if terms else out


def boilerplate_reject(c: Column) -> Column:
    """Null for a page's text that carries content, else why it is blanked."""
    t = F.lower(text(c))
    return (
        F.when(F.length(t) < 150, "too_short")
        .when(F.contains(t, F.lit("username")) & F.contains(t, F.lit("password")), "login_form")
        .when(contains_any(t, lx.BLOCKED_PAGE), "blocked_page")
        .when(contained(t, lx.NOISE_WORDS) >= 4, "noise")
        .when(~contains_any(t, lx.PAGE_TERMS), "no_domain_word")
        .when(count_words(t) < 30, "too_few_words")
    )


def url_reject(url: Column) -> Column:
    u = F.lower(strip(text(url)))
    bad = flags(*[F.startswith(u, F.lit(p)) for p in lx.LINK_SCHEMES]) > 0
    return F.when(u == "", "empty_url").when(bad, "invalid_url").when(~u.rlike("^https?://"), "invalid_url")


def structured_reject(title: Column) -> Column:
    return F.when(F.length(strip(text(title))) < 10, "title_too_short")
