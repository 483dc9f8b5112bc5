"""HTML columns: sections, text, attributes, links, embedded data."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import collapse_space, decode_entities

#: Sections around the content, in the order in which they go.
SECTIONS = ("header", "footer", "nav", "aside")
_VALUE = r"\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"


def strip_sections(html: Column, tags: Iterable[str] = SECTIONS) -> Column:
    for tag in tags:
        html = F.regexp_replace(html, rf"(?is)<{tag}\b[^>]*>.*?</{tag}>", " ")
    return html


def strip_scripts(html: Column) -> Column:
    return strip_sections(html, ("script", "style"))


def plain_text(html: Column) -> Column:
    return collapse_space(decode_entities(F.regexp_replace(F.coalesce(html, F.lit("")), "<[^>]*>", " ")))


def attribute(attributes: Column, name: str) -> Column:
    pattern = rf"(?is)(?<![A-Za-z0-9_]){name}{_VALUE}"
    return F.regexp_replace(F.coalesce(F.regexp_extract(attributes, pattern, 1), F.lit("")), r"^[\"']|[\"']\z", "")


def page_title(html: Column) -> Column:
    return plain_text(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def text_sample(html: Column, most: int = 60_000) -> Column:
    """The start of the text; how long it may be is the feature."""
    return F.substring(plain_text(strip_scripts(html)), 1, most)


def handler_links(script: Column) -> Column:
    """URLs that stand in an event handler: quoted ones, then bare absolute ones."""
    start = r"(?:https?://|//|/|\./|\.\./)"
    quoted = F.regexp_extract_all(script, F.lit(rf"(?:'{start}[^'\"]+'|\"{start}[^'\"]+\")"), F.lit(0))
    bare = F.regexp_extract_all(script, F.lit(r"(https?://[^\s'\"`<>)]+)"), F.lit(0))
    return F.concat(F.transform(quoted, lambda x: F.substring(x, F.lit(2), F.length(x) - 2)), bare)


def anchors(html: Column) -> Column:
    """ARRAY<STRUCT<attributes, body>> of the a elements with a href, in order."""
    pattern = r"(?is)<a\b([^>]*)>(.*?)</a>"
    rows = F.arrays_zip(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)).alias("attributes"), F.regexp_extract_all(html, F.lit(pattern), F.lit(2)).alias("body"))
    return F.filter(rows, lambda x: x["attributes"].rlike(r"(?i)(?<![A-Za-z0-9_])href\s*="))


def sections(html: Column, tags: Iterable[str] = ("nav", "header", "footer")) -> Column:
    """The inner HTML of the named sections."""
    parts = [F.regexp_extract_all(html, F.lit(rf"(?is)<{t}\b[^>]*>(.*?)</{t}>"), F.lit(1)) for t in tags]
    return F.concat(*parts)


def json_ld_blocks(html: Column) -> Column:
    pattern = r"(?is)<script[^>]*type=[\"']application/ld\+json[\"'][^>]*>(.*?)</script>"
    return F.regexp_extract_all(html, F.lit(pattern), F.lit(1))


def microdata(html: Column) -> Column:
    """itemprop -> text; of equal names the last one stays."""
    pattern = r"(?is)<(?:[a-z][a-z0-9]*)\b[^>]*\bitemprop\s*=\s*\"([^\"]*)\"[^>]*>([^<]*)"
    names, texts = (F.regexp_extract_all(html, F.lit(pattern), F.lit(i)) for i in (1, 2))
    pairs = F.arrays_zip(names.alias("name"), F.transform(texts, collapse_space).alias("text"))
    last = F.filter(pairs, lambda p, i: ~F.array_contains(F.slice(names, i + 2, F.greatest(F.size(names), F.lit(1))), p["name"]))
    return F.map_from_entries(last)


def clean_page(html: Column, status: Column) -> Column:
    """STRUCT<html, job_body, error_type>: a job page without what is no text; an error page's
    are empty."""
    body = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?s)<!--.*?-->", "")
    body = strip_sections(body, ("script", "noscript", "select", "style", "button", "aside", "svg"))
    body = F.regexp_replace(body, r"(?is)<(meta|link|path)\b[^>]*>", "")
    bad = F.coalesce(status, F.lit(0)) >= 400
    return F.struct(
        F.when(bad, "").otherwise(collapse_space(body)).alias("html"),
        F.when(bad, "").otherwise(plain_text(body)).alias("job_body"),
        F.when(bad, F.concat(F.lit("http_"), status.cast("string"))).otherwise("").alias("error_type"),
    )


def apply_phrases(text: Column, phrases: Iterable[str]) -> Column:
    """STRUCT<found, is_job>: phrases that stand in a text as whole words; a job page has at least
    one and none more than three times."""
    from .base import escape

    low = F.lower(F.coalesce(text, F.lit("")))
    counts = F.array(*[F.struct(F.lit(p).alias("phrase"), F.regexp_count(low, F.lit(r"(?<![a-z0-9_])" + escape(p.lower()) + (r"(?![a-z0-9_])" if p.replace(" ", "").isalpha() else ""))).alias("n")) for p in phrases])
    found = F.filter(counts, lambda x: x["n"] > 0)
    return F.struct(F.transform(found, lambda x: x["phrase"]).alias("found"), ((F.size(found) > 0) & ~F.exists(found, lambda x: x["n"] > 3)).alias("is_job"))
