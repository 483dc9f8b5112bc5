"""Job postings in embedded JSON-LD.

A posting's fields may stand anywhere in a tree of any depth, so the search is a vectorised
Python function; everything around it is built-in columns."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .html import json_ld_blocks

FIELDS = ("job_title", "job_description", "job_id", "posted_date", "expiration_date", "job_type", "company", "same_as", "logo", "occupational_category", "salary", "currency", "salary_type", "location", "postal_code")
POSTING = StructType([StructField(f, StringType()) for f in FIELDS])


def _objects(tree: object) -> Iterator[dict]:
    """Objects in order: of lists each item, of objects the object, then its @graph."""
    todo = [tree]
    while todo:
        x = todo.pop()
        if isinstance(x, list):
            todo += x[::-1]
        elif isinstance(x, dict):
            yield x
            if "@graph" in x:
                todo.append(x["@graph"])


def _is_posting(x: dict) -> bool:
    kind = x.get("@type")
    return any(isinstance(k, str) and k.lower() == "jobposting" for k in (kind if isinstance(kind, list) else [kind]))


def find_posting(blocks: list[str] | None) -> dict | None:
    """The first posting in a page's blocks; blocks that are no JSON are passed over."""
    for block in [] if blocks is None else blocks:
        try:
            tree = json.loads(block.replace("﻿", "").replace(" ", " ").strip())
        except ValueError:
            continue
        for x in _objects(tree):
            if _is_posting(x):
                return x
    return None


def _first(tree: object, name: str) -> object:
    """The first value of a key anywhere in the tree, an object's own keys in their order."""
    todo: list = [tree]
    while todo:
        x = todo.pop()
        if isinstance(x, tuple):
            if x[0] == name:
                return x[1]
            todo.append(x[1])
        elif isinstance(x, list):
            todo += x[::-1]
        elif isinstance(x, dict):
            todo += list(x.items())[::-1]
    return None


def _text(x: object) -> str | None:
    if x is None or x is False or x == "" or x == 0:
        return None
    if isinstance(x, str):
        return x
    return json.dumps(x, separators=(",", ":"), ensure_ascii=False)


def _part(x: object, name: str) -> object:
    return x.get(name) if isinstance(x, dict) else None


def posting_fields(posting: dict | None) -> dict[str, str | None] | None:
    """The flat fields of a posting; none without a hiring organization."""
    org = _first(posting, "hiringOrganization") if posting else None
    if not org:
        return None
    get = lambda name: _first(posting, name)
    own = {
        "job_title": get("title"), "job_description": get("description"), "posted_date": get("datePosted"), "expiration_date": get("validThrough"), "job_type": get("employmentType"),
        "occupational_category": get("occupationalCategory"), "same_as": _part(org, "sameAs"), "logo": _part(org, "logo"), "company": org if isinstance(org, str) else _part(org, "name"),
    }
    id_ = get("identifier")
    own["job_id"] = id_ if isinstance(id_, str) else _part(id_, "value")
    base, estimated = get("baseSalary"), get("estimatedSalary")
    if pay := base or estimated:
        value = _part(pay, "value")
        low, high = _part(value, "minValue"), _part(value, "maxValue")
        salary = value if isinstance(value, str | int | float) else _part(value, "value")
        if not salary and (low or high):
            salary = f"{_text(low) or ''}-{_text(high) or ''}"
        if salary:
            unit = _part(value, "unitText")
            own |= {"salary": f"{_text(salary)} {unit}" if unit else salary, "currency": _part(pay, "currency"), "salary_type": "base" if base else "estimated"}
    place, address = get("jobLocation"), get("address")
    out = {f: _text(own.get(f)) for f in FIELDS}
    if isinstance(place, str) and place:
        out["location"] = place
    elif place:
        country = _part(address, "addressCountry")
        parts = (_part(address, "addressLocality"), _part(address, "addressRegion"), _part(country, "name") if isinstance(country, dict) else country)
        out["location"] = ",".join(s for x in parts if (s := (_text(x) or "").strip())) or None
        out["postal_code"] = _text(_part(address, "postalCode"))
    else:
        out["location"] = ""
    return out


@F.pandas_udf(StringType())
def _posting(blocks: pd.Series) -> pd.Series:
    return pd.Series([None if (p := find_posting(b)) is None else json.dumps(p) for b in blocks], dtype=object)


@F.pandas_udf(POSTING)
def _fields(postings: pd.Series) -> pd.DataFrame:
    rows = [posting_fields(json.loads(p)) if p else None for p in postings]
    return pd.DataFrame([{f: None for f in FIELDS} if r is None else r for r in rows], columns=list(FIELDS), dtype=object)


def job_posting(html: Column) -> Column:
    """The first posting of a page as JSON, or null."""
    return _posting(json_ld_blocks(html))


def posting_columns(posting: Column) -> Column:
    """STRUCT of the posting's fields, all null where there is none."""
    return _fields(posting)
