"""Small column helpers."""

from __future__ import annotations

import os.path
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once for each row however often body uses it."""
    return F.transform(F.array(value), body)[0]


def given(value: Column | None, otherwise: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), where a column holds it already; else body(otherwise), as let()."""
    return let(otherwise, body) if value is None else body(value)


def settled(df: DataFrame) -> DataFrame:
    """df with every column computed once for each row: filters above stay above, where the optimizer
    would copy the columns that they test into the filter, and branches that read the rows share what is below."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def shared(df: DataFrame, *keys: str) -> DataFrame:
    """df, dealt by keys, for several readers: computed once, as each reads one shuffle with all columns."""
    return settled(settled(df).repartition(*keys))


def escape(text: str) -> str:
    """text as a regular expression that Java and RE2 read alike."""
    return "".join("\\" + c if c in r"\.^$|?*+()[]{}-/" else c for c in text)


def any_of(words: Iterable[str]) -> str:
    """A pattern for any of the words as substrings: one search, however many words."""
    return "(?:" + "|".join(escape(w) for w in words) + ")"


def _by_prefix(words: list[str]) -> str:
    """any_of(words) with what words begin with alike written once: a text is tried for each first letter, not for
    each word. No word may begin another."""
    groups: dict[str, list[str]] = {}
    for w in words:
        groups.setdefault(w[0], []).append(w)
    parts = []
    for same in groups.values():
        start = os.path.commonprefix(same)
        parts.append(escape(start) + (_by_prefix([w[len(start) :] for w in same]) if len(same) > 1 else ""))
    return "(?:" + "|".join(parts) + ")"


def contains_any(text: Column, words: Iterable[str]) -> Column:
    # A word that holds another adds nothing.
    words = list(dict.fromkeys(words))
    words = [w for w in words if not any(v in w for v in words if v != w)]
    return text.rlike(_by_prefix(words) if all(words) else "") if words else F.lit(False)


def in_domain(host: Column, domain: str) -> Column:
    return (host == domain) | host.endswith("." + domain)


def in_domains(host: Column, domains: Iterable[str]) -> Column:
    return host.rlike("(?:^|\\.)" + any_of(domains) + "$")
