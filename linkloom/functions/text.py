"""Text columns: normal forms, entities, pagers, error messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import let
from .rules import PAGERS

_SPACE = "[\\s ﻿  -     　]+"


def collapse_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), _SPACE, " "))


def _numeric_references(text: Column) -> Column:
    """&#65; and &#x41; as characters: the text is cut before each reference."""

    def piece(x: Column) -> Column:
        ten, hexa = F.regexp_extract(x, r"^&#(\d{1,7});", 1), F.regexp_extract(x, r"^&#[xX]([0-9a-fA-F]{1,6});", 1)
        code = F.when(ten != "", ten.cast("int")).when(hexa != "", F.conv(hexa, 16, 10).cast("int"))
        rest = F.regexp_replace(x, r"^&#[xX]?[0-9a-fA-F]+;", "")
        wide = F.lpad(F.hex(code), 8, "0")
        char = F.decode(F.unhex(wide), "UTF-32")
        return F.when(code.isNotNull() & (code < 0x110000), F.concat(char, rest)).otherwise(x)

    cut = F.split(F.regexp_replace(text, r"(&#[xX]?[0-9a-fA-F]+;)", "\u0001$1"), "\u0001")
    return F.when(text.contains("&#"), F.array_join(F.transform(cut, piece), "")).otherwise(text)


def decode_entities(text: Column) -> Column:
    """The few named references and all numeric ones, & first, so &amp;lt; becomes <."""
    t = F.coalesce(text, F.lit(""))
    decoded = t
    for name, char in (("&nbsp;", " "), ("&amp;", "&"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">")):
        decoded = F.regexp_replace(decoded, "(?i)" + name, char)
    return F.when(t.contains("&"), let(decoded, _numeric_references)).otherwise(t)


def match_form(text: Column) -> Column:
    """Lower case, anything but a-z, 0-9 and white space as a space, spaces collapsed."""
    t = F.replace(F.lower(F.coalesce(text, F.lit(""))), F.lit("&nbsp;"), F.lit(" "))
    return F.trim(F.regexp_replace(F.when(t.contains("&#"), let(t, _numeric_references)).otherwise(t), "[^a-z0-9]+", " "))


def tokens(text: Column) -> Column:
    return F.filter(F.split(match_form(text), " "), lambda x: x != "")


def text_keys(text: Column) -> Column:
    """The distinct words of a text and pairs of neighbouring words."""

    def keys(words: Column) -> Column:
        pairs = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
        return F.array_distinct(F.concat(words, pairs))

    return let(tokens(text), keys)


def parse_flag(text: Column) -> Column:
    return F.lower(F.trim(text.cast("string"))).isin("1", "true", "yes", "y")


def positive_int(text: Column, otherwise: int) -> Column:
    n = F.floor(text.try_cast("double"))
    return F.when(n > 0, n.cast("int")).otherwise(otherwise)


def http_status(message: Column) -> Column:
    """The HTTP status that an error message names, else 0."""
    first = F.regexp_extract(message, r"(?i)response code (\d{3})", 1)
    second = F.regexp_extract(message, r"(?i)status(?: code)?\s*[:=]\s*(\d{3})", 1)
    return F.coalesce(F.nullif(first, F.lit("")), F.nullif(second, F.lit("")), F.lit("0")).cast("int")


def pager_text(text: Column) -> Column:
    """What the first pager, in the order of the list, that the text holds says; null for none."""
    found = [F.nullif(F.regexp_extract(text, f"(?i)({p})", 1), F.lit("")) for p in PAGERS]
    # Every one of them names a total.
    return F.when(text.rlike(r"(?i)of \d"), F.coalesce(*found))


def page_count(text: Column) -> Column:
    """How many result pages a pager names: 1 for no text, -1 for a text without a pager.

    Of three numbers the last over the second, of two their quotient where the pager says what
    is shown, else the second."""

    def pages(match: Column) -> Column:
        plain = F.lower(F.replace(match, F.lit(","), F.lit("")))
        numbers = F.transform(F.regexp_extract_all(plain, F.lit(r"(\d{1,5})"), F.lit(1)), lambda x: x.cast("int"))
        shown = plain.startswith("showing") | plain.endswith("opportunities")
        over = lambda a, b: F.ceil(F.try_divide(a, b)).cast("int")
        return let(numbers, lambda x: F.when(F.size(x) == 3, over(x[2], x[1])).when((F.size(x) == 2) & shown, over(x[1], x[0])).otherwise(F.get(x, F.lit(1))))

    t = F.coalesce(text, F.lit(""))
    return F.when(t == "", 1).otherwise(let(pager_text(t), lambda m: F.when(m.isNull(), -1).otherwise(pages(m))))


def page_numbers(count: Column) -> Column:
    return F.when(count >= 1, F.transform(F.sequence(F.lit(1), count), lambda x: x.cast("string"))).otherwise(F.expr("cast(array() as array<string>)"))


def nearest_bucket(n: Column) -> Column:
    """Half of that of 5, 10, 15, 20, 25, 50 and 100 nearest to n (of two, the first); 5 for 0."""
    sizes = F.array(*[F.lit(x) for x in (5, 10, 15, 20, 25, 50, 100)])
    best = F.array_min(F.transform(sizes, lambda x, i: F.struct(F.abs(x - n), i, x.alias("size"))))
    return F.when(n > 0, best["size"]).otherwise(10) / 2
