"""URL columns: parsing, resolving, normal forms, keys and the order of preference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import let

_URL = r"^([A-Za-z][A-Za-z0-9+.-]*):(?://([^/?#\\]*))?([^?#]*)(\?[^#]*)?(#.*)?$"
_HOST = r"^[^\s<>^|%]+$"
_IN_PATH, _IN_QUERY, _IN_HASH = r'"<>`{}', r"\"<>'", r'"<>`'
#: Fragments that name a job route.
ROUTE = r"(?i)^#!?/(jobs?|careers?|positions?|openings?|opportunit(y|ies)|posting|apply)([^A-Za-z0-9_]|$)"


def _encoded(text: Column, unsafe: str) -> Column:
    """text with the characters of the class `unsafe`, and all beyond ASCII, percent-encoded."""
    bad = rf"[^\x21-\x7e]|[{unsafe}]"
    one = lambda c: F.when(c == " ", "%20").when(c.rlike(bad), F.url_encode(c)).otherwise(c)
    return F.when(text.rlike(bad), F.array_join(F.transform(F.split(text, ""), one), "")).otherwise(text)


def _without_dots(path: Column) -> Column:
    def step(done: Column, part: Column) -> Column:
        return F.when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))).when(part == ".", done).otherwise(F.concat(done, F.array(part)))

    folded = F.aggregate(F.split(path, "/"), F.expr("cast(array() as array<string>)"), step)
    ends = F.when(path.rlike(r"/\.\.?$"), "/").otherwise("")
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), F.concat(F.array_join(folded, "/"), ends)).otherwise(path)


def parse_url(url: Column) -> Column:
    """STRUCT<scheme, user, host, port, path, query, hash> of an absolute URL, else null.

    Scheme and host in lower case, default ports dropped, an empty path of an http(s) URL as /,
    dot segments resolved, spaces and non-ASCII percent-encoded. Hosts beyond ASCII stay as
    they are: see ascii_hosts. One search cuts the URL into its parts."""

    def placed(place: Column, user: Column, scheme: Column, path: Column, query: Column, hash_: Column) -> Column:
        ported = place.rlike(r":\d*$")
        host = F.lower(F.when(ported, F.regexp_replace(place, r":\d*$", "")).otherwise(place))
        port = F.when(ported, F.substring_index(place, ":", -1)).otherwise("")
        port = F.when((scheme == "http") & (port == "80") | (scheme == "https") & (port == "443"), "").otherwise(port)
        path = let(path, lambda x: let(_without_dots(x), lambda y: _encoded(y, _IN_PATH)))
        query = F.when(query == "?", "").otherwise(_encoded(query, _IN_QUERY))
        hash_ = F.when(hash_ == "#", "").otherwise(_encoded(hash_, _IN_HASH))
        return F.struct(scheme.alias("scheme"), user.alias("user"), host.alias("host"), port.alias("port"), path.alias("path"), query.alias("query"), hash_.alias("hash"))

    def parts(x: Column) -> Column:
        scheme = F.lower(x[0])
        web = scheme.isin("http", "https")
        path = F.when(web & (x[2] == ""), "/").otherwise(x[2])
        named = x[1].contains("@")
        place = F.when(named, F.regexp_replace(x[1], "^.*@", "")).otherwise(x[1])
        user = F.when(named, F.regexp_replace(x[1], "@[^@]*$", "")).otherwise("")
        fine = lambda p: F.when(~web | p["host"].rlike(_HOST), p)
        return F.when(F.size(x) == 5, let(let(place, lambda y: placed(y, user, scheme, path, x[3], x[4])), fine))

    # No URL that was cut holds a line end, so that separates the parts.
    clean = F.translate(F.trim(url), "\t\r\n", "")
    return let(F.split(F.regexp_replace(clean, _URL, "$1\n$2\n$3\n$4\n$5"), "\n"), parts)


def with_parts(df: DataFrame, **given: Column) -> DataFrame:
    """df with parse_url() of the given URLs as columns of these names.

    Step by step in projections, which the engine compiles, where let() is interpreted. Filters on what follows
    belong behind settled(), or they get copies of the steps."""

    def step(columns: dict[str, Column]) -> None:
        nonlocal df
        df = df.select(*[c for c in df.columns if c not in columns], *[x.alias(c) for c, x in columns.items()])

    name = lambda n, part: f"_{n}_{part}"
    keep = df.columns
    step({name(n, "x"): F.trim(u) for n, u in given.items()})
    clean = lambda u: F.when(u.rlike("[\t\r\n]"), F.translate(u, "\t\r\n", "")).otherwise(u)
    step({name(n, "x"): F.split(F.regexp_replace(clean(F.col(name(n, "x"))), _URL, "$1\n$2\n$3\n$4\n$5"), "\n") for n in given})
    for n in given:
        x = F.col(name(n, "x"))
        named, fine = x[1].contains("@"), F.size(x) == 5
        step({
            name(n, "x"): x, name(n, "scheme"): F.when(fine, F.lower(x[0])), name(n, "place"): F.when(fine, F.when(named, F.regexp_replace(x[1], "^.*@", "")).otherwise(x[1])),
            name(n, "user"): F.when(fine, F.when(named, F.regexp_replace(x[1], "@[^@]*$", "")).otherwise("")),
        })
    for n in given:
        x, scheme, place = (F.col(name(n, c)) for c in ("x", "scheme", "place"))
        ported, web = place.contains(":") & place.rlike(r":\d*$"), scheme.isin("http", "https")
        step({
            name(n, "host"): F.lower(F.when(ported, F.regexp_replace(place, r":\d*$", "")).otherwise(place)), name(n, "port"): F.when(ported, F.substring_index(place, ":", -1)).otherwise(""),
            name(n, "path"): F.when(scheme.isNotNull(), _without_dots(F.when(web & (x[2] == ""), "/").otherwise(x[2]))),
        })
    built = {}
    for n in given:
        x, scheme, user, host, port, path = (F.col(name(n, c)) for c in ("x", "scheme", "user", "host", "port", "path"))
        web = scheme.isin("http", "https")
        port = F.when((scheme == "http") & (port == "80") | (scheme == "https") & (port == "443"), "").otherwise(port)
        query, hash_ = F.when(x[3] == "?", "").otherwise(_encoded(x[3], _IN_QUERY)), F.when(x[4] == "#", "").otherwise(_encoded(x[4], _IN_HASH))
        p = F.struct(scheme.alias("scheme"), user.alias("user"), host.alias("host"), port.alias("port"), _encoded(path, _IN_PATH).alias("path"), query.alias("query"), hash_.alias("hash"))
        built[n] = F.when(scheme.isNotNull() & (~web | host.rlike(_HOST)), p)
    step(built)
    return df.select(*[c for c in keep if c not in given], *given)


def with_forms(df: DataFrame, **given: Column) -> DataFrame:
    """df with url_forms() of the given URLs as columns of these names: compiled, as with_parts()."""
    keep = [c for c in df.columns if c not in given]
    df = df.select(*keep, *[u.alias(f"_{n}_url") for n, u in given.items()])
    df = with_parts(df, **{f"_{n}_p": F.col(f"_{n}_url") for n in given})
    df = df.select("*", *[F.when(F.col(f"_{n}_p").isNotNull(), _named(F.col(f"_{n}_p"))).alias(f"_{n}_named") for n in given])
    return df.select(*keep, *[_forms(F.col(f"_{n}_p"), F.col(f"_{n}_named"), F.col(f"_{n}_url")).alias(n) for n in given])


def _place(p: Column) -> Column:
    return F.concat(p["host"], F.when(p["port"] == "", "").otherwise(F.concat(F.lit(":"), p["port"])))


def _root(p: Column) -> Column:
    web = p["scheme"].isin("http", "https")
    user = F.when(p["user"] == "", "").otherwise(F.concat(p["user"], F.lit("@")))
    return F.concat(p["scheme"], F.when(web, F.concat(F.lit("://"), user, _place(p))).otherwise(":"))


def _named(p: Column) -> Column:
    """The path without slashes at its end."""
    return F.when(p["path"] == "/", "/").otherwise(F.regexp_replace(p["path"], "/+$", ""))


def _points(scheme: Column, named: Column, query: Column) -> Column:
    return F.when(scheme == "https", 100).otherwise(0) + F.when(named, 10).otherwise(0) + F.when(query == "", 1).otherwise(0)


def url_forms(url: Column) -> Column:
    """STRUCT<normal, key, score>: normalize_url, url_key and the url_score of the normal form, by
    parsing once."""

    return let(parse_url(url), lambda p: let(_named(p), lambda named: _forms(p, named, url)))


def _forms(p: Column, named: Column, url: Column) -> Column:
    web = p["scheme"].isin("http", "https")
    path = F.when(named == "", "/").otherwise(named)
    route = F.when(p["hash"].rlike(ROUTE), p["hash"]).otherwise("")
    rest = F.concat(F.when(web, path).otherwise(named), p["query"], route)
    score = _points(p["scheme"], (path != "/") | (named == "") & ~web, p["query"])
    forms = F.struct(F.concat(_root(p), rest).alias("normal"), F.concat(_place(p), path, p["query"], route).alias("key"), score.alias("score"))
    plain = F.trim(url)
    unparsed = F.struct(plain.alias("normal"), F.regexp_replace(F.lower(plain), "/+$", "").alias("key"), F.when(plain != "", 0).alias("score"))
    return F.when(p.isNull(), unparsed).otherwise(forms)


def normalize_url(url: Column) -> Column:
    """The URL without a trailing slash or a fragment, but for fragments that route to jobs.
    What doesn't parse is only trimmed."""
    return url_forms(url)["normal"]


def url_key(url: Column) -> Column:
    """What two spellings of one page share: the normal form without its scheme."""
    return url_forms(url)["key"]


def url_score(url: Column) -> Column:
    """https, then a path without a trailing slash, then no query. Null for no URL."""
    return let(parse_url(url), lambda p: _score(url, p))


def _score(url: Column, p: Column) -> Column:
    score = _points(p["scheme"], (p["path"] != "/") & ~p["path"].endswith("/"), p["query"])
    return F.when(F.coalesce(url, F.lit("")) != "", F.when(p.isNull(), 0).otherwise(score))


def form_preference(forms: Column) -> Column:
    """preference() of url_forms(): for min_by over normal forms."""
    return F.struct((-F.coalesce(forms["score"], F.lit(-1))).alias("s"), F.length(forms["normal"]).alias("l"), forms["normal"].alias("u"))


def preference(url: Column, parts: Column | None = None) -> Column:
    """The smaller, the better: for min_by. Higher score, then shorter, then first in order. parts: the URL's
    parse_url, where it is known."""
    score = url_score(url) if parts is None else _score(url, parts)
    return F.struct((-F.coalesce(score, F.lit(-1))).alias("s"), F.length(url).alias("l"), url.alias("u"))


def ascii_hosts(url: Column) -> Column:
    """url with a host beyond ASCII as punycode; as it is where there is no such form. To be applied
    in a projection of its own, where URLs come in: the engine takes it for nondeterministic."""
    cut = r"^([A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?)([^/?#:@]*)(.*)$"
    name = F.try_reflect(F.lit("java.net.IDN"), F.lit("toASCII"), F.lower(F.regexp_extract(url, cut, 2)))
    whole = F.concat(F.regexp_extract(url, cut, 1), name, F.regexp_extract(url, cut, 3))
    return F.when(F.regexp_extract(url, cut, 2).rlike(r"[^\x00-\x7f]"), F.coalesce(whole, url)).otherwise(url)


def is_number(text: Column) -> Column:
    return F.trim(text).try_cast("double").isNotNull()


def url_aliases(url: Column) -> Column:
    """The normal forms by which a page may be known: its own and those with http and https."""

    return F.transform(alias_forms(url), lambda x: x["normal"])


def alias_forms(url: Column) -> Column:
    """ARRAY<STRUCT<normal, key>>: url_aliases and the url_key of each, by parsing once. What is no web URL
    has its own normal form only."""

    def form(p: Column, scheme: Column, port: str, rest: Column) -> Column:
        user = F.when(p["user"] == "", "").otherwise(F.concat(p["user"], F.lit("@")))
        place = F.concat(p["host"], F.when((p["port"] == "") | (p["port"] == port), "").otherwise(F.concat(F.lit(":"), p["port"])))
        return F.struct(F.concat(scheme, F.lit("://"), user, place, rest).alias("normal"), F.concat(place, rest).alias("key"))

    def web(p: Column) -> Column:
        def by(rest: Column) -> Column:
            http, https = form(p, F.lit("http"), "80", rest), form(p, F.lit("https"), "443", rest)
            return F.array_distinct(F.when(p["scheme"] == "http", F.array(http, https)).otherwise(F.array(https, http)))

        path = let(_named(p), lambda named: F.when(named == "", "/").otherwise(named))
        return let(F.concat(path, p["query"], F.when(p["hash"].rlike(ROUTE), p["hash"]).otherwise("")), by)

    def other(normal: Column) -> Column:
        return F.filter(F.array(F.struct(normal.alias("normal"), url_key(normal).alias("key"))), lambda x: x["normal"] != "")

    return let(parse_url(url), lambda p: F.when(p["scheme"].isin("http", "https"), web(p)).otherwise(let(normalize_url(url), other)))


def comparable_host(url: Column) -> Column:
    return let(parse_url(url), host_of)


def host_of(p: Column) -> Column:
    """comparable_host() of a parsed URL."""
    return F.coalesce(F.regexp_replace(p["host"], r"^www\.", ""), F.lit(""))


def segments(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda x: x != "")


def plain_segment(segment: Column) -> Column:
    """A segment percent-decoded, in lower case; as it is where decoding fails."""
    return F.lower(F.coalesce(F.try_url_decode(F.replace(segment, F.lit("+"), F.lit("%2B"))), segment))


def file_extension(url: Column) -> Column:
    last = lambda p: F.regexp_extract(p["path"], r"([^/]*)/*$", 1)
    return let(parse_url(url), lambda p: F.coalesce(F.lower(F.regexp_extract(last(p), r"^.+(\.[^.]*)$", 1)), F.lit("")))


def skippable(href: Column) -> Column:
    h = F.trim(F.coalesce(href, F.lit("")))
    return (h == "") | h.rlike(r"(?i)^(#|javascript:|mailto:|tel:|data:)")


def resolve_link(href: Column, base: Column) -> Column:
    """href as an absolute URL, seen from the page base; empty for what leads to no page."""
    joined = lambda b: let(parse_url(_joined(href, b)), whole_url)
    return F.when(skippable(href), "").otherwise(F.coalesce(let(parse_url(base), joined), F.lit("")))


def _joined(href: Column, b: Column) -> Column:
    """href as it reads after the parsed page b."""
    h = F.trim(F.coalesce(href, F.lit("")))
    folder = F.regexp_replace(b["path"], "[^/]*$", "")
    return (
        F.when(h.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), h)
        .when(h.startswith("//"), F.concat(b["scheme"], F.lit(":"), h))
        .when(h.startswith("/"), F.concat(_root(b), h))
        .when(h.startswith("?"), F.concat(_root(b), b["path"], h))
        .otherwise(F.concat(_root(b), folder, h))
    )


def whole_url(p: Column) -> Column:
    """A parsed URL as text."""
    return F.concat(_root(p), p["path"], p["query"], p["hash"])


def with_resolved(df: DataFrame, href: str, base: str, name: str) -> DataFrame:
    """df with resolve_link() of the column href, seen from the parsed URLs in the column base, as the column
    `name`: compiled, as with_parts()."""
    whole = F.when(~skippable(F.col(href)), _joined(F.col(href), F.col(base)))
    df = with_parts(df, _resolved=whole)
    return df.select(*[c for c in df.columns if c != "_resolved"], F.coalesce(whole_url(F.col("_resolved")), F.lit("")).alias(name))


def is_mobile_user_agent(agent: Column) -> Column:
    return F.coalesce(agent, F.lit("")).rlike("(?i)mobile|android|iphone|ipad|ipod")


def mask_password(url: Column) -> Column:
    return F.regexp_replace(url, r"^([^:/]+://[^:@/]*):[^@]*@", "$1:***@")
