"""Hosted job boards: the board behind a link, its vendor, and how good a careers URL is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules as R
from .base import given, in_domain, in_domains, let
from .predicates import has_career_signal, is_ats_link, is_non_career
from .urls import comparable_host, host_of, normalize_url, parse_url, plain_segment, segments


def ats_canonical(url: Column, parts: Column | None = None) -> Column:
    """The landing page of the board that a link belongs to; empty where it isn't http(s). parts: the URL's
    parse_url, where it is known."""

    def built(p: Column) -> Column:
        host = F.regexp_replace(p["host"], r"^www\.", "")

        def by(s: Column) -> Column:
            low = F.transform(s, plain_segment)
            first, second = F.get(low, F.lit(0)), F.get(low, F.lit(1))
            n = F.size(s)
            take = lambda k: F.slice(s, 1, k)
            none = F.slice(s, 1, 0)
            job = lambda x: F.coalesce(x.isin("job", "jobs"), F.lit(False))
            named = F.filter(s, lambda x, i: ~plain_segment(x).isin(*R.BOARD_ROUTE_WORDS) & F.forall(F.slice(low, F.lit(1), i), lambda y: y.isin(*R.BOARD_ROUTE_WORDS)))
            last, before = F.try_element_at(low, F.lit(-1)), F.try_element_at(low, F.lit(-2))
            detail = last.rlike("^([a-f0-9]{8,}|[a-f0-9-]{12,}|[0-9]{4,})$") | last.isin(*R.DETAIL_WORDS) | before.isin(*R.CONTAINER_WORDS)
            return (
                F.when(in_domain(host, "jobs.lever.co"), take(1))
                .when(in_domain(host, "greenhouse.io") & host.rlike(r"^(boards|job-boards)\."), F.slice(named, 1, 1))
                .when(in_domain(host, "greenhouse.io"), F.when(job(first), none).otherwise(take(1)))
                .when(in_domains(host, ("myworkdayjobs.com", "myworkdaysite.com")) & (n >= 2) & first.rlike("^[a-z]{2}(-[a-z]{2})?$"), F.when(job(second), take(1)).otherwise(take(2)))
                .when(in_domains(host, ("myworkdayjobs.com", "myworkdaysite.com")), F.when(job(first), none).otherwise(take(1)))
                .when(in_domains(host, ("oraclecloud.com", "oraclecloudapps.com")) & (first == "hcmui") & (second == "candidateexperience"), F.when((n >= 5) & (F.get(low, F.lit(3)) == "sites"), take(5)).otherwise(take(4)))
                .when(in_domain(host, "workforcenow.adp.com") & F.lower(p["path"]).contains("recruitment/recruitment.html"), s)
                .when(in_domain(host, "entertimeonline.com"), F.when((n >= 2) & (first == "ta"), take(2)).otherwise(take(1)))
                .when((n >= 2) & F.coalesce(detail, F.lit(False)), F.slice(s, F.lit(1), n - 1))
                .otherwise(s)
            )

        adp = in_domain(host, "workforcenow.adp.com") & F.lower(p["path"]).contains("recruitment/recruitment.html")
        # Only lower-case spellings of the keys are looked up.
        keys = [F.regexp_extract(p["query"], rf"[?&]({k}=[^&]*)", 1) for k in ("cid", "ccid", "type", "lang")]
        kept = F.filter(F.array(*keys), lambda x: x != "")
        query = F.when(adp & (F.size(kept) > 0), F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
        place = F.concat(p["host"], F.when(p["port"] == "", "").otherwise(F.concat(F.lit(":"), p["port"])))
        return F.concat(F.lit("https://"), place, F.lit("/"), F.array_join(let(segments(p["path"]), by), "/"), query)

    return given(parts, parse_url(url), lambda p: F.when(p["scheme"].isin("http", "https"), built(p)).otherwise(""))


def template_name(host: Column) -> Column:
    name = F.regexp_replace(F.lower(host), r"^jobs\.", "")
    name = F.regexp_replace(name, r"\.(com|net|org|io|ai|co|hr|us|de|eu|cn)$", "")
    return F.regexp_replace(F.regexp_replace(name, "[^a-z0-9]+", "_"), "^_+|_+$", "")


def ats_template(url: Column, parts: Column | None = None) -> Column:
    """The vendor's name; empty for what is no hosted board. parts: the URL's parse_url, where it is known."""

    def named(host: Column) -> Column:
        out = F.when(~is_ats_link(url, parts), "")
        for template, domains in R.ATS_TEMPLATES:
            out = out.when(in_domains(host, domains), template)
        domain = F.filter(F.lit(list(R.ATS_DOMAINS)), lambda d: (host == d) | F.endswith(host, F.concat(F.lit("."), d)))
        return out.otherwise(template_name(F.coalesce(F.get(domain, F.lit(0)), host)))

    return let(comparable_host(url), named) if parts is None else named(host_of(parts))


def career_score(url: Column, base: Column) -> Column:
    """How likely the URL is the careers page of the site base; null for never."""

    def scored(n: Column) -> Column:
        def by(p: Column) -> Column:
            both = F.lower(F.concat(p["path"], p["query"]))
            last = F.coalesce(F.try_element_at(segments(p["path"]), F.lit(-1)), F.lit(""))
            words = F.size(F.filter(F.split(last, "[-_]+"), lambda x: F.trim(x) != ""))
            strong, support = both.rlike(R.STRONG_CAREER_PATH), both.rlike(R.SUPPORTING_CAREER_PATH)
            plus = lambda test, points: F.when(test, points).otherwise(0)
            score = (
                plus((F.coalesce(base, F.lit("")) != "") & (host_of(p) == comparable_host(base)), 20)
                + plus(p["scheme"] == "https", 8)
                + plus(p["query"] == "", 3)
                + plus(is_ats_link(n, p), 200)
                + F.when(strong, 120).when(support | has_career_signal(n, is_ats_link(n, p)), 45).otherwise(0)
                + plus(both.rlike(R.LISTING_PATH), 15)
                - plus(both.rlike(R.ARTICLE_PATH), 90)
                - plus(F.length(last) > 40, 20)
                - plus(words > 4, 25)
            )
            return F.when(p.isNotNull() & (strong | support | ~is_non_career(n, parts=p)), score)

        return let(parse_url(n), by)

    return let(normalize_url(url), scored)
