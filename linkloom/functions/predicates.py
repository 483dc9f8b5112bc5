"""What kind of page a URL or an anchor text leads to: boolean columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules as R
from .base import any_of, contains_any, given, in_domain, in_domains, let
from .rules import CONFIGURED, RuleSet
from .text import match_form
from .urls import comparable_host, host_of, parse_url, plain_segment, segments


def is_likely_job_link(url: Column, rules: RuleSet = CONFIGURED) -> Column:
    low = F.lower(F.coalesce(url, F.lit("")))
    return (
        F.when((low == "") | low.startswith("javascript:") | low.contains("emailme.asp") | low.rlike(r"jobcode=0(?!\d)"), False)
        .when(low.rlike(r"/jobs?(/|\?|$)"), True)
        .when(contains_any(low, rules.strong), True)
        .when(contains_any(low, rules.excluded), False)
        .otherwise(contains_any(low, rules.weak))
    )


def is_job_detail(url: Column) -> Column:
    return F.lower(F.coalesce(url, F.lit(""))).rlike(R.JOB_DETAIL)


def is_ats_link(url: Column, parts: Column | None = None) -> Column:
    """Does the URL lead to a hosted job board? parts: its parse_url, where it is known."""

    def judged(p: Column) -> Column:
        host = F.regexp_replace(p["host"], r"^www\.", "")
        path, both = F.lower(p["path"]), F.lower(F.concat(p["path"], p["query"]))
        starts = lambda *x: F.coalesce(host.rlike("^" + any_of(x)), F.lit(False))
        sure = (
            in_domain(host, "jobs.lever.co")
            | in_domains(host, ("myworkdayjobs.com", "myworkdaysite.com"))
            | (in_domain(host, "entertimeonline.com") & path.rlike(r"/ta/[^/]+\.careers"))
            | (in_domains(host, ("oraclecloud.com", "oraclecloudapps.com")) & path.contains("/hcmui/candidateexperience/"))
            | (in_domain(host, "workforcenow.adp.com") & path.contains("recruitment/recruitment.html"))
            | (in_domain(host, "greenhouse.io") & (starts("boards.", "job-boards.") | path.rlike(r"/(jobs|embed/job_board|job_board|board)")))
            | (in_domain(host, "icims.com") & (starts("jobs.") | path.rlike(r"/jobs?(/|$)")))
            | (in_domain(host, "brassring.com") & both.rlike(r"(/tgnewui/|/search/home|homewithpreload|partnerid=|siteid=)"))
            | (in_domain(host, "taleo.net") & both.rlike(r"(careersection|jobdetail|search\.ftl|requisition|jobsearch)"))
            | (in_domains(host, ("successfactors.com", "successfactors.eu", "successfactors.cn")) & both.rlike(r"(career|jobs?|career_ns|company=)"))
            | (in_domains(host, ("dayforcehcm.com", "dayforce.com")) & both.rlike(r"(candidateportal|careers?|jobs?|recruiting)"))
            | (in_domain(host, "jobvite.com") & (starts("jobs.") | path.rlike(r"/(job|jobs|careers?|openings?)")))
            | host.rlike(r".\." + any_of(R.ATS_HOSTED) + "$")
        )
        hinted = both.rlike(R.ATS_PATH_HINT) | both.rlike(R.ATS_QUERY_HINT) | host.rlike(R.ATS_HOST_HINT) | (in_domain(host, "smartrecruiters.com") & ((path != "/") | starts("careers.", "jobs.")))
        page = p["scheme"].isin("http", "https") & (host != "") & ~path.rlike(R.FILE_PATH)
        return page & (sure | (in_domains(host, R.ATS_DOMAINS) & hinted))

    return given(parts, parse_url(url), lambda p: F.coalesce(p.isNotNull() & judged(p), F.lit(False)))


def is_job_board_landing(url: Column, ats: Column | None = None, parts: Column | None = None) -> Column:
    """ats: is_ats_link of the URL, parts: its parse_url, where they are known."""
    low = F.lower(F.coalesce(url, F.lit("")))

    def hosted(p: Column) -> Column:
        oracle = p["host"].contains("oraclecloud.com") & F.lower(p["path"]).rlike(r"/hcmui/candidateexperience/[^/]+/sites/[^/]+(/jobs)?/?$")
        return (p["host"].contains("myworkdayjobs.com") & ~is_job_detail(url)) | oracle

    return F.when((is_ats_link(url) if ats is None else ats) | low.rlike(R.BOARD_LANDING), True).otherwise(given(parts, parse_url(url), lambda p: F.coalesce(p.isNotNull() & hosted(p), F.lit(False))))


def is_external(url: Column, page_url: Column) -> Column:
    a, b = comparable_host(url), comparable_host(page_url)
    return (a != "") & (b != "") & (a != b)


def is_bot_challenge(url: Column) -> Column:
    return contains_any(F.lower(F.coalesce(url, F.lit(""))), R.CHALLENGES)


def is_challenge_page(links: Column, challenges: Column, job_links: Column) -> Column:
    """From a page's counts: does it answer with a bot challenge?"""
    return (links > 0) & (job_links == 0) & (challenges > 0) & ((links <= 3) | (challenges >= links))


def is_sparse_page(url: Column, links: Column, host: Column) -> Column:
    """Has a fetched page (its links as an array) so few links, or no job-like ones where they are to be
    expected, that it was perhaps read too early?"""
    n, job_like = F.size(F.coalesce(links, F.expr("cast(array() as array<string>)"))), F.exists(links, lambda x: x.rlike("(?i)/job/|/jobs/|jobdetails|requisition|opening|position|apply"))
    vendor = host.contains("myworkdayjobs.com") | (host.contains("oraclecloud.com") & F.lower(url).contains("/hcmui/candidateexperience/"))
    return (n <= 1) | (~F.coalesce(job_like, F.lit(False)) & ((n <= 10) | F.coalesce(vendor, F.lit(False))))


def excluded_host_pattern(url: Column, rules: RuleSet = CONFIGURED, parts: Column | None = None) -> Column:
    """The first pattern, in the order of the list, that the host holds; null for none. parts: the URL's
    parse_url, where it is known."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(F.trim(F.coalesce(url, F.lit("")))), r"^[a-z][a-z0-9+.-]*://", ""), r"[/?#].*$", "")
    parsed = comparable_host(url) if parts is None else host_of(parts)
    host = F.regexp_replace(F.coalesce(F.nullif(parsed, F.lit("")), plain), r"^www\.", "")
    first = lambda h: F.coalesce(*[F.when(h.contains(p), p) for p in rules.excluded_hosts], F.lit(None).cast("string"))
    if parts is not None:
        return F.when(contains_any(host, rules.excluded_hosts), let(host, first))
    return let(host, first)


def has_strong_signal(text: Column) -> Column:
    return F.lower(text).rlike(R.STRONG_SIGNAL) | F.lower(text).rlike(R.ATS_QUERY_HINT)


def has_career_signal(url: Column, ats: Column | None = None) -> Column:
    """ats: is_ats_link of the URL, where it is known."""
    low = F.lower(F.coalesce(url, F.lit("")))
    return (low != "") & ((is_ats_link(url) if ats is None else ats) | low.rlike(R.CAREER_PATH_HINT) | has_strong_signal(low))


def has_hard_terminal(path: Column) -> Column:
    """Does the path end in, or is it, what no careers page is called?"""
    clean = F.filter(F.transform(segments(path), lambda x: F.regexp_replace(plain_segment(x), "[^a-z0-9]", "")), lambda x: x != "")
    hard = lambda x: x.isin(*R.HARD_NON_CAREER)
    return let(clean, lambda s: (F.size(s) > 0) & (F.coalesce(hard(F.try_element_at(s, F.lit(-1))), F.lit(False)) | ((F.size(s) <= 2) & F.forall(s, hard))))


def is_non_career(url: Column, excluded: tuple[str, ...] = R.NON_CAREER, parts: Column | None = None) -> Column:
    """parts: the URL's parse_url, where it is known."""
    low = F.lower(F.trim(F.coalesce(url, F.lit(""))))

    def judged(p: Column) -> Column:
        both = F.when(p.isNull(), low).otherwise(F.lower(F.concat(p["path"], p["query"], p["hash"])))
        path = F.when(p.isNull(), "").otherwise(F.lower(p["path"]))

        def by(text: Column) -> Column:
            hard, signal = has_hard_terminal(path), has_strong_signal(text)
            return path.rlike(R.FILE_PATH) | (~signal & hard) | (contains_any(text, excluded) & (~signal | hard))

        return let(both, by) if parts is None else by(both)

    return F.when((low == "") | low.rlike("^(javascript|mailto|tel):"), True).otherwise(given(parts, parse_url(url), judged))


def is_non_job_text(text: Column, rules: RuleSet = CONFIGURED) -> Column:
    def judged(t: Column) -> Column:
        words = F.split(t, " ")
        stops = (F.size(words) <= 4) & F.forall(words, lambda w: w.isin(*R.STOP_TEXT))
        return F.when((t == "") | (F.length(t) > 140), False).when(contains_any(t, rules.job_text), False).when(contains_any(t, rules.non_job_text), True).otherwise(stops)

    return let(match_form(text), judged)


def is_social(host: Column, page_host: Column, rules: RuleSet = CONFIGURED) -> Column:
    """Is the host a social network's, other than the one the page is on itself?"""
    other = lambda h, own: F.exists(F.lit(list(rules.social)), lambda d: h.contains(d) & ~(own.contains(d)))
    return let(host, lambda h: F.when(~contains_any(h, rules.social), False).otherwise(let(page_host, lambda own: other(h, own))))
