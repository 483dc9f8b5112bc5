"""Records of pages: statuses, redirects, the careers URL, the page table."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.ats import ats_canonical, ats_template, career_score
from ..functions.base import let, settled, shared
from ..functions.html import page_title, text_sample
from ..functions.predicates import excluded_host_pattern, is_ats_link, is_bot_challenge, is_challenge_page, is_job_board_landing, is_job_detail, is_likely_job_link, is_non_job_text, is_social
from ..functions.rules import CONFIGURED, RuleSet
from ..functions.text import match_form
from ..functions.urls import alias_forms, form_preference, host_of, normalize_url, preference, url_forms, url_key, with_forms, with_parts
from . import links as L


def career_status(excluded: Column, details: Column, expired: Column, boards: Column) -> Column:
    """One status of a page's flags, the first that holds."""
    return (
        F.when(excluded, "excluded_domain").when(details, "job_links_found").when(expired, "expired_or_no_jobs").when(boards, "ats_career_links_found").otherwise("no_job_links")
    )


def redirect_summary(steps: Column, status: Column, request: Column, final: Column) -> Column:
    """STRUCT of a redirect chain, an array of (url, status_code, location), by its codes."""
    codes = F.filter(F.transform(F.slice(steps, 1, 20), lambda s: s["status_code"]), lambda c: c > 0)
    count = F.greatest(F.size(steps) - 1, F.lit(0))
    return F.struct(
        codes.alias("codes"), count.alias("redirects"),
        ((count > 0) | (normalize_url(final) != normalize_url(request))).alias("redirected"),
        F.coalesce(F.get(codes, F.lit(0)), status).alias("initial_status"),
    )


def best_attempt(attempts: DataFrame, by: str) -> DataFrame:
    """Of a page's attempts (attempt, likely, links) the first with several links and a likely job;
    else that with most likely jobs, then links; of equal ones the first."""
    good = (F.col("attempt") == 1) & (F.col("links") > 1) & (F.col("likely") >= 1)
    order = F.struct(good.alias("g"), F.col("likely"), F.col("links"), -F.col("attempt"))
    return attempts.groupBy(by).agg(F.max_by(F.struct("attempt", "likely", "links"), order).alias("b")).select(by, "b.*")


def expiry_phrases(text: Column, rules: RuleSet = CONFIGURED, most: int = 8) -> Column:
    """The rules' expiry phrases in a text, in the order in which their first words stand in it, at
    most `most` (the report's length).

    A phrase is looked up by its first two words, which have to be words of the text, and then
    has to stand in it. Of phrases with one normal form the first counts."""
    return let(match_form(text), lambda form: phrases_of_form(form, rules, most))


def phrases_of_form(form: Column, rules: RuleSet = CONFIGURED, most: int = 8) -> Column:
    """expiry_phrases() of a text whose match_form is known: each phrase is searched for once."""
    known: dict[str, tuple[str, str]] = {}
    for phrase in rules.expiry:
        words = re.findall("[a-z0-9]+", phrase.lower().replace("&nbsp;", " "))
        if len(plain := " ".join(words)) >= 3:
            known.setdefault(plain, (phrase.strip(), " ".join(words[:2])))
    if not known:
        return F.expr("cast(array() as array<string>)")

    def hit(padded: Column, i: int, plain: str, phrase: str, key: str) -> Column:
        struct = lambda at: F.struct(at.alias("at"), F.lit(key.count(" ")).alias("words"), F.lit(i).alias("place"), F.lit(phrase).alias("phrase"))
        return let(F.instr(padded, f" {key} "), lambda at: F.when((at > 0) if plain == key else (at > 0) & padded.contains(plain), struct(at)))

    def found(padded: Column) -> Column:
        hits = F.array(*[hit(padded, i, plain, phrase, key) for i, (plain, (phrase, key)) in enumerate(known.items())])
        return F.slice(F.transform(F.array_sort(F.array_compact(hits)), lambda x: x["phrase"]), 1, most)

    # Most texts hold no phrase: one look for the first words is dealt with before the places are asked for.
    padded, none = F.concat(F.lit(" "), form, F.lit(" ")), F.expr("cast(array() as array<string>)")
    keys = sorted({key for _, key in known.values()})
    return F.when(reduce(or_, [padded.contains(f" {key} ") for key in keys]), let(padded, found)).otherwise(none)


def whole_text(title: Column, text: Column) -> Column:
    """What expiry phrases are looked up in."""
    return F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(text, F.lit("")))


def expiry_verdict(text: Column, title: Column, status: Column, rules: RuleSet = CONFIGURED, most: int = 8) -> Column:
    """STRUCT<status_code, fast_hint_matched, status_code_expired, matched_keywords,
    matched_keyword_count, is_expired_or_no_jobs> of a page: an error status or a phrase makes
    it expired, the hint is for information."""
    whole = whole_text(title, text)
    code = F.coalesce(status, F.lit(0)).cast("int")

    def judged(form: Column, m: Column) -> Column:
        return F.struct(
            code.alias("status_code"), form.rlike(R.EXPIRY_HINT).alias("fast_hint_matched"), (code >= 400).alias("status_code_expired"),
            m.alias("matched_keywords"), F.size(m).alias("matched_keyword_count"), ((code >= 400) | (F.size(m) > 0)).alias("is_expired_or_no_jobs"),
        )

    return let(match_form(whole), lambda form: let(phrases_of_form(form, rules, most), lambda m: judged(form, m)))


def expiry_matches(texts: DataFrame, by: str, rules: RuleSet = CONFIGURED, title: str = "title", text: str = "text", most: int = 8) -> DataFrame:
    """(by, matches) of the texts that hold a phrase: one scan, no join."""
    whole = F.concat_ws(" ", F.col(title), F.col(text))
    return settled(texts.select(by, expiry_phrases(whole, rules, most).alias("matches"))).where(F.size("matches") > 0)


def resolved_career_url(base: Column, final: Column, links: Column, boards: Column, ats: Column | None = None) -> Column:
    """The preferred board (of the final URL, if it is one, and of boards), else the best careers link,
    else base. All of one row: arrays of a page's links, no join. ats: is_ats_link of final, where it is known."""
    canonical = F.filter(F.transform(F.concat(F.when(is_ats_link(final) if ats is None else ats, F.array(final)).otherwise(F.expr(_NO_LINKS)), boards), lambda u: ats_canonical(u)), lambda x: x != "")
    board = F.array_min(F.transform(F.transform(canonical, url_forms), form_preference))["u"]
    scored = F.transform(links, lambda u: F.struct((-career_score(u, base)).alias("s"), preference(u).alias("p")))
    best = F.array_min(F.filter(scored, lambda x: x["s"] <= -60))["p"]["u"]
    return F.coalesce(board, best, base)


def final_career_url(pages: DataFrame, links: DataFrame, boards: DataFrame) -> DataFrame:
    """(page_id, final_career_url): the preferred board, else the best careers link, else the page.

    pages (page_id, url, final_url), links and boards (page_id, url)."""
    each = lambda x, name: L.dedupe_links(x.select("page_id", "url", F.lit(0).alias("pos")), ["page_id"]).groupBy("page_id").agg(F.collect_list("url").alias(name))
    fallback = F.coalesce(F.nullif(normalize_url(F.col("final_url")), F.lit("")), normalize_url(F.col("url")))
    out = pages.select("page_id", "final_url", fallback.alias("base")).join(each(links, "l"), "page_id", "left").join(each(boards, "b"), "page_id", "left")
    none = F.expr(_NO_LINKS)
    return out.select("page_id", resolved_career_url(F.col("base"), F.col("final_url"), F.coalesce("l", none), F.coalesce("b", none)).alias("final_career_url"))


#: What a page may come with besides page_id, url and html.
FETCHED = {
    "final_url": "string", "status_code": "int", "redirect_chain": "array<struct<url:string,status_code:int,location:string>>", "error": "string", "user_agent": "string",
    "started_at": "timestamp_ntz", "fetched_at": "timestamp_ntz",
}
_NO_LINKS = "cast(array() as array<string>)"


def normalized_steps(steps: Column) -> Column:
    """A redirect chain with normal URLs and no nulls, without steps that have neither URL nor status."""
    none = F.expr(f"cast(array() as {FETCHED['redirect_chain']})")
    fixed = lambda x: F.struct(
        F.coalesce(F.nullif(normalize_url(x["url"]), F.lit("")), x["url"], F.lit("")).alias("url"), F.coalesce(x["status_code"], F.lit(0)).alias("status_code"), F.coalesce(x["location"], F.lit("")).alias("location")
    )
    return F.filter(F.transform(F.coalesce(steps, none), fixed), lambda x: (x["url"] != "") | (x["status_code"] > 0))


def page_facts(pages: DataFrame, rules: RuleSet = CONFIGURED, most: int = 8) -> DataFrame:
    """Each page's own columns, by one projection that leaves the HTML behind: URLs, exclusions,
    redirects, title, expiry. Columns of FETCHED that pages lack are null."""
    given = pages.select("page_id", "url", "html", *[F.col(c) if c in pages.columns else F.lit(None).cast(t).alias(c) for c, t in FETCHED.items()])
    # Where no page was led elsewhere both URLs are one.
    if "final_url" in pages.columns:
        given = with_forms(given, own=F.col("url"), final=F.coalesce(F.when(F.col("final_url") != "", F.col("final_url")), F.col("url")))
        given = with_parts(given, own_parts=F.col("own.normal"), final_parts=F.col("final.normal"))
    else:
        given = with_parts(with_forms(given, own=F.col("url")), own_parts=F.col("own.normal"))
        given = given.select("*", F.col("own").alias("final"), F.col("own_parts").alias("final_parts"))
    chain = normalized_steps(F.col("redirect_chain"))
    given = given.withColumn("redirect_chain", chain)
    steps = F.slice("redirect_chain", 1, 20)
    codes = F.filter(F.transform(steps, lambda x: x["status_code"]), lambda c: c > 0)
    redirects = F.greatest(F.size("redirect_chain") - 1, F.lit(0))
    status = F.coalesce("status_code", F.lit(0))
    # Of the page's two URLs the preferred one.
    career = F.array_min(F.array(*[F.struct(form_preference(F.col(c)).alias("p"), F.col(c).alias("f")) for c in ("own", "final")]))["f"]
    given = given.select("*", F.substring(page_title(F.col("html")), 1, 300).alias("title"))
    title = F.col("title")
    given = given.select("*", match_form(whole_text(title, text_sample(F.col("html")))).alias("form"))
    return given.select(
        "page_id", F.col("url").alias("request_url"), F.col("own.normal").alias("url"), F.col("own.key").alias("own_key"), F.col("final.normal").alias("final_url"), F.col("final.key").alias("final_key"),
        career["normal"].alias("career_url"), career["key"].alias("career_url_key"), "error", "user_agent", "started_at", "fetched_at", status.alias("http_status_code"),
        F.when(F.size(codes) > 0, F.get(codes, F.lit(0))).otherwise(status).alias("initial_http_status_code"), steps.alias("redirect_chain"), codes.alias("redirect_status_codes"), redirects.alias("redirect_count"),
        ((redirects > 0) | (F.col("own.normal") != F.col("final.normal"))).alias("redirected"), F.coalesce(title, F.lit("")).alias("page_title"),
        excluded_host_pattern(F.col("own.normal"), rules, F.col("own_parts")).alias("excluded_source"), excluded_host_pattern(F.col("final.normal"), rules, F.col("final_parts")).alias("excluded_final"),
        is_ats_link(F.col("final.normal"), F.col("final_parts")).alias("final_ats"), host_of(F.col("own_parts")).alias("page_host"), phrases_of_form(F.col("form"), rules, most).alias("phrases"),
    )


def _flagged(links: DataFrame, rules: RuleSet) -> DataFrame:
    """links (page_id, key, url, pos, texts, gained, page_host) with what decides about them. A URL is parsed once."""
    url, p = F.col("url"), F.col("parts")
    links = with_parts(links, parts=url)
    links = links.select("*", host_of(p).alias("host"), is_likely_job_link(url, rules).alias("likely"), is_ats_link(url, p).alias("ats"))
    links = links.select("*", (F.col("likely") | is_job_board_landing(url, F.col("ats"), p)).alias("board"))
    near = (F.col("page_host") == "") | ((F.col("host") != "") & ((F.col("host") == F.col("page_host")) | F.col("board")))
    here = F.col("gained") | (near & ~is_social(F.col("host"), F.col("page_host"), rules))
    none = (F.size("texts") > 0) & F.forall("texts", lambda t: is_non_job_text(t, rules))
    links = links.select("*", here.alias("here"), none.alias("texts_none"))
    links = links.select("*", (F.col("here") & (F.col("gained") | ~F.col("texts_none") | F.col("likely") | F.col("ats"))).alias("kept"))
    links = links.select("*", (F.col("kept") & (F.col("likely") | F.col("gained"))).alias("is_job"))
    why = F.when(F.col("ats"), F.coalesce(L.ats_reason(url, rules, F.col("ats"), p), F.lit("")))
    links = links.select("*", why.alias("ats_why"), L.career_reason(url, F.col("is_job"), rules, F.col("ats"), p).alias("career_why"))
    return links.select("*", F.when(F.col("ats_why") == "", ats_canonical(url, p)).alias("board_url"))


def career_links(pages: DataFrame, rules: RuleSet = CONFIGURED, expand: bool = False, most_boards: int = 1, existing: DataFrame | None = None, most_phrases: int = 8) -> DataFrame:
    """The page table: one row for each page (page_id, url, html, and what of FETCHED there is).

    Links go through the domain, social and text filters; job links, boards and careers
    links are told apart; boards may be expanded by one hop; the page's own URLs go; expiry is
    looked for where no job details are. Pages of excluded domains have no links, pages with an
    error none and the status error; one that answers with a bot challenge counts as an error.
    existing (career_url_key, links, job_links, ats_career_links): earlier rows, whose links are
    merged in. HTML is read once and stays in the scan; links are grouped by page twice."""
    facts = page_facts(pages, rules, most_phrases)
    own = facts.select("page_id", F.col("url").alias("page_url"), "page_host")
    raw = L.gathered_entries(L.link_entries(pages), ["page_id"]).withColumn("gained", F.lit(False))
    # Files tell nothing about how much is made of a row: no side is sent to all tasks.
    hosts = own.select("page_id", "page_host").hint("merge")
    if expand:
        raw = shared(raw, "page_id")
        jobs = _flagged(raw.join(hosts, "page_id"), rules).select("page_id", "pos", "url", "is_job")
        gained = with_forms(L.expand_boards(own.select("page_id", F.col("page_url").alias("url")), jobs, most_boards, rules), f=F.col("url"))
        gained = gained.select("page_id", F.col("f.key").alias("key"), "url", F.lit(1 << 30).alias("pos"), F.expr(_NO_LINKS).alias("texts"), F.lit(True).alias("gained"))
        raw = with_parts(raw.unionByName(gained), parts=F.col("url")).groupBy("page_id", "key").agg(
            F.min_by("url", preference(F.col("url"), F.col("parts"))).alias("url"), F.min("pos").alias("pos"), F.flatten(F.collect_list("texts")).alias("texts"), F.bool_or("gained").alias("gained")
        )
    rows = _flagged(raw.join(hosts, "page_id"), rules)
    entry = lambda test: F.collect_list(F.when(test, F.struct("pos", "key", "url")))
    rollup = rows.groupBy("page_id").agg(
        entry(F.col("kept") & F.col("career_why").isNull()).alias("stay"), entry(F.col("is_job")).alias("jobs"), F.collect_set("board_url").alias("boards"),
        F.count_if(F.col("here") & F.col("texts_none") & ~F.col("gained")).alias("text_filtered"), F.count_if(F.col("kept") & F.col("career_why").isNotNull()).alias("career_filtered"),
        F.count_if(F.coalesce(F.col("ats_why") != "", F.lit(False))).alias("ats_filtered"), F.count_if(~F.col("gained")).alias("raw_count"), F.count_if(~F.col("gained") & is_bot_challenge(F.col("url"))).alias("challenges"),
    )
    out = facts.join(rollup.hint("merge"), "page_id", "left")
    if existing is not None:
        before = existing.select("career_url_key", *[F.col(c).alias(f"old_{c}") for c in ("links", "job_links", "ats_career_links")])
        out = out.join(before, "career_url_key", "left")
    return _page_rows(out, existing is not None)


def _page_rows(out: DataFrame, merged: bool) -> DataFrame:
    none = F.expr(_NO_LINKS)
    urls_of = lambda c: F.transform(F.array_sort(F.coalesce(c, F.expr("cast(array() as array<struct<pos:int,key:string,url:string>>)"))), lambda x: x["url"])
    selves = F.array("own_key", "final_key", "career_url_key")

    def distinct(x: Column) -> Column:
        """Of the spellings of one page the preferred one, at the first's place."""

        def of(forms: Column) -> Column:
            keys = F.array_distinct(F.transform(forms, lambda f: f["key"]))
            return F.transform(keys, lambda k: F.array_min(F.transform(F.filter(forms, lambda f: f["key"] == k), form_preference))["u"])

        return let(F.transform(x, url_forms), of)

    failed = F.col("error").isNotNull()
    challenged = is_challenge_page(F.coalesce("raw_count", F.lit(0)), F.coalesce("challenges", F.lit(0)), F.size(F.coalesce("jobs", F.array())))
    excluded = F.col("excluded_source").isNotNull() | F.col("excluded_final").isNotNull()
    out = out.withColumns({"bot_challenge": challenged & F.col("excluded_source").isNull() & ~failed})
    failed = failed | F.col("bot_challenge")
    empty = excluded | failed
    out = out.withColumns({"failed": failed & F.col("excluded_source").isNull(), "pattern": F.when(~failed, F.coalesce("excluded_source", "excluded_final")), "empty": empty})
    old = lambda c: F.coalesce(f"old_{c}", none) if merged else none
    lists = {"job_links": distinct(F.concat(old("job_links"), urls_of("jobs"))) if merged else urls_of("jobs"), "ats_career_links": F.array_sort(F.coalesce("boards", none))}
    if merged:
        lists["ats_career_links"] = distinct(F.concat(old("ats_career_links"), lists["ats_career_links"]))
    out = out.withColumns({c: F.when(F.col("empty"), none).otherwise(x) for c, x in lists.items()})
    forced = F.concat(old("links"), urls_of("stay"), urls_of("jobs"), F.coalesce("boards", none))
    links = F.filter(distinct(forced), lambda u: ~F.array_contains(selves, url_key(u)))
    if not merged:  # without boards, equal keys have equal spellings
        empty_entries = F.expr("cast(array() as array<struct<pos:int,key:string,url:string>>)")
        entries = F.array_distinct(F.concat(F.array_sort(F.coalesce("stay", empty_entries)), F.array_sort(F.coalesce("jobs", empty_entries))))
        plain = F.transform(F.filter(entries, lambda x: ~F.array_contains(selves, x["key"])), lambda x: x["url"])
        links = F.when(F.size(F.coalesce("boards", none)) == 0, plain).otherwise(links)
    out = out.withColumn("links", F.when(F.col("empty"), none).otherwise(links))
    details = F.size(F.filter("job_links", is_job_detail))
    count = lambda c: F.when(F.col("empty"), 0).otherwise(F.coalesce(c, F.lit(0))).cast("long")
    out = out.withColumns({
        "link_count": F.size("links").cast("long"), "job_link_count": F.size("job_links").cast("long"), "ats_career_link_count": F.size("ats_career_links").cast("long"), "job_detail_link_count": details.cast("long"),
        "text_filtered_link_count": count("text_filtered"), "career_filtered_link_count": count("career_filtered"), "ats_filtered_link_count": count("ats_filtered"),
    })
    # Expiry counts only where no job details and no exclusion settle the page.
    looked = ~F.col("empty") & (F.col("job_detail_link_count") == 0)
    expired = F.when(looked, (F.col("http_status_code") >= 400) | (F.size("phrases") > 0)).otherwise(False)
    words = F.when(looked, F.slice("phrases", 1, 20)).otherwise(none)
    fallback = F.coalesce(F.nullif("final_url", F.lit("")), F.col("career_url"))
    out = out.withColumns({"expired_or_no_jobs": expired, "expire_keyword_matches": words, "base": fallback})
    out = out.withColumn("final_career_url", resolved_career_url(F.col("base"), F.col("final_url"), F.col("links"), F.col("ats_career_links"), F.col("final_ats")))
    out = with_parts(out, career_parts=F.col("final_career_url"))
    status = career_status(F.col("pattern").isNotNull(), F.col("job_detail_link_count") > 0, F.col("expired_or_no_jobs"), F.col("ats_career_link_count") > 0)
    has = {f"has_{c}": F.col(n) > 0 for c, n in (("job_links", "job_link_count"), ("job_detail_links", "job_detail_link_count"), ("ats_career_links", "ats_career_link_count"))}
    out = out.withColumns(has | {
        "career_links_status": F.when(F.col("failed"), "error").otherwise(status), "job_links_status": F.when(F.col("failed"), "error").when(F.col("job_link_count") > 0, "job_links_found").otherwise("no_job_links"),
        "crawl_status": F.when(F.col("failed"), "error").otherwise("success"), "source": F.when(F.col("excluded_source").isNotNull(), "rules").when(~F.col("failed"), "html"), "ats_template": ats_template(F.col("final_career_url"), F.col("career_parts")),
        "error": F.when(F.col("failed"), F.coalesce("error", F.lit("bot challenge"))), "expire_keyword_match_count": F.size("expire_keyword_matches").cast("long"), "excluded_domain_pattern": F.coalesce("pattern", F.lit("")),
    })
    return out.select("page_id", *PAGE_COLUMNS)


#: The page table besides page_id: URLs, links by kind, statuses, fetch.
PAGE_COLUMNS = (
    "career_url", "career_url_key", "request_url", "final_url", "final_career_url", "ats_template", "page_title", "links", "link_count", "job_links", "job_link_count", "has_job_links", "job_detail_link_count", "has_job_detail_links",
    "job_links_status", "ats_career_links", "ats_career_link_count", "has_ats_career_links", "career_links_status", "expired_or_no_jobs", "expire_keyword_matches", "expire_keyword_match_count", "excluded_domain_pattern",
    "text_filtered_link_count", "career_filtered_link_count", "ats_filtered_link_count", "http_status_code", "initial_http_status_code", "redirect_chain", "redirect_status_codes", "redirect_count", "redirected", "bot_challenge",
    "crawl_status", "source", "user_agent", "error", "started_at", "fetched_at",
)
#: What a failed fetch leaves as it was in a page's row, where rows are kept on errors.
KEPT_ON_ERROR = (
    "links", "link_count", "job_links", "job_link_count", "has_job_links", "job_detail_link_count", "has_job_detail_links", "ats_career_links", "ats_career_link_count", "has_ats_career_links", "final_career_url", "ats_template",
    "text_filtered_link_count", "career_filtered_link_count", "ats_filtered_link_count", "page_title", "source", "user_agent",
)


def stored_of(pages: DataFrame, stored: DataFrame) -> DataFrame:
    """(page_id, and the columns of stored) of the stored pages that a page (page_id, url) is known as: by
    the key or the URL of one of its aliases. One join on equal values, each row once; a URL is parsed once."""
    key, url = lambda x: F.concat(F.lit("k"), x), lambda x: F.concat(F.lit("u"), x)
    names = lambda f: F.array_distinct(F.concat(F.transform(f, lambda x: key(x["key"])), F.transform(f, lambda x: url(x["normal"]))))
    aliases = pages.select("page_id", F.explode(let(alias_forms(F.col("url")), names)).alias("_name"))
    known = stored.select("*", F.explode(F.array(key(F.col("career_url_key")), url(F.col("career_url")))).alias("_name"))
    return aliases.join(known, "_name").drop("_name").dropDuplicates(["page_id", "career_url_key", "career_url"])


def stored_pages(old: DataFrame, new: DataFrame, keep_on_error: bool = True) -> DataFrame:
    """The stored page table after new rows: by career_url_key, with created_at, last_success_at and
    last_error_at. A row of a failed fetch keeps the links there were, if asked for, and is
    inserted without any. Both sides hold each key once."""
    a, b = old.alias("a"), new.alias("b")
    both = a.join(b, F.col("a.career_url_key") == F.col("b.career_url_key"), "full_outer")
    came, failed, was = F.col("b.career_url_key").isNotNull(), F.col("b.crawl_status") == "error", F.col("a.career_url_key").isNotNull()

    def column(c: str) -> Column:
        kept = ~came | (failed & was if keep_on_error and c in KEPT_ON_ERROR else F.lit(False))
        return F.when(kept, F.col(f"a.{c}")).otherwise(F.col(f"b.{c}")).alias(c)

    times = [
        F.coalesce("a.created_at", "b.fetched_at").alias("created_at"), F.when(came & ~failed, F.col("b.fetched_at")).otherwise(F.col("a.last_success_at")).alias("last_success_at"),
        F.when(came & failed, F.col("b.fetched_at")).otherwise(F.col("a.last_error_at")).alias("last_error_at"),
    ]
    return both.select(*[column(c) for c in new.columns], *times)
