"""Relations of links: extraction, dedupe, filters, expansion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import html as H
from ..functions.base import let, settled, shared
from ..functions.ats import ats_canonical, career_score
from ..functions.predicates import has_career_signal, has_strong_signal, is_ats_link, is_job_board_landing, is_job_detail, is_likely_job_link, is_non_career, is_non_job_text, is_social
from ..functions.rules import CONFIGURED, RuleSet
from ..functions.text import collapse_space
from ..functions.urls import comparable_host, form_preference, host_of, preference, url_key, with_forms, with_parts, with_resolved


def link_entries(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html", same_domain_only: bool = False, stripped: bool = False) -> DataFrame:
    """(page, page_url, branch, pos, url, text) of every link of every page.

    Branches: 0 anchors (and URLs in their javascript: targets), 1 frames, 2 data attributes,
    3 event handlers. Of a page's equal (url, text) the first stays. One scan, one shuffle."""
    source = H.strip_scripts(H.strip_sections(F.col(html)) if stripped else F.col(html))
    none = F.expr("cast(array() as array<string>)")
    # Most pages lack what a pattern looks for in every tag: one search for its sure part settles that.
    found = lambda sure, pattern: F.when(F.col("source").rlike(sure), F.regexp_extract_all(F.col("source"), F.lit(pattern), F.lit(0))).otherwise(none)
    entry = lambda branch, raw, text: F.struct(F.lit(branch).alias("branch"), raw.alias("raw"), F.substring(collapse_space(text), 1, 240).alias("text"))

    def anchor(a: Column) -> Column:
        return let(H.attribute(a["attributes"], "href"), lambda href: opened(a, a["attributes"], href))

    def opened(a: Column, attributes: Column, href: Column) -> Column:
        text = F.coalesce(*[F.nullif(x, F.lit("")) for x in (H.plain_text(a["body"]), H.attribute(attributes, "aria-label"), H.attribute(attributes, "title"))], F.lit(""))
        inline = F.transform(F.when(F.lower(F.trim(href)).startswith("javascript:"), H.handler_links(href)).otherwise(none), lambda x: entry(0, x, text))
        return F.concat(F.array(entry(0, href, text)), inline)

    frames = F.transform(found("(?i)frame", r"(?is)<i?frame\b[^>]*>"), lambda x: entry(1, H.attribute(x, "src"), F.lit("")))
    data = F.flatten(F.transform(found("(?i)data-(?:href|url|link|job-url)", r"(?is)<[a-z][^>]*\bdata-(?:href|url|link|job-url)\s*=[^>]*>"), lambda x: F.array(*[entry(2, H.attribute(x, f"data-{n}"), F.lit("")) for n in ("href", "url", "link", "job-url")])))
    handlers = F.flatten(F.transform(found("(?i)on(?:click|keydown)", r"(?is)<[a-z][^>]*\bon(?:click|keydown)\s*=[^>]*>"), lambda x: F.transform(F.concat(*[H.handler_links(H.attribute(x, n)) for n in ("onclick", "onkeydown")]), lambda y: entry(3, y, F.lit("")))))
    pages = with_parts(pages.select(page, F.col(url).alias("page_url"), source.alias("source")), _base=F.col("page_url"))
    entries = F.concat(F.flatten(F.transform(H.anchors(F.col("source")), anchor)), frames, data, handlers)
    rows = pages.select(page, "page_url", "_base", F.posexplode(entries).alias("pos", "e")).select(page, "page_url", "_base", "e.branch", "pos", "e.raw", "e.text")
    rows = settled(with_resolved(rows, "raw", "_base", "url").select(page, "page_url", "branch", "pos", "url", "text")).where("url <> ''")
    if same_domain_only:
        rows = rows.where(comparable_host(F.col("url")) == comparable_host(F.col("page_url")))
    return rows.groupBy(page, "page_url", "url", "text").agg(F.min("branch").alias("branch"), F.min("pos").alias("pos"))


def dedupe_links(links: DataFrame, by: list[str], url: str = "url", pos: str = "pos") -> DataFrame:
    """(by, key, url, pos): of the spellings of one page the preferred one, at the first's place.

    The order of preference is total, so the choice is an aggregate that each task begins. A
    URL is parsed once."""
    rows = with_forms(links.where(F.trim(url) != "").select(*by, pos, F.col(url).alias("_link")), f=F.col("_link"))
    return rows.groupBy(*by, F.col("f.key").alias("key")).agg(F.min_by("f.normal", form_preference(F.col("f"))).alias("url"), F.min(pos).alias(pos))


def gathered_entries(entries: DataFrame, by: list[str]) -> DataFrame:
    """(by, key, url, pos, texts): as dedupe_links, with the distinct texts of the spellings."""
    rows = with_forms(entries.where(F.trim("url") != "").select(*by, "pos", "text", "url"), f=F.col("url"))
    return rows.groupBy(*by, F.col("f.key").alias("key")).agg(
        F.min_by("f.normal", form_preference(F.col("f"))).alias("url"), F.min("pos").alias("pos"), F.collect_set(F.nullif(F.trim("text"), F.lit(""))).alias("texts")
    )


def dedupe_entries(entries: DataFrame, by: list[str]) -> DataFrame:
    """(by, url, text): as dedupe_links, with every distinct text of the spellings, or ''."""
    return gathered_entries(entries, by).select(*by, "url", F.explode_outer("texts").alias("text")).withColumn("text", F.coalesce("text", F.lit("")))


def merged_pages(base: DataFrame, incoming: DataFrame, by: str = "page_id") -> DataFrame:
    """Two collections of one page (by, title, sample, entries as an array of (url, text)) as one:
    the incoming title and text where they are not empty, and the entries of both, each once."""
    a, b = base.alias("a"), incoming.alias("b")
    none = F.expr("cast(array() as array<struct<url:string,text:string>>)")
    either = lambda c: F.coalesce(F.nullif(F.col(f"b.{c}"), F.lit("")), F.col(f"a.{c}"), F.lit(""))
    both = a.join(b, F.col(f"a.{by}") == F.col(f"b.{by}"), "full_outer")
    return both.select(F.coalesce(f"a.{by}", f"b.{by}").alias(by), either("title").alias("title"), either("sample").alias("sample"), F.array_distinct(F.concat(F.coalesce("a.entries", none), F.coalesce("b.entries", none))).alias("entries"))


def same_domain(links: DataFrame, base: str = "page_url", keep_external: bool = True, rules: RuleSet = CONFIGURED) -> DataFrame:
    url = F.col("url")
    own = comparable_host(url) == comparable_host(F.col(base))
    board = is_likely_job_link(url, rules) | is_job_board_landing(url) | is_ats_link(url)
    return links.where((comparable_host(F.col(base)) == "") | ((comparable_host(url) != "") & (own | (board if keep_external else F.lit(False)))))


def drop_social(links: DataFrame, base: str = "page_url", rules: RuleSet = CONFIGURED) -> DataFrame:
    return links.where(~is_social(comparable_host(F.col("url")), comparable_host(F.col(base)), rules))


def flag_anchor_text(links: DataFrame, entries: DataFrame, by: list[str], rules: RuleSet = CONFIGURED) -> DataFrame:
    """links with texts and dropped: a link all of whose texts are no job's goes, unless the
    URL itself is a job link or a board."""
    texts = entries.where("text <> ''").groupBy(*by, "url").agg(F.count(F.lit(1)).alias("texts"), F.bool_and(is_non_job_text(F.col("text"), rules)).alias("none"))
    out = links.join(texts, [*by, "url"], "left")
    keeps = is_likely_job_link(F.col("url"), rules) | is_ats_link(F.col("url"))
    return out.withColumns({"texts": F.coalesce("texts", F.lit(0)), "dropped": F.coalesce("none", F.lit(False)) & ~keeps}).drop("none")


def career_reason(url: Column, forced: Column, rules: RuleSet = CONFIGURED, ats: Column | None = None, parts: Column | None = None) -> Column:
    """Why a link is no careers link; null where it is one. ats: is_ats_link, parts: parse_url, where they are known."""
    return F.when(forced, None).when(is_non_career(url, rules.non_career, parts), "non_career_pattern").when(~has_career_signal(url, ats), "not_career_like")


def ats_reason(url: Column, rules: RuleSet = CONFIGURED, ats: Column | None = None, parts: Column | None = None) -> Column:
    return (
        F.when(~(is_ats_link(url) if ats is None else ats), "not_ats")
        .when(is_non_career(url, rules.non_career, parts) & ~has_strong_signal(url), "non_career_pattern")
        .when(ats_canonical(url, parts) == "", "invalid_ats_url")
    )


def drop_self(links: DataFrame, selves: DataFrame, by: list[str]) -> DataFrame:
    """links without those that lead to the page itself; selves (by, url)."""
    keys = selves.select(*by, url_key(F.col("url")).alias("k")).distinct()
    return links.withColumn("k", url_key(F.col("url"))).join(keys, [*by, "k"], "left_anti").drop("k")


def without_sections(links: DataFrame, sections: DataFrame, by: list[str], url: str = "url") -> DataFrame:
    """links without those that the page's own sections (navigation, footer) have."""
    return links.join(sections.select(*by, url).distinct(), [*by, url], "left_anti")


def link_difference(new: DataFrame, old: DataFrame, by: list[str], url: str = "url") -> DataFrame:
    """The distinct links of new that old lacks; no rows where nothing is new."""
    return new.select(*by, url).where(F.coalesce(F.col(url), F.lit("")) != "").distinct().join(old.select(*by, url).distinct(), [*by, url], "left_anti")


def best_career_url(candidates: DataFrame, by: list[str], base: str, least: int = 60) -> DataFrame:
    """(by, url, score) of the best careers URL of each group, if it scores at least `least`."""
    links = candidates.select(*by, base, "url").withColumn("pos", F.lit(0))
    one = links.groupBy(*by).agg(F.first(base).alias(base))
    scored = dedupe_links(links, by).join(one, by).withColumn("score", career_score(F.col("url"), F.col(base))).where(F.col("score") >= least)
    best = F.struct((-F.col("score")).alias("s"), preference(F.col("url")).alias("p"))
    return scored.groupBy(*by).agg(F.min_by(F.struct("url", "score"), best).alias("b")).select(*by, "b.url", "b.score")


def expand_boards(pages: DataFrame, links: DataFrame, most: int = 1, rules: RuleSet = CONFIGURED) -> DataFrame:
    """(page_id, url) of job links one board away, without those that the page has.

    pages (page_id, url), links (page_id, pos, url) and, if there, is_job: the page's job links
    (else: the likely ones). A page without job details takes the job links of the first `most`
    external boards that its links, job links first, lead to; for each of these boards
    without details also those of the first `most` landing pages among its job links. Pages are joined by
    URL key; the rows of a page are numbered, never gathered. URLs are read once, for all the joins."""
    url, p = F.col("url"), F.col("p")
    likely = is_likely_job_link(url, rules)
    own = F.col("is_job") if "is_job" in links.columns else likely
    rows = with_parts(with_forms(links.select("page_id", "pos", "url", own.alias("own")), f=url), p=url)
    landing = is_job_board_landing(url, is_ats_link(url, p), p)
    rows = shared(rows.select("page_id", "pos", "url", "own", F.col("f.key").alias("k"), likely.alias("likely"), is_job_detail(url).alias("detail"), landing.alias("landing"), host_of(p).alias("host")), "page_id")
    keyed = with_parts(with_forms(pages.select(F.col("page_id").alias("to_page"), F.col("url").alias("page_url")), f=F.col("page_url")), p=F.col("page_url"))
    keyed = shared(keyed.select("to_page", host_of(p).alias("page_host"), F.col("f.key").alias("k")), "k")
    detailed = rows.where("own and detail").select("page_id").distinct()
    first = Window.partitionBy("page_id").orderBy(~F.col("own"), "pos", "url")
    seeds = rows.where("landing").join(keyed.select(F.col("to_page").alias("page_id"), "page_host"), "page_id")
    seeds = seeds.where("host <> page_host and host <> ''").join(detailed, "page_id", "left_anti")
    seeds = seeds.withColumn("n", F.row_number().over(first)).where(F.col("n") <= most).select("page_id", "k")
    reached = seeds.join(keyed.select("to_page", "k"), "k").select("page_id", "to_page").distinct()
    jobs = rows.where("likely").select(F.col("page_id").alias("to_page"), "pos", "url", "k", "detail", "landing")
    found = reached.join(jobs, "to_page")
    # Boards without a detail among their job links lead on, each by itself.
    bare = jobs.groupBy("to_page").agg(F.bool_or("detail").alias("any")).where("not any").select("to_page")
    onward = Window.partitionBy("page_id", "to_page").orderBy("pos", "url")
    more = found.where("landing").join(bare, "to_page").withColumn("n", F.row_number().over(onward)).where(F.col("n") <= most)
    more = more.select("page_id", "k").join(keyed.select("to_page", "k"), "k").select("page_id", "to_page").distinct()
    gained = found.select("page_id", "k", "url").unionByName(more.join(jobs, "to_page").select("page_id", "k", "url"))
    gained = gained.groupBy("page_id", "k").agg(F.min_by("url", preference(url)).alias("url"))
    return gained.join(rows.where("own").select("page_id", "k"), ["page_id", "k"], "left_anti").select("page_id", "url")
