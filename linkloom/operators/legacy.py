"""Operators of the earlier phases: link labels, job buckets, next-page families, board ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import html as H
from ..functions import rules as R
from ..functions.base import any_of, contains_any, let
from ..functions.urls import is_number, resolve_link


def is_label(label: Column) -> Column:
    """A label of a collected link: some text that is no pager."""
    t = F.coalesce(label, F.lit(""))
    return (t != "") & ~t.rlike("(?i)page|next|opportunities>>")


def is_job_label(label: Column) -> Column:
    """A label that may name a job: five characters at least, no number and no pager."""
    t = F.coalesce(label, F.lit(""))
    return (F.length(t) >= 5) & ~is_number(t) & ~t.rlike("(?i)jobs|page|next|>>")


def is_counted_label(label: Column) -> Column:
    """A label that counts when a page's jobs are counted: no number at its end and no pager."""
    t = F.coalesce(label, F.lit(""))
    return ~t.rlike(r"\d$|(?i)page|mainurl|older posts|»|last|next")


def labelled_links(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page, link, label) of the anchors outside asides: the text, else the aria-label or title, of each
    link with a label that is no pager; of equal links the first."""
    source = H.strip_sections(F.col(html), ("aside",))
    label = lambda a: F.coalesce(*[F.nullif(x, F.lit("")) for x in (H.plain_text(a["body"]), H.attribute(a["attributes"], "aria-label"), H.attribute(a["attributes"], "title"))], F.lit(""))
    rows = pages.select(page, F.col(url).alias("_url"), F.posexplode(H.anchors(source)).alias("_pos", "_a"))
    rows = rows.select(page, "_pos", resolve_link(H.attribute(F.col("_a.attributes"), "href"), F.col("_url")).alias("link"), label(F.col("_a")).alias("label"))
    rows = rows.where((F.col("link") != "") & is_label(F.col("label")))
    return rows.groupBy(page, "link").agg(F.min_by("label", "_pos").alias("label"))


def legacy_page(html: Column, status: Column, phrases: Sequence[str]) -> Column:
    """STRUCT<html, job_body, error_type, ldjson, microdata, phrases, is_job> of a job page."""
    page = H.clean_page(html, status)
    fine = F.coalesce(status, F.lit(0)) < 400

    def built(p: Column) -> Column:
        found = H.apply_phrases(p["job_body"], phrases)
        return F.struct(
            p["html"].alias("html"), p["job_body"].alias("job_body"), p["error_type"].alias("error_type"), F.when(fine, H.json_ld_blocks(html)).otherwise(F.expr("cast(array() as array<string>)")).alias("ldjson"),
            H.microdata(html).alias("microdata"), found["found"].alias("phrases"), found["is_job"].alias("is_job"),
        )

    return let(page, built)


def merged_posting(blocks: Column) -> Column:
    """The JobPosting objects of a page's JSON-LD blocks merged to one map of their top-level texts, later
    blocks win; of an array the first such object counts. Null where a block can't be read."""
    kind = lambda o: F.get_json_object(o, "$['@type']") == "JobPosting"
    members = lambda b: F.when(F.trim(b).startswith("["), F.from_json(b, "array<string>")).otherwise(F.array(b))
    first = lambda b: F.get(F.filter(members(b), lambda o: F.coalesce(kind(o), F.lit(False))), F.lit(0))
    fields = F.filter(F.transform(blocks, lambda b: F.map_entries(F.from_json(first(b), "map<string,string>"))), lambda x: x.isNotNull())
    whole = F.forall(blocks, lambda b: F.try_parse_json(b).isNotNull())
    none = F.expr("cast(map() as map<string,string>)")
    add = lambda done, more: F.map_from_entries(F.concat(F.filter(F.map_entries(done), lambda e: ~F.exists(more, lambda m: m["key"] == e["key"])), more))
    return F.when(whole, F.aggregate(fields, none, add))


def unique(df: DataFrame, by: list[str] | None = None, order: str | None = None) -> DataFrame:
    """Rows without repetitions: of whole rows, or of equal `by` the first in order."""
    if not by:
        return df.distinct()
    if not order:
        return df.dropDuplicates(by)
    others = [c for c in df.columns if c not in by]
    return df.groupBy(*by).agg(F.min_by(F.struct(*others), order).alias("_r")).select(*by, "_r.*").select(*df.columns)


def repeated_values(df: DataFrame, by: str, value: str, least: int = 3) -> DataFrame:
    """(by, value, n) of the values that a group has `least` times or more."""
    return df.groupBy(by, value).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def value_counts(df: DataFrame, value: str) -> DataFrame:
    """(value, n), the most frequent first where they are ordered by n."""
    return df.groupBy(value).agg(F.count(F.lit(1)).alias("n"))


def first_selector(url: Column, selectors: Sequence[str]) -> Column:
    """The first selector, in order, that the URL holds and doesn't end with; null for none."""
    low = F.lower(url)
    return F.get(F.filter(F.lit([s.lower() for s in selectors]), lambda s: low.contains(s) & ~low.endswith(s) & ~low.endswith(F.concat(s, F.lit("#")))), F.lit(0))


def bucket_hash(*parts: Column) -> Column:
    return F.md5(F.concat(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def dominant_bucket(links: DataFrame, selectors: Sequence[str], by: str = "page_id") -> DataFrame:
    """Of the links (by, link, label, mainparent, parent_node, node_name) of each page those in the
    largest bucket of one place in the page and one selector.

    Of equal buckets the greater hash wins. In a bucket of ten or more, links of one path shape that
    make up 70 percent stand for it."""
    rows = links.withColumn("selector", first_selector(F.col("link"), selectors)).where(F.col("selector").isNotNull() & is_job_label(F.col("label")))
    rows = rows.dropDuplicates([by, "link"]).withColumn("bucket", bucket_hash(F.col("mainparent"), F.col("parent_node"), F.col("node_name"), F.col("selector")))
    sizes = rows.groupBy(by, "bucket").agg(F.count(F.lit(1)).alias("size"))
    best = sizes.groupBy(by).agg(F.max(F.struct("size", "bucket")).alias("b")).select(by, "b.bucket", "b.size")
    rows = rows.join(best, [by, "bucket"])
    rows = rows.withColumn("shape", F.regexp_replace(F.regexp_replace("link", r"\?.*$", ""), r"[^/]*$", ""))
    share = F.count(F.lit(1)).over(Window.partitionBy(by, "shape")) / F.col("size")
    rows = rows.withColumn("share", share)
    rows = rows.withColumn("top", F.max("share").over(Window.partitionBy(by)))
    return rows.where((F.col("size") < 10) | (F.col("top") < 0.7) | (F.col("share") >= 0.7)).select(by, "link", "label", "bucket")


def leads_to_listing(url: Column, page_url: Column) -> Column:
    """Does the URL lead to a list, form or site page rather than to one job?

    Not where it carries a return URL; social hosts do, other than from their own pages; then
    known ends and parts; of the rest, addresses of up to two segments whose last one (but for its
    final character) looks like no identifier."""
    low, host, page_host = F.lower(url), F.get(F.split(url, "/"), F.lit(2)), F.get(F.split(page_url, "/"), F.lit(2))
    social = F.coalesce(host.isin(*R.SOCIAL_HOSTS) & (F.coalesce(page_url, F.lit("")) != ""), F.lit(False))
    ends = low.rlike(any_of(sorted({x.lower() for x in R.LISTING_ENDS})) + "$")
    last = F.regexp_extract(url, "(/[^/]*)[^/]$", 1)
    return (
        F.when(url.contains("URL=http"), False)
        .when(social, ~F.coalesce(host == page_host, F.lit(False)))
        .when(ends | contains_any(low, sorted({x.lower() for x in R.LISTING_PARTS})), True)
        .otherwise((F.size(F.split(url, "/")) < 5) & ~last.rlike("[0-9#._?=-]"))
    )


def natural_key(text: Column) -> Column:
    """A sort key by which numbers in a text go by size and letters without case or accents."""
    plain = F.translate(F.lower(text), "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy")
    pieces = F.regexp_extract_all(plain, F.lit(r"([0-9]+|[^0-9]+)"), F.lit(1))
    return F.array_join(F.transform(pieces, lambda x: F.when(x.rlike("^[0-9]"), F.lpad(x, 20, "0")).otherwise(x)), "")


def is_web_address(url: Column) -> Column:
    """An http, https or ftp URL, or one without a scheme, of a public host with a top-level domain."""
    private = r"^(?:(?:https?|ftp):)?//(?:[^@/]*@)?(?:10\.|127\.|169\.254\.|192\.168\.|172\.(?:1[6-9]|2[0-9]|3[01])\.)[0-9.]+(?::|/|$)"
    shape = r"(?i)^(?:(?:https?|ftp):)?//(?:\S+(?::\S*)?@)?(?:[0-9]{1,3}(?:\.[0-9]{1,3}){3}|[a-z0-9\u00a1-\uffff-]+(?:\.[a-z0-9\u00a1-\uffff-]+)*\.[a-z\u00a1-\uffff]{2,})(?::\d{2,5})?(?:[/?#]\S*)?$"
    return F.coalesce(url.rlike(shape) & ~url.rlike(private), F.lit(False))


#: Ways in which a page offers more results, by words in its links and buttons: our own list, for
#: static pages.
PAGER_FAMILIES = {"load_more": ("load more", "show more", "view more"), "next_button": (">next<", "next page", "rel=\"next\""), "input": ("name=\"page\"",), "pagination": ("class=\"pagination", "class=\"pager")}


def pager_families(html: Column) -> Column:
    low = F.lower(F.coalesce(html, F.lit("")))
    return F.array_compact(F.array(*[F.when(contains_any(low, words), name) for name, words in PAGER_FAMILIES.items()]))


def board_job_ids(payload: Column) -> Column:
    """The distinct values of the ExternalJobID codes in a job list's JSON."""
    codes = F.from_json(payload, "struct<jobRequisitions:array<struct<customFieldGroup:struct<stringFields:array<struct<nameCode:struct<codeValue:string>,stringValue:string>>>>>>")
    fields = F.flatten(F.transform(codes["jobRequisitions"], lambda j: j["customFieldGroup"]["stringFields"]))
    return F.array_distinct(F.transform(F.filter(fields, lambda f: f["nameCode"]["codeValue"] == "ExternalJobID"), lambda f: f["stringValue"]))


def with_job_id(url: Column, job_id: Column) -> Column:
    """url with its jobId query parameter set."""
    pair = F.concat(F.lit("jobId="), F.url_encode(job_id))
    replaced = F.regexp_replace(url, F.lit(r"([?&])jobId=[^&#]*"), F.concat(F.lit("$1"), pair))
    cut = F.regexp_extract(url, "^([^#]*)(#.*)?$", 1)
    added = F.concat(cut, F.when(cut.contains("?"), "&").otherwise("?"), pair, F.coalesce(F.regexp_extract(url, "^([^#]*)(#.*)?$", 2), F.lit("")))
    return F.when(url.rlike("[?&]jobId="), replaced).otherwise(added)
