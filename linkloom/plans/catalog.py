"""The engine's named queries and the SQL that checks them."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ats, html, postings, predicates, text, urls
from ..functions.rules import RuleSet
from ..operators import clustering, legacy, lifecycle, links, records
from ..sources import seeds
from ..sources.folders import shared_folder
from ..streaming import jobs as streaming
from .oracle import ORACLE
from .synth import spread, synthetic

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

#: Literal times of the lifecycle queries.
NOW = "TIMESTAMP_NTZ '1997-01-01 00:00:00'"
#: Phrases that the documents of the driver's tables hold; not expiry phrases, but searched alike.
FREQUENT = RuleSet(expiry=("and the", "Released under", "All rights reserved", "of the ing", "que de", "und der", "erent", "der die"))


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def page_url_parts(spark, d):
    p = table(spark, d, "pages").select("page_id", "url", urls.parse_url(F.col("url")).alias("p"))
    return p.select("page_id", "p.scheme", "p.host", "p.port", "p.path", "p.query", "p.hash", urls.comparable_host(F.col("url")).alias("comparable_host"), urls.file_extension(F.col("url")).alias("extension"))


@query
def page_url_normalized(spark, d):
    return table(spark, d, "pages").select("page_id", urls.normalize_url(F.col("url")).alias("normal"), urls.url_key(F.col("url")).alias("key"), urls.url_score(F.col("url")).cast("bigint").alias("score"))


@query
def spelling_normalized(spark, d):
    return synthetic(spark, d, "spellings").select("k", urls.normalize_url(F.col("url")).alias("normal"), urls.url_key(F.col("url")).alias("key"))


@query
def page_title_sample(spark, d):
    p = table(spark, d, "pages").select("page_id", html.page_title(F.col("html")).alias("title"), html.text_sample(F.col("html")).alias("sample"))
    return p.select("page_id", "title", F.length("sample").cast("bigint").alias("sample_chars"), F.md5("sample").alias("sample_md5"))


@query
def page_link_entries(spark, d):
    return links.link_entries(table(spark, d, "pages")).select("page_id", "url", "text")


@query
def page_link_rollup(spark, d):
    entries = links.dedupe_entries(links.link_entries(table(spark, d, "pages")), ["page_id"])
    return entries.groupBy("page_id").agg(F.count_distinct("url").alias("link_count"), F.count_if(F.col("text") != "").alias("text_count"), F.min("url").alias("first_url"))


@query
def section_links(spark, d):
    return table(spark, d, "pages").select("page_id", F.explode(html.sections(F.col("html"), ("nav",))).alias("s")).select("page_id", F.explode(html.anchors(F.col("s"))).alias("a")).select(
        "page_id", html.attribute(F.col("a.attributes"), "href").alias("href"), html.plain_text(F.col("a.body")).alias("label")
    ).distinct()


@query
def section_stripped_links(spark, d):
    pages = synthetic(spark, d, "built_pages")
    return links.link_entries(pages, same_domain_only=True, stripped=True).select("page_id", "branch", "url", "text")


@query
def all_branch_links(spark, d):
    return links.link_entries(synthetic(spark, d, "built_pages")).groupBy("page_id", "branch").agg(F.count(F.lit(1)).alias("links"), F.min("url").alias("first_url"))


@query
def handler_links(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.expr("concat('open(''/a/', o_custkey, ''');x(\"https://h.example.com/', o_orderkey, '\")')").alias("js"))
    return rows.select("o_orderkey", F.posexplode(html.handler_links(F.col("js"))).alias("pos", "link")).select("o_orderkey", F.col("pos").cast("bigint").alias("pos"), "link")


@query
def dedupe_prefer_https(spark, d):
    rows = synthetic(spark, d, "spellings").withColumn("g", F.lit(0)).withColumnRenamed("k", "pos")
    return links.dedupe_links(rows, ["g"]).select("key", "url", "pos")


@query
def likely_job_links(spark, d):
    return synthetic(spark, d, "job_urls").select("k", predicates.is_likely_job_link(F.col("url")).alias("likely"), predicates.is_job_detail(F.col("url")).alias("detail"))


@query
def job_detail_counts(spark, d):
    rows = synthetic(spark, d, "job_urls").select(urls.comparable_host(F.col("url")).alias("host"), predicates.is_job_detail(F.col("url")).alias("detail"))
    return rows.groupBy("host").agg(F.count(F.lit(1)).alias("links"), F.count_if("detail").alias("details"))


@query
def board_landing_links(spark, d):
    rows = synthetic(spark, d, "job_urls").unionByName(synthetic(spark, d, "board_urls").select((F.col("k") + 1_000_000).alias("k"), "url"))
    own = F.lit("https://www.h1.example.com/")
    return rows.select("k", predicates.is_job_board_landing(F.col("url")).alias("landing"), predicates.is_external(F.col("url"), own).alias("external"))


@query
def ats_links(spark, d):
    b = synthetic(spark, d, "board_urls")
    return b.select("k", "url", predicates.is_ats_link(F.col("url")).alias("ats"), ats.ats_canonical(F.col("url")).alias("canonical"), ats.ats_template(F.col("url")).alias("template"))


@query
def non_career_reasons(spark, d):
    return synthetic(spark, d, "job_urls").select("k", links.career_reason(F.col("url"), F.lit(False)).alias("reason"))


@query
def anchor_text_filter(spark, d):
    return synthetic(spark, d, "anchor_texts").select("k", predicates.is_non_job_text(F.col("text")).alias("non_job"))


@query
def anchor_filtered_links(spark, d):
    entries = synthetic(spark, d, "job_urls").join(synthetic(spark, d, "anchor_texts"), "k").select((F.col("k") % 20).alias("g"), "url", "text")
    own = entries.select("g", "url").distinct()
    return links.flag_anchor_text(own, entries, ["g"]).select("g", "url", "texts", "dropped")


@query
def same_domain_filter(spark, d):
    rows = synthetic(spark, d, "job_urls").withColumn("page_url", F.lit("https://h1.example.com/"))
    return links.same_domain(rows).select("k", "url")


@query
def social_filter(spark, d):
    hosts = F.expr("CASE WHEN k % 4 = 0 THEN 'https://www.facebook.com/x' WHEN k % 4 = 1 THEN 'https://youtube.com/y' ELSE url END")
    rows = synthetic(spark, d, "job_urls").withColumn("url", hosts).withColumn("page_url", F.expr("CASE WHEN k % 3 = 0 THEN 'https://facebook.com/own' ELSE 'https://a.example.com' END"))
    return links.drop_social(rows).select("k", "url")


@query
def self_link_filter(spark, d):
    rows = synthetic(spark, d, "spellings").withColumn("g", F.col("k") % 7)
    own = rows.where("k <= 50").select("g", "url")
    return links.drop_self(rows, own, ["g"]).groupBy("g").agg(F.count(F.lit(1)).alias("links"))


@query
def excluded_domains(spark, d):
    rows = spread(table(spark, d, "customer")).select("c_custkey", F.expr("concat('https://www.', CASE WHEN c_custkey % 5 = 0 THEN 'sites.google' WHEN c_custkey % 5 = 1 THEN 'mountainfountain' WHEN c_custkey % 5 = 2 THEN 'indeed.vitas' ELSE 'acme' END, '.com/google')").alias("url"))
    return rows.select("c_custkey", predicates.excluded_host_pattern(F.col("url")).alias("pattern"))


@query
def expired_pages(spark, d):
    docs = spread(table(spark, d, "documents"), 1 << 22).select("doc_id", F.lit("").alias("title"), "text")
    found = records.expiry_matches(docs, "doc_id", FREQUENT, most=20)
    return found.select("doc_id", F.explode("matches").alias("phrase"))


@query
def bot_challenge_pages(spark, d):
    rows = synthetic(spark, d, "job_urls").withColumn("g", F.expr("k % 60")).withColumn("url", F.expr("CASE WHEN k % 60 < 20 THEN concat(url, '/captcha') ELSE url END"))
    url = F.col("url")
    n = rows.groupBy("g").agg(F.count(F.lit(1)).alias("links"), F.count_if(predicates.is_bot_challenge(url)).alias("challenges"), F.count_if(predicates.is_likely_job_link(url)).alias("jobs"))
    return n.select("g", "links", "challenges", predicates.is_challenge_page(F.col("links"), F.col("challenges"), F.col("jobs")).alias("challenge"))


@query
def best_attempt(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("attempt"), (F.col("l_partkey") % 3).alias("likely"), (F.col("l_suppkey") % 4).alias("links"))
    return records.best_attempt(rows, "l_orderkey")


@query
def final_career_url(spark, d):
    base = synthetic(spark, d, "job_urls")
    pages = base.where("k % 10 = 0").select(F.col("k").alias("page_id"), F.col("url"), F.col("url").alias("final_url"))
    own = base.select((F.floor(F.col("k") / 10) * 10).alias("page_id"), "url")
    boards = synthetic(spark, d, "board_urls").where("k % 3 = 0").select((F.col("k") * 10).alias("page_id"), "url").where(predicates.is_ats_link(F.col("url")))
    return records.final_career_url(pages, own, boards)


@query
def career_status(spark, d):
    flag = lambda n: F.expr(f"floor(p_partkey / {n}) % 2 = 1")
    return table(spark, d, "part").select("p_partkey", records.career_status(flag(8), flag(4), flag(2), flag(1)).alias("status"))


def _career_pages(spark, d):
    steps = F.expr("CASE WHEN page_id % 8 = 0 THEN array(named_struct('url', concat(url, '/old'), 'status_code', 301, 'location', url), named_struct('url', url, 'status_code', 200, 'location', '')) END")
    return synthetic(spark, d, "career_pages").withColumn("redirect_chain", steps)


@query
def career_links_table(spark, d):
    text = lambda c: F.concat_ws(",", c).alias(c)
    kept = (
        "page_id", "career_url", "career_url_key", "request_url", "final_url", "final_career_url", "ats_template", "page_title", "link_count", "job_link_count", "has_job_links", "job_detail_link_count", "job_links_status", "ats_career_link_count",
        "career_links_status", "expired_or_no_jobs", "expire_keyword_match_count", "excluded_domain_pattern", "text_filtered_link_count", "career_filtered_link_count", "http_status_code", "initial_http_status_code", "redirect_count", "redirected",
        "bot_challenge", "crawl_status", "source", "error",
    )
    return records.career_links(_career_pages(spark, d)).select(*kept, *[text(c) for c in ("links", "job_links", "ats_career_links", "expire_keyword_matches")])


@query
def page_record_counts(spark, d):
    rows = records.career_links(spread(table(spark, d, "pages"), 1 << 20), expand=True)
    return rows.groupBy("crawl_status", "career_links_status").agg(F.count(F.lit(1)).alias("pages"), F.sum("job_link_count").alias("job_links"))


@query
def page_upsert(spark, d):
    new = records.career_links(_career_pages(spark, d)).withColumn("fetched_at", F.expr(NOW))
    old = new.where("page_id % 2 = 1").withColumns({"link_count": F.lit(7).cast("long"), "crawl_status": F.lit("success"), "created_at": F.expr(NOW) - F.expr("INTERVAL 1 DAY"), "last_success_at": F.expr(NOW) - F.expr("INTERVAL 1 DAY"), "last_error_at": F.lit(None).cast("timestamp_ntz")})
    out = records.stored_pages(old, new)
    return out.select("career_url_key", "link_count", "crawl_status", "created_at", "last_success_at", "last_error_at")


@query
def merged_page_runs(spark, d):
    rows = synthetic(spark, d, "career_pages").where("page_id % 8 = 0")
    old = rows.select(F.expr("concat('c', page_id, '.example.org/careers')").alias("career_url_key"), F.expr("array(concat('http://c', page_id, '.example.org/job/', page_id), concat('https://c', page_id, '.example.org/job/old'))").alias("links"), F.expr("array(concat('https://c', page_id, '.example.org/job/old'))").alias("job_links"), F.expr("cast(array() as array<string>)").alias("ats_career_links"))
    out = records.career_links(rows, existing=old)
    return out.select("page_id", F.concat_ws(",", "links").alias("links"), F.concat_ws(",", "job_links").alias("job_links"), "job_detail_link_count")


@query
def expiry_verdicts(spark, d):
    v = records.expiry_verdict(html.text_sample(F.col("html")), html.page_title(F.col("html")), F.col("status_code"))
    rows = synthetic(spark, d, "career_pages").select("page_id", v.alias("v"))
    return rows.select("page_id", F.col("v.status_code").cast("bigint").alias("status_code"), "v.fast_hint_matched", "v.status_code_expired", F.concat_ws(",", "v.matched_keywords").alias("keywords"), "v.is_expired_or_no_jobs")


@query
def stored_by_alias(spark, d):
    pages = synthetic(spark, d, "spellings").select(F.col("k").alias("page_id"), "url")
    stored = synthetic(spark, d, "spellings").where("k % 13 = 0").select(urls.normalize_url(F.col("url")).alias("career_url")).distinct()
    stored = stored.withColumn("career_url_key", urls.url_key(F.col("career_url"))).groupBy("career_url_key").agg(F.min("career_url").alias("career_url"))
    return records.stored_of(pages, stored).select("page_id", "career_url_key")


@query
def url_aliases(spark, d):
    rows = synthetic(spark, d, "spellings").select("k", F.explode(urls.url_aliases(F.col("url"))).alias("alias"))
    return rows.where("alias not like '%:80%'").select("k", "alias")


@query
def merged_collections(spark, d):
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("page_id"), F.col("p_name").alias("title"), F.col("p_type").alias("sample"), F.expr("array(named_struct('url', concat('https://a.example.com/', p_partkey), 'text', p_name))").alias("entries"))
    new = rows.where("page_id % 2 = 0").withColumns({"title": F.expr("CASE WHEN page_id % 4 = 0 THEN '' ELSE 'new' END"), "entries": F.expr("concat(entries, array(named_struct('url', 'https://b.example.com/', 'text', '')))")})
    return links.merged_pages(rows.where("page_id % 3 = 0"), new).select("page_id", "title", "sample", F.size("entries").cast("bigint").alias("entries"))


@query
def board_expansion(spark, d):
    pages = synthetic(spark, d, "built_pages").select("page_id", "url")
    # Ids that no supplier has: a page is known by its id.
    boards = pages.select((-1 - F.col("page_id") % 10).alias("page_id"), F.expr("concat('https://q', page_id % 10, '.example.net/jobs')").alias("url")).distinct()
    out = pages.where("page_id % 3 <> 0").select("page_id", F.lit(0).alias("pos"), F.expr("concat('https://q', page_id % 10, '.example.net/jobs')").alias("url"))
    more = boards.select("page_id", F.lit(0).alias("pos"), F.concat("url", F.lit("/job/1")).alias("url"))
    return links.expand_boards(pages.unionByName(boards), out.unionByName(more))


@query
def merge_runs(spark, d):
    rows = synthetic(spark, d, "spellings").withColumn("g", F.col("k") % 3)
    old, new = rows.where("k % 2 = 0").withColumn("pos", F.col("k")), rows.where("k % 2 = 1").withColumn("pos", F.col("k") + 1_000_000_000)
    return links.dedupe_links(old.unionByName(new), ["g"]).select("g", "key", "url", "pos")


@query
def ldjson_blocks(spark, d):
    p = synthetic(spark, d, "posting_pages")
    return p.select("k", F.posexplode(html.json_ld_blocks(F.col("page"))).alias("pos", "block")).select("k", F.col("pos").cast("bigint").alias("pos"), "block")


@query
def posting_fields(spark, d):
    p = synthetic(spark, d, "posting_pages").select("k", postings.posting_columns(postings.job_posting(F.col("page"))).alias("f"))
    return p.where("f.company is not null").select("k", *[F.col(f"f.{c}") for c in postings.FIELDS])


@query
def queue_items(spark, d):
    return synthetic(spark, d, "messages").select("id", lifecycle.queue_item(F.col("value")).alias("q")).select("id", "q.url", "q.career_url")


@query
def retry_envelopes(spark, d):
    return synthetic(spark, d, "messages").select("id", lifecycle.decode_envelope(F.col("value")).alias("e")).select("id", "e.value", F.col("e.retries").cast("bigint").alias("retries"), "e.first_seen")


@query
def retry_outcomes(spark, d):
    return lifecycle.retry_outcomes(synthetic(spark, d, "failures")).select("id", "reason", "outcome")


@query
def retry_counters(spark, d):
    return lifecycle.retry_counters(lifecycle.retry_outcomes(synthetic(spark, d, "failures")))


@query
def claimable_jobs(spark, d):
    got = lifecycle.claim(synthetic(spark, d, "jobs"), F.expr(NOW), "w1", 50, retry_errors=True)
    return got.select("id", "status", F.col("attempts").cast("bigint").alias("attempts"), "lock_by", "lock_until")


@query
def reseed_queue(spark, d):
    return lifecycle.reseed(synthetic(spark, d, "jobs"), F.expr(NOW))


@query
def discovery_upsert(spark, d):
    found = table(spark, d, "lineitem").select(F.col("l_partkey").alias("url"), F.col("l_suppkey").alias("career_url"), F.col("l_shipdate").alias("at"))
    old, new = (lifecycle.discoveries(found.where(t)) for t in ("at < TIMESTAMP_NTZ '1996-01-01'", "at >= TIMESTAMP_NTZ '1996-01-01'"))
    out = lifecycle.upsert(old, new, "url", {"first_discovered_at": "min", "last_discovered_at": "max", "career_url": "overwrite", "career_urls": "union", "discovery_count": "add"})
    return out.select("url", "first_discovered_at", "last_discovered_at", "career_url", F.concat_ws(",", F.transform("career_urls", lambda x: x.cast("string"))).alias("career_urls"), F.col("discovery_count").cast("bigint").alias("discovery_count"))


@query
def resume_seeds(spark, d):
    seeds = synthetic(spark, d, "spellings").select("k", "url", (F.col("k") % 5 == 0).alias("seeded"))
    return lifecycle.open_seeds(seeds, synthetic(spark, d, "spellings").where("k % 11 = 0")).select("k", "key")


@query
def queue_dedupe_append(spark, d):
    m = table(spark, d, "events").select(F.col("event_id").alias("pos"), F.col("user_id").alias("key"))
    return lifecycle.unseen(m, m.where("key % 9 = 0")).select("pos", "key")


@query
def failed_replay(spark, d):
    moved, left = lifecycle.move(table(spark, d, "events").select(F.col("event_id").alias("id"), "event_type"), 100)
    return moved.withColumn("to", F.lit("moved")).unionByName(left.withColumn("to", F.lit("left"))).groupBy("to", "event_type").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))


@query
def stale_deliveries(spark, d):
    rows = table(spark, d, "events").select(F.col("event_id").alias("id"), F.col("ts").alias("delivered_at"))
    return lifecycle.stale_pending(rows, F.expr("TIMESTAMP_NTZ '2024-01-15 00:00:00'")).select("id")


@query
def health_snapshot(spark, d):
    return lifecycle.health(synthetic(spark, d, "jobs"))


@query
def stream_health(spark, d):
    rows = table(spark, d, "events").select(F.lit("events").alias("queue"), F.col("event_type").alias("group"), F.col("user_id").alias("consumer"))
    return lifecycle.queue_health(rows).select("group", "pending", "consumers")


@query
def info_sections(spark, d):
    section = lifecycle.info_section(F.expr("concat('# Part\r\nname:', p_name, '\n:x\nnone\nsize: ', p_size, ' \nsize:', p_size + 1, '\nurl:a:b')"))
    return spread(table(spark, d, "part")).select("p_partkey", F.explode(section).alias("name", "value"))


@query
def unique_keys(spark, d):
    rows = synthetic(spark, d, "spellings").select(urls.url_key(F.col("url")).alias("key"))
    return lifecycle.duplicated(rows, "key")


@query
def html_work_actions(spark, d):
    jobs = synthetic(spark, d, "jobs").groupBy("url").agg(F.max("status").alias("status"), F.max("career_url").alias("career_url")).withColumn("career_urls", F.array(F.lit("https://first.example.com/")))
    messages = synthetic(spark, d, "jobs").select("id", F.expr("CASE WHEN id % 10 = 0 THEN concat(url, '/other') ELSE url END").alias("url"), F.expr("CASE WHEN id % 4 = 0 THEN 'https://own.example.com/' END").alias("career_url"))
    return lifecycle.html_work(messages, jobs, only_jobs=True).select("id", "career_url", "action")


@query
def job_marks(spark, d):
    now = F.expr(NOW)
    jobs = synthetic(spark, d, "jobs").select(F.expr("concat('https://j.example.com/', id)").alias("url"), "status", "career_url", F.col("discovered_at").alias("created_at"), F.col("discovered_at").alias("updated_at"), F.lit("w").alias("lock_by"), F.col("lock_until").alias("lock_at"), "lock_until", F.col("id").alias("_id")).drop("_id")
    marks = synthetic(spark, d, "jobs").where("id % 3 = 0").select(F.expr("concat('https://j.example.com/', CASE WHEN id % 2 = 0 THEN id ELSE -id END)").alias("url"), F.lit("done").alias("status"), F.expr("CASE WHEN id % 5 = 0 THEN 'https://c.example.com/' END").alias("career_url"))
    out = lifecycle.mark_jobs(jobs, marks, now)
    return out.groupBy("status").agg(F.count(F.lit(1)).alias("jobs"), F.count("lock_by").alias("locked"), F.count_if(F.col("updated_at") == now).alias("updated"), F.count_if(F.col("created_at") == now).alias("created"), F.count_if(F.col("career_url") == "https://c.example.com/").alias("career"))


@query
def queued_marks(spark, d):
    jobs = synthetic(spark, d, "jobs").select("url", "queued", "queued_at").dropDuplicates(["url"])
    marked = lifecycle.mark_queued(jobs.withColumns({"queued": F.lit(False), "queued_at": F.lit(None).cast("timestamp_ntz")}), jobs.where("url like '%7'"), F.expr(NOW))
    return marked.select("url", "queued", "queued_at")


@query
def seed_cycles(spark, d):
    jobs = synthetic(spark, d, "jobs")
    parts = []
    for name, options in (("plain", {"queue_length": 5}), ("recovered", {"queue_length": 0}), ("reset", {"queue_length": 5, "reset": True})):
        queue, after = lifecycle.seed_cycle(jobs, F.expr(NOW), **options)
        parts.append(queue.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("cycle"), F.lit("queue").alias("part"), "n"))
        parts.append(after.agg(F.count_if(F.col("queued_at") == F.expr(NOW)).alias("n")).select(F.lit(name).alias("cycle"), F.lit("marked").alias("part"), "n"))
    return reduce(DataFrame.unionByName, parts)


@query
def replayed_failures(spark, d):
    source = table(spark, d, "events").select(F.col("event_id").alias("id"))
    rows = None
    for name, options in (("all", {}), ("some", {"most": 70}), ("kept", {"most": 70, "keep": True})):
        moved, left = lifecycle.replay(source, 50, **options)
        part = moved.select(F.lit(name).alias("run"), F.lit("moved").alias("part"), "id").unionByName(left.select(F.lit(name).alias("run"), F.lit("left").alias("part"), "id"))
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy("run", "part").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last_id"))


@query
def acknowledged(spark, d):
    log = table(spark, d, "events").select(F.col("event_id").alias("id"), "event_type")
    pending, kept = lifecycle.acknowledge(log.where("id % 2 = 0"), log, log.where("id % 3 = 0"))
    return pending.withColumn("part", F.lit("pending")).unionByName(kept.withColumn("part", F.lit("log"))).groupBy("part", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query
def lifecycle_violations(spark, d):
    rows = table(spark, d, "events").select(F.col("user_id").alias("url"), F.struct("ts", "event_id").alias("at"), F.expr("CASE event_id % 5 WHEN 0 THEN 'pending' WHEN 1 THEN 'processing' WHEN 2 THEN 'done' WHEN 3 THEN 'error' ELSE 'skipped' END").alias("status"))
    return lifecycle.bad_transitions(rows).groupBy("before", "status").agg(F.count(F.lit(1)).alias("n"))


@query
def redirect_summary(spark, d):
    step = F.struct(F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"), F.concat(F.lit("https://h.example.com/"), F.col("l_partkey").cast("string")).alias("url"), F.expr("CAST(CASE l_partkey % 3 WHEN 0 THEN 301 WHEN 1 THEN 200 ELSE 0 END AS INT)").alias("status_code"))
    chains = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(step)).alias("steps"))
    s = records.redirect_summary(F.col("steps"), F.lit(200), F.get(F.col("steps"), F.lit(0))["url"], F.element_at("steps", -1)["url"])
    return chains.select("l_orderkey", s.alias("s")).select("l_orderkey", F.concat_ws(",", F.transform("s.codes", lambda x: x.cast("string"))).alias("codes"), F.col("s.redirects").cast("bigint").alias("redirects"), "s.redirected", F.col("s.initial_status").cast("bigint").alias("initial_status"))


@query
def page_counts(spark, d):
    return synthetic(spark, d, "pagers").select("k", text.page_count(F.col("text")).cast("bigint").alias("pages"), F.size(text.page_numbers(text.page_count(F.col("text")))).cast("bigint").alias("numbers"))


@query
def link_buckets(spark, d):
    return table(spark, d, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n")).select("l_partkey", text.nearest_bucket(F.col("n")).alias("bucket"))


@query
def repeated_texts(spark, d):
    lines = table(spark, d, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return legacy.repeated_values(lines, "doc_id", "line").select("doc_id", F.md5("line").alias("line_md5"), "n")


@query
def link_set_diff(spark, d):
    a = links.link_entries(table(spark, d, "pages").where("page_id % 2 = 0")).select(F.lit(0).alias("g"), "text")
    b = links.link_entries(table(spark, d, "pages").where("page_id % 2 = 1")).select(F.lit(0).alias("g"), "text")
    return links.link_difference(a, b, ["g"], "text").select("text")


@query
def links_outside_sections(spark, d):
    pages = synthetic(spark, d, "built_pages")
    nav = pages.select("page_id", "url", F.concat_ws("", html.sections(F.col("html"), ("nav", "footer"))).alias("html"))
    return links.without_sections(links.link_entries(pages), links.link_entries(nav), ["page_id"]).select("page_id", "url", "text")


@query
def word_frequencies(spark, d):
    words = table(spark, d, "documents").select(F.explode(text.tokens(F.col("text"))).alias("word"))
    return legacy.value_counts(words, "word")


@query
def url_clusters(spark, d):
    rows = table(spark, d, "pages").select("url").unionByName(synthetic(spark, d, "job_urls").select("url"))
    return clustering.cluster_urls(rows)


@query
def url_cluster_kinds(spark, d):
    rows = table(spark, d, "pages").select("url").unionByName(synthetic(spark, d, "job_urls").select("url"))
    return clustering.cluster_urls(rows).groupBy("kind").agg(F.count(F.lit(1)).alias("urls"), F.count_distinct("cluster").alias("clusters"))


@query
def apply_phrase_class(spark, d):
    rows = table(spark, d, "part").select("p_partkey", F.expr("repeat(concat('Apply now for ', p_name, '. '), CAST(p_partkey % 6 AS INT))").alias("text"))
    got = rows.select("p_partkey", html.apply_phrases(F.col("text"), ("apply now", "send your resume", "for")).alias("a"))
    return got.select("p_partkey", F.concat_ws(",", "a.found").alias("found"), "a.is_job")


@query
def microdata_map(spark, d):
    rows = table(spark, d, "part").select("p_partkey", F.expr("concat('<p itemprop=\"title\">', p_name, '</p><b itemprop=\"brand\"> ', p_brand, '</b><i itemprop=\"title\">', p_type, '</i>')").alias("h"))
    return rows.select("p_partkey", F.explode(html.microdata(F.col("h"))).alias("name", "value"))


@query
def clean_page(spark, d):
    c = table(spark, d, "pages").select("page_id", html.clean_page(F.col("html"), F.when(F.col("page_id") % 10 == 0, 404).otherwise(200)).alias("c"))
    return c.select("page_id", F.md5("c.job_body").alias("body_md5"), F.length("c.job_body").cast("bigint").alias("body_chars"), "c.error_type")


@query
def ends_with_filter(spark, d):
    page = F.lit("https://www.facebook.com/us")
    rows = synthetic(spark, d, "job_urls").unionByName(synthetic(spark, d, "board_urls").select((F.col("k") + 1_000_000).alias("k"), "url"))
    rows = rows.unionByName(table(spark, d, "pages").select((F.col("page_id") + 2_000_000).alias("k"), "url"))
    return rows.select("k", legacy.leads_to_listing(F.col("url"), page).alias("listing"))


@query
def natural_order(spark, d):
    return synthetic(spark, d, "job_urls").select("url", legacy.natural_key(F.col("url")).alias("sort_key"))


@query
def mobile_agents(spark, d):
    rows = table(spark, d, "part").select("p_partkey", F.expr("concat('Mozilla/5.0 (', CASE WHEN p_partkey % 3 = 0 THEN 'iPhone' WHEN p_partkey % 3 = 1 THEN 'X11; Linux' ELSE 'Android 14' END, ')')").alias("agent"))
    return rows.select("p_partkey", urls.is_mobile_user_agent(F.col("agent")).alias("mobile"))


@query
def stream_queue_dedupe(spark, d):
    return streaming.deduped(spark, f"{d}/events.parquet", "user_id").select(F.col("user_id").alias("key"))


@query
def stream_retry_routing(spark, d):
    return streaming.routed(spark, synthetic(spark, d, "failures")).groupBy("stream", "outcome").agg(F.count(F.lit(1)).alias("n"))


@query
def unique_rows(spark, d):
    rows = synthetic(spark, d, "job_urls").select((F.col("k") % 50).alias("g"), F.col("k").alias("pos"), "url")
    first = legacy.unique(rows, ["g"], "pos").select("g", "url")
    return first.unionByName(legacy.unique(rows.select("g", F.lit("x").alias("url"))))


@query
def sparse_pages(spark, d):
    rows = synthetic(spark, d, "job_urls").groupBy((F.col("k") % 300).alias("g")).agg(F.array_sort(F.collect_list("url")).alias("links"))
    url = F.expr("CASE WHEN g % 3 = 0 THEN 'https://acme.wd5.myworkdayjobs.com/x' ELSE 'https://a.example.com/' END")
    return rows.select("g", predicates.is_sparse_page(url, F.col("links"), urls.comparable_host(url)).alias("sparse"))


@query
def numbers_and_flags(spark, d):
    raw = F.expr("CASE p_partkey % 6 WHEN 0 THEN '12' WHEN 1 THEN ' 3.5 ' WHEN 2 THEN 'yes' WHEN 3 THEN 'TRUE' WHEN 4 THEN '-4' ELSE p_name END")
    return table(spark, d, "part").select("p_partkey", urls.is_number(raw).alias("number"), text.parse_flag(raw).alias("flag"), text.positive_int(raw, 9).cast("bigint").alias("count"))


@query
def job_labels(spark, d):
    label = F.col("text")
    return synthetic(spark, d, "anchor_texts").select("k", legacy.is_label(label).alias("any_link"), legacy.is_job_label(label).alias("job"), legacy.is_counted_label(label).alias("counted"))


@query
def labelled_links(spark, d):
    return legacy.labelled_links(synthetic(spark, d, "built_pages")).select("page_id", "link", "label")


@query
def first_selectors(spark, d):
    return synthetic(spark, d, "job_urls").select("k", legacy.first_selector(F.col("url"), ("/jobs/", "/job/", "jobid=", "/openings/", "/team/")).alias("selector"))


@query
def dominant_buckets(spark, d):
    rows = synthetic(spark, d, "job_urls").select((F.col("k") % 25).alias("page_id"), F.col("url").alias("link"), F.expr("concat('Nurse ', k, ' wanted')").alias("label"), F.expr("concat('m', k % 2)").alias("mainparent"), F.lit("p").alias("parent_node"), F.lit("a").alias("node_name"))
    return legacy.dominant_bucket(rows, ("/job/", "/jobs/", "/careers/")).select("page_id", "link", "bucket")


@query
def web_addresses(spark, d):
    url = F.expr("CASE p_partkey % 7 WHEN 0 THEN concat('https://a', p_partkey, '.example.com/x') WHEN 1 THEN 'http://10.1.2.3/' WHEN 2 THEN '//b.example.org' WHEN 3 THEN 'http://localhost' WHEN 4 THEN 'ftp://8.8.8.8:21/f' WHEN 5 THEN p_name ELSE 'http://192.168.0.9:80/y' END")
    return table(spark, d, "part").select("p_partkey", legacy.is_web_address(url).alias("valid"))


@query
def pager_words(spark, d):
    page = F.expr("concat('<a>', CASE p_partkey % 4 WHEN 0 THEN 'Load more' WHEN 1 THEN 'Next page' WHEN 2 THEN p_name ELSE 'Show More' END, '</a>', CASE WHEN p_partkey % 3 = 0 THEN '<ul class=\"pagination\">' ELSE '' END)")
    return table(spark, d, "part").select("p_partkey", F.concat_ws(",", legacy.pager_families(page)).alias("families"))


@query
def board_jobs(spark, d):
    code = lambda name, value: f"'{{\"nameCode\":{{\"codeValue\":\"{name}\"}},\"stringValue\":\"', {value}, '\"}}'"
    payload = F.expr(f"concat('{{\"jobRequisitions\":[{{\"customFieldGroup\":{{\"stringFields\":[', {code('ExternalJobID', 'p_partkey')}, ',', {code('Other', 'p_size')}, ']}}}},{{\"customFieldGroup\":{{\"stringFields\":[', {code('ExternalJobID', 'p_size')}, ']}}}}]}}')")
    rows = table(spark, d, "part").select("p_partkey", F.explode(legacy.board_job_ids(payload)).alias("job_id"))
    return rows.select("p_partkey", "job_id", legacy.with_job_id(F.expr("concat('https://b.example.com/x', CASE WHEN p_partkey % 2 = 0 THEN '?jobId=0&a=1' ELSE '#t' END)"), F.col("job_id")).alias("url"))


@query
def masked_passwords(spark, d):
    return table(spark, d, "customer").select("c_custkey", urls.mask_password(F.expr("concat('redis://u', CASE WHEN c_custkey % 2 = 0 THEN concat(':', c_name) ELSE '' END, '@h:6379/0')")).alias("masked"))


@query
def ascii_hosts(spark, d):
    host = F.expr("CASE c_custkey % 3 WHEN 0 THEN 'bücher.example' WHEN 1 THEN 'a.example' ELSE '日本.example' END")
    return table(spark, d, "customer").select("c_custkey", urls.ascii_hosts(F.concat(F.lit("https://"), host, F.lit(":8443/ü?x="), F.col("c_custkey").cast("string"))).alias("url"))


@query
def merged_postings(spark, d):
    block = F.expr("CASE p_partkey % 3 WHEN 0 THEN concat('{\"@type\":\"JobPosting\",\"title\":\"', p_name, '\",\"url\":\"first\"}') WHEN 1 THEN concat('[{\"@type\":\"Thing\"},{\"@type\":\"JobPosting\",\"title\":\"', p_name, '\"}]') ELSE '{broken' END")
    second = F.lit('{"@type":"JobPosting","url":"second"}')
    rows = table(spark, d, "part").select("p_partkey", legacy.merged_posting(F.array(block, second)).alias("m"))
    return rows.select("p_partkey", F.col("m")["title"].alias("title"), F.col("m")["url"].alias("url"))


@query
def legacy_pages(spark, d):
    page = F.expr("concat('<script type=\"application/ld+json\">{}</script><p itemprop=\"x\">', p_name, '</p> apply now ', '<style>s</style>')")
    rows = table(spark, d, "part").select("p_partkey", legacy.legacy_page(page, F.when(F.col("p_partkey") % 5 == 0, 500).otherwise(200), ("apply now",)).alias("l"))
    return rows.select("p_partkey", "l.job_body", "l.error_type", F.size("l.ldjson").cast("bigint").alias("blocks"), F.col("l.microdata")["x"].alias("x"), "l.is_job")


@query
def seed_file_urls(spark, d):
    path = f"{shared_folder(spark)}/seeds-{uuid.uuid4().hex}"
    synthetic(spark, d, "spellings").select(F.concat(F.lit(" "), "url")).write.text(path)
    return seeds.seed_file(spark, path)


@query
def seed_batches(spark, d):
    rows = synthetic(spark, d, "spellings").select(F.col("k").alias("id"), F.col("url").alias("careerUrl"), F.expr("k % 5 = 0").alias("redisSeeded"), F.expr("CAST(NULL AS TIMESTAMP_NTZ)").alias("redisSeededAt"))
    done = synthetic(spark, d, "spellings").where("k % 11 = 0").select("url")
    first, marked = seeds.seed_batch(rows, F.expr(NOW), most=40)
    again, _ = seeds.seed_batch(rows, F.expr(NOW), done, queue_length=0)
    parts = first.select(F.lit("first").alias("part"), "key"), again.select(F.lit("again").alias("part"), "key"), marked.where(F.col("redisSeededAt").isNotNull()).select(F.lit("marked").alias("part"), F.col("id").cast("string").alias("key"))
    return reduce(DataFrame.unionByName, parts)


@query
def seed_choice(spark, d):
    rows = synthetic(spark, d, "spellings").select(F.col("k").alias("id"), F.col("url").alias("careerUrl"), F.lit(True).alias("redisSeeded"))
    found = [seeds.choose_seed_table(x) for x in ([("empty", rows.limit(0)), ("all_marked", rows)], [("all_marked", rows), ("open", rows.withColumn("redisSeeded", F.lit(None).cast("boolean")))])]
    return spark.createDataFrame(found, "name string, reason string")


@query
def message_log(spark, d):
    path = f"{shared_folder(spark)}/log-{uuid.uuid4().hex}"
    rows = table(spark, d, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("value"))
    none = seeds.log_length(spark, path)
    seeds.append_messages(rows.where("id % 2 = 0"), path)
    seeds.append_messages(rows.where("id % 2 = 1").withColumn("value", F.struct("value")), path)
    return spark.read.parquet(path).groupBy("value").agg(F.count(F.lit(1)).alias("n"), F.lit(none).cast("bigint").alias("before"), F.lit(seeds.log_length(spark, path)).cast("bigint").alias("after"))


@query
def vocabulary_file(spark, d):
    path = f"{shared_folder(spark)}/words-{uuid.uuid4().hex}"
    table(spark, d, "nation").select(F.lit(1).alias("g"), "n_name").groupBy("g").agg(F.to_json(F.array_sort(F.collect_list("n_name"))).alias("value")).select("value").write.text(path)
    return spark.createDataFrame([(x,) for x in seeds.json_array_file(spark, path)], "word string")


@query
def health_json(spark, d):
    return seeds.health_report(lifecycle.health(synthetic(spark, d, "jobs")))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
