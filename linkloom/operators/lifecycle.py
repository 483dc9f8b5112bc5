"""The processing lifecycle as relations: envelopes, retries, claims, re-seeding, upserts, health.

All times are columns or literals that the caller gives; nothing here reads a clock."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import rules as R
from ..functions.base import contains_any, let
from ..functions.predicates import is_likely_job_link
from ..functions.rules import CONFIGURED, RuleSet
from ..functions.text import http_status
from ..functions.urls import file_extension, form_preference, url_forms, url_key

PAYLOAD, RETRY, FIRST_SEEN = R.ENVELOPE


def queue_item(value: Column) -> Column:
    """STRUCT<url, career_url> of a queue value: an object's URL, or the value itself."""
    get = lambda *names: F.coalesce(*[F.nullif(F.get_json_object(value, f"$.{n}"), F.lit("")) for n in names])
    is_object = F.trim(value).startswith("{") & F.try_parse_json(value).isNotNull()
    return F.when(is_object, F.struct(get("url", "link", "jobUrl").alias("url"), get("careerUrl", "career_url").alias("career_url"))).otherwise(
        F.struct(F.trim(value).alias("url"), F.lit(None).cast("string").alias("career_url"))
    )


def decode_envelope(value: Column) -> Column:
    """STRUCT<value, retries, first_seen>: what a retry envelope holds, or the value as it is."""
    payload = F.get_json_object(value, f"$.{PAYLOAD}")
    wrapped = F.trim(value).startswith("{") & payload.isNotNull()
    count = F.coalesce(F.get_json_object(value, f"$.{RETRY}").try_cast("double"), F.lit(0.0))
    return F.struct(
        F.when(wrapped, payload).otherwise(value).alias("value"),
        F.when(wrapped, F.floor(F.greatest(count, F.lit(0.0)))).otherwise(0).cast("int").alias("retries"),
        F.when(wrapped, F.get_json_object(value, f"$.{FIRST_SEEN}")).alias("first_seen"),
    )


def encode_envelope(value: Column, retries: Column, first_seen: Column) -> Column:
    return F.to_json(F.struct(value.alias(PAYLOAD), retries.alias(RETRY), first_seen.alias(FIRST_SEEN)))


def retry_decision(error: Column, url: Column) -> Column:
    """STRUCT<retryable, reason>: files, client errors but 408 and 429, and bad URLs are final."""
    extension, status = file_extension(url), http_status(error)
    reason = (
        F.when(extension.isin(*R.FINAL_EXTENSIONS), F.concat(F.lit("non_retryable_extension:"), extension))
        .when((status >= 400) & (status < 500) & ~status.isin(408, 429), F.concat(F.lit("http_"), status.cast("string")))
        .when(contains_any(F.lower(error), R.FINAL_ERRORS), "invalid_or_unsupported_url")
        .otherwise("retryable")
    )
    return F.struct((reason == "retryable").alias("retryable"), reason.alias("reason"))


def retry_outcomes(failures: DataFrame, most: int = 3) -> DataFrame:
    """failures (url, error, retries) with reason and outcome: requeued, parked for good errors
    that come too often (max_retries), or parked at once."""
    out = failures.withColumn("d", retry_decision(F.col("error"), F.col("url")))
    spent = F.col("d.retryable") & (F.col("retries") >= most)
    out = out.withColumn("reason", F.when(spent, "max_retries").otherwise(F.col("d.reason")))
    return out.withColumn("outcome", F.when(F.col("d.retryable") & ~spent, "requeued").otherwise("parked")).drop("d")


def retry_counters(outcomes: DataFrame, stream: str = "stream") -> DataFrame:
    """(name, value): each counter in all and for each stream, in one pass. A parked message
    counts as parked and, by its reason, as exhausted or skipped."""
    why = F.when(F.col("reason") == "max_retries", "retry_exhausted").otherwise("retry_skipped")
    names = F.when(F.col("outcome") == "requeued", F.array(F.lit("retry_requeued"))).otherwise(F.array(F.lit("failed_parked"), why))
    counts = outcomes.select(F.col(stream).alias("s"), F.explode(names).alias("c")).rollup("c", "s").count().where("c is not null")
    label = F.when(F.col("s").isNull(), F.concat("c", F.lit("_total"))).otherwise(F.concat_ws(":", "s", "c"))
    return counts.select(label.alias("name"), F.col("count").alias("value"))


def claimable(jobs: DataFrame, now: Column, retry_errors: bool = False, error_delay: str = "INTERVAL 300 SECONDS") -> DataFrame:
    """Jobs that are waiting, unlocked or with a lease that ran out, and old errors if asked for."""
    waits = F.col("status").isNull() | F.col("status").isin("pending", "processing")
    if retry_errors:
        waits = waits | ((F.col("status") == "error") & (F.col("error_at").isNull() | (F.col("error_at") <= now - F.expr(error_delay))))
    return jobs.where(waits & (F.col("lock_until").isNull() | (F.col("lock_until") <= now)))


def claim(jobs: DataFrame, now: Column, worker: str, count: int, lease: str = "INTERVAL 300 SECONDS", **options: object) -> DataFrame:
    """The next `count` claimable jobs, longest undiscovered first, as they are once claimed."""
    taken = claimable(jobs, now, **options).orderBy("discovered_at", "id").limit(count)
    return taken.withColumns({"status": F.lit("processing"), "attempts": F.coalesce("attempts", F.lit(0)) + 1, "lock_by": F.lit(worker), "lock_at": now, "lock_until": now + F.expr(lease)})


def open_jobs(jobs: DataFrame, now: Column, include_queued: bool = False, stale: str = "INTERVAL 4 HOURS") -> DataFrame:
    """Jobs with a URL that are neither done nor skipped nor, unless asked for, queued of late."""
    open_ = F.col("url").isNotNull() & (F.col("status").isNull() | ~F.col("status").isin("done", "skipped"))
    if not include_queued:
        open_ = open_ & (~F.coalesce("queued", F.lit(False)) | F.col("queued_at").isNull() | (F.col("queued_at") <= now - F.expr(stale)))
    return jobs.where(open_)


def reseed(jobs: DataFrame, now: Column, include_queued: bool = False, stale: str = "INTERVAL 4 HOURS") -> DataFrame:
    """(key, url, career_url): what goes into the queue again. Of the spellings of one URL the preferred
    one, with the first career URL there is."""
    rows = open_jobs(jobs, now, include_queued, stale).select("id", "career_url", url_forms(F.col("url")).alias("f"))
    career = F.min_by("career_url", F.when(F.coalesce("career_url", F.lit("")) != "", F.col("id")))
    return rows.groupBy(F.col("f.key").alias("key")).agg(F.min_by("f.normal", form_preference(F.col("f"))).alias("url"), career.alias("career_url"))


def discoveries(found: DataFrame) -> DataFrame:
    """found (url, career_url, at) by job: first and last time, latest page, all pages, count."""
    latest = F.struct("at", "career_url")
    return found.groupBy("url").agg(
        F.min("at").alias("first_discovered_at"), F.max("at").alias("last_discovered_at"), F.max_by("career_url", latest).alias("career_url"),
        F.array_sort(F.collect_set("career_url")).alias("career_urls"), F.count(F.lit(1)).alias("discovery_count"),
    )


#: How two values of one key become one: the new one, the old one, their union, sum, min or max.
POLICIES = {
    "overwrite": lambda old, new: F.coalesce(new, old),
    "insert_only": lambda old, new: F.coalesce(old, new),
    "union": lambda old, new: F.array_sort(F.array_union(F.coalesce(old, F.array()), F.coalesce(new, F.array()))),
    "add": lambda old, new: F.coalesce(old, F.lit(0)) + F.coalesce(new, F.lit(0)),
    "min": lambda old, new: F.least(old, new),
    "max": lambda old, new: F.greatest(old, new),
}


def upsert(old: DataFrame, new: DataFrame, key: str, policies: Mapping[str, str]) -> DataFrame:
    """old with new merged in by key, each column by its policy. Keys are unique on both sides."""
    a, b = old.alias("a"), new.alias("b")
    both = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")
    merged = [POLICIES[p](F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) for c, p in policies.items()]
    return both.select(F.coalesce(f"a.{key}", f"b.{key}").alias(key), *merged)


def unseen(messages: DataFrame, seen: DataFrame, key: str = "key", pos: str = "pos") -> DataFrame:
    """The first message of each key that has not been seen before."""
    first = Window.partitionBy(key).orderBy(pos)
    fresh = messages.where(F.col(key).isNotNull()).join(seen.select(key).distinct(), key, "left_anti")
    return fresh.withColumn("n", F.row_number().over(first)).where("n = 1").drop("n")


def move(source: DataFrame, count: int, order: str = "id") -> tuple[DataFrame, DataFrame]:
    """(moved, left): the first `count` messages in order, and the rest."""
    moved = source.orderBy(order).limit(count)
    return moved, source.join(moved.select(order), order, "left_anti")


def replay(source: DataFrame, batch: int, most: int | None = None, keep: bool = False, order: str = "id") -> tuple[DataFrame, DataFrame]:
    """(moved, left) of a queue of failed messages: all of them, or the first `most`, go; with keep
    one batch is copied and all stay."""
    if keep:
        return source.orderBy(order).limit(min(batch, most or batch)), source
    return move(source, most, order) if most else (source, source.limit(0))


def acknowledge(pending: DataFrame, log: DataFrame, done: DataFrame, delete: bool = True, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(pending, log) after the messages `done` were acknowledged: they wait no more, and those of them
    that had been waiting leave the log, if asked for."""
    keys = done.select(key).distinct()
    acked = pending.join(keys, key, "left_semi").select(key)
    return pending.join(keys, key, "left_anti"), log.join(acked, key, "left_anti") if delete else log


def stale_pending(deliveries: DataFrame, now: Column, idle: str = "INTERVAL 60 SECONDS") -> DataFrame:
    return deliveries.where(F.col("delivered_at") <= now - F.expr(idle))


def health(jobs: DataFrame) -> DataFrame:
    """One row of counts over jobs with a URL."""
    s = F.col("status")
    count = lambda test, name: F.count_if(test).alias(name)
    return jobs.where("url is not null").agg(
        F.count(F.lit(1)).alias("total"), *[count(s == x, x) for x in ("pending", "processing", "done", "skipped", "error")], count(s.isNull(), "missing_status"),
        count(F.coalesce("queued", F.lit(False)) & (s.isNull() | ~s.isin("done", "skipped")), "queued_pending"),
    )


def queue_health(deliveries: DataFrame, queue: str = "queue", group: str = "group", consumer: str = "consumer") -> DataFrame:
    """(queue, group, pending, consumers) of undelivered and delivered messages."""
    return deliveries.groupBy(F.col(queue).alias("queue"), F.col(group).alias("group")).agg(F.count(F.lit(1)).alias("pending"), F.count_distinct(consumer).alias("consumers"))


def info_section(text: Column) -> Column:
    """The key:value lines of a report as a map; comments and lines without a key are left out, and
    of equal keys the last one stays."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), r"\r?\n"), lambda x: ~x.startswith("#") & (F.instr(x, ":") > 1))
    pairs = F.transform(lines, lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("key"), F.trim(F.substring(x, F.instr(x, ":") + 1, F.length(x))).alias("value")))
    pairs = F.filter(pairs, lambda p: p["key"] != "")
    last = lambda ps: F.filter(ps, lambda p, i: ~F.exists(F.slice(ps, i + 2, F.greatest(F.size(ps), F.lit(1))), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(let(pairs, last))


def duplicated(df: DataFrame, key: str) -> DataFrame:
    """(key, n) of the keys that are there more than once: no rows where `key` is unique."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def html_work(messages: DataFrame, jobs: DataFrame, only_jobs: bool = False, rules: RuleSet = CONFIGURED) -> DataFrame:
    """messages (id, url, career_url) with action and the career URL that the job knows, if it lacks one.

    action: done for jobs (url, status, career_url, career_urls) that are done or skipped; skip, if
    asked for, for what is no job link; else fetch. Messages without a URL are done."""
    known = jobs.select("url", F.col("status").alias("_status"), F.coalesce(F.nullif("career_url", F.lit("")), F.get("career_urls", F.lit(0))).alias("_career"))
    out = messages.join(known, "url", "left")
    settled = F.coalesce(F.col("_status").isin("done", "skipped"), F.lit(False)) | (F.coalesce("url", F.lit("")) == "")
    skips = F.lit(only_jobs) & ~is_likely_job_link(F.col("url"), rules)
    career = F.coalesce(F.nullif("career_url", F.lit("")), F.col("_career"))
    return out.select("id", "url", career.alias("career_url"), F.when(settled, "done").when(skips, "skip").otherwise("fetch").alias("action"))


def mark_jobs(jobs: DataFrame, marks: DataFrame, now: Column, extras: tuple[str, ...] = ()) -> DataFrame:
    """jobs after marks (url, status, career_url, extras), which hold each URL once: status and extras
    are set, a career URL only where there is one, locks are cleared, and new jobs are inserted with
    created_at."""
    a, b = jobs.alias("a"), marks.alias("b")
    both = a.join(b, F.col("a.url") == F.col("b.url"), "full_outer")
    marked = F.col("b.url").isNotNull()
    special = {
        "url": F.coalesce("a.url", "b.url"), "career_url": F.coalesce(F.nullif("b.career_url", F.lit("")), F.col("a.career_url")), "created_at": F.coalesce("a.created_at", F.when(marked, now)),
        "updated_at": F.when(marked, now).otherwise(F.col("a.updated_at")),
    }
    special |= {c: F.when(marked, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")) for c in ("status", *extras)}
    special |= {c: F.when(~marked, F.col(f"a.{c}")) for c in ("lock_by", "lock_at", "lock_until")}
    return both.select(*[special.get(c, F.col(f"a.{c}")).alias(c) for c in jobs.columns])


def mark_queued(jobs: DataFrame, urls: DataFrame, now: Column) -> DataFrame:
    """jobs with those of `urls` (url) marked as queued."""
    keys = urls.select("url").distinct().withColumn("_now", F.lit(True))
    out = jobs.join(keys, "url", "left")
    return out.withColumns({"queued": F.coalesce("_now", "queued"), "queued_at": F.when(F.col("_now"), now).otherwise(F.col("queued_at"))}).drop("_now")


def seed_cycle(jobs: DataFrame, now: Column, queue_length: int, recover_when_empty: bool = True, reset: bool = False, include_queued: bool = False, most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(queue, jobs) of one cycle of re-seeding. An empty queue makes queued jobs count as open, if
    asked for; reset, for the first cycle, clears the marks of open jobs first. `most` URLs at most,
    by id. All jobs that were looked at are marked as queued."""
    open_ = F.col("status").isNull() | ~F.col("status").isin("done", "skipped")
    if reset:
        jobs = jobs.withColumns({"queued": F.when(~open_, F.col("queued")), "queued_at": F.when(~open_, F.col("queued_at"))})
    todo = open_jobs(jobs, now, include_queued or (recover_when_empty and queue_length == 0))
    todo = todo.orderBy("id").limit(most) if most else todo
    return reseed(todo, now, include_queued=True), mark_queued(jobs, todo, now)


def open_seeds(seeds: DataFrame, done: DataFrame, include_seeded: bool = False) -> DataFrame:
    """Seeds with a URL that are unmarked and whose page has not been completed."""
    rows = seeds.where("url is not null" + ("" if include_seeded else " and seeded is distinct from true"))
    keys = done.select(url_key(F.col("url")).alias("key")).distinct()
    return rows.withColumn("key", url_key(F.col("url"))).join(keys, "key", "left_anti")


#: Which status may follow which.
NEXT_STATUS = {None: ("pending", "processing"), "pending": ("processing",), "processing": ("done", "skipped", "error"), "error": ("processing",), "done": (), "skipped": ()}


def bad_transitions(history: DataFrame, key: str = "url", at: str = "at") -> DataFrame:
    """Steps of a status history (key, at, status) that the lifecycle does not have."""
    before = F.lag("status").over(Window.partitionBy(key).orderBy(at))
    fine = F.lit(False)
    for old, news in NEXT_STATUS.items():
        if news:
            fine = fine | ((F.col("before").isNull() if old is None else F.col("before") == old) & F.col("status").isin(*news))
    return history.withColumn("before", before).where(~F.coalesce(fine, F.lit(False)))
