"""Command line: runs the batch jobs over Parquet tables.

    python -m linkloom.cli seed --file urls.txt --queue pages_queue/
    python -m linkloom.cli seed --table seeds/ --marks seed_marks/ --queue pages_queue/ [--done career_links/] [--watch]
    python -m linkloom.cli worker:links --pages pages/ --out career_links/ [--max 1000] [--expand]
    python -m linkloom.cli seed:job-links --jobs jobs/ --marks job_marks/ --queue jobs_queue/ --now "2024-01-01 00:00:00" [--watch]
    python -m linkloom.cli seed:failed-links --log failed/ --queue pages_queue/ [--max 100] [--keep-failed]
    python -m linkloom.cli worker:html --pages pages/ --jobs jobs/ --out postings/ [--source table] [--max 1000]
    python -m linkloom.cli health --jobs jobs/ [--json]

Tables are read, and queues and marks appended to; no command changes a table that it reads. With --watch
a seeding command goes on, --poll-ms after each cycle, until --cycles or --max are reached."""

from __future__ import annotations

import argparse
import logging
import time
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import postings
from .functions.predicates import is_likely_job_link
from .operators import lifecycle, records
from .sources import seeds

log = logging.getLogger("linkloom")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="linkloom", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(dest="command", required=True)
    needed = {
        "seed": ("queue",), "worker:links": ("pages", "out"), "seed:job-links": ("jobs", "marks", "queue", "now"), "seed:failed-links": ("log", "queue"), "worker:html": ("pages", "jobs", "out"),
        "health": ("jobs",),
    }
    optional = {"seed": ("file", "table", "marks", "done"), "worker:html": ("now",), "worker:links": ("existing",)}
    flags = {
        "seed": ("include-seeded", "resume-from-results", "recover-when-empty", "watch"), "worker:links": ("expand",), "seed:job-links": ("include-queued", "reset-queued", "recover-when-empty", "watch"),
        "seed:failed-links": ("keep-failed",), "worker:html": ("retry-errors", "skip-non-jobs"), "health": ("json",),
    }
    for name in needed:
        p = commands.add_parser(name)
        for o in needed[name]:
            p.add_argument(f"--{o}", required=True)
        for o in optional.get(name, ()):
            p.add_argument(f"--{o}")
        for o in flags.get(name, ()):
            p.add_argument(f"--{o}", action="store_true")
        if name != "health":
            p.add_argument("--max", type=int)
        if name in ("seed", "seed:job-links"):
            p.add_argument("--poll-ms", type=int, default=2000)
            p.add_argument("--cycles", type=int)
        if name == "seed":
            p.add_argument("--field", default="careerUrl")
            p.add_argument("--mark-field", default="redisSeeded")
        if name == "seed:failed-links":
            p.add_argument("--batch-size", type=int, default=500)
        if name == "worker:html":
            p.add_argument("--source", choices=("queue", "table"), default="queue")
    return parser


def _cycles(a: argparse.Namespace) -> Iterator[int]:
    """The numbers of the cycles to run: one, or with --watch one after the other."""
    n = 0
    while True:
        yield n
        n += 1
        if not a.watch or (a.cycles and n >= a.cycles):
            return
        time.sleep(a.poll_ms / 1000)


def _table(spark: SparkSession, path: str | None, schema: str) -> DataFrame:
    """A table that other commands append to; empty where there is none yet."""
    return spark.read.parquet(path) if path and seeds.log_length(spark, path) else spark.createDataFrame([], schema)


def _seed_tables(spark: SparkSession, a: argparse.Namespace) -> None:
    total = 0
    for n in _cycles(a):
        left = a.max - total if a.max else None
        if left is not None and left <= 0:
            break
        table = spark.read.parquet(a.table)
        kind = table.schema["id"].dataType.simpleString()
        marked = _table(spark, a.marks, f"id {kind}")
        table = table.drop(a.mark_field).join(marked.select("id").distinct().withColumn(a.mark_field, F.lit(True)), "id", "left")
        empty = seeds.log_length(spark, a.queue) if a.recover_when_empty or a.watch else None
        done = spark.read.parquet(a.done).select(F.col("career_url").alias("url")) if a.done and (a.resume_from_results or empty == 0) else None
        queue, after = seeds.seed_batch(table, F.current_timestamp(), done, empty, a.include_seeded, left, "id", a.field, a.mark_field)
        before = seeds.log_length(spark, a.queue)
        queue.write.mode("append").parquet(a.queue)
        if a.marks:
            after.where(F.col(a.mark_field)).select("id").join(marked, "id", "left_anti").write.mode("append").parquet(a.marks)
        total += seeds.log_length(spark, a.queue) - before
        log.info("seed cycle %s: %s queued in all", n, total)


def _seed_jobs(spark: SparkSession, a: argparse.Namespace) -> None:
    total = 0
    for n in _cycles(a):
        jobs = spark.read.parquet(a.jobs)
        kind = jobs.schema["queued_at"].dataType.simpleString()
        now = F.lit(a.now).cast(kind)
        marks = _table(spark, a.marks, f"id bigint, queued_at {kind}").groupBy("id").agg(F.max("queued_at").alias("_at"))
        jobs = jobs.join(marks, "id", "left").withColumns({"queued": F.col("queued") | F.col("_at").isNotNull(), "queued_at": F.greatest("queued_at", "_at")}).drop("_at")
        left = a.max - total if a.max else None
        if left is not None and left <= 0:
            break
        before = seeds.log_length(spark, a.queue)
        queue, after = lifecycle.seed_cycle(jobs, now, before, a.recover_when_empty, a.reset_queued and not n, a.include_queued, left)
        queue.write.mode("append").parquet(a.queue)
        after.where(F.col("queued_at") == now).select("id", "queued_at").write.mode("append").parquet(a.marks)
        total += seeds.log_length(spark, a.queue) - before
        log.info("job cycle %s: %s queued in all", n, total)


def main(argv: list[str] | None = None) -> None:
    a = _parser().parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    read = spark.read.parquet
    if a.command == "seed" and a.file:
        seeds.seed_file(spark, a.file).write.mode("append").parquet(a.queue)
    elif a.command == "seed":
        _seed_tables(spark, a)
    elif a.command == "worker:links":
        pages = read(a.pages).orderBy("page_id").limit(a.max) if a.max else read(a.pages)
        records.career_links(pages, expand=a.expand, existing=read(a.existing) if a.existing else None).write.mode("overwrite").parquet(a.out)
    elif a.command == "seed:job-links":
        _seed_jobs(spark, a)
    elif a.command == "seed:failed-links":
        moved, _ = lifecycle.replay(read(a.log), a.batch_size, a.max, a.keep_failed)
        moved.write.mode("append").parquet(a.queue)
    elif a.command == "worker:html":
        jobs = read(a.jobs)
        if a.source == "table":
            jobs = lifecycle.claimable(jobs, F.lit(a.now).cast(jobs.schema["lock_until"].dataType) if a.now else F.current_timestamp(), a.retry_errors).orderBy("discovered_at", "id")
        jobs = jobs.limit(a.max) if a.max else jobs
        pages = read(a.pages).join(jobs.select("url").distinct(), "url", "left_semi")
        pages = pages.where(is_likely_job_link(F.col("url"))) if a.skip_non_jobs else pages
        found = pages.select("page_id", "url", postings.posting_columns(postings.job_posting(F.col("html"))).alias("f"))
        found.where("f.company is not null").select("page_id", "url", "f.*").write.mode("overwrite").parquet(a.out)
    else:
        snapshot = lifecycle.health(read(a.jobs))
        if a.json:
            print(seeds.health_report(snapshot).first()[0])
        else:
            snapshot.show(truncate=False)


if __name__ == "__main__":
    main()
