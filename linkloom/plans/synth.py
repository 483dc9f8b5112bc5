"""Inputs that the driver's tables lack, as SQL that Spark and the checking engine both run.

{table} stands for a table; every expression is spelled alike in both dialects."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VENDORS = (
    "https://jobs.lever.co/acme", "https://boards.greenhouse.io/acme", "https://acme.wd5.myworkdayjobs.com/en-US/Ext", "https://e.fa.oraclecloud.com/hcmUI/CandidateExperience/en/sites/CX_1",
    "https://acme.bamboohr.com/careers", "https://acme.recruitee.com/o", "https://careers.icims.com/jobs", "https://www.example.org/work",
)


def _case(key: str, values: tuple[str, ...]) -> str:
    return "CASE " + " ".join(f"WHEN {key} % {len(values)} = {i} THEN {v}" for i, v in enumerate(values)) + " END"


def _text(*values: str) -> tuple[str, ...]:
    return tuple("'" + v + "'" for v in values)


_HOST = "concat('https://', CASE WHEN k % 5 = 0 THEN 'www.' ELSE '' END, 'h', CAST(k % 37 AS STRING), '.example.com')"
_PATHS = _case("k", (
    "concat('/job/', CAST(k AS STRING))", "concat('/jobs/', CAST(k AS STRING))", "'/careers/engineer'", "'/about'", "concat('/p?jobid=', CAST(k AS STRING))", "'/privacy'", "concat('/files/x', CAST(k AS STRING), '.pdf')",
    "'/careers/home-health-aide'", "'/openings/'", "concat('/x?jobcode=0', CASE WHEN k % 2 = 0 THEN '' ELSE '7' END)", "'/blog/apply-now-for-a-better-job-story-today'", "'/team/contact'",
))

INPUTS = {
    # (k, url)
    "job_urls": f"SELECT k, concat({_HOST}, {_PATHS}) AS url FROM (SELECT p_partkey AS k FROM {{part}}) t",
    # (k, url): spellings of few pages
    "spellings": """
        SELECT k, concat(CASE WHEN k % 2 = 0 THEN 'http' ELSE 'HTTPS' END, '://', CASE WHEN k % 3 = 0 THEN 'Site' ELSE 'site' END, CAST(s AS STRING), '.example.com',
                         CASE WHEN k % 4 = 0 AND k % 2 = 0 THEN ':80' WHEN k % 4 = 1 THEN ':8080' ELSE '' END, '/p', CAST(s % 3 AS STRING),
                         CASE WHEN k % 5 = 0 THEN '/' WHEN k % 5 = 1 THEN '?q=1' WHEN k % 5 = 2 THEN '#top' WHEN k % 5 = 3 THEN '#/jobs/7' ELSE '' END) AS url
        FROM (SELECT o_orderkey AS k, o_custkey % 40 AS s FROM {orders}) t""",
    # (k, v, shape, url)
    "board_urls": f"""
        SELECT k, v, shape, concat({_case("v", _text(*VENDORS))}, {_case("shape", ("''", "'/'", "'/job/4711'", "'/details'", "concat('/deadbeef', CAST(10 + v AS STRING))"))}) AS url
        FROM (SELECT s_suppkey AS k, s_suppkey % 8 AS v, CAST(floor(s_suppkey / 8) AS BIGINT) % 5 AS shape FROM {{supplier}}) t""",
    # (k, text)
    "anchor_texts": f"SELECT p_partkey AS k, {_case('p_partkey', (*_text('About Us', 'Apply now', 'Home', 'Contact', 'Open positions', 'Nurse', 'Learn more', 'Careers'), 'p_name'))} AS text FROM {{part}}",
    # (id, url, status, discovered_at, lock_until, error_at, queued, queued_at, career_url, attempts)
    "jobs": """
        SELECT k AS id, concat(CASE WHEN k % 2 = 0 THEN 'http' ELSE 'https' END, '://h', CAST(k % 50 AS STRING), '.example.com/job/', CAST(floor(k / 6) AS BIGINT)) AS url,
               CASE WHEN k % 7 = 0 THEN 'pending' WHEN k % 7 = 1 THEN 'processing' WHEN k % 7 = 2 THEN 'done' WHEN k % 7 = 3 THEN 'skipped' WHEN k % 7 = 4 THEN 'error' WHEN k % 7 = 5 THEN 'missing' END AS status,
               d AS discovered_at, CASE WHEN k % 3 = 0 THEN d + INTERVAL 1 DAY END AS lock_until, CASE WHEN k % 7 = 4 THEN d + INTERVAL 2 DAY END AS error_at,
               CASE WHEN k % 4 = 0 THEN NULL ELSE k % 4 = 1 END AS queued, CASE WHEN k % 8 < 5 THEN d + INTERVAL 3 HOUR END AS queued_at,
               CASE WHEN k % 3 = 1 THEN concat('https://h', CAST(k % 50 AS STRING), '.example.com/careers') WHEN k % 3 = 2 THEN '' END AS career_url, CAST(k % 4 AS INT) AS attempts
        FROM (SELECT o_orderkey AS k, o_orderdate AS d FROM {orders}) t""",
    # (id, stream, url, error, retries)
    "failures": f"""
        SELECT event_id AS id, CASE WHEN user_id % 2 = 0 THEN 'links' ELSE 'html' END AS stream,
               concat('https://h', CAST(user_id % 20 AS STRING), '.example.com/', {_case('event_id', _text('a', 'b.pdf', 'c?x=1', 'd.HTML', 'e.zip'))}) AS url,
               {_case('event_id', _text('Response code 404 (Not Found)', 'Response code 429 (Too Many)', 'status: 503', 'Navigation timeout', 'TypeError: Invalid URL', 'status code=408', 'Unsupported protocol ftp', 'Protocol "mailto:" not supported', 'unsupported url scheme'))} AS error,
               CAST(event_id % 5 AS INT) AS retries
        FROM {{events}}""",
    # (id, value)
    "messages": """
        SELECT event_id AS id, CASE
            WHEN event_id % 5 = 0 THEN concat('https://a.example.com/', CAST(user_id AS STRING))
            WHEN event_id % 5 = 1 THEN concat('{{"url":"https://a.example.com/', CAST(user_id AS STRING), '","careerUrl":"https://c.example.com"}}')
            WHEN event_id % 5 = 2 THEN concat('{{"link":"https://b.example.com/', CAST(user_id AS STRING), '","career_url":"https://d.example.com"}}')
            WHEN event_id % 5 = 3 THEN concat('{{"_clf_payload":"https://e.example.com/', CAST(user_id AS STRING), '","_clf_retry":', CAST(event_id % 4 AS STRING), ',"_clf_first_seen_at":"2024-01-01"}}')
            ELSE '{{not json' END AS value
        FROM {events}""",
    # (k, page)
    "posting_pages": """
        SELECT p_partkey AS k, concat('<html><script type="application/ld+json">', CASE
            WHEN p_partkey % 4 = 0 THEN concat('{{"@type":"JobPosting","title":"', p_name, '","hiringOrganization":{{"name":"', p_brand, '","sameAs":"https://s.example.com","logo":"l.png"}},"identifier":{{"value":"', CAST(p_partkey AS STRING), '"}},"description":"Do it","datePosted":"2024-01-02","validThrough":"2024-02-03","occupationalCategory":"29-1141",',
                 '"baseSalary":{{"currency":"USD","value":{{"minValue":10,"maxValue":', CAST(p_size + 10 AS STRING), ',"unitText":"HOUR"}}}},"jobLocation":{{"address":{{"addressLocality":"X","addressRegion":"Y","addressCountry":{{"name":"Z"}},"postalCode":"04109"}}}}}}')
            WHEN p_partkey % 4 = 1 THEN concat('[{{"@type":"Thing"}},{{"@type":"jobposting","title":"', p_name, '","hiringOrganization":"', p_brand, '","jobLocation":"', p_type, '"}}]')
            WHEN p_partkey % 4 = 2 THEN concat('{{"@graph":[{{"@type":"WebPage"}},{{"@type":["JobPosting"],"title":"', p_name, '","hiringOrganization":{{"name":"', p_brand, '"}},"employmentType":"FULL_TIME"}}]}}')
            ELSE '{{"@type":"JobPosting", broken' END, '</script></html>') AS page
        FROM {part}""",
    # (page_id, url, html): links in the page's own sections and body
    "built_pages": """
        SELECT s_suppkey AS page_id, concat('https://p', CAST(s_suppkey AS STRING), '.example.org/careers') AS url,
               concat('<nav><a href="/about">About</a></nav><a href="/job/', CAST(s_suppkey AS STRING), '">Nurse</a><a href="https://q', CAST(s_suppkey % 10 AS STRING), '.example.net/jobs">All</a>',
                      '<iframe src="/frame/', CAST(s_suppkey % 3 AS STRING), '"></iframe><div data-url="/d/', CAST(s_suppkey % 4 AS STRING), '" onclick="go(''/c/', CAST(s_suppkey % 5 AS STRING), ''')">x</div>',
                      '<footer><a href="/privacy">Privacy</a></footer>') AS html
        FROM {supplier}""",
    # (page_id, url, html, status_code, error): each status that a page's row can have, by k % 8
    "career_pages": """
        SELECT k AS page_id, concat('https://c', CAST(k AS STRING), CASE WHEN k % 8 = 4 THEN '.indeed' ELSE '' END, '.example.org/careers') AS url,
               concat('<html><title>Page ', CAST(k AS STRING), '</title><body>', CASE
                 WHEN k % 8 = 0 THEN concat('<a href="/job/', CAST(k AS STRING), '">Nurse</a><a href="/zebra">About Us</a>')
                 WHEN k % 8 = 1 THEN concat('<a href="https://jobs.lever.co/acme', CAST(k AS STRING), '">Open roles</a>')
                 WHEN k % 8 = 2 THEN '<p>This position has been filled.</p>'
                 WHEN k % 8 = 4 THEN concat('<a href="/job/', CAST(k AS STRING), '">Nurse</a>')
                 WHEN k % 8 = 6 THEN '<a href="/.well-known/sgcaptcha/?r=1">check</a>'
                 WHEN k % 8 = 7 THEN '<a href="/team">Zebra</a><a href="/blog/post">Giraffe</a><a href="/careers/">Careers</a>'
                 ELSE '' END, '</body></html>') AS html,
               CAST(CASE WHEN k % 8 = 3 THEN 404 WHEN k % 8 = 5 THEN 0 ELSE 200 END AS INT) AS status_code, CASE WHEN k % 8 = 5 THEN 'Navigation timeout' END AS error
        FROM (SELECT p_partkey AS k FROM {part}) t""",
    # (k, text)
    "pagers": f"SELECT o_orderkey AS k, {_case('o_orderkey', ('concat(' + chr(39) + 'Showing 1 - 10 of ' + chr(39) + ', CAST(o_custkey % 900 + 11 AS STRING))', 'concat(' + chr(39) + 'Page: 2 of ' + chr(39) + ', CAST(o_custkey % 90 + 2 AS STRING))', 'concat(' + chr(39) + 'Showing 20 of ' + chr(39) + ', CAST(o_custkey % 900 + 20 AS STRING), ' + chr(39) + ' jobs' + chr(39) + ')', chr(39) + 'no pager' + chr(39), chr(39) * 2))} AS text FROM {{orders}}",
}


def spread(df: DataFrame, piece: int = 1 << 17) -> DataFrame:
    """The rows of a table in tasks of about `piece` bytes of its files, for work that is dear by the row: of
    short rows one row group, which is one task, holds a million."""
    n = -(-int(str(df._jdf.queryExecution().analyzed().stats().sizeInBytes())) // piece)
    return df.repartition(n) if n > 1 else df


def tables_of(name: str) -> list[str]:
    return sorted(set(re.findall(r"(?<!\{)\{(\w+)\}(?!\})", INPUTS[name])))


def synthetic(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.sql(INPUTS[name], **{t: spread(spark.read.parquet(f"{sf_dir}/{t}.parquet")) for t in tables_of(name)})


def synthetic_sql(name: str) -> str:
    """The same rows for the checking engine, as a subquery."""
    text = INPUTS[name]
    for t in tables_of(name):
        text = re.sub(rf"(?<!\{{)\{{{t}\}}", t, text)
    return "(" + text.replace("{{", "{").replace("}}", "}") + ")"
