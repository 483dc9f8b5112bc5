"""SQL for the checking engine, written on its own, by query name."""

from __future__ import annotations

from ..functions import rules as R
from .synth import VENDORS
from .synth import synthetic_sql as S

_ENC = r"CASE WHEN regexp_matches({x}, '[^\x21-\x7e]') THEN list_aggregate(list_transform(string_split({x}, ''), lambda c: CASE WHEN regexp_matches(c, '[^\x21-\x7e]') THEN url_encode(c) ELSE c END), 'string_agg', '') ELSE {x} END"


def _parts(source: str, keep: str, url: str = "url") -> str:
    """URL parts of http(s) URLs without user names, dot segments or spaces."""
    encoded = lambda x: _ENC.format(x=x)
    return f"""(
      SELECT *, CASE WHEN scheme = 'http' AND port0 = '80' OR scheme = 'https' AND port0 = '443' THEN '' ELSE port0 END AS port
      FROM (SELECT {keep}, {url} AS raw, lower(regexp_extract({url}, '^([A-Za-z]+)://', 1)) AS scheme, lower(regexp_extract({url}, '^[A-Za-z]+://([^/?#:]*)', 1)) AS host,
                   regexp_extract({url}, '^[A-Za-z]+://[^/?#:]*:([0-9]+)', 1) AS port0,
                   CASE WHEN regexp_extract({url}, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) = '' THEN '/' ELSE {encoded(f"regexp_extract({url}, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1)")} END AS path,
                   regexp_extract({url}, '^[^#?]*([?][^#]*)', 1) AS query, regexp_extract({url}, '(#.*)$', 1) AS hash
            FROM {source}) z)"""


_PLACE = "host || CASE WHEN port = '' THEN '' ELSE ':' || port END"
_TRIMMED = "CASE WHEN path = '/' THEN '/' ELSE regexp_replace(path, '/+$', '') END"
_HASH = "CASE WHEN regexp_matches(lower(hash), '^#!?/(jobs?|careers?|positions?|openings?|opportunit(y|ies)|posting|apply)([^a-z0-9_]|$)') THEN hash ELSE '' END"
_NORMAL = f"scheme || '://' || {_PLACE} || {_TRIMMED} || query || {_HASH}"
_KEY = f"{_PLACE} || {_TRIMMED} || query || {_HASH}"
_SCORE = f"(CASE WHEN scheme = 'https' THEN 100 ELSE 0 END + CASE WHEN {_TRIMMED} <> '/' THEN 10 ELSE 0 END + CASE WHEN query = '' THEN 1 ELSE 0 END)"
_CHOICE = f"first(normal ORDER BY score DESC, length(normal), normal)"


def _any(text: str, words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"


def _matches(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, '{pattern}')"


_U = "lower(url)"
_LIKELY = f"""CASE WHEN {_any(_U, ('emailme.asp',))} OR {_matches(_U, 'jobcode=0([^0-9]|$)')} THEN false WHEN {_matches(_U, '/jobs?(/|[?]|$)')} THEN true
  WHEN {_any(_U, R.STRONG_JOB_CONFIGURED)} THEN true WHEN {_any(_U, R.EXCLUDED_JOB_CONFIGURED)} THEN false ELSE {_any(_U, R.WEAK_JOB)} END"""
_DETAIL = _matches(_U, R.JOB_DETAIL)
#: Path and query of the synthetic job URLs.
_PQ = "lower(regexp_extract(url, '^https?://[^/?#]*(.*)$', 1))"
_PATH = "lower(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1))"
_SIGNAL = f"({_matches(_PQ, R.STRONG_SIGNAL)} OR {_matches(_PQ, R.ATS_QUERY_HINT)})"
_SEGMENTS = f"list_filter(list_transform(string_split({_PATH}, '/'), lambda x: regexp_replace(x, '[^a-z0-9]', '', 'g')), lambda x: x <> '')"
_HARDS = "[" + ", ".join(f"'{x}'" for x in R.HARD_NON_CAREER) + "]"
_HARD = f"(len({_SEGMENTS}) > 0 AND (list_contains({_HARDS}, {_SEGMENTS}[-1]) OR len({_SEGMENTS}) <= 2 AND len(list_filter({_SEGMENTS}, lambda x: NOT list_contains({_HARDS}, x))) = 0))"
_NON_CAREER = f"({_matches(_PATH, R.FILE_PATH)} OR {_HARD} AND NOT {_SIGNAL} OR {_any(_PQ, R.EXCLUDED_JOB_CONFIGURED)} AND (NOT {_SIGNAL} OR {_HARD}))"
_FORM = "trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9\\s]+', ' ', 'g'), '\\s+', ' ', 'g'))"
_STOPS = "[" + ", ".join(f"'{x}'" for x in R.STOP_TEXT) + "]"
_CONFIGURED_TEXT = tuple(x for x in R.NON_JOB_TEXT if x != "connect with us")
_NON_JOB = f"""CASE WHEN f = '' OR length(f) > 140 THEN false WHEN {_any('f', R.JOB_TEXT)} THEN false WHEN {_any('f', _CONFIGURED_TEXT)} THEN true
  ELSE len(string_split(f, ' ')) <= 4 AND len(list_filter(string_split(f, ' '), lambda w: NOT list_contains({_STOPS}, w))) = 0 END"""
#: The pages' anchors: all root-relative.
_ANCHORS = f"""(
  SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*') AS root, a[1] AS href, a[2] AS label
  FROM (SELECT page_id, url, unnest(list_zip(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1), regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2))) AS a FROM pages) z)"""
_ENTRIES = f"(SELECT DISTINCT page_id, root || {_ENC.format(x='href')} AS url, trim(label) AS text FROM {_ANCHORS} y)"
_NOW = "TIMESTAMP '1997-01-01 00:00:00'"
_CANONICAL = "CASE " + " ".join(
    f"WHEN v = {i} THEN {x}"
    for i, x in enumerate(
        (
            f"'{VENDORS[0]}'", f"'{VENDORS[1]}'", f"'{VENDORS[2]}'", f"'{VENDORS[3]}'", f"'{VENDORS[4]}' || CASE WHEN shape = 2 THEN '/job' ELSE '' END",
            # the generic rule takes one segment off what looks like a detail page
            f"'{VENDORS[5]}' || CASE WHEN shape = 2 THEN '/job' ELSE '' END", f"'{VENDORS[6]}' || CASE WHEN shape = 2 THEN '/job' ELSE '' END", f"'{VENDORS[7]}' || CASE WHEN shape = 2 THEN '/job' ELSE '' END",
        )
    )
) + " END"

ORACLE: dict[str, str] = {
    "page_url_parts": f"""SELECT page_id, scheme, host, port, path, query, hash, regexp_replace(host, '^www[.]', '') AS comparable_host,
        lower(regexp_extract(regexp_extract(path, '([^/]*)/*$', 1), '^.+([.][^.]*)$', 1)) AS extension FROM {_parts('pages', 'page_id')}""",
    "page_url_normalized": f"SELECT page_id, {_NORMAL} AS normal, {_KEY} AS key, CAST(CASE WHEN scheme = 'https' THEN 100 ELSE 0 END + CASE WHEN path <> '/' AND NOT ends_with(path, '/') THEN 10 ELSE 0 END + CASE WHEN query = '' THEN 1 ELSE 0 END AS BIGINT) AS score FROM {_parts('pages', 'page_id')}",
    "spelling_normalized": f"SELECT k, {_NORMAL} AS normal, {_KEY} AS key FROM {_parts(S('spellings'), 'k')}",
    "page_title_sample": r"""
        SELECT page_id, title, CAST(length(sample) AS BIGINT) AS sample_chars, md5(sample) AS sample_md5 FROM (
          SELECT page_id, trim(regexp_replace(t(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), '\s+', ' ', 'g')) AS title,
                 substr(trim(regexp_replace(t(regexp_replace(regexp_replace(html, '(?is)<script\b[^>]*>.*?</script>', ' ', 'g'), '(?is)<style\b[^>]*>.*?</style>', ' ', 'g')), '\s+', ' ', 'g')), 1, 60000) AS sample
          FROM pages) z""",
    "page_link_entries": f"SELECT page_id, url, text FROM {_ENTRIES} x",
    "page_link_rollup": f"""
        WITH n AS (SELECT page_id, text, {_NORMAL} AS normal, {_KEY} AS key, {_SCORE} AS score FROM {_parts(_ENTRIES + ' x', 'page_id, text')}),
             b AS (SELECT page_id, key, {_CHOICE} AS url FROM n GROUP BY ALL),
             t AS (SELECT DISTINCT page_id, key, text FROM n WHERE text <> '')
        SELECT b.page_id, count(DISTINCT b.url) AS link_count, count(t.text) AS text_count, min(b.url) AS first_url FROM b LEFT JOIN t USING (page_id, key) GROUP BY b.page_id""",
    "section_links": f"SELECT DISTINCT page_id, href, trim(label) AS label FROM {_ANCHORS} y",
    "section_stripped_links": f"""
        SELECT page_id, branch, 'https://p' || page_id || '.example.org' || path AS url, text FROM (
          SELECT page_id, unnest([0, 1, 2, 3]) AS branch, unnest(['/job/' || page_id, '/frame/' || (page_id % 3), '/d/' || (page_id % 4), '/c/' || (page_id % 5)]) AS path, unnest(['Nurse', '', '', '']) AS text FROM {S('built_pages')} s) z""",
    "all_branch_links": f"""
        SELECT page_id, branch, CAST(CASE WHEN branch = 0 THEN 4 ELSE 1 END AS BIGINT) AS links, 'https://p' || page_id || '.example.org' || CASE branch WHEN 0 THEN '/about' WHEN 1 THEN '/frame/' || (page_id % 3) WHEN 2 THEN '/d/' || (page_id % 4) ELSE '/c/' || (page_id % 5) END AS first_url
        FROM (SELECT page_id, unnest([0, 1, 2, 3]) AS branch FROM {S('built_pages')} s) z""",
    "handler_links": """
        SELECT o_orderkey, CAST(unnest([0, 1, 2]) AS BIGINT) AS pos, unnest(['/a/' || o_custkey, 'https://h.example.com/' || o_orderkey, 'https://h.example.com/' || o_orderkey]) AS link FROM orders""",
    "dedupe_prefer_https": f"SELECT key, {_CHOICE} AS url, min(k) AS pos FROM (SELECT k, {_NORMAL} AS normal, {_KEY} AS key, {_SCORE} AS score FROM {_parts(S('spellings'), 'k')}) z GROUP BY key",
    "likely_job_links": f"SELECT k, {_LIKELY} AS likely, {_DETAIL} AS detail FROM {S('job_urls')} s",
    "job_detail_counts": f"SELECT regexp_replace(regexp_extract(url, '^https://([^/]*)', 1), '^www[.]', '') AS host, count(*) AS links, count(*) FILTER (WHERE {_DETAIL}) AS details FROM {S('job_urls')} s GROUP BY 1",
    "board_landing_links": f"""
        SELECT k, {_matches(_U, R.BOARD_LANDING)} AS landing, NOT {_matches('url', '^https://(www[.])?h1[.]example[.]com/')} AS external FROM {S('job_urls')} s
        UNION ALL SELECT k + 1000000, v <> 7 OR {_matches(_U, R.BOARD_LANDING)}, true FROM {S('board_urls')} s""",
    "ats_links": f"SELECT k, url, v <> 7 AS ats, {_CANONICAL} AS canonical, CASE v WHEN 0 THEN 'lever' WHEN 1 THEN 'greenhouse' WHEN 2 THEN 'workday' WHEN 3 THEN 'oracle' WHEN 4 THEN 'bamboohr' WHEN 5 THEN 'recruitee' WHEN 6 THEN 'icims' ELSE '' END AS template FROM {S('board_urls')} s",
    "non_career_reasons": f"SELECT k, CASE WHEN {_NON_CAREER} THEN 'non_career_pattern' WHEN NOT ({_matches(_U, R.CAREER_PATH_HINT)} OR {_matches(_U, R.STRONG_SIGNAL)} OR {_matches(_U, R.ATS_QUERY_HINT)}) THEN 'not_career_like' END AS reason FROM {S('job_urls')} s",
    "anchor_text_filter": f"SELECT k, {_NON_JOB} AS non_job FROM (SELECT k, {_FORM} AS f FROM {S('anchor_texts')} s) z",
    "anchor_filtered_links": f"""
        SELECT g, url, count(*) AS texts, bool_and({_NON_JOB}) AND NOT bool_or({_LIKELY}) AS dropped
        FROM (SELECT u.k % 20 AS g, url, {_FORM} AS f FROM {S('job_urls')} u JOIN {S('anchor_texts')} a ON u.k = a.k) z GROUP BY g, url""",
    "same_domain_filter": f"SELECT k, url FROM {S('job_urls')} s WHERE {_matches('url', '^https://(www[.])?h1[.]example[.]com/')} OR {_LIKELY} OR {_matches(_U, R.BOARD_LANDING)}",
    "social_filter": f"""
        SELECT k, CASE WHEN k % 4 = 0 THEN 'https://www.facebook.com/x' WHEN k % 4 = 1 THEN 'https://youtube.com/y' ELSE url END AS url FROM {S('job_urls')} s WHERE k % 4 > 1 OR k % 4 = 0 AND k % 3 = 0""",
    "self_link_filter": f"""
        WITH n AS (SELECT k, k % 7 AS g, {_KEY} AS key FROM {_parts(S('spellings'), 'k')}) SELECT g, count(*) AS links FROM n WHERE (g, key) NOT IN (SELECT (g, key) FROM n WHERE k <= 50) GROUP BY g""",
    "excluded_domains": "SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'google' WHEN c_custkey % 5 = 1 THEN 'fountain' WHEN c_custkey % 5 = 2 THEN 'indeed' END AS pattern FROM customer",
    "expired_pages": r"""
        WITH w AS (SELECT doc_id, string_split(trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9\s]+', ' ', 'g'), '\s+', ' ', 'g')), ' ') AS w FROM documents),
             t AS (SELECT doc_id, w, array_to_string(w, ' ') AS f FROM w)
        SELECT doc_id, p.phrase FROM t JOIN (VALUES ('and the', 'and the', 2), ('Released under', 'released under', 2), ('All rights reserved', 'all rights reserved', 2), ('of the ing', 'of the ing', 2), ('que de', 'que de', 2), ('und der', 'und der', 2), ('erent', 'erent', 1), ('der die', 'der die', 2)) AS p(phrase, plain, n)
          ON contains(f, plain) AND CASE WHEN n = 1 THEN list_contains(w, plain) ELSE contains(' ' || f || ' ', ' ' || string_split(plain, ' ')[1] || ' ' || string_split(plain, ' ')[2] || ' ') END""",
    "bot_challenge_pages": f"""
        SELECT g, links, challenges, jobs = 0 AND challenges > 0 AND (links <= 3 OR challenges >= links) AS challenge FROM (
          SELECT g, count(*) AS links, count(*) FILTER (WHERE contains(url, '/captcha')) AS challenges, count(*) FILTER (WHERE {_LIKELY}) AS jobs
          FROM (SELECT k % 60 AS g, CASE WHEN k % 60 < 20 THEN url || '/captcha' ELSE url END AS url FROM {S('job_urls')} s) y GROUP BY g) z""",
    "best_attempt": """
        SELECT l_orderkey, attempt, likely, links FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN attempt = 1 AND links > 1 AND likely >= 1 THEN 0 ELSE 1 END, likely DESC, links DESC, attempt) AS n
          FROM (SELECT l_orderkey, l_linenumber AS attempt, l_partkey % 3 AS likely, l_suppkey % 4 AS links FROM lineitem) y) z WHERE n = 1""",
    "career_status": "SELECT p_partkey, CASE WHEN p_partkey // 8 % 2 = 1 THEN 'excluded_domain' WHEN p_partkey // 4 % 2 = 1 THEN 'job_links_found' WHEN p_partkey // 2 % 2 = 1 THEN 'expired_or_no_jobs' WHEN p_partkey % 2 = 1 THEN 'ats_career_links_found' ELSE 'no_job_links' END AS status FROM part",
    "board_expansion": f"SELECT page_id, 'https://q' || (page_id % 10) || '.example.net/jobs/job/1' AS url FROM {S('built_pages')} s WHERE page_id % 3 <> 0",
    "merge_runs": f"SELECT g, key, {_CHOICE} AS url, min(pos) AS pos FROM (SELECT k % 3 AS g, CASE WHEN k % 2 = 0 THEN k ELSE k + 1000000000 END AS pos, {_NORMAL} AS normal, {_KEY} AS key, {_SCORE} AS score FROM {_parts(S('spellings'), 'k')}) z GROUP BY g, key",
    "ldjson_blocks": f"""SELECT k, CAST(0 AS BIGINT) AS pos, regexp_extract(page, '<script type="application/ld[+]json">(.*?)</script>', 1) AS block FROM {S('posting_pages')} s""",
    "posting_fields": """
        SELECT p_partkey AS k, p_name AS job_title, CASE WHEN a THEN 'Do it' END AS job_description, CASE WHEN a THEN CAST(p_partkey AS VARCHAR) END AS job_id, CASE WHEN a THEN '2024-01-02' END AS posted_date, CASE WHEN a THEN '2024-02-03' END AS expiration_date,
               CASE WHEN p_partkey % 4 = 2 THEN 'FULL_TIME' END AS job_type, p_brand AS company, CASE WHEN a THEN 'https://s.example.com' END AS same_as, CASE WHEN a THEN 'l.png' END AS logo, CASE WHEN a THEN '29-1141' END AS occupational_category,
               CASE WHEN a THEN '10-' || (p_size + 10) || ' HOUR' END AS salary, CASE WHEN a THEN 'USD' END AS currency, CASE WHEN a THEN 'base' END AS salary_type, CASE WHEN a THEN 'X,Y,Z' WHEN p_partkey % 4 = 1 THEN p_type ELSE '' END AS location,
               CASE WHEN a THEN '04109' END AS postal_code FROM (SELECT *, p_partkey % 4 = 0 AS a FROM part) q WHERE p_partkey % 4 < 3""",
    "queue_items": f"""
        SELECT id, CASE WHEN id % 5 = 0 OR id % 5 = 4 THEN value WHEN id % 5 = 3 THEN NULL ELSE coalesce(json_extract_string(j, '$.url'), json_extract_string(j, '$.link')) END AS url,
               coalesce(json_extract_string(j, '$.careerUrl'), json_extract_string(j, '$.career_url')) AS career_url FROM (SELECT id, value, CASE WHEN json_valid(value) THEN value::JSON END AS j FROM {S('messages')} s) z""",
    "retry_envelopes": f"""
        SELECT id, CASE WHEN id % 5 = 3 THEN json_extract_string(j, '$._clf_payload') ELSE value END AS value, CAST(CASE WHEN id % 5 = 3 THEN CAST(json_extract_string(j, '$._clf_retry') AS BIGINT) ELSE 0 END AS BIGINT) AS retries,
               json_extract_string(j, '$._clf_first_seen_at') AS first_seen FROM (SELECT id, value, CASE WHEN json_valid(value) THEN value::JSON END AS j FROM {S('messages')} s) z""",
    "claimable_jobs": f"""
        SELECT id, 'processing' AS status, CAST(attempts + 1 AS BIGINT) AS attempts, 'w1' AS lock_by, {_NOW} + INTERVAL 300 SECOND AS lock_until FROM {S('jobs')} s
        WHERE (status IS NULL OR status IN ('pending', 'processing') OR status = 'error' AND (error_at IS NULL OR error_at <= {_NOW} - INTERVAL 300 SECOND)) AND (lock_until IS NULL OR lock_until <= {_NOW})
        ORDER BY discovered_at, id LIMIT 50""",
    "reseed_queue": f"""
        WITH o AS (SELECT * FROM {S('jobs')} s WHERE (status IS NULL OR status NOT IN ('done', 'skipped')) AND (queued IS DISTINCT FROM true OR queued_at IS NULL OR queued_at <= {_NOW} - INTERVAL 4 HOUR)),
             n AS (SELECT id, career_url, {_NORMAL} AS normal, {_KEY} AS key, {_SCORE} AS score FROM {_parts('o', 'id, career_url')})
        SELECT key, {_CHOICE} AS url, first(career_url ORDER BY id) FILTER (WHERE career_url <> '') AS career_url FROM n GROUP BY key""",
    "discovery_upsert": """
        WITH f AS (SELECT l_partkey AS url, l_suppkey AS c, l_shipdate AS at_, l_shipdate >= TIMESTAMP '1996-01-01' AS later FROM lineitem),
             g AS (SELECT url, min(at_) AS a, max(at_) AS b, string_agg(DISTINCT CAST(c AS VARCHAR), ',' ORDER BY c) AS cs, count(*) AS n FROM (SELECT DISTINCT url, c FROM f) d JOIN f USING (url, c) GROUP BY url),
             s AS (SELECT url, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS cs FROM (SELECT DISTINCT url, c FROM f) d GROUP BY url),
             l AS (SELECT url, first(c ORDER BY at_ DESC, c DESC) AS c FROM f GROUP BY url)
        SELECT url, a AS first_discovered_at, b AS last_discovered_at, l.c AS career_url, s.cs AS career_urls, n AS discovery_count FROM (SELECT url, min(at_) AS a, max(at_) AS b, count(*) AS n FROM f GROUP BY url) q JOIN s USING (url) JOIN l USING (url)""",
    "resume_seeds": f"""
        WITH n AS (SELECT k, {_KEY} AS key FROM {_parts(S('spellings'), 'k')}) SELECT k, key FROM n WHERE k % 5 <> 0 AND key NOT IN (SELECT key FROM n WHERE k % 11 = 0)""",
    "queue_dedupe_append": "SELECT min(event_id) AS pos, user_id AS key FROM events WHERE user_id % 9 <> 0 GROUP BY user_id",
    "failed_replay": "SELECT CASE WHEN n <= 100 THEN 'moved' ELSE 'left' END AS \"to\", event_type, count(*) AS n, min(event_id) AS first_id FROM (SELECT event_id, event_type, row_number() OVER (ORDER BY event_id) AS n FROM events) z GROUP BY ALL",
    "stale_deliveries": "SELECT event_id AS id FROM events WHERE ts <= TIMESTAMP '2024-01-15 00:00:00' - INTERVAL 60 SECOND",
    "health_snapshot": f"""
        SELECT count(*) AS total, {', '.join(f"count(*) FILTER (WHERE status = '{x}') AS {x}" for x in ('pending', 'processing', 'done', 'skipped', 'error'))}, count(*) FILTER (WHERE status IS NULL) AS missing_status,
               count(*) FILTER (WHERE queued AND (status IS NULL OR status NOT IN ('done', 'skipped'))) AS queued_pending FROM {S('jobs')} s""",
    "stream_health": 'SELECT event_type AS "group", count(*) AS pending, count(DISTINCT user_id) AS consumers FROM events GROUP BY event_type',
    "lifecycle_violations": """
        SELECT before, status, count(*) AS n FROM (SELECT status, lag(status) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM (SELECT user_id, ts, event_id, CASE event_id % 5 WHEN 0 THEN 'pending' WHEN 1 THEN 'processing' WHEN 2 THEN 'done' WHEN 3 THEN 'error' ELSE 'skipped' END AS status FROM events) y) z
        WHERE NOT coalesce(before IS NULL AND status IN ('pending', 'processing') OR before = 'pending' AND status = 'processing' OR before = 'processing' AND status IN ('done', 'skipped', 'error') OR before = 'error' AND status = 'processing', false) GROUP BY ALL""",
    "redirect_summary": """
        WITH t AS (SELECT l_orderkey, l_linenumber AS n, l_partkey AS p, CASE l_partkey % 3 WHEN 0 THEN 301 WHEN 1 THEN 200 ELSE 0 END AS code FROM lineitem)
        SELECT l_orderkey, coalesce(string_agg(CAST(code AS VARCHAR), ',' ORDER BY n, p) FILTER (WHERE code > 0), '') AS codes, count(*) - 1 AS redirects, count(*) > 1 AS redirected,
               CAST(coalesce(first(code ORDER BY n, p) FILTER (WHERE code > 0), 200) AS BIGINT) AS initial_status FROM t GROUP BY l_orderkey""",
    "page_counts": """
        SELECT k, pages, CAST(greatest(pages, 0) AS BIGINT) AS numbers FROM (SELECT o_orderkey AS k, CAST(CASE o_orderkey % 5 WHEN 0 THEN ceil((o_custkey % 900 + 11) / 10.0) WHEN 1 THEN o_custkey % 90 + 2 WHEN 2 THEN ceil((o_custkey % 900 + 20) / 20.0) WHEN 3 THEN -1 ELSE 1 END AS BIGINT) AS pages FROM orders) z""",
    "link_buckets": "SELECT l_partkey, CAST(first(size ORDER BY abs(size - n), size) AS DOUBLE) / 2 AS bucket FROM (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) y, (VALUES (5), (10), (15), (20), (25), (50), (100)) AS s(size) GROUP BY l_partkey",
    "repeated_texts": "SELECT doc_id, md5(line) AS line_md5, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) z GROUP BY doc_id, line HAVING count(*) >= 3",
    "link_set_diff": f"SELECT DISTINCT text FROM {_ENTRIES} x WHERE page_id % 2 = 0 AND text NOT IN (SELECT text FROM {_ENTRIES} w WHERE page_id % 2 = 1)",
    "word_frequencies": r"SELECT word, count(*) AS n FROM (SELECT unnest(string_split(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'), ' ')) AS word FROM documents) z WHERE word <> '' GROUP BY word",
    "apply_phrase_class": "SELECT p_partkey, CASE WHEN n = 0 THEN '' ELSE 'apply now,for' END AS found, n BETWEEN 1 AND 3 AS is_job FROM (SELECT p_partkey, p_partkey % 6 AS n FROM part) z",
    "microdata_map": "SELECT p_partkey, unnest(['title', 'brand']) AS name, unnest([p_type, p_brand]) AS value FROM part",
    "clean_page": r"""
        SELECT page_id, md5(b) AS body_md5, CAST(length(b) AS BIGINT) AS body_chars, CASE WHEN page_id % 10 = 0 THEN 'http_404' ELSE '' END AS error_type FROM (
          SELECT page_id, CASE WHEN page_id % 10 = 0 THEN '' ELSE trim(regexp_replace(t(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?is)<script\b[^>]*>.*?</script>', ' ', 'g'), '(?is)<style\b[^>]*>.*?</style>', ' ', 'g')), '\s+', ' ', 'g')) END AS b FROM pages) z""",
    "ends_with_filter": f"""
        SELECT k, CASE WHEN contains(url, 'URL=http') THEN false WHEN list_contains({list(R.SOCIAL_HOSTS)}, string_split(url, '/')[3]) THEN string_split(url, '/')[3] <> 'www.facebook.com'
               WHEN len(list_filter({[x.lower() for x in R.LISTING_ENDS]}, lambda x: ends_with(lower(url), x))) > 0 OR len(list_filter({[x.lower() for x in R.LISTING_PARTS]}, lambda x: contains(lower(url), x))) > 0 THEN true
               ELSE len(string_split(url, '/')) < 5 AND NOT regexp_matches(left(string_split(url, '/')[-1], greatest(length(string_split(url, '/')[-1]) - 1, 0)), '[0-9#._?=-]') END AS listing
        FROM (SELECT k, url FROM {S('job_urls')} a UNION ALL SELECT k + 1000000, url FROM {S('board_urls')} b UNION ALL SELECT page_id + 2000000, url FROM pages) z""",
    "natural_order": f"""
        SELECT url, array_to_string(list_transform(regexp_extract_all(lower(url), '[0-9]+|[^0-9]+'), lambda x: CASE WHEN regexp_matches(x, '^[0-9]') THEN lpad(x, 20, '0') ELSE x END), '') AS sort_key FROM {S('job_urls')} s""",
    "mobile_agents": "SELECT p_partkey, p_partkey % 3 <> 1 AS mobile FROM part",
    "stream_queue_dedupe": "SELECT DISTINCT user_id AS key FROM events",
}

_EXT = "lower(regexp_extract(url, '([.][a-z0-9]+)$', 1, 'i'))"
_CODE = "CAST(coalesce(nullif(regexp_extract(error, 'Response code ([0-9]{3})', 1), ''), nullif(regexp_extract(error, 'status(?: code)?[:=] ?([0-9]{3})', 1), ''), '0') AS INT)"
_FINAL = "[" + ", ".join(f"'{x}'" for x in R.FINAL_EXTENSIONS) + "]"
_OUTCOMES = f"""(
  SELECT id, stream, CASE WHEN first <> 'retryable' THEN first WHEN retries >= 3 THEN 'max_retries' ELSE 'retryable' END AS reason, CASE WHEN first = 'retryable' AND retries < 3 THEN 'requeued' ELSE 'parked' END AS outcome
  FROM (SELECT *, CASE WHEN list_contains({_FINAL}, ext) THEN 'non_retryable_extension:' || ext WHEN code BETWEEN 400 AND 499 AND code NOT IN (408, 429) THEN 'http_' || code
               WHEN contains(error, 'Invalid URL') OR contains(error, 'Unsupported protocol') OR contains(error, 'mailto:') THEN 'invalid_or_unsupported_url' ELSE 'retryable' END AS first
        FROM (SELECT *, {_CODE} AS code, {_EXT} AS ext FROM (SELECT * EXCLUDE url, regexp_replace(url, '[?].*$', '') AS url FROM {S('failures')} s) w) y) z)"""
ORACLE |= {
    "retry_outcomes": f"SELECT id, reason, outcome FROM {_OUTCOMES} o",
    "retry_counters": f"""
        SELECT CASE outcome WHEN 'requeued' THEN 'retry_requeued' ELSE 'failed_parked' END || '_total' AS name, count(*) AS value FROM {_OUTCOMES} o GROUP BY 1
        UNION ALL SELECT stream || ':' || CASE outcome WHEN 'requeued' THEN 'retry_requeued' ELSE 'failed_parked' END, count(*) FROM {_OUTCOMES} o GROUP BY 1
        UNION ALL SELECT CASE reason WHEN 'max_retries' THEN 'retry_exhausted' ELSE 'retry_skipped' END || '_total', count(*) FROM {_OUTCOMES} o WHERE outcome = 'parked' GROUP BY 1
        UNION ALL SELECT stream || ':' || CASE reason WHEN 'max_retries' THEN 'retry_exhausted' ELSE 'retry_skipped' END, count(*) FROM {_OUTCOMES} o WHERE outcome = 'parked' GROUP BY 1""",
    "stream_retry_routing": f"SELECT stream, outcome, count(*) AS n FROM {_OUTCOMES} o GROUP BY ALL",
}



_HOST_K = "'c' || page_id || '.example.org'"
_PAGE = f"(SELECT *, page_id % 8 AS c, 'https://c' || page_id || CASE WHEN page_id % 8 = 4 THEN '.indeed' ELSE '' END || '.example.org' AS root FROM {S('career_pages')} s0)"
_LEVER = "'https://jobs.lever.co/acme' || page_id"
_LEVER_JOB = _LIKELY.replace(_U, f"lower({_LEVER})")
ORACLE |= {
    # each class of page by what its HTML holds
    "career_links_table": f"""
        SELECT page_id, root || '/careers' AS career_url, substr(root, 9) || '/careers' AS career_url_key, root || '/careers' AS request_url, root || '/careers' AS final_url,
               CASE c WHEN 0 THEN root || '/job/' || page_id WHEN 1 THEN {_LEVER} ELSE root || '/careers' END AS final_career_url, CASE c WHEN 1 THEN 'lever' ELSE '' END AS ats_template, 'Page ' || page_id AS page_title,
               CAST(CASE WHEN c IN (0, 1) THEN 1 ELSE 0 END AS BIGINT) AS link_count, CAST(j AS BIGINT) AS job_link_count, j > 0 AS has_job_links, CAST(CASE WHEN c = 0 THEN 1 ELSE 0 END AS BIGINT) AS job_detail_link_count,
               CASE WHEN c IN (5, 6) THEN 'error' WHEN j > 0 THEN 'job_links_found' ELSE 'no_job_links' END AS job_links_status, CAST(CASE WHEN c = 1 THEN 1 ELSE 0 END AS BIGINT) AS ats_career_link_count,
               CASE c WHEN 0 THEN 'job_links_found' WHEN 1 THEN 'ats_career_links_found' WHEN 2 THEN 'expired_or_no_jobs' WHEN 3 THEN 'expired_or_no_jobs' WHEN 4 THEN 'excluded_domain' WHEN 7 THEN 'no_job_links' ELSE 'error' END AS career_links_status,
               c IN (2, 3) AS expired_or_no_jobs, CAST(CASE WHEN c = 2 THEN 1 ELSE 0 END AS BIGINT) AS expire_keyword_match_count, CASE WHEN c = 4 THEN 'indeed' ELSE '' END AS excluded_domain_pattern,
               CAST(CASE WHEN c = 0 THEN 1 ELSE 0 END AS BIGINT) AS text_filtered_link_count, CAST(CASE WHEN c = 7 THEN 2 ELSE 0 END AS BIGINT) AS career_filtered_link_count, status_code AS http_status_code,
               CASE WHEN c = 0 THEN 301 ELSE status_code END AS initial_http_status_code, CASE WHEN c = 0 THEN 1 ELSE 0 END AS redirect_count, c = 0 AS redirected, c = 6 AS bot_challenge, CASE WHEN c IN (5, 6) THEN 'error' ELSE 'success' END AS crawl_status,
               CASE WHEN c = 4 THEN 'rules' WHEN c NOT IN (5, 6) THEN 'html' END AS source, CASE c WHEN 5 THEN error WHEN 6 THEN 'bot challenge' END AS error,
               CASE c WHEN 0 THEN root || '/job/' || page_id WHEN 1 THEN {_LEVER} ELSE '' END AS links, CASE WHEN c = 0 THEN root || '/job/' || page_id WHEN j > 0 THEN {_LEVER} ELSE '' END AS job_links,
               CASE c WHEN 1 THEN {_LEVER} ELSE '' END AS ats_career_links, CASE c WHEN 2 THEN 'position has been filled' ELSE '' END AS expire_keyword_matches
        FROM (SELECT *, CASE WHEN c = 0 OR c = 1 AND {_LEVER_JOB} THEN 1 ELSE 0 END AS j FROM {_PAGE} p) q""",
    "page_record_counts": "SELECT 'success' AS crawl_status, 'no_job_links' AS career_links_status, count(*) AS pages, CAST(0 AS BIGINT) AS job_links FROM pages",
    "page_upsert": f"""
        SELECT substr(root, 9) || '/careers' AS career_url_key, CAST(CASE WHEN c = 5 THEN 7 WHEN c IN (0, 1) THEN 1 ELSE 0 END AS BIGINT) AS link_count, CASE WHEN c IN (5, 6) THEN 'error' ELSE 'success' END AS crawl_status,
               CASE WHEN page_id % 2 = 1 THEN {_NOW} - INTERVAL 1 DAY ELSE {_NOW} END AS created_at, CASE WHEN c NOT IN (5, 6) THEN {_NOW} WHEN page_id % 2 = 1 THEN {_NOW} - INTERVAL 1 DAY END AS last_success_at,
               CASE WHEN c IN (5, 6) THEN {_NOW} END AS last_error_at FROM {_PAGE} p""",
    "merged_page_runs": f"""
        SELECT page_id, root || '/job/' || page_id || ',' || root || '/job/old' AS links, root || '/job/old,' || root || '/job/' || page_id AS job_links, CAST(2 AS BIGINT) AS job_detail_link_count FROM {_PAGE} p WHERE c = 0""",
    "expiry_verdicts": f"""
        SELECT page_id, CAST(status_code AS BIGINT) AS status_code, regexp_matches(f, '\\b(404|403|410|500|502|503|504|error|expired|no jobs?|not found|forbidden|access denied|job closed|position filled|vacancy closed)\\b') AS fast_hint_matched, status_code >= 400 AS status_code_expired,
               CASE WHEN page_id % 8 = 2 THEN 'position has been filled' ELSE '' END AS keywords, status_code >= 400 OR page_id % 8 = 2 AS is_expired_or_no_jobs
        FROM (SELECT *, lower('Page ' || page_id || ' Page ' || page_id || ' ' || regexp_replace(html, '<[^>]*>', ' ', 'g')) AS f FROM {S('career_pages')} s) q""",
    "stored_by_alias": f"""
        WITH n AS (SELECT k, {_KEY} AS key, host, {_TRIMMED} || query || {_HASH} AS rest, port FROM {_parts(S('spellings'), 'k')}),
             a AS (SELECT DISTINCT k, key AS career_url_key FROM n UNION SELECT k, host || rest FROM n WHERE port = '80' UNION SELECT k, host || rest FROM n WHERE port = '443')
        SELECT DISTINCT a.k AS page_id, a.career_url_key FROM a JOIN (SELECT DISTINCT key FROM n WHERE k % 13 = 0) m ON a.career_url_key = m.key""",
    "url_aliases": f"""
        SELECT DISTINCT k, s || {_KEY} AS alias FROM {_parts(S('spellings'), 'k')} q, (VALUES ('http://'), ('https://')) AS v(s) WHERE port NOT LIKE '80%'""",
    "merged_collections": """
        SELECT p_partkey AS page_id, CASE WHEN p_partkey % 2 = 0 AND p_partkey % 4 <> 0 THEN 'new' WHEN p_partkey % 3 = 0 THEN p_name ELSE '' END AS title, p_type AS sample, CAST(CASE WHEN p_partkey % 2 = 0 THEN 2 ELSE 1 END AS BIGINT) AS entries
        FROM part WHERE p_partkey % 2 = 0 OR p_partkey % 3 = 0""",
    "info_sections": "SELECT p_partkey, unnest(['name', 'size', 'url']) AS name, unnest([p_name, CAST(p_size + 1 AS VARCHAR), 'a:b']) AS value FROM part",
    "unique_keys": f"SELECT key, count(*) AS n FROM (SELECT {_KEY} AS key FROM {_parts(S('spellings'), 'k')}) q GROUP BY key HAVING count(*) > 1",
    "html_work_actions": f"""
        WITH j AS (SELECT url, max(status) AS status, coalesce(nullif(max(career_url), ''), 'https://first.example.com/') AS career FROM {S('jobs')} s GROUP BY url)
        SELECT id, coalesce(CASE WHEN id % 4 = 0 THEN 'https://own.example.com/' END, career) AS career_url, CASE WHEN coalesce(status IN ('done', 'skipped'), false) THEN 'done' ELSE 'fetch' END AS action
        FROM (SELECT id, CASE WHEN id % 10 = 0 THEN url || '/other' ELSE url END AS url FROM {S('jobs')} s) m LEFT JOIN j USING (url)""",
    "job_marks": f"""
        WITH j AS (SELECT *, id % 3 = 0 AND id % 2 = 0 AS marked FROM {S('jobs')} s),
             r AS (SELECT CASE WHEN marked THEN 'done' ELSE status END AS status, NOT marked AS locked, CASE WHEN marked THEN {_NOW} ELSE discovered_at END AS updated, discovered_at AS created, marked AND id % 5 = 0 AS career FROM j
                   UNION ALL SELECT 'done', false, {_NOW}, {_NOW}, id % 5 = 0 FROM j WHERE id % 3 = 0 AND id % 2 = 1)
        SELECT status, count(*) AS jobs, count(*) FILTER (WHERE locked) AS locked, count(*) FILTER (WHERE updated = {_NOW}) AS updated, count(*) FILTER (WHERE created = {_NOW}) AS created, count(*) FILTER (WHERE career) AS career FROM r GROUP BY status""",
    "queued_marks": f"SELECT DISTINCT url, ends_with(url, '7') AS queued, CASE WHEN ends_with(url, '7') THEN {_NOW} END AS queued_at FROM {S('jobs')} s",
    "seed_cycles": f"""
        WITH b AS (SELECT *, status IS NULL OR status NOT IN ('done', 'skipped') AS waits, queued IS DISTINCT FROM true OR queued_at IS NULL OR queued_at <= {_NOW} - INTERVAL 4 HOUR AS due FROM {S('jobs')} s),
             k AS (SELECT *, regexp_replace(url, '^[a-z]+://', '') AS key, max(CASE WHEN waits AND due THEN 1 ELSE 0 END) OVER (PARTITION BY url) = 1 AS plain, max(CASE WHEN waits THEN 1 ELSE 0 END) OVER (PARTITION BY url) = 1 AS every FROM b)
        SELECT 'plain' AS cycle, 'queue' AS part, count(DISTINCT key) FILTER (WHERE waits AND due) AS n FROM k UNION ALL SELECT 'recovered', 'queue', count(DISTINCT key) FILTER (WHERE waits) FROM k UNION ALL SELECT 'reset', 'queue', count(DISTINCT key) FILTER (WHERE waits) FROM k
        UNION ALL SELECT 'plain', 'marked', count(*) FILTER (WHERE plain OR queued_at = {_NOW}) FROM k UNION ALL SELECT 'recovered', 'marked', count(*) FILTER (WHERE every OR queued_at = {_NOW}) FROM k
        UNION ALL SELECT 'reset', 'marked', count(*) FILTER (WHERE every OR NOT waits AND queued_at = {_NOW}) FROM k""",
    "replayed_failures": """
        WITH e AS (SELECT event_id AS id, row_number() OVER (ORDER BY event_id) AS n FROM events)
        SELECT 'all' AS run, 'moved' AS part, count(*) AS n, max(id) AS last_id FROM e UNION ALL SELECT 'some', CASE WHEN n <= 70 THEN 'moved' ELSE 'left' END, count(*), max(id) FROM e GROUP BY 2
        UNION ALL SELECT 'kept', 'moved', count(*), max(id) FROM e WHERE n <= 50 UNION ALL SELECT 'kept', 'left', count(*), max(id) FROM e""",
    "acknowledged": """
        SELECT 'pending' AS part, event_type, count(*) AS n FROM events WHERE event_id % 2 = 0 AND event_id % 3 <> 0 GROUP BY event_type UNION ALL SELECT 'log', event_type, count(*) FROM events WHERE event_id % 6 <> 0 GROUP BY event_type""",
    "links_outside_sections": f"""
        SELECT page_id, unnest(['https://p' || page_id || '.example.org/job/' || page_id, 'https://q' || (page_id % 10) || '.example.net/jobs', 'https://p' || page_id || '.example.org/frame/' || (page_id % 3), 'https://p' || page_id || '.example.org/d/' || (page_id % 4), 'https://p' || page_id || '.example.org/c/' || (page_id % 5)]) AS url,
               unnest(['Nurse', 'All', '', '', '']) AS text FROM {S('built_pages')} s""",
    "unique_rows": f"SELECT k % 50 AS g, first(url ORDER BY k) AS url FROM {S('job_urls')} s GROUP BY 1 UNION ALL SELECT DISTINCT k % 50, 'x' FROM {S('job_urls')} s",
    "sparse_pages": f"""
        SELECT k % 300 AS g, count(*) <= 1 OR NOT bool_or(regexp_matches(lower(url), '/job/|/jobs/|jobdetails|requisition|opening|position|apply')) AND (count(*) <= 10 OR (k % 300) % 3 = 0) AS sparse FROM {S('job_urls')} s GROUP BY k % 300""",
    "numbers_and_flags": """
        SELECT p_partkey, p_partkey % 6 IN (0, 1, 4) AS number, p_partkey % 6 IN (2, 3) AS flag, CAST(CASE p_partkey % 6 WHEN 0 THEN 12 WHEN 1 THEN 3 ELSE 9 END AS BIGINT) AS count FROM part""",
    "job_labels": f"""
        SELECT k, text <> '' AND NOT regexp_matches(lower(text), 'page|next|opportunities>>') AS any_link, length(text) >= 5 AND try_cast(text AS DOUBLE) IS NULL AND NOT regexp_matches(lower(text), 'jobs|page|next|>>') AS job,
               NOT regexp_matches(lower(text), '[0-9]$|page|mainurl|older posts|last|next') AS counted FROM {S('anchor_texts')} s""",
    "labelled_links": f"""
        SELECT page_id, unnest(['https://p' || page_id || '.example.org/about', 'https://p' || page_id || '.example.org/job/' || page_id, 'https://q' || (page_id % 10) || '.example.net/jobs', 'https://p' || page_id || '.example.org/privacy']) AS link, unnest(['About', 'Nurse', 'All', 'Privacy']) AS label FROM {S('built_pages')} s""",
    "first_selectors": f"SELECT k, list_filter(['/jobs/', '/job/', 'jobid=', '/openings/', '/team/'], lambda x: contains(lower(url), x) AND NOT ends_with(lower(url), x) AND NOT ends_with(lower(url), x || '#'))[1] AS selector FROM {S('job_urls')} s",
    "dominant_buckets": f"""
        WITH r AS (SELECT k % 25 AS page_id, url AS link, min(k) AS k FROM {S('job_urls')} s GROUP BY ALL),
             s AS (SELECT page_id, link, md5('m' || (k % 2) || 'pa' || list_filter(['/job/', '/jobs/', '/careers/'], lambda x: contains(lower(link), x) AND NOT ends_with(lower(link), x) AND NOT ends_with(lower(link), x || '#'))[1]) AS bucket FROM r),
             n AS (SELECT page_id, bucket, count(*) AS size FROM s WHERE bucket IS NOT NULL GROUP BY ALL), b AS (SELECT page_id, max((size, bucket)) AS top FROM n GROUP BY page_id),
             t AS (SELECT s.*, top[1] AS size, regexp_replace(regexp_replace(link, '[?].*$', ''), '[^/]*$', '') AS shape FROM s JOIN b ON s.page_id = b.page_id AND s.bucket = b.top[2]),
             u AS (SELECT *, count(*) OVER (PARTITION BY page_id, shape) / size AS share FROM t), v AS (SELECT *, max(share) OVER (PARTITION BY page_id) AS most FROM u)
        SELECT page_id, link, bucket FROM v WHERE size < 10 OR most < 0.7 OR share >= 0.7""",
    "web_addresses": "SELECT p_partkey, p_partkey % 7 IN (0, 2, 4) AS valid FROM part",
    "pager_words": "SELECT p_partkey, concat_ws(',', CASE WHEN p_partkey % 4 IN (0, 3) THEN 'load_more' END, CASE WHEN p_partkey % 4 = 1 THEN 'next_button' END, CASE WHEN p_partkey % 3 = 0 THEN 'pagination' END) AS families FROM part",
    "board_jobs": """
        SELECT DISTINCT p_partkey, j AS job_id, CASE WHEN p_partkey % 2 = 0 THEN 'https://b.example.com/x?jobId=' || j || '&a=1' ELSE 'https://b.example.com/x?jobId=' || j || '#t' END AS url
        FROM (SELECT p_partkey, unnest([CAST(p_partkey AS VARCHAR), CAST(p_size AS VARCHAR)]) AS j FROM part) q""",
    "masked_passwords": "SELECT c_custkey, 'redis://u' || CASE WHEN c_custkey % 2 = 0 THEN ':***' ELSE '' END || '@h:6379/0' AS masked FROM customer",
    "ascii_hosts": "SELECT c_custkey, 'https://' || CASE c_custkey % 3 WHEN 0 THEN 'xn--bcher-kva' WHEN 1 THEN 'a' ELSE 'xn--wgv71a' END || '.example:8443/ü?x=' || c_custkey AS url FROM customer",
    "merged_postings": "SELECT p_partkey, CASE WHEN p_partkey % 3 < 2 THEN p_name END AS title, CASE WHEN p_partkey % 3 < 2 THEN 'second' END AS url FROM part",
    "legacy_pages": "SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_name || ' apply now' END AS job_body, CASE WHEN p_partkey % 5 = 0 THEN 'http_500' ELSE '' END AS error_type, CAST(CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE 1 END AS BIGINT) AS blocks, p_name AS x, p_partkey % 5 <> 0 AS is_job FROM part",
    "seed_batches": f"""
        WITH n AS (SELECT k, {_KEY} AS key FROM {_parts(S('spellings'), 'k')}), f AS (SELECT * FROM n WHERE k % 5 <> 0 ORDER BY k LIMIT 40)
        SELECT DISTINCT 'first' AS part, key FROM f UNION ALL SELECT DISTINCT 'again', key FROM n WHERE key NOT IN (SELECT key FROM n WHERE k % 11 = 0) UNION ALL SELECT 'marked', CAST(k AS VARCHAR) FROM f""",
    "seed_choice": "SELECT 'all_marked' AS name, 'has_urls' AS reason UNION ALL SELECT 'open', 'unseeded'",
    "message_log": "SELECT CASE WHEN event_id % 2 = 0 THEN event_type ELSE '{\"value\":\"' || event_type || '\"}' END AS value, count(*) AS n, CAST(0 AS BIGINT) AS before, (SELECT count(*) FROM events) AS after FROM events GROUP BY 1",
    "vocabulary_file": "SELECT n_name AS word FROM nation",
    "health_json": f"SELECT to_json(h)::VARCHAR AS report FROM (SELECT * FROM ({ORACLE['health_snapshot']}) z) h",
    "final_career_url": f"""
        WITH p AS (SELECT k AS page_id, url AS page FROM {S('job_urls')} s WHERE k % 10 = 0),
             l AS (SELECT k // 10 * 10 AS page_id, url FROM {S('job_urls')} s),
             c AS (SELECT l.page_id, l.url, {_PQ.replace('url', 'l.url')} AS pq, list_filter(string_split(regexp_replace(regexp_replace(l.url, '^https?://[^/?#]*', ''), '[?].*$', ''), '/'), lambda x: x <> '') AS seg,
                          regexp_replace(regexp_extract(l.url, '^https://([^/?]*)', 1), '^www[.]', '') = regexp_replace(regexp_extract(page, '^https://([^/?]*)', 1), '^www[.]', '') AS same, NOT contains(l.url, '?') AS plain, {_NON_CAREER.replace('url', 'l.url')} AS bad,
                          {_matches(_U, R.CAREER_PATH_HINT).replace('url', 'l.url')} OR {_matches(_U, R.STRONG_SIGNAL).replace('url', 'l.url')} OR {_matches(_U, R.ATS_QUERY_HINT).replace('url', 'l.url')} AS signal FROM l JOIN p USING (page_id)),
             d AS (SELECT *, {_matches('pq', R.STRONG_CAREER_PATH)} AS strong, {_matches('pq', R.SUPPORTING_CAREER_PATH)} AS support, coalesce(seg[-1], '') AS last FROM c),
             e AS (SELECT page_id, regexp_replace(url, '/$', '') AS url, CASE WHEN same THEN 20 ELSE 0 END + 8 + CASE WHEN plain THEN 3 ELSE 0 END + CASE WHEN strong THEN 120 WHEN support OR signal THEN 45 ELSE 0 END + CASE WHEN {_matches('pq', R.LISTING_PATH)} THEN 15 ELSE 0 END
                          - CASE WHEN {_matches('pq', R.ARTICLE_PATH)} THEN 90 ELSE 0 END - CASE WHEN length(last) > 40 THEN 20 ELSE 0 END - CASE WHEN len(list_filter(string_split_regex(last, '[-_]+'), lambda x: trim(x) <> '')) > 4 THEN 25 ELSE 0 END AS score
                   FROM d WHERE NOT (bad AND NOT strong AND NOT support)),
             b AS (SELECT page_id, first(url ORDER BY score DESC, 100 + CASE WHEN regexp_matches(url, '^https://[^/]+/[^?]') THEN 10 ELSE 0 END + CASE WHEN contains(url, '?') THEN 0 ELSE 1 END DESC, length(url), url) AS best FROM e WHERE score >= 60 GROUP BY page_id),
             n AS (SELECT k * 10 AS page_id, {_CANONICAL} AS board FROM {S('board_urls')} s WHERE k % 3 = 0 AND v <> 7)
        SELECT page_id, coalesce(board, best, regexp_replace(page, '/$', '')) AS final_career_url FROM p LEFT JOIN b USING (page_id) LEFT JOIN n USING (page_id)""",
}


def _clusters() -> str:
    """Label by label, each step a query over the one before."""
    cut = "regexp_replace(regexp_replace(url, '[?].*$', ''), '/$', '')"
    part = lambda i: f"coalesce(nullif(string_split({cut}, '/')[{i}], ''), nullif(string_split({cut}, '/')[4], ''), '0')"
    labels = [(f"CAST(len(string_split({cut}, '/')) AS VARCHAR)", False)]
    labels += [(f"coalesce(string_split_regex(regexp_extract(url, '[?]([^#]*)', 1), '[&=]')[{i}], '')", True) for i in (1, 2, 3)]
    labels += [(f"coalesce(string_split({cut}, '/')[3], '')", False)] + [(part(i), True) for i in range(4, 12)] + [(f"coalesce(string_split({cut}, '/')[-1], '')", True)]
    steps, last = [], "deep"
    for n, (label, pooled) in enumerate(labels):
        one = f"CASE WHEN count(*) OVER (PARTITION BY path, label) > 1 THEN label ELSE 'oldLabel' END" if pooled else "label"
        steps.append(f"l{n} AS (SELECT url, md5(path || '/' || label) AS path FROM (SELECT url, path, {one} AS label FROM (SELECT url, path, {label} AS label FROM {last}) a{n}) b{n})")
        last = f"l{n}"
    return f"""
        u AS (SELECT DISTINCT url, coalesce(string_split(url, '/')[4], '') AS first, len(string_split(url, '/')) AS n FROM (SELECT url FROM pages UNION ALL SELECT url FROM {S('job_urls')} s) z WHERE url IS NOT NULL),
        k AS (SELECT url, first, CASE WHEN regexp_matches(first, '^[0-9]+$') THEN 'number' WHEN NOT contains(url, '?') AND (n <= 4 AND length(first) > 0 OR n <= 5 AND ends_with(url, '/')) THEN 'short' ELSE 'deep' END AS kind FROM u),
        deep AS (SELECT url, '' AS path FROM k WHERE kind = 'deep'), {', '.join(steps)},
        g AS (SELECT url, path, count(*) OVER (PARTITION BY path) AS size FROM {last}),
        s AS (SELECT k.url, first, count(*) OVER (PARTITION BY first) AS size FROM k LEFT JOIN g USING (url) WHERE kind = 'short' OR g.size = 1),
        c AS (SELECT url, 'deep' AS kind, 'deep:' || path AS cluster FROM g WHERE size > 1
              UNION ALL SELECT url, CASE WHEN size > 1 THEN 'short' ELSE 'alone' END, CASE WHEN size > 1 THEN 'short:' || first END FROM s
              UNION ALL SELECT url, CASE WHEN count(*) OVER () > 1 THEN 'number' ELSE 'alone' END, CASE WHEN count(*) OVER () > 1 THEN 'number' END FROM k WHERE kind = 'number')"""


ORACLE["url_clusters"] = f"WITH {_clusters()} SELECT url, kind, cluster FROM c"
ORACLE["url_cluster_kinds"] = f"WITH {_clusters()} SELECT kind, count(*) AS urls, count(DISTINCT cluster) AS clusters FROM c GROUP BY kind"
ORACLE["seed_file_urls"] = f"SELECT key, {_CHOICE} AS url FROM (SELECT {_NORMAL} AS normal, {_KEY} AS key, {_SCORE} AS score FROM {_parts(S('spellings'), 'k')}) z GROUP BY key"


def _plain(x: str) -> str:
    """Tags as spaces, then the named references in order; the pages hold no numeric ones."""
    for name, char in (("&nbsp;", " "), ("&amp;", "&"), ("&quot;", '"'), ("&#39;", "''"), ("&apos;", "''"), ("&lt;", "<"), ("&gt;", ">")):
        x_ = f"regexp_replace({x}, '{name}', '{char}', 'gi')" if x.startswith("regexp_replace") else f"regexp_replace(regexp_replace({x}, '<[^>]*>', ' ', 'g'), '{name}', '{char}', 'gi')"
        x = x_
    return x


def _with_plain(sql: str) -> str:
    """t(x) spelled out: the plain text of HTML."""
    at = sql.find("t(reg")
    while at >= 0:
        depth, end = 0, at + 1
        while True:
            depth += {"(": 1, ")": -1}.get(sql[end], 0) if not _quoted(sql, end) else 0
            end += 1
            if not depth:
                break
        inner = f"regexp_replace({sql[at + 2 : end - 1]}, '<[^>]*>', ' ', 'g')"
        sql = sql[:at] + _plain(inner) + sql[end:]
        at = sql.find("t(reg", at + len(_plain(inner)))
    return sql


def _quoted(sql: str, at: int) -> bool:
    return sql.count("'", 0, at) % 2 == 1


for _name in ("page_title_sample", "clean_page"):
    ORACLE[_name] = _with_plain(ORACLE[_name])
