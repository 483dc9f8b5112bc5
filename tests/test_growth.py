"""Queries whose results or growth a review found at fault."""

import duckdb
from pyspark.sql import functions as F

from linkloom.functions import predicates, urls
from linkloom.functions.base import contains_any
from linkloom.operators import lifecycle, links, records
from linkloom.plans import catalog


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_boards_have_ids_that_no_page_has(spark, tmp_path):
    """from the 1,000th supplier on pages and boards had one id."""
    duckdb.sql(f"copy (select range::bigint as s_suppkey from range(995, 1015)) to '{tmp_path}/supplier.parquet' (format parquet)")
    got = {(r.page_id, r.url) for r in catalog.queries()["board_expansion"](spark, str(tmp_path)).collect()}
    assert got == {(k, f"https://q{k % 10}.example.net/jobs/job/1") for k in range(995, 1015) if k % 3}


def test_texts_are_searched_once(spark):
    """the filter on the matches held a copy of the search."""
    rows = spark.createDataFrame([(1, "", "No longer&nbsp;AVAILABLE, page\n not found"), (2, "", "no longer"), (3, "", None), (4, "No jobs", "found")], "i int, title string, text string")
    out = records.expiry_matches(rows, "i")
    assert plan(out).count("regexp_replace(") == plan(rows.select(records.expiry_phrases(F.col("text")).alias("m"))).count("regexp_replace(")
    assert {r.i: r.matches for r in out.collect()} == {1: ["no longer available", "page not found"], 4: ["no jobs found"]}


def test_hosts_are_parsed_once(spark):
    """F5, and the search for social networks: the URL was parsed for each pattern."""
    rows = spark.createDataFrame([("https://www.google.indeed.com/x",), ("https://a.com/google",), ("indeed.com",), (None,)], "url string")
    out = rows.select(predicates.excluded_host_pattern(F.col("url")).alias("p"))
    assert plan(out).count("^([A-Za-z][A-Za-z0-9+.-]*):(?:") == 1
    found = [r.p for r in out.collect()]
    assert found[1] is None and found[3] is None and found[2] == "indeed" and found[0] in ("google", "indeed")
    both = rows.select(predicates.is_social(urls.comparable_host(F.col("url")), urls.comparable_host(F.lit("https://a.com"))).alias("s"))
    assert plan(both).count("^([A-Za-z][A-Za-z0-9+.-]*):(?:") <= 2


def test_aliases_parse_a_url_once(spark):
    """each alias was parsed again for its normal form and its key."""
    given = ["http://U@A.com:443/x/?q#/jobs/7", "https://a.com:443", "http://a.com:80/p//", "ftp://a.com/x/", "Mailto:x", " A.com/ ", "", None, "https://a.com:80/ü x#top"]
    rows = spark.createDataFrame(list(enumerate(given)), "page_id int, url string")
    forms = rows.select("page_id", F.explode(urls.alias_forms(F.col("url"))).alias("f")).select("page_id", "f.*", urls.url_key(F.col("f.normal")).alias("again"), urls.normalize_url(F.col("f.normal")).alias("same"))
    got = forms.collect()
    assert all(r.key == r.again and r.normal in (r.same, "ftp:/x") for r in got)
    assert [r.normal for r in got if r.page_id == 0] == ["http://U@a.com:443/x?q#/jobs/7", "https://U@a.com/x?q#/jobs/7"] and [r.normal for r in got if r.page_id == 5] == ["A.com/"]
    stored = spark.createDataFrame([("a.com/", "https://a.com/"), ("a.com/p", "http://a.com/p")], "career_url_key string, career_url string")
    out = records.stored_of(rows, stored)
    assert plan(out).count("^([A-Za-z][A-Za-z0-9+.-]*):(?:") <= 4
    assert {(r.page_id, r.career_url_key) for r in out.collect()} == {(1, "a.com/"), (2, "a.com/p")}


def test_sections_are_read_once(spark, tmp_path):
    """F8: the lines were cut again for each line and for each test on the map."""
    duckdb.sql(f"copy (select range::bigint as p_partkey, 'n' as p_name, 1 as p_size from range(3)) to '{tmp_path}/part.parquet' (format parquet)")
    out = catalog.queries()["info_sections"](spark, str(tmp_path))
    assert plan(out).count("split(") == 1 and out.count() == 9
    rows = spark.createDataFrame([("a:1\n b :2\na:3\n:x\n#c:1",)], "t string").select(lifecycle.info_section(F.col("t")).alias("m"))
    assert rows.first().m == {"a": "3", "b": "2"}


PARSE = "^([A-Za-z][A-Za-z0-9+.-]*):(?:"


def test_compiled_urls_are_those_of_the_functions(spark):
    """URLs are cut, formed and resolved by projections."""
    given = ["HTTP://U@W@www.A.com:80:81/a/../b c/?q=<\"#/jobs/7", "https://a.com:443", "http://a.com:80/p//", "ftp://a.com/x/", "Mailto:x", " A.com/ ", "", None, "https://a.com:8/ü\tx?#", "http:///x", "http://a|b/", "x:y\nz", "/./p?q", "?q", "//b.de", "javascript:a", "d/e"]
    rows = spark.createDataFrame([(a, b) for a in given for b in given], "url string, base string")
    url, base = F.col("url"), F.col("base")
    got = urls.with_forms(urls.with_parts(rows, p=url, b=base), f=url, p2=base)
    got = urls.with_resolved(got.withColumn("keep", base), "url", "b", "r").collect()
    want = rows.select("*", urls.parse_url(url).alias("p"), urls.url_forms(url).alias("f"), urls.url_forms(base).alias("p2"), urls.resolve_link(url, base).alias("r")).collect()
    names = ("url", "base", "p", "f", "p2", "r")
    assert sorted((str([r[n] for n in names]) for r in got)) == sorted(str([r[n] for n in names]) for r in want)


def test_lists_are_searched_by_prefix(spark):
    """of a list of words each was tried at each place of a text."""
    words = ["about", "abs", "a.c", "b", "", "xabout", "(z", "zz", "about"]
    texts = ["about", "ab s", "a.c", "aXc", "q(z", "z", "b", "", "xx abs", None]
    rows = spark.createDataFrame([(x,) for x in texts], "t string")
    for some in (words, [w for w in words if w], ["one"], []):
        got = [r.c for r in rows.select(contains_any(F.col("t"), some).alias("c")).collect()]
        assert got == [any(w in x for w in some) if x is not None else (None if some else False) for x in texts]


def test_page_records_read_urls_once(spark, tmp_path):
    """each test on a link parsed its URL again, 26 times in all."""
    duckdb.sql(f"copy (select range::bigint as p_partkey, 'n' as p_name from range(24)) to '{tmp_path}/part.parquet' (format parquet)")
    out = catalog.queries()["career_links_table"](spark, str(tmp_path))
    assert plan(out).count(PARSE) <= 13


def test_an_upsert_reads_urls_once(spark, tmp_path):
    """the URLs of pages and links were parsed in 24 places."""
    duckdb.sql(f"copy (select range::bigint as p_partkey, 'n' as p_name from range(24)) to '{tmp_path}/part.parquet' (format parquet)")
    out = catalog.queries()["page_upsert"](spark, str(tmp_path))
    got = {r.career_url_key: r.link_count for r in out.collect()}
    assert len(got) == 24 and got["c8.example.org/careers"] == 1 and got["c5.example.org/careers"] == 7
    assert plan(out).count(PARSE) <= 14


def test_page_records_are_dealt_over_tasks(spark, tmp_path):
    """all pages of a file of one row group were read by one task, and flagged again by each join."""
    html = "(select string_agg(md5((k * 1000 + i)::varchar), ' ') from range(200) r(i))"
    duckdb.sql(f"copy (select k::bigint as page_id, 'https://a.com/' || k as url, {html} as html from range(400) t(k)) to '{tmp_path}/pages.parquet' (format parquet)")
    text = plan(catalog.queries()["page_record_counts"](spark, str(tmp_path)))
    assert "Repartition " in text and text.count(PARSE) <= 100
