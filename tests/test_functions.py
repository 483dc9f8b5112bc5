"""Unit tables of the column functions: input and expected output."""

import json

import pytest
from pyspark.sql import functions as F

from linkloom.functions import ats, html, postings, predicates, text, urls
from linkloom.functions.rules import BUILT_IN, CONFIGURED
from linkloom.operators import lifecycle


def applied(spark, function, values):
    rows = spark.createDataFrame([(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)], ["i", *[f"c{k}" for k in range(len(values[0]) if isinstance(values[0], tuple) else 1)]])
    columns = [F.col(c) for c in rows.columns[1:]]
    return [r[0] for r in rows.select("i", function(*columns).alias("x")).orderBy("i").select("x").collect()]


TABLES = {
    "normalize": (urls.normalize_url, {
        "HTTP://Example.COM:80/Jobs/": "http://example.com/Jobs", "https://a.com": "https://a.com/", "https://a.com/p/?q=1#top": "https://a.com/p?q=1",
        "https://a.com/#/jobs/12": "https://a.com/#/jobs/12", "https://a.com/#!/careers": "https://a.com/#!/careers", "https://a.com/#!jobs": "https://a.com/",
        "https://a.com/x//": "https://a.com/x", "https://a.com/für": "https://a.com/f%C3%BCr", "https://a.com/a b": "https://a.com/a%20b", " not a url/ ": "not a url/",
    }),
    "key": (urls.url_key, {"https://A.com/p/": "a.com/p", "https://a.com": "a.com/", "http://a.com:8080/": "a.com:8080/", "Not A URL//": "not a url"}),
    "score": (urls.url_score, {"https://a.com/p": 111, "http://a.com/p": 11, "https://a.com/": 101, "https://a.com/?x=1": 100}),
    "likely_job": (predicates.is_likely_job_link, {
        "https://a.org/about/jobs/1": True, "https://a.org/careers/engineer": True, "https://fedex.com/careers/engineer": False, "https://a.org/careers/home-health-aide": False,
        "https://a.org/p?jobid=7&utm=press": True, "https://a.org/x?jobcode=0": False, "https://a.org/x?jobcode=05": True, "https://a.org/jobseekers": False,
    }),
    "job_detail": (predicates.is_job_detail, {"https://a/job/1": True, "https://a/jobs/1": False, "https://a/?gh_jid=5": True, "https://a/careers/requisition/9": True}),
    "ats_canonical": (ats.ats_canonical, {
        "https://jobs.lever.co/acme/f204?lever-source=x": "https://jobs.lever.co/acme", "https://boards.greenhouse.io/acme/jobs/123": "https://boards.greenhouse.io/acme",
        "http://boards.greenhouse.io/embed/job_board?for=acme": "https://boards.greenhouse.io/", "https://acme.wd5.myworkdayjobs.com/en-US/Ext/job/NY/E_R1": "https://acme.wd5.myworkdayjobs.com/en-US/Ext",
        "https://acme.wd5.myworkdayjobs.com/job/NY/E": "https://acme.wd5.myworkdayjobs.com/",
        "https://e.fa.us2.oraclecloud.com/hcmUI/CandidateExperience/en/sites/CX_1/job/55": "https://e.fa.us2.oraclecloud.com/hcmUI/CandidateExperience/en/sites/CX_1",
        "https://workforcenow.adp.com/m/recruitment/recruitment.html?cid=1&ccId=2&jobId=3": "https://workforcenow.adp.com/m/recruitment/recruitment.html?cid=1",
        "https://acme.bamboohr.com/careers/42": "https://acme.bamboohr.com/careers", "mailto:x@y.z": "",
    }),
    "ats_template": (ats.ats_template, {
        "https://jobs.lever.co/acme/f204": "lever", "https://boards.greenhouse.io/acme/jobs/123": "greenhouse", "https://acme.wd5.myworkdayjobs.com/job/NY/E": "workday",
        "https://e.fa.us2.oraclecloud.com/hcmUI/CandidateExperience/en/sites/CX_1": "oracle", "https://workforcenow.adp.com/m/recruitment/recruitment.html?cid=1": "adp",
        "https://acme.bamboohr.com/careers/42": "bamboohr", "https://a.org/x": "",
    }),
    "non_job_text": (lambda c: predicates.is_non_job_text(c, BUILT_IN), {"Contact Us": True, "Apply now": False, "": False, "Registered Nurse": False, "Home Health Aide": True, "Executive Chef": True}),
    "page_count": (text.page_count, {
        "Showing 1 - 10 of 95": 10, "Showing 11 - 20 of 95": 5, "Showing 20 of 95 jobs": 5, "Page: 2 of 7": 7, "Search Results Page 3 of 12": 12, "1 - 25 of 1,240": 50, "no pager": -1, "": 1,
    }),
    "excluded_host": (predicates.excluded_host_pattern, {"https://sites.google.com/x": "google", "https://www.mountainfountain.org": "fountain", "https://a.com/google": None}),
    "entities": (text.decode_entities, {"&amp;lt;b&amp;gt;": "<b>", "A&nbsp;&#38;&#x26;": "A &&", "&copy;": "&copy;", "&#233;": "é"}),
    "plain_text": (html.plain_text, {"<b>a</b>\n<i>b</i>": "a b"}),
    "extension": (urls.file_extension, {"https://a/x.PDF": ".pdf", "https://a/x": "", "https://a/.env": "", "https://a/x.tar.gz?y=.z": ".gz"}),
    "status": (text.http_status, {"Response code 404 (Not Found)": 404, "status: 503": 503, "status code=429": 429, "timeout": 0}),
    "handler": (html.handler_links, {"go('/a/b')": ["/a/b"], "open(\"https://x.y/z\")": ["https://x.y/z", "https://x.y/z"], "nothing()": []}),
    "mobile": (urls.is_mobile_user_agent, {"Mozilla (iPhone)": True, "Mozilla (X11)": False}),
    "mask": (urls.mask_password, {"redis://u:secret@h:1/0": "redis://u:***@h:1/0"}),
    "bucket": (text.nearest_bucket, {0: 5.0, 7: 2.5, 8: 5.0, 90: 50.0}),
    "page_numbers": (text.page_numbers, {3: ["1", "2", "3"], -1: []}),
}


@pytest.mark.parametrize("name", TABLES)
def test_table(spark, name):
    function, cases = TABLES[name]
    assert dict(zip(cases, applied(spark, function, list(cases)), strict=True)) == cases


def test_resolve(spark):
    base = "https://m.h.net/en/25#top"
    cases = {"/für": "https://m.h.net/f%C3%BCr", "/the,": "https://m.h.net/the,", "a/../b": "https://m.h.net/en/b", "//c.d/e": "https://c.d/e", "?x=1": "https://m.h.net/en/25?x=1", "#f": "", "mailto:a@b": ""}
    assert applied(spark, urls.resolve_link, [(h, base) for h in cases]) == list(cases.values())


def test_retry_decision(spark):
    cases = {
        ("Response code 404 (Not Found)", "https://a/x"): "http_404", ("Response code 429", "https://a/x"): "retryable", ("status: 503", "https://a/x"): "retryable",
        ("anything", "https://a/x.PDF"): "non_retryable_extension:.pdf", ("TypeError: Invalid URL", "zzz"): "invalid_or_unsupported_url", ("Navigation timeout", "https://a/x"): "retryable",
    }
    got = applied(spark, lifecycle.retry_decision, list(cases))
    assert [(r.retryable, r.reason) for r in got] == [(x == "retryable", x) for x in cases.values()]


def test_envelope(spark):
    wrapped = lambda retry: json.dumps({"_clf_payload": "https://a", "_clf_retry": retry, "_clf_first_seen_at": "t"})
    got = applied(spark, lifecycle.decode_envelope, ["https://a", '{"url":"https://a"}', wrapped(2), wrapped(-1), wrapped("x")])
    assert [tuple(r) for r in got] == [("https://a", 0, None), ('{"url":"https://a"}', 0, None), ("https://a", 2, "t"), ("https://a", 0, "t"), ("https://a", 0, "t")]


def test_posting_fields():
    posting = {
        "@type": "JobPosting", "title": "T", "hiringOrganization": {"name": "C"}, "identifier": {"value": "7"},
        "baseSalary": {"currency": "USD", "value": {"minValue": 10, "maxValue": 20, "unitText": "HOUR"}},
        "jobLocation": {"address": {"addressLocality": "X", "addressRegion": "Y", "addressCountry": {"name": "Z"}, "postalCode": "1"}},
    }
    got = postings.posting_fields(posting)
    want = {"job_title": "T", "company": "C", "job_id": "7", "salary": "10-20 HOUR", "currency": "USD", "salary_type": "base", "location": "X,Y,Z", "postal_code": "1"}
    assert {k: got[k] for k in want} == want
    del posting["hiringOrganization"]
    assert postings.posting_fields(posting) is None


def test_posting_search():
    blocks = ["{bad", '[{"@graph": [{"@type": "Thing"}, {"@type": ["x", "JOBPOSTING"], "title": "a"}]}]']
    assert postings.find_posting(blocks)["title"] == "a"
    assert postings.find_posting([]) is None


def test_normal_form_is_stable(spark):
    values = [k for name in ("normalize", "ats_canonical") for k in TABLES[name][1]]
    once = applied(spark, urls.normalize_url, values)
    assert applied(spark, urls.normalize_url, once) == once
    assert applied(spark, urls.url_key, once) == applied(spark, urls.url_key, values)


def test_rule_sets_differ_where_they_should():
    assert "team" in BUILT_IN.non_career and "team" not in CONFIGURED.non_career and "emailme.asp" in CONFIGURED.excluded
