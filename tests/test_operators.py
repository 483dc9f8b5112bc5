"""Operators on small relations."""

from pyspark.sql import functions as F

from linkloom.operators import legacy, lifecycle, links, records
from linkloom.sources import seeds


def test_dedupe_prefers_https_and_is_stable(spark):
    rows = spark.createDataFrame([(1, 0, "http://a.com/p"), (1, 1, "https://a.com/p/"), (1, 2, "https://b.com"), (1, 3, "http://a.com/p"), (2, 0, None)], "g int, pos int, url string")
    once = links.dedupe_links(rows.where("url is not null"), ["g"])
    assert {(r.url, r.pos) for r in once.collect()} == {("https://a.com/p", 0), ("https://b.com/", 2)}
    again = links.dedupe_links(once.drop("key"), ["g"])
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in once.collect()}


def test_filters_split_their_input(spark):
    rows = spark.createDataFrame([(1, "https://a.com/careers/x"), (1, "https://a.com/privacy"), (1, "https://z.com/none")], "g int, url string")
    reasons = {r.url: r.reason for r in rows.withColumn("reason", links.career_reason(F.col("url"), F.lit(False))).collect()}
    assert reasons == {"https://a.com/careers/x": None, "https://a.com/privacy": "non_career_pattern", "https://z.com/none": "not_career_like"}


def test_status_is_total(spark):
    flags = [(bool(i & 8), bool(i & 4), bool(i & 2), bool(i & 1)) for i in range(16)]
    rows = spark.createDataFrame(flags, "a boolean, b boolean, c boolean, d boolean")
    got = [r.s for r in rows.select(records.career_status(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("s")).collect()]
    want = ["excluded_domain" if a else "job_links_found" if b else "expired_or_no_jobs" if c else "ats_career_links_found" if d else "no_job_links" for a, b, c, d in flags]
    assert got == want


def test_envelope_round_trip(spark):
    rows = spark.createDataFrame([("https://a/x", 2, "t"), ("plain text", 0, None)], "v string, n int, f string")
    back = rows.select(lifecycle.decode_envelope(lifecycle.encode_envelope(F.col("v"), F.col("n"), F.col("f"))).alias("e"), "v", "n", "f")
    assert all((r.e.value, r.e.retries, r.e.first_seen) == (r.v, r.n, r.f) for r in back.collect())


def test_upsert_policies(spark):
    old = spark.createDataFrame([("a", 1, [1], 5), ("b", 2, [2], 6)], "k string, n int, s array<int>, keep int")
    new = spark.createDataFrame([("b", 3, [3], 9), ("c", 4, [4], 7)], "k string, n int, s array<int>, keep int")
    out = lifecycle.upsert(old, new, "k", {"n": "add", "s": "union", "keep": "insert_only"})
    assert {r.k: (r.n, r.s, r.keep) for r in out.collect()} == {"a": (1, [1], 5), "b": (5, [2, 3], 6), "c": (4, [4], 7)}


def test_dominant_bucket(spark):
    rows = [(1, f"https://a.com/jobs/{i}", f"Nurse number {chr(97 + i)}", "m", "p", "a") for i in range(5)] + [(1, "https://a.com/jobs/last", "Cook wanted", "other", "p", "a")]
    got = legacy.dominant_bucket(spark.createDataFrame(rows, "page_id int, link string, label string, mainparent string, parent_node string, node_name string"), ["/jobs/"])
    assert {r.link for r in got.collect()} == {f"https://a.com/jobs/{i}" for i in range(5)}


def test_job_id_parameter(spark):
    rows = spark.createDataFrame([("https://a/x?jobId=1&b=2", "9"), ("https://a/x", "9"), ("https://a/x?b=2#t", "9")], "u string, j string")
    assert [r[0] for r in rows.select(legacy.with_job_id(F.col("u"), F.col("j"))).collect()] == ["https://a/x?jobId=9&b=2", "https://a/x?jobId=9", "https://a/x?b=2&jobId=9#t"]


def test_seed_sources(spark, tmp_path):
    (tmp_path / "urls.txt").write_text("http://a.com/p\nhttps://a.com/p/\n\nhttps://b.com\n")
    assert {r.url for r in seeds.seed_file(spark, str(tmp_path / "urls.txt")).collect()} == {"https://a.com/p", "https://b.com/"}
    (tmp_path / "words.json").write_text('["a", 1, "b"]')
    assert seeds.json_array_file(spark, str(tmp_path / "words.json")) == ["a", "b"]
    assert seeds.json_array_file(spark, str(tmp_path / "none.json")) == []
    empty = spark.createDataFrame([], "id int, careerUrl string, redisSeeded boolean")
    full = spark.createDataFrame([(1, "https://a.com", True), (2, "https://b.com", None)], "id int, careerUrl string, redisSeeded boolean")
    assert seeds.choose_seed_table([("x", empty), ("y", full)]) == ("y", "unseeded")
    todo = seeds.seed_table(full)
    assert [r.id for r in todo.collect()] == [2]
    marked = seeds.with_marks(full, todo, F.lit("2024-01-01").cast("timestamp"))
    assert {r.id: r.redisSeeded for r in marked.collect()} == {1: True, 2: True}
    log = str(tmp_path / "log")
    assert seeds.log_length(spark, log) == 0
    seeds.append_messages(spark.createDataFrame([(1, "a"), (2, "b")], "id int, value string"), log)
    assert seeds.log_length(spark, log) == 2


def test_empty_pages_have_no_links(spark):
    pages = spark.createDataFrame([(1, "https://a.com", None), (2, None, "<a href='/x'>y</a>"), (3, "https://a.com", "")], "page_id int, url string, html string")
    assert links.link_entries(pages).count() == 0


def test_web_addresses_and_natural_order(spark):
    urls = {"https://a.com/x": True, "//a.com": True, "http://10.0.0.1/": False, "http://8.8.8.8/": True, "http://localhost": False, "a.com": False, "ftp://über.de/": True, None: False}
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string")
    assert [r[0] for r in rows.select(legacy.is_web_address(F.col("u"))).collect()] == list(urls.values())
    names = ["b2", "A10", "a9", "Éa", "eb"]
    rows = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in rows.orderBy(legacy.natural_key(F.col("n"))).collect()] == ["a9", "A10", "b2", "Éa", "eb"]
