"""The command line over small tables."""

import json

from linkloom import cli


def test_seeding_from_files_and_tables(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    (tmp_path / "urls.txt").write_text("http://a.example/p\nhttps://a.example/p/\n\n")
    cli.main(["seed", "--file", at("urls.txt"), "--queue", at("q")])
    assert [r.url for r in spark.read.parquet(at("q")).collect()] == ["https://a.example/p"]
    spark.createDataFrame([(i, f"https://s{i}.example/") for i in range(5)], "id long, careerUrl string").write.parquet(at("seeds"))
    args = ["seed", "--table", at("seeds"), "--marks", at("marks"), "--queue", at("q2")]
    cli.main([*args, "--max", "2"])
    assert {r.id for r in spark.read.parquet(at("marks")).collect()} == {0, 1}
    cli.main([*args, "--watch", "--cycles", "2", "--poll-ms", "1"])
    assert spark.read.parquet(at("q2")).count() == 5 and spark.read.parquet(at("marks")).distinct().count() == 5


def test_jobs_failed_links_and_health(spark, tmp_path, capsys):
    at = lambda name: str(tmp_path / name)
    schema = "id long, url string, status string, queued boolean, queued_at timestamp_ntz, career_url string, lock_until timestamp_ntz, error_at timestamp_ntz, discovered_at timestamp_ntz"
    rows = [(i, f"https://j.example/job/{i}", "done" if i == 3 else None, None, None, None, None, None, None) for i in range(4)]
    spark.createDataFrame(rows, schema).write.parquet(at("jobs"))
    args = ["seed:job-links", "--jobs", at("jobs"), "--marks", at("marks"), "--queue", at("q"), "--now", "2024-01-01 00:00:00"]
    cli.main([*args, "--max", "2"])
    cli.main(args)
    assert sorted(r.url for r in spark.read.parquet(at("q")).collect()) == [f"https://j.example/job/{i}" for i in range(3)]
    spark.createDataFrame([(i, "x") for i in range(9)], "id long, value string").write.parquet(at("failed"))
    cli.main(["seed:failed-links", "--log", at("failed"), "--queue", at("again"), "--max", "4"])
    assert spark.read.parquet(at("again")).count() == 4
    cli.main(["health", "--jobs", at("jobs"), "--json"])
    assert json.loads(capsys.readouterr().out)["total"] == 4


def test_workers(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    posting = '<script type="application/ld+json">{"@type":"JobPosting","title":"T","hiringOrganization":"O"}</script>'
    spark.createDataFrame([(1, "https://a.example/careers", '<a href="/job/1">Nurse</a>'), (2, "https://a.example/job/1", posting)], "page_id long, url string, html string").write.parquet(at("pages"))
    cli.main(["worker:links", "--pages", at("pages"), "--out", at("links")])
    assert {r.page_id: r.job_detail_link_count for r in spark.read.parquet(at("links")).collect()} == {1: 1, 2: 0}
    spark.createDataFrame([(1, "https://a.example/job/1", "pending")], "id long, url string, status string").write.parquet(at("jobs"))
    cli.main(["worker:html", "--pages", at("pages"), "--jobs", at("jobs"), "--out", at("postings")])
    assert [(r.page_id, r.job_title, r.company) for r in spark.read.parquet(at("postings")).collect()] == [(2, "T", "O")]
