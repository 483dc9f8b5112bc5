"""URL filters, HTML extraction, nearest neighbours and the pipeline."""

import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linkloom.llm import html_text, neighbours, url_filters


def test_url_filters(spark):
    cases = {
        "http://a.net/x": ("a.net", "/x", "net/", "block"), "http://WWW.Example.NET/en/1?q#h": ("www.example.net", "/en/1", "example.net/en/", "allow"), "http://a.net": ("a.net", "", None, "allow"),
        "https://example.com/de/": ("example.com", "/de/", "example.com/de/", "block"), "https://notexample.com/de/": ("notexample.com", "/de/", None, "allow"), "https://example.com/dex/": ("example.com", "/dex/", None, "allow"),
        "https://spam-farm.example.org/en/": ("spam-farm.example.org", "/en/", None, "block"), "https://spam-farm.example.org/fr/": ("spam-farm.example.org", "/fr/", "org/fr/", "allow"),
        None: ("", "", None, "allow"), "no scheme": ("", "", None, "allow"), "x://": ("", "", None, "allow"), "http://a.net:80/": ("a.net:80", "/", None, "allow"), "http://a.org/casino/": ("a.org", "/casino/", None, "block"),
    }
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(cases)], "page_id int, url string, host string")
    got = {r["url"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filters.judge_urls(df).collect()}
    assert got == cases
    assert url_filters.judge_urls(df.limit(0)).count() == 0


def test_odd_urls(spark):
    long = "https://a.example.net/" + "x/" * 20000
    df = spark.createDataFrame([(1, long), (1, long), (None, long), (2, ""), (3, "http://ä.net/ü")], "page_id int, url string").withColumns({c: F.lit("k") for c in ("path", "rule", "verdict", "tokens", "key")})
    rows = url_filters.judge_urls(df).collect()
    assert len(rows) == 5 and [r["rule"] for r in rows] == ["net/"] * 3 + [None, "net/"] and rows[0] == rows[1] and len(rows[0]["path"]) == 40001


def test_rules_stand_under_their_rarest_token():
    r = url_filters.Rule("block", "example.net/en/")
    assert r.tokens() == ["example", "net", "en"]
    assert url_filters.Rule("block", "*casino*").tokens() == [] and url_filters.Rule("block", "example.com/de").tokens() == ["example", "com"]


def test_many_rules(spark, monkeypatch):
    monkeypatch.setattr(url_filters, "RULES_PER_MAP", 3)
    rules = [url_filters.Rule("block", f"h{i}.example/p{i}/") for i in range(20)]
    df = spark.createDataFrame([(i, f"http://www.h{i}.example/p{i}/x") for i in range(25)], "page_id int, url string")
    got = {r["page_id"]: r["rule"] for r in url_filters.judge_urls(df, rules=rules).collect()}
    assert got == {i: f"h{i}.example/p{i}/" if i < 20 else None for i in range(25)}


def test_blocks():
    page = """<!doctype html><head><title>t</title><style>p{}</style></head><body class="has-sidebar"><header>H</header><nav><ul><li>m</ul></nav><div class="ad">ad</div><article><header><h1>T &amp;
    x</h1></header><p>one <b>two</b><br>three<p>four<script>var x="</p>"</script><div class="comments"><p>c</div><aside>s</aside></article><footer>f</footer>"""
    assert html_text.blocks(page) == [(3, "H"), (3, "m"), (3, "ad"), (1, "T & x"), (1, "one two three"), (1, "four"), (3, "c"), (3, "s"), (3, "f")]
    assert html_text.main_text(html_text.blocks(page), []) == "T & x\none two three\nfour"
    assert html_text.blocks(None) == [] and html_text.blocks("plain < text") == [(0, "plain < text")]
    assert html_text.blocks('<p class="ad">x<p>y') == [(3, "x"), (0, "y")]


def test_shared_lines():
    assert html_text.shared_lines(list("abcde"), list("bxdy")) == {1, 3}
    rng = np.random.default_rng(4)
    for _ in range(200):
        a, b = ([*map(str, rng.integers(0, 5, int(rng.integers(0, 9))))] for _ in range(2))
        best = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1, j + 1] = best[i, j] + 1 if a[i] == b[j] else max(best[i, j + 1], best[i + 1, j])
        assert len(html_text.shared_lines(a, b)) == best[-1, -1]


def test_extraction_by_neighbours(spark):
    shell = "<div>Site name</div><p>{}</p><div>All rights</div>"
    rows = [(i, f"https://a.example/p/{i}", shell.format(f"own text {i}")) for i in range(20)] + [(50, None, None), (51, "https://b.example/", "<p>alone</p>"), (52, "https://b.example/", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in html_text.extract_text(df).collect()}
    assert len(got) == 23 and got[50]["text"] == "" and got[51]["text"] == "alone" and got[51]["n_chars"] == 5
    assert all(r["text"] == f"own text {i}" for i, r in got.items() if i < 20)
    assert html_text.extract_text(df.limit(0)).count() == 0


def test_differencing_decides_outside_articles():
    page = "<div>Site name</div><article><p>teaser {0}</article><div>body text {0}</div><main><p>skip to top</p><p>more {0}</p></main>"
    own, near = (html_text.blocks(page.format(x)) for x in "ab")
    assert html_text.main_text(own, [near]) == "teaser a\nbody text a\nskip to top\nmore a"
    assert html_text.main_text(own, [near, html_text.blocks(page.format("c"))]) == "teaser a\nbody text a\nmore a"
    quoted = [(1, "a quoted passage"), (0, "Site name")]
    assert html_text.main_text(quoted, [quoted]) == "a quoted passage"
    assert html_text.main_text([(1, "a long article"), (0, "Site")], []) == "a long article"
    assert html_text.main_text([(1, "card"), (0, "the long body of the page")], []) == "card\nthe long body of the page"


def test_copies_keep_their_text_and_first_pages_lose_the_shell(spark):
    shell = "<div>Site name</div><p>{}</p><div>All rights</div>"
    texts = {0: "own text 0", 1: "own text 1", 2: "a whole article that stands here", 3: "own text 3", 4: "own text 4"}
    rows = [(10 * i + j, f"https://a.example/p/{i}?v={j}", shell.format(t)) for i, t in texts.items() for j in range(7 if i in (0, 2) else 1)]
    rows += [(1000 + j, f"https://b.example/{j // 3}", "<p>the same page of a host twice</p>") for j in range(9)]
    rows += [(2000 + i, f"https://c.example/{i}", f"<p>a first long paragraph of a mirrored text</p><p>another one</p><p>edit {i}</p>") for i in range(2)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r["page_id"]: r["text"] for r in html_text.extract_text(df).collect()}
    assert len(got) == len(rows)
    assert all(got[i] == texts[i // 10] for i in got if i < 1000)
    assert {got[i] for i in got if 1000 <= i < 2000} == {"the same page of a host twice"}
    assert got[2001] == "a first long paragraph of a mirrored text\nanother one\nedit 1"


def test_only_differencing_finds_the_text(spark):
    """Pages of plain elements: every page's own lines, and no line of the shell, which differs by host."""
    rng = np.random.default_rng(7)
    rows, want = [], {}
    for i in range(120):
        host, own = f"h{i % 4}.example", [f"sentence {rng.integers(0, 10**9)} of page {i}" for _ in range(int(rng.integers(2, 6)))]
        shell = [f"<div>{host} menu {j}</div>" for j in range(3)], [f"<div>{host} imprint {j}</div>" for j in range(2)]
        body = [f"<div>{x}</div>" for x in own]
        body.insert(1, f"<div>{host} subscribe to the letter</div>")
        rows.append((i, f"https://{host}/{'x' * (i % 3)}/{i}", "".join([*shell[0], *body, *shell[1]])))
        want[i] = "\n".join(own)
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    assert {r["page_id"]: r["text"] for r in html_text.extract_text(df).collect()} == want


def test_odd_pages(spark):
    long = "<article>" + "".join(f"<p>line {i} of a very long page</p>" for i in range(20000)) + "</article>"
    rows = [(1, "https://a.example/1", long, "x"), (1, "https://a.example/1", long, "x"), (2, None, "<p>no url</p>", None), (3, "https://a.example/1", "", "y"), (None, "https://a.example/" + "p" * 9000, None, "z")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").withColumns({c: F.lit("k") for c in ("part", "own", "key", "data", "h", "rank", "n_chars", "kept", "source")})
    got = [(r["page_id"], r["n_chars"]) for r in html_text.extract_text(df).collect()]
    assert sorted(got, key=str) == sorted([(1, len("\n".join(f"line {i} of a very long page" for i in range(20000))))] * 2 + [(2, 6), (3, 0), (None, 0)], key=str)


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_ranges_do_not_decide_the_near_pages(parts):
    rng = np.random.default_rng(parts)
    rows = sorted((f"{'abc'[int(rng.integers(0, 3))]}.example\x00/{rng.integers(0, 30):02}", n, int(rng.integers(0, 4))) for n in range(60))
    part = sorted(int(x) for x in rng.integers(0, parts, len(rows)))
    table = pa.record_batch([pa.array(part, pa.int32()), pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows])], names=["part", "key", "h", "digest"])
    edges = [e for b in html_text._edges(iter([table])) for e in b.to_pylist()]
    extra = {}
    for p, key, h, to in html_text._borrowed(edges):
        for t in to:
            extra.setdefault(t, []).append((key, h, p))
    for p in set(part):
        first, last = part.index(p), len(part) - 1 - part[::-1].index(p)
        for at, step in ((first, -1), (last, 1)):
            near, host, i = [], rows[at][0].split("\x00")[0], at + step
            while 0 <= i < len(rows) and rows[i][0].split("\x00")[0] == host and len(near) < 3:
                if rows[i][2] not in [d for d, _ in near]:
                    near.append((rows[i][2], rows[i][1]))
                i += step
            assert {h for _, h in near} == {h for _, h, q in extra.get(p, []) if (q < p) == (step < 0)}


def brute(vectors, queries, k):
    out = {}
    for q in queries:
        far = sorted((float(np.sqrt(((v - vectors[q]) ** 2).sum())), i) for i, v in vectors.items() if i != q)
        out[q] = [i for _, i in far[:k]]
    return out


def test_neighbours(spark):
    rng = np.random.default_rng(5)
    vectors = {i: rng.standard_normal(8).astype("float32").astype(float) for i in range(3000)}
    for i in range(0, 900, 3):
        vectors[i] = vectors[0]  # many equal ones
    rows = [(i, [float(x) for x in v], "x") for i, v in vectors.items()]
    rows += [(5001, None, "x"), (5002, [0.0] * 8, "x"), (5003, [float("nan")] * 8, "x"), (5100, [1.0, None] * 4, "x"), (5200, [1.0], "x"), (None, [1.0] * 8, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    want = brute(vectors, [i for i in vectors if i % 100 == 0], 10)
    assert set(got) == set(want) and all(len(x) == 10 for x in got.values())
    assert got[0] == want[0] and got[300] == want[300]
    assert np.mean([len(set(got[q]) & set(want[q])) / 10 for q in want]) >= 0.9


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_on_the_driver_s_vectors(spark, sf):
    d = f"/root/testdata/{sf}"
    if not os.path.isdir(d):
        pytest.skip("the tables are not here")
    vectors = {r["vec_id"]: np.array(r["embedding"], float) for r in spark.read.parquet(f"{d}/embeddings.parquet").collect()}
    got = {}
    for r in neighbours.op8_nearest_neighbours(spark, d).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
        assert r["rank"] == len(got[r["query_id"]]) and r["score"] == pytest.approx(float(np.sqrt(((vectors[r["vec_id"]] - vectors[r["query_id"]]) ** 2).sum())), abs=1e-12)
    want = brute(vectors, [i for i in vectors if i % 100 == 0], 10)
    recall = np.mean([len(set(got[q]) & set(want[q])) / 10 for q in want])
    print(f"recall at {sf}: {recall:.3f}")
    assert set(got) == set(want) and recall >= 0.9


@pytest.mark.parametrize("rows", [[], [(100, [1.0, 2.0])], [(100, [1.0, 2.0]), (100, [1.0, 2.0]), (1, [1.0, 2.5])]])
def test_few_vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = neighbours.nearest(df, F.col("vec_id") % 100 == 0).collect()
    assert [(r["query_id"], r["vec_id"]) for r in got] == ([] if len(rows) < 2 else [(100, 1)] * len(got)) and len(got) <= 2


CLASHING = ("spans", "score", "lang_pred", "known", "tokens", "weight", "copies", "copy", "block", "place", "n_lines", "n_removed", "__x", "__c0", "__c1", "__source", "part", "row", "k", "gone", "component_id")


def test_pipeline(spark, odd, none):
    import corpus_pipeline

    base = ["doc_id", "text", "lang", "source", "n_chars"]
    for start in (odd, none, odd.withColumns({c: F.lit(f"keep {c}") for c in CLASHING})):
        docs = start
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, "").cache()
            assert docs.columns == start.columns, name
            assert all(r[c] == f"keep {c}" for r in docs.collect() for c in docs.columns if c not in base), name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() >= docs.count()


def test_pipeline_row_by_row(spark, tmp_path):
    """Every stage's rows on documents whose fate is known."""
    import corpus_pipeline

    rng = np.random.default_rng(11)
    en = "the quick brown fox jumps over the lazy dog and this is that with from every other small house of many people".split()
    text = lambda n: " ".join(rng.choice(en, n))
    clean = {i: "\n".join(text(12) for _ in range(4)) for i in range(40)}
    passage = "\n".join(text(20) for _ in range(3))
    near = text(140).split()
    near = [" ".join(near), " ".join([*near[:-1], "fox fox"])]
    rows = dict(clean) | {100: clean[3], 101: passage + "\n" + text(30), 102: text(30) + "\n" + passage, 103: None, 104: "", 105: "12 34", 106: "これは日本語の文章です " * 9, 107: near[0], 108: near[1]}
    table = [(k, t, "en" if t and k != 106 else None, "big" if k < 30 else "small", len(t or "")) for k, t in rows.items()]
    spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    docs, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = docs.collect()
    texts = lambda name: {r["doc_id"]: r["text"] for r in seen[name]}
    assert texts("language_id") == {k: t for k, t in rows.items() if k not in (103, 104, 105, 106)}
    lined = texts("language_id") | {102: rows[102].split("\n")[0]}
    lined.pop(100)
    assert texts("line_dedup") == lined and all(r["n_chars"] == len(r["text"]) for r in seen["line_dedup"])
    lined.pop(108)
    assert texts("near_dedup") == lined and len(seen["near_dedup"]) == len(lined)
    assert texts("mixing") == lined and len(seen["mixing"]) >= len(lined)
    copies = {k: sum(r["doc_id"] == k for r in seen["mixing"]) for k in lined}
    assert all(copies[k] == 1 for k in range(30)) and max(copies.values()) <= 2
    pieces = {k: sum(r["doc_id"] == k for r in seen["packing"]) for k in lined}
    assert pieces == copies and {r["doc_id"]: r["length"] for r in seen["packing"]}.keys() == lined.keys()
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(seen["packing"])


def test_near_dedup_keeps_one_row_of_repeated_and_null_keys(spark, tmp_path):
    import corpus_pipeline

    words = " ".join(f"w{i}" for i in range(60))
    rows = [(7, words)] * 5 + [(None, words + " x")] * 3 + [(None, "another text that has no key at all")] * 4 + [(8, "a text of its own that stays here"), (8, "other words under the same key as before")]
    spark.createDataFrame([(k, t, "en", "a", len(t)) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(str(tmp_path / "d"))
    got = corpus_pipeline.near_dedup(spark, spark.read.parquet(str(tmp_path / "d")), "").collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted({(None, words + " x"), *rows[8:]}, key=str)
