"""The document operators on odd rows, empty tables and against brute force."""

import hashlib
import itertools
import os
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.llm import fingerprints, graph, jaccard, language, line_dedup, mixing, packing, sharding


def sized(df):
    return df.withColumn("bytes", F.coalesce(F.octet_length("text"), F.lit(0)) + 16)


@pytest.mark.parametrize("which", ["odd", "none", "clash"])
def test_sharding(which, request):
    df = request.getfixturevalue(which)
    rows = sharding.assign_shards(sized(df), "bytes", shards=5).collect()
    assert len(rows) == df.count()
    counts = Counter(r["shard"] for r in rows)
    assert not rows or max(counts.values()) - min(counts.get(s, 0) for s in range(5)) <= 1
    for s in counts:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))


def test_sharding_is_a_permutation_and_repeats(spark):
    df = spark.range(500).withColumn("bytes", F.lit(100))
    once = [r["id"] for r in sharding.shuffled_positions(df, "bytes").orderBy("position").collect()]
    again = [r["id"] for r in sharding.shuffled_positions(df, "bytes").orderBy("position").collect()]
    assert once == again and sorted(once) == list(range(500)) and once != sorted(once)
    other = [r["id"] for r in sharding.shuffled_positions(df, "bytes", seed=18).orderBy("position").collect()]
    assert other != once


def test_sharding_query(spark, tmp_path):
    texts = {i: None if i % 9 == 0 else "ä" * (i % 40) for i in range(500)}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    rows = sharding.op10_sharding(spark, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 16, zlib.crc32(data), "rows", None)
    counts = Counter(r["shard"] for r in rows)
    assert set(counts) == set(range(40)) and max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n)) for s, n in counts.items())


@pytest.mark.parametrize("file_bytes", [256 << 20, 100_000])
def test_written_shards(odd, spark, tmp_path, file_bytes):
    sharding.write_shards(odd, str(tmp_path / "out"), shards=3, file_bytes=file_bytes)
    back = spark.read.parquet(str(tmp_path / "out"))
    counts = Counter(r["shard"] for r in back.collect())
    assert max(counts.values()) - min(counts.values()) <= 1 and all(sorted(r["slot"] for r in back.where(f"shard = {s}").collect()) == list(range(n)) for s, n in counts.items())
    assert sorted(map(str, (r["text"] for r in back.collect()))) == sorted(map(str, (r["text"] for r in odd.collect())))


@pytest.mark.parametrize("which", ["odd", "none", "clash"])
def test_fingerprints(which, request):
    df = request.getfixturevalue(which)
    rows = fingerprints.fingerprint_documents(df).collect()
    assert len(rows) == df.count()
    by = {}
    for r in rows:
        assert by.setdefault(fingerprints.canonical(r["text"] or ""), r["fingerprint"]) == r["fingerprint"]
    assert len(set(by.values())) == len(by)


def test_canonical_form():
    assert fingerprints.canonical("  Straße\u00a0ＡＢ ") == fingerprints.canonical("STRASSE ab")
    assert fingerprints.canonical("a b") != fingerprints.canonical("ab")
    data = fingerprints.canonical("x")
    plain = fingerprints.digest(data)
    assert fingerprints.digest(data, frozenset([plain])) == f"{plain}-{hashlib.sha256(data).hexdigest()}"


def test_edited_fingerprints(spark, tmp_path):
    texts = {i: ["Straße  ", "STRASSE", "ｓｔｒａßｅ\n", "a", "a b", "ab"][i % 6] if i % 3 else "wort " * (i % 7) + f"text {i}" for i in range(60)} | {100 + i: "Same text" if i % 2 else "same\u00a0 TEXT" for i in range(6)}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in fingerprints.op6_fingerprints(spark, str(tmp_path)).collect()}
    order = sorted(texts, reverse=True)
    for at, i in enumerate(order):
        t, after = texts[i], texts[order[(at + 1) % len(order)]]
        cut = len(t) // 3
        edited = t[: len(t) - cut] + after[:cut]
        assert got[i]["n_chars"] == len(t) and got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        plain = lambda x: " ".join(unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", x).casefold()).split())
        assert got[i]["near_edited"] == float(plain(edited) == plain(t)) == float(got[i]["fingerprint"] == got[i]["edited_fingerprint"])
        assert got[i]["near_next"] == float(plain(after) == plain(t)) == float(got[i]["fingerprint"] == got[order[(at + 1) % len(order)]]["fingerprint"])


def test_shared_digests_are_told_apart(spark, monkeypatch):
    texts = [f"text {i % 20}" for i in range(50)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    # A hash of a few values, so that different texts share digests; once few are sent, once all are told apart.
    weak = lambda data: f"{len(data) % 2}"
    monkeypatch.setattr(fingerprints.xxhash, "xxh3_128_hexdigest", weak)
    for shared in (frozenset(["0", "1"]), None):
        got = [fingerprints.digest(fingerprints.canonical(t), shared) for t in texts]
        assert all((a == b) == (x == y) for a, x in zip(got, texts) for b, y in zip(got, texts))
    assert fingerprints.shared_digests(df).count() == 0


def test_rows_of_one_key_spread_over_parts(spark):
    from linkloom.llm.common import sort_bounds, with_next

    df = spark.createDataFrame([(None if i % 2 else i, f"t{i}") for i in range(4000)], "k long, text string")
    dealt = with_next(df, "k", F.col("text"), wrap=True).collect()
    own = Counter(r["part"] for r in dealt if r["own"])
    assert sum(own.values()) == 4000 and len(own) > 8 and max(own.values()) < 800
    keyed = df.withColumn("rank", F.struct("k", F.xxhash64("k", "text").alias("h")))
    assert len(sort_bounds(keyed, "rank", 10)) == 9


def test_edited_fingerprints_of_few(spark, tmp_path):
    for rows in ([], [(5, "abc")], [(5, None), (5, None), (None, "x")]):
        path = str(tmp_path / str(len(rows)))
        spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
        assert fingerprints.op6_fingerprints(spark, path).count() == len(rows)


def brute_components(texts, words, num, den):
    def shingled(t):
        own = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return {tuple(own[i : i + words]) for i in range(len(own) - words + 1)} if len(own) >= words else ({tuple(own)} if own else set())

    sets = {k: shingled(t) for k, t in texts.items()}
    root = {k: k for k in texts}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(sorted(texts), 2):
        both = len(sets[a] & sets[b])
        if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), top(k)) for k in texts}


def near_copies(count, seed):
    rng = np.random.default_rng(seed)
    texts = {}
    for i in range(count):
        if i % 3 == 0 or not texts:
            words = [f"w{x}" for x in rng.integers(0, 4000, int(rng.integers(1, 90)))]
        else:
            words = texts[int(rng.integers(0, i))].split()
            for _ in range(int(rng.integers(0, 4))):
                words[int(rng.integers(0, len(words)))] = f"x{rng.integers(0, 99)}"
        texts[i] = " ".join(words)
    return texts


@pytest.mark.parametrize("block,sketched", [(256, 1 << 13), (3, 1 << 13), (3, 4)])
@pytest.mark.parametrize("words,num", [(4, 85), (5, 80)])
def test_jaccard_join_against_all_pairs(spark, monkeypatch, block, sketched, words, num):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "SKETCHED", sketched)
    texts = near_copies(240, words)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.link_components(df, words=words, num=num).collect()}
    assert got == brute_components(texts, words, num, 100)


def test_signatures_meet_wherever_sets_link():
    rng = np.random.default_rng(0)
    for _ in range(3000):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        keep = rng.permutation(len(a))[: max(1, len(a) - int(rng.integers(0, max(1, n // 10) + 1)))]
        b = np.unique(np.concatenate([a[keep], rng.integers(0, 2**64, int(rng.integers(0, max(1, n // 10) + 1)), dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 85 * (len(a) + len(b) - both):
            assert set(jaccard.signatures(a, 85, 100).tolist()) & set(jaccard.signatures(b, 85, 100).tolist())


def test_sketches_rule_no_link_out():
    rng = np.random.default_rng(3)
    for _ in range(500):
        n = int(rng.choice([rng.integers(1, 900), rng.integers(900, 6000)]))
        a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[int(rng.integers(0, 1 + len(a) // 5)) :], rng.integers(0, 2**64, int(rng.integers(0, 1 + n // 5)), dtype=np.uint64)]))
        x, y = jaccard.stacked([jaccard.sketch(s) for s in (a, b)])
        assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))
        both = len(np.intersect1d(a, b))
        edges = jaccard._joined_sketches(np.array([len(a), len(b)]), np.stack([x, y]), 2, 85, 100)
        assert edges or 100 * both < 85 * (len(a) + len(b) - both)


def test_a_common_passage_joins_nothing(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    rng = np.random.default_rng(4)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = {i: passage + " " + " ".join(f"w{x}" for x in rng.integers(0, 9999, 40)) for i in range(200)} | {500: ""} | {600 + i: f"{passage} {passage} x{i}" for i in range(30)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.link_components(df).collect()}
    assert got == brute_components(texts, 4, 85, 100)


def test_jaccard_join_odd(odd, none, clash):
    assert jaccard.link_components(none).count() == 0
    rows = jaccard.link_components(odd).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by[6]["component_id"] == by[1]["component_id"] == 1 and by[2]["n_shingles"] == 0 and by[3]["component_id"] == 3 and by[9]["component_id"] == 5
    assert jaccard.link_components(clash).count() == odd.count()


def test_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(50, 49), (49, 50), (60, 60)] + [(100, i) for i in range(101, 140)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({got[i] for i in range(21)}) == 1 and got[49] == got[50] and len({got[i] for i in range(100, 140)}) == 1
    assert len({got[0], got[49], got[100]}) == 3 and 60 not in got
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_lines(rows, least=5):
    """Each document against every earlier one: all common blocks of lines with words go.
    rows: (key, text); the key orders them. Written without the library's alignment."""
    out, earlier = [], []
    for k, t in sorted(rows):
        lines = t.split("\n")
        own = [i for i, x in enumerate(lines) if x.split()]
        gone = set()
        if len(t.split()) >= least and any(t == other for _, other in earlier):
            out.append((k, ""))
            continue
        for _, other in earlier:
            theirs = [x for x in other.split("\n") if x.split()]
            for i, j in itertools.product(range(len(own)), range(len(theirs))):
                n = 0
                while i + n < len(own) and j + n < len(theirs) and lines[own[i + n]] == theirs[j + n]:
                    n += 1
                if sum(len(lines[x].split()) for x in own[i : i + n]) >= least:
                    gone |= set(own[i : i + n])
        kept = []
        for i, x in enumerate(lines):
            around = [max([-1, *[o for o in own if o < i]]), min([len(lines), *[o for o in own if o > i]])]
            blank = not x.split() and gone and all(o in gone or o in (-1, len(lines)) for o in around)
            if i not in gone and not blank:
                kept.append(x)
        out.append((k, "\n".join(kept)))
        earlier.append((k, t))
    return dict(out)


def deduped(spark, texts):
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    return {r["doc_id"]: r["text"] for r in line_dedup.drop_repeated_lines(df).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_line_dedup_against_all_pairs(spark, seed):
    rng = np.random.default_rng(seed)
    lines = [f"shared line {i} with words" for i in range(30)] + ["short", "", " ", "two words", "and three words"] * 3
    texts = {k: "\n".join([lines[i] for i in rng.integers(0, len(lines), int(rng.integers(1, 14)))] + [f"only in {k} here"] * int(rng.integers(0, 2))) for k in range(90)}
    assert deduped(spark, texts) == brute_lines(texts.items())


def test_blocks_of_lines_with_other_owners_go(spark):
    # Both lines of 3 and 4 stand first in other documents, and only together they are long enough.
    texts = {1: "aa bb cc\nalone in one", 2: "dd ee ff\nalone in two", 3: "aa bb cc\ndd ee ff\nin three", 4: "in four\naa bb cc\ndd ee ff", 5: "aa bb cc\ndd ee ff\nin three"}
    assert deduped(spark, texts) == {1: texts[1], 2: texts[2], 3: texts[3], 4: "in four", 5: ""}


def test_frequency_of_a_line_decides_nothing(spark):
    texts = {k: f"start {k}\naa bb cc\ndd ee ff\nend {k}" for k in range(300)} | {-1: "dd ee ff\nx", -2: "aa bb cc\ny"}
    got = deduped(spark, texts)
    assert all(got[k] == (texts[k] if k <= 0 else f"start {k}\nend {k}") for k in texts)


def test_line_dedup_odd(odd, none, clash):
    assert line_dedup.drop_repeated_lines(none).count() == 0
    for df in (odd, clash):
        rows = line_dedup.drop_repeated_lines(df).collect()
        assert len(rows) == odd.count()
        by = {r["doc_id"]: r["text"] for r in rows if r["doc_id"] is not None}
        assert by[6] == "" and by[1] and by[2] is None and by[4] == " \t\n " and len(by[9]) < 200
    named = line_dedup.drop_repeated_lines(clash, lines="a", removed="b").first()
    assert named["n_removed"] == "x" and named["k"] == "x"


def test_patience():
    assert line_dedup.patience("abcxyz", "abcqxyz") == [(0, 0), (1, 1), (2, 2), (3, 4), (4, 5), (5, 6)]
    assert line_dedup.patience("", "abc") == []
    assert line_dedup.common_blocks([(0, 0), (1, 1), (3, 2)], [3, 3, 0, 9], 6) == [0, 1, 3]


def test_blocks_without_anchors_go():
    def brute(a, b, words, least):
        out = set()
        for i, j in itertools.product(range(len(a)), range(len(b))):
            n = 0
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                n += 1
            out |= set(range(i, i + n)) if sum(words[i : i + n]) >= least else set()
        return sorted(out)

    rng = np.random.default_rng(6)
    for _ in range(1500):
        a, b = ([*map(str, rng.integers(0, 4, int(rng.integers(0, 12))))] for _ in range(2))
        words = [int(x) for x in a]
        got = line_dedup.repeated_in(a, b, words, 4)
        assert line_dedup.repeated_runs(a, b, words, 4) == got
        assert got == brute(a, b, words, 4) == sorted(set(line_dedup.common_blocks(line_dedup.patience(a, b), words, 4)))
    # Twice in the later document, in the middle of both.
    assert line_dedup.repeated_in(list("pxqxr"), list("sxt"), [9] * 5, 5) == [1, 3]
    assert len(line_dedup.repeated_in(["x"] * 20000, ["x"] * 10000, [1] * 20000, 5)) == 20000


def test_frequent_copies_and_short_lines_go_whole(spark):
    copy = "Of.\na passage that very many documents hold\nOf.\nand its end\nOf."
    texts = {0: "Of.\nan unrelated first document"} | {k: copy for k in range(1, 160)}
    texts |= {k: f"new {k}\nOf.\nOf.\ntwo words\nby it\nand so on\nnew end {k}" for k in range(160, 290)}
    got = deduped(spark, texts)
    assert all(got[k] == (texts[k] if k in (0, 1, 160) else "" if k < 160 else f"new {k}\nnew end {k}") for k in texts)


def test_packing_round_trip(spark, odd, none, clash):
    json_ = packing.vocabulary()
    assert packing.pack(packing.token_pieces(none, json_)).count() == 0
    for df in (odd, clash):
        pieces = packing.token_pieces(df, json_, with_ids=True)
        rows = packing.pack(pieces, block=5).collect()
        assert len({(r["row"], r["piece"]) for r in rows}) == len(rows)
        bins = {}
        for r in rows:
            assert len(r["ids"]) == r["length"] <= 2048 and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
            bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for b in bins.values():
            assert [o for o, _ in sorted(b)] == list(np.cumsum([0, *[n for _, n in sorted(b)]])[:-1]) and sum(n for _, n in b) <= 2048
        from tokenizers import Tokenizer

        own = Tokenizer.from_str(json_)
        for row, group in itertools.groupby(sorted(rows, key=lambda r: (r["row"], r["piece"])), key=lambda r: r["row"]):
            ids = [i for r in group for i in r["ids"]]
            text = df.select(F.monotonically_increasing_id().alias("row"), "text").where(F.col("row") == row).first()["text"] if row < 3 else None
            assert ids[-1] == 0
            if text is not None:
                assert ids[:-1] == own.encode(text, add_special_tokens=False).ids


def test_encoders_agree(monkeypatch):
    ids = packing.Ids(packing.vocabulary())
    texts = ["a  b", "x\n\ny", " lead ", "<|endoftext|> hi", "", "don't stop's", "a\tb", "é è k", "123 4a5", "日本語", "²³ ½", "a\x85b", "a\u00a0b", "…—“q”"]
    rng = np.random.default_rng(5)
    bits = ["日本", "don't", "x", "  ", "\n", " ", "é", "12", "…", "a b", "\t \u00a0", "Ω", "'s", " ,"]
    texts += ["".join(rng.choice(bits, 4000)) + " Ω" for _ in range(20)] + ["Ω" * 50_000]
    monkeypatch.setattr(packing, "PART", 50)
    assert ids.of(texts) == [np.array(ids.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_ids_of_the_driver_s_documents(spark):
    """The fast encoder against the vocabulary file's own library, on whole texts."""
    from tokenizers import Tokenizer

    d = "/root/testdata/sf0.01"
    if not os.path.isdir(d):
        pytest.skip("the tables are not here")
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    own = Tokenizer.from_str(packing.vocabulary())
    rows = packing.op5_packing(spark, d).collect()
    bins, held = {}, {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        held.setdefault(r["doc_id"], []).append(r)
    assert set(held) == set(texts)
    for k, pieces in held.items():
        ids = np.array([*own.encode(texts[k], add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for n, r in enumerate(sorted(pieces, key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (n, at) and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids) and all(r["length"] == 2048 for r in pieces if r["piece"])
    for b in bins.values():
        assert [o for o, _ in sorted(b)] == [0, *np.cumsum([n for _, n in sorted(b)])[:-1].tolist()] and sum(n for _, n in b) <= 2048
    assert len(bins) <= 1.02 * sum(r["length"] for r in rows) / 2048 + 1


def test_sum_of_squares_against_counting_every_bin():
    rng = np.random.default_rng(8)
    for most in (7, 20):
        lengths = rng.integers(1, most + 1, 120)
        number, place = packing.sum_of_squares(lengths, most)
        bins: list[list[int]] = []
        for b, p, n in zip(number.tolist(), place.tolist(), lengths.tolist(), strict=True):
            def squares(bins):
                return sum(c * c for g, c in Counter(most - sum(x) for x in bins).items() if g)

            tried = {i: squares([*bins[:i], [*bins[i], n], *bins[i + 1 :]]) for i in range(len(bins)) if sum(bins[i]) + n <= most} | {len(bins): squares([*bins, [n]])}
            # Of the placements with the smallest sum.
            assert n == most or tried[b] == min(tried.values())
            bins += [[]] if b == len(bins) else []
            assert p == sum(bins[b])
            bins[b].append(n)


def test_sum_of_squares_keeps_bins_whole():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 101, 2000)
    number, place = packing.sum_of_squares(lengths, 100)
    fill = Counter()
    for b, p, n in zip(number, place, lengths, strict=True):
        assert p == fill[b]
        fill[b] += n
    assert max(fill.values()) <= 100 and len(fill) < 1.06 * lengths.sum() / 100
    assert packing.cut(5000, 2048) == [(0, 904), (904, 2048), (2952, 2048)] and packing.cut(2048, 2048) == [(0, 2048)]


def test_language_of_mixed_text(spark, odd, none, clash):
    en = "the quick brown fox jumps over the lazy dog and this is that with from".split()
    de = "der schnelle braune fuchs springt über den faulen hund und das ist mit von".split()
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(en if i % 2 else de, 30)), "en" if i % 2 else "de") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.learn(df)
    assert model.langs == ["de", "en"]
    out = language.identify(df, model).withColumn("held", language.held_out(F.col("doc_id"))).collect()
    tested = [r for r in out if r["held"]]
    assert tested and all(r["lang_pred"] == r["lang"] and 0 <= r["score"] <= 1 for r in tested)
    mixed = spark.createDataFrame([(1, " ".join(en) + ". " + " ".join(de) + " der hund")], "doc_id long, text string")
    spans = language.identify(mixed, model, with_spans=True).first()["spans"]
    assert [s["lang"] for s in spans] == ["en", "de"] and spans[0]["start"] == 0 and spans[1]["end"] == len(" ".join(en) + ". " + " ".join(de) + " der hund")
    for odd_df in (odd, none, clash):
        rows = language.identify(odd_df, model).collect()
        assert len(rows) == odd_df.count()
        assert all((r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or "")) for r in rows)
    nothing = language.learn(none)
    assert {r["lang_pred"] for r in language.identify(odd, nothing).collect()} == {"und"}


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(9)
    words = ["ab", "cd", "ef", "gh"]
    for _ in range(40):
        m = language.Model(["x", "y", "z"], None, None, 0)
        score = rng.uniform(-9, 0, (4, 3)).astype(np.float32)
        m.scores = lambda known, s=score: (np.array([s[words.index(w)] for w in known]), np.zeros(len(known)))
        text = [words[i] for i in rng.integers(0, 4, 6)]
        (found, *_), (none, *_) = m.read([text, []])
        cost = lambda path: sum(float(score[words.index(w)][c]) for w, c in zip(text, path)) - language.SWITCH * sum(a != b for a, b in zip(path, path[1:]))
        assert len(none) == 0 and abs(cost(found.tolist()) - max(cost(p) for p in itertools.product(range(3), repeat=6))) < 2e-3


def test_language_of_held_out_documents(spark):
    d = "/root/testdata/sf0.01"
    if not os.path.isdir(d):
        pytest.skip("the tables are not here")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    rows = language.op9_language_id(spark, d).join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
    tested = [r for r in rows if r["held_out"] and r["lang"] and r["lang_pred"] != "und"]
    assert len(tested) > 200 and np.mean([r["lang"] == r["lang_pred"] for r in tested]) > 0.98


def test_texts_in_no_known_language(spark):
    rng = np.random.default_rng(6)
    en = "the quick brown fox jumps over the lazy dog and this is that with from every other small house of many people".split()
    de = "der schnelle braune fuchs springt über den faulen hund und das ist mit von jedem anderen kleinen haus vieler menschen".split()
    rows = [(i, " ".join(rng.choice(en if i % 2 else de, 40)), "en" if i % 2 else "de") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    mixed, odd = " ".join([*en, *de, *en, *de]), "xqzvk jjwq zzkxv qqpwx vvkzj wxqjz kkzqx jqwvz zxqkj"
    more = [(1000, mixed, None), (1001, "これは日本語の文章です " * 5, None), (1002, odd, None), (1003, None, None), (1004, "12 34", None), (1005, "ok", None), (1006, "das haus", None)]
    both = df.unionByName(spark.createDataFrame(more, df.schema))
    known = {r["doc_id"]: r["known"] for r in language.identify(both, language.learn(df), with_known=True).collect()}
    assert all(known[i] for i in range(300)) and {k: known[k] for k in range(1000, 1007)} == {1000: True, 1001: False, 1002: False, 1003: False, 1004: False, 1005: True, 1006: True}
    # Many languages are all learned, and long texts are not drawn.
    many = spark.createDataFrame([(i, f"wort{i % 700} text", f"l{i % 700}") for i in range(2100)] + [(9999, "x " * language.LONGEST, "long")], df.schema)
    # All but those of which the three rows are held out.
    assert len(language.learn(many).langs) == len({i % 700 for i in range(2100) if zlib.crc32(str(i).encode()) % 3 != 1}) and "long" not in language.learn(many).langs


def brute_mix(rows, most, blocks):
    """rows: (key, source, tokens); blocks: {key: (block, place)}. Copies by an own search for the power."""
    totals = Counter()
    for _, s, n in rows:
        totals[s] += n
    share = {s: n / sum(totals.values()) for s, n in totals.items()}
    low, high = 0.0, 1.0
    for _ in range(60):
        x = (low + high) / 2
        low, high = (low, x) if (min(share.values()) / max(share.values())) ** (x - 1) <= most else (x, high)
    raised = {s: p**high for s, p in share.items()}
    top = max(totals, key=totals.get)
    out = {}
    for s in totals:
        budget = max(totals[s], round(totals[top] * raised[s] / raised[top]))
        whole, rest, sofar = *divmod(budget, totals[s]), 0
        for _, k, n in sorted((blocks[k], k, n) for k, t, n in rows if t == s):
            sofar += n
            out[k] = whole + (sofar <= rest)
    return out


def test_mixing_against_an_own_search(spark, tmp_path):
    rng = np.random.default_rng(12)
    rows = [(i, "w " * int(rng.integers(1, 30)), "abc"[int(rng.choice(3, p=[0.8, 0.15, 0.05]))]) for i in range(800)]
    spark.createDataFrame([(i, s, t) for i, t, s in rows], "doc_id long, source string, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = mixing.op7_source_mixing(spark, str(tmp_path)).collect()
    assert len(got) == 800 and {r["doc_id"]: (r["source"], r["tokens"]) for r in got} == {i: (s, len(t.split())) for i, t, s in rows}
    want = brute_mix([(i, s, len(t.split())) for i, t, s in rows], 4.0, {r["doc_id"]: (r["block"], r["place"]) for r in got})
    assert {r["doc_id"]: r["copies"] for r in got} == want


def test_mixing_of_more_sources_than_are_sent(spark, monkeypatch):
    rows = [(i, "w " * (1 + i % 9), "big" if i % 3 else f"s{i % 40}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    key = lambda x: sorted((r["doc_id"], r["copies"], r["block"], r["place"], round(r["weight"], 12)) for r in x.collect())
    few = key(mixing.mix(df))
    monkeypatch.setattr(mixing, "SENT_SOURCES", 2)
    assert key(mixing.mix(df)) == few


def test_mixing_meets_its_limits(spark, odd, none, clash):
    assert mixing.mix(none).count() == 0
    rows = [(i, "w " * (1 + i % 9), "big" if i % 10 else f"small{i % 30}") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(df, max_repetition=3.0, block_documents=20).collect()
    assert len(out) == 900 and min(r["copies"] for r in out) >= 1 and max(r["copies"] for r in out) <= 3
    taken = Counter()
    for r in out:
        taken[r["source"]] += r["copies"] * r["tokens"]
    weights = {r["source"]: r["weight"] for r in out}
    assert abs(sum(weights.values()) - 1) < 1e-9
    for s, w in weights.items():
        assert abs(taken[s] / sum(taken.values()) - w) < 0.02
    even = mixing.mix(df, target_entropy=1.2, budget=5000).collect()
    ws = {r["source"]: r["weight"] for r in even}
    assert abs(-sum(w * np.log(w) for w in ws.values()) - 1.2) < 1e-6
    assert abs(sum(r["copies"] * r["tokens"] for r in even) - 5000) < 60
    for odd_df in (odd, clash):
        got = mixing.mix(odd_df).collect()
        assert len(got) == odd.count() and all(r["copies"] >= 1 for r in got)
    assert mixing.repeated(mixing.mix(df, max_repetition=3.0)).count() == sum(r["copies"] for r in mixing.mix(df, max_repetition=3.0).collect())
