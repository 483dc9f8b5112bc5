"""Line dedup by pairwise alignment.

Documents are found through the hashes of their lines, short lines being hashed along with the ones
next to them until they hold enough words to count. Of each hash the first document is the
owner, and each later document with another text is aligned with every owner of its hashes by
patience diff, with an exact match of runs for what has no anchors; the common blocks go from
the later document. Any block that an earlier document has is found so, however many have
it. Copies of one text cost no alignment: they go whole."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FREQUENT, checkpointed, looked_up, tidied, unused

#: Words that a common block has at least.
LEAST_WORDS = 5


def _anchors(a: Sequence, b: Sequence, a0: int, a1: int, b0: int, b1: int) -> list[tuple[int, int]]:
    """Lines that stand once in both ranges, as the longest increasing sequence of pairs."""
    once_a = {x: n for x, n in Counter(a[a0:a1]).items() if n == 1}
    once_b = {x: n for x, n in Counter(b[b0:b1]).items() if n == 1}
    at = {a[i]: i for i in range(a0, a1) if a[i] in once_a}
    pairs = [(at[b[j]], j) for j in range(b0, b1) if b[j] in once_b and b[j] in at]
    ends: list[int] = []
    last: list[int] = []
    before: list[int] = []
    for n, (i, _) in enumerate(pairs):
        k = bisect_left(ends, i)
        before.append(last[k - 1] if k else -1)
        if k == len(ends):
            ends.append(i)
            last.append(n)
        else:
            ends[k], last[k] = i, n
    out = []
    n = last[-1] if last else -1
    while n >= 0:
        out.append(pairs[n])
        n = before[n]
    return out[::-1]


def _increasing(a: Sequence, b: Sequence) -> list[tuple[int, int]]:
    """Pairs (i, j) of equal lines a[i] == b[j], both increasing, by patience diff alone."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        i, j = a0, b0
        anchors = _anchors(a, b, a0, a1, b0, b1)
        for x, y in [*anchors, (a1, b1)] if anchors else []:
            todo.append((i, x, j, y))
            if x < a1 and y < b1:
                out.append((x, y))
            i, j = x + 1, y + 1
    return sorted(out)


def _longest(a: Sequence, b: Sequence) -> list[tuple[int, int]]:
    """For each i the size of the longest run of lines that ends at a[i] and stands in b, and
    where in b it ends, by an automaton of the runs of b: time goes by the sizes of both."""
    then: list[dict] = [{}]
    link, size, end, last = [-1], [0], [-1], 0
    for j, x in enumerate(b):
        new, p = len(then), last
        then.append({})
        link.append(0)
        size.append(size[last] + 1)
        end.append(j)
        while p >= 0 and x not in then[p]:
            then[p][x] = new
            p = link[p]
        if p >= 0:
            q = then[p][x]
            if size[q] > size[p] + 1:
                copy = len(then)
                then.append(dict(then[q]))
                link.append(link[q])
                size.append(size[p] + 1)
                end.append(end[q])
                while p >= 0 and then[p].get(x) == q:
                    then[p][x] = copy
                    p = link[p]
                link[q] = q = copy
            link[new] = q
        last = new
    out, at, n = [], 0, 0
    for x in a:
        while at and x not in then[at]:
            at = link[at]
            n = size[at]
        if x in then[at]:
            at, n = then[at][x], n + 1
        out.append((n, end[at]))
    return out


def patience(a: Sequence, b: Sequence) -> list[tuple[int, int]]:
    """Pairs (i, j) of equal lines a[i] == b[j] by patience diff, both increasing, and then
    those of each longest common run that the diff has not found whole, as lines without
    anchors are in: a run of b may be taken more than once."""
    out = _increasing(a, b)
    have, found = set(out), _longest(a, b)
    for i, (n, j) in enumerate(found):
        if n and (i + 1 == len(a) or found[i + 1][0] != n + 1):
            run = [(i - k, j - k) for k in range(n - 1, -1, -1)]
            out += [] if have.issuperset(run) else run
    return out


def common_blocks(pairs: list[tuple[int, int]], words: Sequence[int], least: int) -> list[int]:
    """The lines i of runs of pairs, next to each other on both sides, with `least` words."""
    out: list[int] = []
    run: list[int] = []
    for n, (i, j) in enumerate(pairs):
        if n and pairs[n - 1] != (i - 1, j - 1):
            out += run if sum(words[k] for k in run) >= least else []
            run = []
        run.append(i)
    return out + (run if sum(words[k] for k in run) >= least else [])


def repeated_in(a: Sequence, b: Sequence, words: Sequence[int], least: int) -> list[int]:
    """The lines of common_blocks(patience(a, b), words, least), without listing the pairs:
    the diff's blocks, and for what it leaves the longest common runs."""
    gone = set(common_blocks(_increasing(a, b), words, least))
    there = set(b)
    if any(i not in gone and x in there for i, x in enumerate(a)):
        upto = [0, *accumulate(words)]
        last = len(a)
        for i, (n, _) in reversed([*enumerate(_longest(a, b))]):
            if n and upto[i + 1] - upto[i + 1 - n] >= least:
                gone.update(range(i + 1 - n, min(i + 1, last)))
                last = min(last, i + 1 - n)
    return sorted(gone)


def repeated_runs(a: Sequence, b: Sequence, words: Sequence[int], least: int) -> list[int]:
    """repeated_in() by what the two share only: a gap in between stands for all other lines."""
    both = set(a) & set(b)

    def shared(x: Sequence, gap: int) -> tuple[list, list[int]]:
        out: list = []
        at: list[int] = []
        for i, line in enumerate(x):
            if line in both:
                if at and at[-1] != i - 1:
                    out.append(gap)
                    at.append(-1)
                out.append(line)
                at.append(i)
        return out, at

    (own, at), (other, _) = shared(a, 0), shared(b, 1)
    return [at[i] for i in repeated_in(own, other, [words[i] if i >= 0 else 0 for i in at], least)]


def windows(lines: Sequence[bytes], words: Sequence[int], least: int) -> set[bytes]:
    """Hashes of the shortest runs of lines with `least` words that begin, or end, at each line.

    A line with so many words is a run of its own. Every line of a block that two documents
    share stands in a run that they share: in the one that begins the block or, behind that,
    in one that ends at the line."""
    upto = [0, *accumulate(words)]
    out = set()
    for i, line in enumerate(lines):
        if words[i] >= least:
            out.add(line)
            continue
        end = bisect_left(upto, upto[i] + least)
        if end < len(upto):
            out.add(xxhash.xxh3_128_digest(b"".join(lines[i:end])))
        start = bisect_right(upto, upto[i + 1] - least) - 1
        if start >= 0:
            out.add(xxhash.xxh3_128_digest(b"".join(lines[start : i + 1])))
    return out


def _cut(data: bytes) -> list[bytes]:
    return [data[i : i + 16] for i in range(0, len(data), 16)]


def _counts(data: bytes) -> list[int]:
    return np.frombuffer(data, "<u4").tolist()


def repeated_lines(df: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """(k, gone): for the first document of each text the numbers, from 0, of its lines with
    words that are to be deleted.

    k is (key, hash of the text); rows with one key and one text are one document. Documents
    are ordered by k, null keys first. A document that is not here is a copy of one that is."""
    kind = f"struct<d:{df.schema[key].dataType.simpleString()},h:bigint>"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                b = batch.slice(at, 500)
                whole, hashes, words, places = [], [], [], []
                for t in b.column(1).to_pylist():
                    data = (t or "").encode("utf-8", "surrogatepass")
                    lines = data.split(b"\n")
                    n = [len(x.split()) for x in lines]
                    held = [i for i, x in enumerate(n) if x]
                    whole.append(xxhash.xxh3_128_digest(data))
                    hashes.append(b"".join([xxhash.xxh3_128_digest(lines[i]) for i in held]))
                    words.append(np.array([n[i] for i in held], "<u4").tobytes())
                    places.append(np.array(held, "<u4").tobytes())
                yield pa.record_batch([b.column(0), *(pa.array(x, pa.binary()) for x in (whole, hashes, words, places))], names=["k", "t", "hashes", "words", "places"])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                b = batch.slice(at, 500)
                found = [sorted(windows(_cut(x), _counts(y), least_words)) for x, y in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
                rows = np.repeat(np.arange(b.num_rows), [len(x) for x in found])
                yield pa.record_batch([b.column(0).take(pa.array(rows)), pa.array([x for f in found for x in f], pa.binary())], names=["k", "hash"])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                b = batch.slice(at, 500)
                gone = []
                for x, w, y, p in zip(*[b.column(i).to_pylist() for i in range(1, 5)], strict=True):
                    places = _counts(p)
                    gone.append([places[i] for i in repeated_runs(_cut(x), _cut(y), _counts(w), least_words)])
                yield pa.record_batch([b.column(0), pa.array(gone, pa.list_(pa.int32()))], names=["k", "gone"])

    base = df.select(F.struct(F.col(key).alias("d"), F.xxhash64(text).alias("h")).alias("k"), F.col(text).alias("text"))
    # A null text and an empty one differ in h.
    sides = base.mapInArrow(tidied(read), f"k {kind}, t binary, hashes binary, words binary, places binary")
    sides = sides.groupBy("t", F.col("k.h").alias("h")).agg(F.min("k").alias("k"), *[F.first(c).alias(c) for c in ("hashes", "words", "places")])
    sides = checkpointed(sides.select("k", "hashes", "words", "places"))

    # Each run's documents, and the first of them; a run that no other document has is done with.
    found = checkpointed(sides.select("k", "hashes", "words").mapInArrow(tidied(runs), f"k {kind}, hash binary"))
    shared = found.groupBy("hash").agg(F.min("k").alias("ok"), F.max("k").alias("last"), F.count(F.lit(1)).alias("n"))
    shared = checkpointed(shared.where(F.col("ok") != F.col("last")).select("hash", "ok", "n"))
    pairs = looked_up(found, shared, "hash", "n").where("k <> ok").select("k", "ok").distinct()
    pairs = checkpointed(pairs, frees=(found, shared))

    # The pairs of an owner that has very many are dealt over several tasks.
    most = pairs.count() // FREQUENT + 1
    hot = F.broadcast(pairs.groupBy("ok").count().where(F.col("count") > most).select("ok", F.ceil(F.col("count") / most).cast("int").alias("shares")))  # fewer than FREQUENT rows
    shares = F.coalesce(F.col("shares"), F.lit(1))
    both = pairs.join(hot, "ok", "left").select("k", "ok", F.pmod(F.xxhash64("k"), shares).cast("int").alias("share"))
    owners = sides.select(F.col("k").alias("ok"), F.col("hashes").alias("other")).join(hot, "ok", "left")
    owners = owners.select("ok", "other", F.explode(F.sequence(F.lit(0), shares - 1)).alias("share"))
    both = both.join(sides, "k").hint("merge").join(owners, ["ok", "share"])
    aligned = both.select("k", "hashes", "words", "other", "places").mapInArrow(tidied(align), f"k {kind}, gone array<int>")
    every = aligned.where(F.size("gone") > 0).unionByName(sides.select("k", F.array().cast("array<int>").alias("gone")))
    every = every.groupBy("k").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone"))
    return checkpointed(every, frees=(sides, pairs))


def without(text: str, gone: Sequence[int] | None) -> tuple[str, int]:
    """text without its lines `gone`, and without blank lines that stand between such lines
    only, and how many lines that are; all go where gone is null."""
    if gone is None:
        return "", text.count("\n") + 1
    lines = text.split("\n")
    out, blank, deleted = [], [], set(gone)
    before = True  # whether the line with words before has gone; so it is at the text's start
    for i, x in enumerate(lines):
        if i in deleted:
            out += [] if before else blank
            before, blank = True, []
        elif x.encode("utf-8", "surrogatepass").split():
            out += blank
            out.append(x)
            before, blank = False, []
        else:
            blank.append(x)
    out += [] if before and deleted else blank
    return "\n".join(out), len(lines) - len(out)


def drop_repeated_lines(df: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS, lines: str = "n_lines", removed: str = "n_removed") -> DataFrame:
    """df with the text without the lines that earlier documents have, and in columns named by
    `lines` and `removed` how many lines it had and lost (columns of these names are replaced).

    Deleted is every block of lines with words, at least least_words of them together, that an earlier
    document has, line after line (smaller key; null keys come first; of equal keys the
    text's hash decides), and blank lines between such lines. Lines are compared byte by byte, by 128-bit
    hashes; blank lines are passed over. The first document of a block keeps it, so no content is
    lost. A document whose whole text stands in an earlier one is left with an empty text. Null
    texts stay null; what only repeats within its own document, and texts of fewer words, stay; rows
    with one key and text are one document, and every row is kept. An empty table gives no rows."""
    df = df.drop(lines, removed)
    at, hash_, gone_ = unused(df, 3)
    gone = repeated_lines(df, key, text, least_words).select(F.col("k.d").alias(at), F.col("k.h").alias(hash_), F.col("gone").alias(gone_))
    keyed = df.withColumns({at: F.col(key), hash_: F.xxhash64(text)})
    on = keyed[at].eqNullSafe(gone[at]) & (keyed[hash_] == gone[hash_])
    out = keyed.join(gone, on, "left").drop(gone[at]).drop(gone[hash_]).drop(at, hash_)

    @F.pandas_udf("text string, removed int")
    def kept(texts: pd.Series, gone: pd.Series) -> pd.DataFrame:
        got = [(None, 0) if t is None else without(t, g) for t, g in zip(texts, gone, strict=True)]
        return pd.DataFrame(got, columns=["text", "removed"], index=texts.index)

    # A copy of an earlier text goes whole, as one block; an untouched text doesn't move.
    copy = F.col(gone_).isNull() & (F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")) >= least_words)
    touched = F.coalesce(copy | (F.size(gone_) > 0), F.lit(False))
    out = out.withColumn(gone_, F.struct(touched.alias("touched"), kept(F.when(touched, F.col(text)), F.col(gone_)).alias("kept")))
    hit = F.col(f"`{gone_}`.touched")
    return out.withColumns(
        {
            lines: F.when(F.col(text).isNull(), 0).otherwise(F.regexp_count(text, F.lit("\n")) + 1),
            removed: F.when(hit, F.col(f"`{gone_}`.kept.removed")).otherwise(0),
            text: F.when(hit, F.col(f"`{gone_}`.kept.text")).otherwise(F.col(text)),
        }
    ).drop(gone_)


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document's doc_id, n_lines, n_removed and the text that stays."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return drop_repeated_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


#: Runs of one to five lines with words, which hold all shortest runs of five words; a run goes where an earlier
#: document has it. For tables whose keys are unique.
OP1_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents WHERE text IS NOT NULL
), w AS (
  SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM l
), h AS (
  SELECT *, row_number() OVER d AS i, lead(line, 1) OVER d AS l1, lead(line, 2) OVER d AS l2, lead(line, 3) OVER d AS l3, lead(line, 4) OVER d AS l4,
         n + lead(n, 1) OVER d AS n1, n + lead(n, 1) OVER d + lead(n, 2) OVER d AS n2, n + lead(n, 1) OVER d + lead(n, 2) OVER d + lead(n, 3) OVER d AS n3,
         n + lead(n, 1) OVER d + lead(n, 2) OVER d + lead(n, 3) OVER d + lead(n, 4) OVER d AS n4
  FROM w WHERE n > 0 WINDOW d AS (PARTITION BY doc_id ORDER BY pos)
), r AS (
  SELECT doc_id, i, 0 AS more, [line] AS run FROM h WHERE n >= 5 UNION ALL SELECT doc_id, i, 1, [line, l1] FROM h WHERE n1 >= 5 UNION ALL SELECT doc_id, i, 2, [line, l1, l2] FROM h WHERE n2 >= 5
  UNION ALL SELECT doc_id, i, 3, [line, l1, l2, l3] FROM h WHERE n3 >= 5 UNION ALL SELECT doc_id, i, 4, [line, l1, l2, l3, l4] FROM h WHERE n4 >= 5
), o AS (
  SELECT run, min(doc_id) AS least FROM r GROUP BY run
), g AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + more + 1)) AS i FROM r JOIN o USING (run) WHERE least < doc_id
), c AS (
  SELECT doc_id, min(doc_id) OVER (PARTITION BY text) < doc_id AND len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) >= 5 AS copy FROM documents WHERE text IS NOT NULL
), f AS (
  SELECT w.doc_id, w.pos, w.line, w.n, CASE WHEN w.n > 0 THEN g.i IS NOT NULL END AS gone, count(g.i) OVER (PARTITION BY w.doc_id) > 0 AS hit
  FROM w LEFT JOIN h ON w.doc_id = h.doc_id AND w.pos = h.pos LEFT JOIN g ON h.doc_id = g.doc_id AND h.i = g.i
), b AS (
  SELECT *, coalesce(gone, hit AND coalesce(last_value(gone IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING), true)
         AND coalesce(first_value(gone IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), true)) AS bye FROM f
), k AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE bye) AS n_removed, string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT bye) AS kept FROM b GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(k.n_lines, 0) AS INTEGER) AS n_lines, CAST(CASE WHEN c.copy THEN k.n_lines ELSE coalesce(k.n_removed, 0) END AS INTEGER) AS n_removed,
       CASE WHEN c.copy THEN '' WHEN d.text IS NULL THEN NULL ELSE coalesce(k.kept, '') END AS text
FROM documents d LEFT JOIN k USING (doc_id) LEFT JOIN c USING (doc_id)
"""
