"""HTML extraction by nearest-URL page differencing.

A page becomes lines of text, one for each block that a reader sees. Each page is then compared
with the two nearest pages of other text in the order of URL paths within its host; lines are
aligned by longest common subsequence, and what they share outside an article is the site's,
not the page's, and goes. What is left goes if the page's own markup says it is no content."""

from __future__ import annotations

import html
import json
import re
from bisect import bisect_left
from collections import Counter, deque
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from .common import bucket_of, shuffle_partitions, sort_bounds

#: Elements whose text is never content.
SKIPPED = frozenset("nav footer aside form menu dialog button select option textarea input label template noscript iframe object svg canvas audio video map".split())
#: Of these, those whose text is no line of a page.
UNSEEN = frozenset("select option textarea input template noscript iframe object svg canvas audio video map".split())
#: Elements that hold text which is no markup.
RAW = frozenset("script style title noscript template textarea iframe xmp noembed noframes".split())
#: Elements without an end.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that stand within a line.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark meter output progress q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Words in class, id or role that mark what is no content.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo sidebar nav navbar navigation menu breadcrumb breadcrumbs footer masthead header comment comments reply replies respond disqus "
    "cookie cookies consent gdpr notice notices alert popup modal newsletter subscribe signup login share sharing social related recommended pagination pager toolbar widget complementary contentinfo search".split()
)
#: First words of names that don't mark their element, as in has-sidebar or entry-header.
UNMARKED = frozenset("has with no without article entry post content main".split())
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|([^<]+|<)", re.S)
#: Share of a page's text from which one other page that has it may be a copy, and from which
#: two others that have it are copies too.
COPY, COPIES = 0.5, 0.9
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


def blocks(source: str | None) -> list[tuple[int, str]]:
    """(content, line) for each block of a page in order; content is 1 within an article, 2 in
    a main element outside one, 3 in what its own markup says is no content, and 0 elsewhere.
    Blocks without text, and what no reader sees (scripts, styles, fields), are left out."""
    source = source or ""
    out: list[tuple[int, str]] = []
    text: list[str] = []
    skip: list[str] = []  # open elements of the skipped one's name
    within, head, at = {"article": 0, "main": 0}, False, 0

    def end() -> None:
        line = " ".join(html.unescape("".join(text)).split())
        text.clear()
        if line:
            out.append((3 if skip else 1 if within["article"] else 2 if within["main"] else 0, line))

    while m := TOKEN.match(source, at):
        at = m.end()
        closing, tag, attributes, words = m.groups()
        if words is not None:
            if not head and not (skip and skip[0] in UNSEEN):
                text.append(words)
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if skip == ["p"] and tag not in INLINE and not (closing and tag == "p"):
            end()
            skip.pop()  # a paragraph ends where the next block begins
        if skip:
            if tag not in INLINE or tag == skip[-1]:
                end()
            elif tag == "br":
                text.append(" ")
            if tag == skip[-1]:
                if closing:
                    skip.pop()
                elif tag not in VOID and not attributes.endswith("/"):
                    skip.append(tag)
            elif tag in RAW and not closing:
                at = _raw_end(source, at, tag)
            continue
        if tag not in INLINE:
            end()
        elif tag == "br":
            text.append(" ")
        if tag == "head":
            head = not closing
        elif tag == "body":
            head = False
        elif tag in within:
            within[tag] = max(0, within[tag] + (-1 if closing else 1))
        if closing:
            continue
        if tag in RAW:
            at = _raw_end(source, at, tag)
        elif tag not in VOID and tag not in ("html", "body", "main") and (tag in SKIPPED or tag == "header" and not any(within.values()) or attributes and _marked(attributes)):
            end()
            skip.append(tag)
            within["article"] -= tag == "article"
    end()
    return out


def _marked(attributes: str) -> bool:
    for _, a, b, c in ATTRIBUTE.findall(attributes):
        for name in (a or b or c).lower().split():
            words = re.split("[-_]", name)
            if words[0] in MARKS or words[-1] in MARKS and words[0] not in UNMARKED:
                return True
    return False


def _raw_end(source: str, at: int, tag: str) -> int:
    m = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
    return m.end() if m else len(source)


def shared_lines(a: list[str], b: list[str]) -> set[int]:
    """The places in a of a longest common subsequence of a and b.

    The pairs of equal lines are gone through in order, and `ends` has the smallest end in b of a
    common subsequence of each length."""
    places: dict[str, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        places.setdefault(b[j], []).append(j)
    ends: list[int] = []
    found: list[tuple] = []
    for i, x in enumerate(a):
        for j in places.get(x, ()):
            k = bisect_left(ends, j)
            node = (i, found[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                found.append(node)
            else:
                ends[k], found[k] = j, node
    out, node = set(), found[-1] if found else None
    while node:
        out.add(node[0])
        node = node[1]
    return out


def main_text(own: list[tuple[int, str]], near: list[list[tuple[int, str]]]) -> str:
    """The lines of a page that are its content, given up to two near pages with other texts.

    All lines outside articles, menus and notices included, are aligned with those of the near pages. A line
    goes where both have it, or one of them, unless the line is in main or that page has COPY of the
    page's text and may be a copy. Where this would leave less than the rest of COPIES of what is not
    marked as no content, all that stays. An article's lines stay even where the other pages have
    them: copies and quoted passages are content. What differencing leaves goes if its markup
    says that it is no content. Where there is no page to compare with, the markup alone
    decides: lines outside article and main go if those hold half of the text."""
    plain = [(i, c, x) for i, (c, x) in enumerate(own) if c != 3]
    everything = sum(len(x) for _, _, x in plain)
    if not near:
        marked = sum(len(x) for _, c, x in plain if c)
        alone = 2 * marked >= everything > 0
        return "\n".join(x for _, c, x in plain if c or not alone)
    gone = repeated(own, near)
    if sum(len(own[i][1]) for i in gone if own[i][0] != 3) > COPIES * everything:
        gone = set()
    return "\n".join(x for i, _, x in plain if i not in gone)


def repeated(own: list[tuple[int, str]], near: list[list[tuple[int, str]]]) -> set[int]:
    """The places of the lines of a page outside articles that the near pages show to be the site's."""
    loose = [i for i, (c, _) in enumerate(own) if c != 1]
    everything = sum(len(x) for c, x in own if c != 3)
    votes: Counter[int] = Counter()
    for page in near if loose else ():
        held = {loose[i] for i in shared_lines([own[i][1] for i in loose], [x for c, x in page if c != 1])}
        copy = sum(len(own[i][1]) for i in held if own[i][0] != 3) >= COPY * everything > 0
        votes.update({i: 1 if copy or own[i][0] == 2 else 2 for i in held})
    return {i for i, n in votes.items() if n >= 2}


def _key(url: Column) -> Column:
    """host, a zero character, path: pages of a host stand together, near paths side by side."""
    clean = F.coalesce(url, F.lit(""))
    host = F.lower(F.regexp_extract(clean, r"^(?s:.*?)://([^/?#]*)", 1))
    return F.concat(host, F.lit("\x00"), F.regexp_extract(clean, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1))


@F.pandas_udf(BinaryType())
def _parsed(pages: pd.Series) -> pd.Series:
    pack = zstandard.ZstdCompressor(level=1)
    return pages.map(lambda x: pack.compress(json.dumps(blocks(x)).encode()))


def _host(key: str) -> str:
    return key.partition("\x00")[0]


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each part, of its first host the first three different texts and of its last host
    the last three, as one row each: (part, tail, whole, key, h, digest). whole: the part
    has one host only."""
    part, heads, tails, hosts = None, {}, {}, 0

    def found() -> pa.RecordBatch:
        rows = [(part, tail, hosts == 1, *place, d) for tail, texts in ((False, heads), (True, tails)) for d, place in texts.items()]
        names = ["part", "tail", "whole", "key", "h", "digest"]
        return pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), pa.bool_(), pa.bool_(), pa.string(), pa.int64(), pa.int64()), strict=True)], names=names)

    host = None
    for b in batches:
        for p, key, h, digest in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if p != part:
                if part is not None:
                    yield found()
                part, host, heads, tails, hosts = p, None, {}, {}, 0
            if _host(key) != host:
                host, tails, hosts = _host(key), {}, hosts + 1
            if hosts == 1 and len(heads) < 3:
                heads.setdefault(digest, (key, h))
            tails.pop(digest, None)
            tails[digest] = (key, h)
            if len(tails) > 3:
                tails.pop(next(iter(tails)))
    if part is not None:
        yield found()


def _borrowed(edges: list) -> list[tuple]:
    """(part, key, h, to): the rows that other parts have to see, so that each part starts
    after the last three texts of its first host and ends before the next three of its last."""
    heads: dict[int, list] = {}
    tails: dict[int, list] = {}
    whole = {}
    for r in edges:
        (tails if r["tail"] else heads).setdefault(r["part"], []).append((r["digest"], r["part"], r["key"], r["h"]))
        whole[r["part"]] = r["whole"]
    to: dict[tuple, list[int]] = {}
    for order, near, far in ((sorted(whole), tails, heads), (sorted(whole, reverse=True), heads, tails)):
        state: list = []  # the texts next to the part, the farthest first
        for p in order:
            own = near[p] if near is tails else near[p][::-1]
            if state and _host(state[-1][2]) != _host(far[p][0][2]):
                state = []
            for _, *row in state:
                to.setdefault(tuple(row), []).append(p)
            known = {x[0] for x in own}
            state = ([x for x in state if x[0] not in known] if whole[p] else []) + own
            state = state[-3:]
    return [(*row, parts) for row, parts in to.items()]


def _dealt(pages: DataFrame) -> DataFrame:
    """(part, own, key, data, kept) in ranges of keys of about equal size, each sorted by key,
    with the pages of other parts around them that theirs are compared with."""
    spark = pages.sparkSession
    parts = shuffle_partitions(spark)
    # Pages of one key are told apart by a hash, so that their order is fixed; so they spread, too.
    keyed = pages.withColumn("h", F.xxhash64(*pages.columns))
    keyed = keyed.withColumn("rank", F.struct("key", "h"))
    bounds = sort_bounds(keyed, "rank", 4 * parts)
    keyed = keyed.withColumn("part", bucket_of(F.col("rank"), bounds, keyed.schema["rank"].dataType.simpleString()))
    light = keyed.select("part", "key", "h", F.xxhash64(_parsed("source")).alias("digest")).repartition(parts, "part").sortWithinPartitions("part", "key", "h")
    edges = light.mapInArrow(_edges, "part int, tail boolean, whole boolean, key string, h bigint, digest bigint").collect()  # six rows for each part
    extra = spark.createDataFrame(_borrowed(edges), "part int, key string, h bigint, to array<int>")
    tagged = keyed.select("part", "key", "h", _parsed("source").alias("data"), "kept").join(F.broadcast(extra), ["part", "key", "h"], "left")
    others = F.transform(F.coalesce("to", F.array().cast("array<int>")), lambda p: F.struct(p.alias("part"), F.lit(False).alias("own")))
    places = F.concat(F.array(F.struct(F.col("part").alias("part"), F.lit(True).alias("own"))), others)
    out = tagged.select(F.explode(places).alias("place"), "key", "h", "data", "kept").select("place.part", "place.own", "key", "h", "data", "kept")
    return out.repartition(parts, "part").sortWithinPartitions("part", "key", "h")


class _Run:
    """Pages with equal texts, one after the other."""

    def __init__(self, place: tuple, data: bytes) -> None:
        self.place, self.data = place, data
        self.lines: list[tuple[int, str]] = [(c, x) for c, x in json.loads(zstandard.ZstdDecompressor().decompress(data))]
        self.rows: list[pa.RecordBatch] = []


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[_Run]:
    run = None
    for b in batches:
        kept = pa.record_batch(b.columns[4:], names=b.schema.names[4:])
        mine = b.column(1)
        start = 0
        places = [(p, _host(k)) for p, k in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True)]
        data = b.column(3).to_pylist()
        for i in range(b.num_rows):
            if run is None or run.place != places[i] or run.data != data[i]:
                if run is not None:
                    if i > start:
                        run.rows.append(kept.slice(start, i - start).filter(mine.slice(start, i - start)))
                    yield run
                run, start = _Run(places[i], data[i]), i
        if run is not None and b.num_rows > start:
            run.rows.append(kept.slice(start).filter(mine.slice(start)))
    if run is not None:
        yield run


def _compared(runs: Iterator[_Run]) -> Iterator[tuple[_Run, list[list[tuple[int, str]]]]]:
    """Each run with its near pages: the texts before and after it, and where one of these is
    missing or both are equal, the next farther one."""
    before: dict[bytes, _Run] = {}  # the last three texts of the host, the nearest last
    ahead: deque[_Run] = deque()

    def first() -> tuple[_Run, list]:
        run = ahead.popleft()
        back = [x for x in reversed(before.values()) if x.data != run.data]
        forth = [x for x in ahead if x.data != run.data]
        near = {x.data: x.lines for x in [*back[:1], *forth[:1], *back[1:], *forth[1:]]}
        before.pop(run.data, None)
        before[run.data] = run
        if len(before) > 3:
            before.pop(next(iter(before)))
        return run, list(near.values())[:2]

    for run in runs:
        if ahead and ahead[0].place != run.place:
            while ahead:
                yield first()
            before.clear()
        ahead.append(run)
        if len(ahead) > 3:
            yield first()
    while ahead:
        yield first()


def extract_text(df: DataFrame, html_column: str = "html", url: str = "url", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The kept columns of each page with text, its main text, and n_chars, its code points.

    White space within a block is one space, character references are decoded, and blocks are
    joined by a line end. A null or empty page has an empty text; repeated rows are kept and have one text; pages of any length
    are read whole, those of a task one after the other; an empty table gives no rows; columns that are not kept play no part; a page without a URL is
    compared with others without one; a host's only text is compared with none. Pages are
    dealt by ranges of (host, path) and a hash, so a large host, and the pages of one URL, spread over many tasks. Pages of equal
    text are never compared with each other; a host's first and last pages are compared
    with the two next to them. Pages with one path are told apart by a hash of their columns."""

    names, kinds = list(keep), [df.schema[c] for c in keep]

    def differenced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[pa.RecordBatch] = []
        texts: list[str] = []

        def ready() -> pa.RecordBatch:
            kept = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
            out = pa.record_batch([*kept.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*names, "text", "n_chars"])
            rows.clear()
            texts.clear()
            return out

        held = 0
        for run, near in _compared(_runs(batches)):
            text = main_text(run.lines, near) if any(b.num_rows for b in run.rows) else ""
            for b in run.rows:
                for at in range(0, b.num_rows, 500):
                    piece = b.slice(at, 500)
                    rows.append(piece)
                    texts += [text] * piece.num_rows
                    held += piece.num_rows * len(text)
                    if len(texts) >= 2000 or held > 1 << 24:
                        yield ready()
                        held = 0
            run.rows.clear()
        if texts:
            yield ready()

    pages = df.select(F.struct(*[F.col(c) for c in keep]).alias("kept"), F.col(html_column).alias("source"), _key(F.col(url)).alias("key"))
    dealt = _dealt(pages).select("part", "own", "key", "data", *[F.col(f"kept.`{c}`") for c in keep])
    return dealt.mapInArrow(differenced, StructType([*kinds, StructField("text", StringType()), StructField("n_chars", LongType())]))


def op4_html_extraction(spark, sf_dir: str) -> DataFrame:
    """Every page's page_id, url, text, n_chars."""
    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


#: For the pages of the driver's tables, whose articles hold h1, p, b and br only.
OP4_SQL = r"""
SELECT page_id, url, coalesce(text, '') AS text, CAST(length(coalesce(text, '')) AS BIGINT) AS n_chars FROM (
  SELECT page_id, url, array_to_string(list_filter(list_transform(
           string_split_regex(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '</?(?:h1|p)>'),
           lambda x: trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(replace(x, '<br>', ' '), '</?b>', '', 'g'),
             '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)), '&#39;', chr(39)), '&amp;', '&'), '\s+', ' ', 'g'))
         ), lambda x: x <> ''), chr(10)) AS text
  FROM pages) z
"""
