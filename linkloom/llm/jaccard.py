"""N-gram Jaccard join by PartEnum signatures.

Sets of word n-grams fall into bands of sizes. For each band the feature domain is dealt
into more parts than two sets that are similar enough can differ in, so the two agree in
whole parts, and the hash of what a set holds of a part is a signature. What shares signatures is
a candidate group. Large ones are taken apart by sketches, which rule out most of what links to
nothing; then texts are compared exactly, each moved once to the others of its group."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, dropped, looked_up, shuffle_partitions, tidied
from .graph import components

_MUL = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word n-grams; of fewer words, of all as one.
    A-Z are lower-cased; words are what stands between ASCII white space."""
    own = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not own:
        return np.empty(0, np.uint64)
    h = np.array([xxhash.xxh64_intdigest(w) for w in own], np.uint64)
    n = min(len(h), words)
    # A polynomial in the word hashes, each step mixed; n keeps short sequences apart.
    out = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        out = _mixed(out * _MUL[0] + h[i : len(h) - n + 1 + i])
    return np.unique(out)


def set_id(own: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(own.tobytes())


@lru_cache(None)
def band(i: int, num: int, den: int) -> tuple[int, int, int, int, int, int, int]:
    """(low, high, reach, groups, needed, parts, within) of band i.

    low to high are its sizes and reach the largest size that can link to one of them. Two such
    sets differ in `differ` elements at most. The domain falls into groups of parts; in at least
    `needed` groups the sets differ in `within` elements at most, so in parts - within parts of
    each of those they agree."""
    low = 1 if i == 0 else band(i - 1, num, den)[1] + 1
    high = low * den // num
    reach = high * den // num
    differ = max(s - 2 * -(-num * s // (num + den)) for s in range(max(2, high + reach - 8), high + reach + 1))
    # Small sets have few signatures, so theirs can span more of the set.
    if differ <= 3:
        within, parts, needed = differ, 2 * differ + 1, 1
    elif low < 150:
        within, parts, needed = 2, 5, 2
    else:
        # One part a group; more groups than differences, by the empty ones to be expected.
        empty = (differ + 8) * math.exp(-low / (differ + 8))
        within, parts, needed = 0, 1, math.ceil(empty + 4 * math.sqrt(empty) + 2)
    return low, high, reach, differ // (within + 1) + needed, needed, parts, within


@lru_cache(None)
def band_of(n: int, num: int, den: int) -> int:
    i = 0
    while band(i, num, den)[1] < n:
        i += 1
    return i


@lru_cache(None)
def _subsets(parts: int, within: int) -> np.ndarray:
    """The subsets of parts - within parts, a row of 0 and 1 for each."""
    rows = [[int(p in c) for p in range(parts)] for c in combinations(range(parts), parts - within)]
    return np.array(rows, np.uint64)


def signatures(own: np.ndarray, num: int, den: int) -> np.ndarray:
    """The signatures of a set, as 64-bit integers.

    A set takes part in its own band, and in the one below where it can link to a set of
    that. For each group, each subset of as many parts as have to agree is a signature. One
    of parts that the set has nothing of is left out, unless the groups with such a subset
    are so many that all agreeing ones could be: then these have signatures too."""
    n = len(own)
    if not n:
        return own
    i = band_of(n, num, den)
    out = []
    for b in (i, i - 1):
        if b < 0 or n > band(b, num, den)[2]:
            continue
        _, _, _, groups, needed, parts, within = band(b, num, den)
        cells = groups * parts
        at = (((own >> np.uint64(32)) * np.uint64(cells)) >> np.uint64(32)).astype(np.int64)  # own is sorted, so at is
        first = np.flatnonzero(np.diff(at, prepend=at[0] + 1))
        held = np.zeros(cells, np.uint64)
        held[at[first]] = _mixed(np.add.reduceat(own * _MUL[1], first)) | np.uint64(1)
        held = held.reshape(groups, parts)
        choices = _subsets(parts, within)
        # What stands in a subset's parts, each part by a factor of its own.
        factor = _mixed(np.arange(1, parts + 1, dtype=np.uint64)) | np.uint64(1)
        value = (held * factor) @ choices.T
        full = ((held != 0).astype(np.uint64) @ choices.T) > 0
        if (~full).any(1).sum() >= needed:
            full[:] = True
        tag = np.uint64((b * 0x1F123BB5 + 1) * int(_MUL[2]) % (1 << 64))
        place = np.arange(value.size, dtype=np.uint64).reshape(value.shape)
        out.append(_mixed(_mixed(value) + place * _MUL[3] + tag)[full])
    return np.concatenate(out)


def _linked(sets: list[np.ndarray], num: int, den: int) -> list[int]:
    """For each of the sets, the first one that links reach from it: all pairs are compared."""
    root = list(range(len(sets)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    sizes = np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    known, ids = np.unique(np.concatenate(sets), return_inverse=True)
    flag = np.zeros(len(known), np.int32)
    for i in range(len(sets) - 1):
        end = starts[i + 1]
        flag[ids[starts[i] : end]] = 1
        both = np.add.reduceat(flag[ids[end:]], starts[i + 1 :] - end)
        flag[ids[starts[i] : end]] = 0
        for j in np.flatnonzero(den * both >= num * (sizes[i] + sizes[i + 1 :] - both)) + i + 1:
            a, b = top(i), top(int(j))
            root[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(sets))]


#: Signatures that a task folds at once, and that a bucket holds at most (about).
FOLDED = 1 << 19
BUCKET = 1 << 21
#: Texts in a block of a large candidate group.
BLOCK = 256
#: Ids of sets that a task remembers to send each text once.
SEEN = 1 << 20
#: Bits of a sketch, at least, and sets of a candidate group whose sketches one task compares with as many.
BITS, SKETCHED = 1024, 1 << 11
#: Sizes of sets that differ by this factor stand in one class.
CLASS = 0.9


def _star(sig: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each signature once, in order, with its smallest node; and edges (a, b) from that
    to the others."""
    order = np.lexsort((node, sig))
    sig, node = sig[order], node[order]
    first = np.ones(len(sig), bool)
    first[1:] = sig[1:] != sig[:-1]
    pivot = node[np.maximum.accumulate(np.where(first, np.arange(len(sig)), 0))]
    pairs = np.stack([pivot, node], 1)[node != pivot]
    return sig[first], node[first], np.unique(pairs, axis=0) if len(pairs) else pairs.reshape(0, 2)


def candidate_edges(texts: DataFrame, words: int, num: int, den: int, buckets: int) -> DataFrame:
    """(a, b): sets, by the first 8 bytes of their ids, that a shared signature joins. texts (node, data).

    The sets with one signature are joined in a star, first within each task and then over
    the tasks: a signature of many sets reaches the shuffle once for each FOLDED ones of a task. The
    shuffle moves columns: signatures as differences, byte plane by byte plane, and places in
    a list of nodes."""

    def sent(sig: np.ndarray, node: np.ndarray) -> Iterator[pa.RecordBatch]:
        sig, node, pairs = _star(sig, node)
        at = ((sig >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)  # sig is sorted, so at is
        cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(sig)]
        rows: list[list] = [[], [], [], [], []]
        for i, j in zip(cuts, cuts[1:], strict=False):
            known, place = np.unique(node[i:j], return_inverse=True)
            gaps = np.diff(sig[i:j], prepend=np.uint64(0))
            row = (int(at[i]), gaps.view(np.uint8).reshape(-1, 8).T.tobytes(), known.tobytes(), place.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), None)
            for column, x in zip(rows, row, strict=True):
                column.append(x)
        for column, x in zip(rows, (int(at[0]), None, None, None, pairs.tobytes()), strict=True):
            column.append(x)
        yield pa.record_batch([pa.array(rows[0], pa.int64()), *(pa.array(x, pa.binary()) for x in rows[1:])], names=["bucket", "gaps", "known", "place", "pairs"])

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs, nodes, held = [], [], 0
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            for node, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                s = signatures(shingles(unpack.decompress(data.as_py()).decode("utf-8", "surrogatepass"), words), num, den)
                sigs.append(s)
                nodes.append(np.full(len(s), node))
                held += len(s)
                if held >= FOLDED:
                    yield from sent(np.concatenate(sigs), np.concatenate(nodes))
                    sigs, nodes, held = [], [], 0
        if sigs:
            yield from sent(np.concatenate(sigs), np.concatenate(nodes))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, sigs, nodes = None, [], []

        def done() -> Iterator[pa.RecordBatch]:
            if sigs:
                pairs = _star(np.concatenate(sigs), np.concatenate(nodes))[2]
                sigs.clear()
                nodes.clear()
                yield pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for b in batches:
            for at, gaps, known, place, pairs in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if at != bucket:
                    yield from done()
                    bucket = at
                if pairs is not None:
                    found = np.frombuffer(pairs, np.int64).reshape(-1, 2)
                    yield pa.record_batch([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])
                    continue
                planes = np.frombuffer(gaps, np.uint8).reshape(8, -1).T
                sigs.append(np.cumsum(np.ascontiguousarray(planes).view(np.uint64).ravel(), dtype=np.uint64))
                places = np.ascontiguousarray(np.frombuffer(place, np.uint8).reshape(4, -1).T).view("<u4").ravel()
                nodes.append(np.frombuffer(known, np.int64)[places])
        yield from done()

    sent_ = texts.select("node", "data").mapInArrow(tidied(signed), "bucket bigint, gaps binary, known binary, place binary, pairs binary")
    dealt = sent_.repartition(shuffle_partitions(texts.sparkSession), "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(tidied(joined), "a bigint, b bigint")


def _compared(rows: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """(root, node) for each set that links join to an earlier one, its root, within one task of
    rows (task, set_id, data). A task is read as a run of rows; it holds 2 * BLOCK texts at most."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        task, ids, sets = None, [], []

        def done() -> Iterator[pa.RecordBatch]:
            if len(sets) > 1:
                edges = [(i, j) for j, i in enumerate(_linked(sets, num, den)) if i != j]
                yield pa.record_batch([pa.array([ids[i] for i, _ in edges], pa.binary()), pa.array([ids[j] for _, j in edges], pa.binary())], names=["root", "node"])

        for b in batches:
            for t, i, data in zip(*[b.column(k).to_pylist() for k in range(3)], strict=True):
                if t != task:
                    yield from done()
                    task, ids, sets = t, [], []
                if not ids or ids[-1] != i:
                    ids.append(i)
                    sets.append(shingles(unpack.decompress(data).decode("utf-8", "surrogatepass"), words))
        yield from done()

    parts = shuffle_partitions(rows.sparkSession)
    dealt = rows.select("task", "set_id", "data").repartition(parts, "task").sortWithinPartitions("task", "set_id")
    return dealt.mapInArrow(tidied(compare), "root binary, node binary")


def sketch(own: np.ndarray) -> bytes:
    """For each cell of the domain, whether the set holds an odd number of it; there are about as
    many cells as elements, BITS at least. Two sketches differ in no more bits than their sets in elements."""
    bits = max(BITS.bit_length() - 1, (len(own) - 1).bit_length())
    cells = (own >> np.uint64(64 - bits)).astype(np.int64)
    return np.packbits(np.bincount(cells, minlength=1 << bits) & 1).tobytes()


def stacked(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of one length: in longer ones neighbouring cells are made one."""
    least = min(map(len, sketches))
    rows = []
    for x in sketches:
        bits = np.frombuffer(x, np.uint8)
        if len(x) > least:
            bits = np.packbits(np.bitwise_xor.reduce(np.unpackbits(bits).reshape(8 * least, -1), axis=1))
        rows.append(bits)
    return np.stack(rows).view(np.uint64)


def _joined_sketches(sizes: np.ndarray, bits: np.ndarray, first_side: int, num: int, den: int) -> list[tuple[int, int]]:
    """Edges (i, j) that join, with the fewest of them, all sets whose sizes and sketches do not rule a
    link out. Every pair is looked at, or, where the sets have two sides, every pair across."""
    label = np.arange(len(sizes))
    out = []
    for i in range(first_side):
        start = i + 1 if first_side == len(sizes) else first_side
        both = sizes[i] + sizes[start:]
        may = both - 2 * -(-num * both // (num + den))
        near = np.flatnonzero((may >= 0) & (np.bitwise_count(bits[i] ^ bits[start:]).sum(1, dtype=np.int64) <= may)) + start
        new, first = np.unique(label[near], return_index=True)
        for k, at in zip(new.tolist(), first.tolist(), strict=True):
            if k != label[i]:
                out.append((i, int(near[at])))
                label[label == k] = label[i]
    return out


def _refined(large: DataFrame, num: int, den: int) -> DataFrame:
    """large (set_id, g, size, n, sketch) in smaller groups: those that pairs join whose sketches may belong
    to linked sets. Texts do not move for that.

    A group is dealt by classes of sizes and, in a class, by a hash into blocks of about SKETCHED sets;
    each two blocks that are near enough in size are one task."""
    width = -math.log(CLASS)
    reach = int(1 + math.log(den / num) / width)
    light = large.select("g", "size", "set_id", "n", "sketch", F.floor(F.log("n") / width).cast("int").alias("c"))
    held = light.groupBy("g", "c").agg(F.ceil(F.count(F.lit(1)) / SKETCHED).cast("int").alias("parts"), F.count(F.lit(1)).alias("m"))
    # One row for each group: some hundred classes at most.
    groups = checkpointed(held.groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("c", "parts"))).alias("parts"), F.sum("m").alias("m")))
    rows = looked_up(light, groups, "g", "m")
    own = F.pmod(F.xxhash64(F.lit(5), "set_id"), F.element_at("parts", F.col("c"))).cast("int")
    classes = F.filter(F.sequence(F.col("c") - reach, F.col("c") + reach), lambda k: F.map_contains_key("parts", k))
    others = F.flatten(F.transform(classes, lambda k: F.transform(F.sequence(F.lit(0), F.element_at("parts", k) - 1), lambda p: F.struct(k.alias("c"), p.alias("p")))))
    rows = rows.withColumn("own", F.struct(F.col("c").alias("c"), own.alias("p")))
    rows = rows.select("g", "own", F.explode(others).alias("other"), "set_id", "n", "sketch")
    rows = rows.withColumn("task", F.to_json(F.struct("g", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))))
    rows = rows.withColumn("side", (F.col("own") > F.col("other")).cast("int"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, ids, sizes, bits, sides = None, [], [], [], 0

        def done() -> Iterator[pa.RecordBatch]:
            if len(ids) > 1:
                edges = _joined_sketches(np.array(sizes), stacked(bits), len(ids) - sides, num, den)
                yield pa.record_batch([pa.array([ids[i] for i, _ in edges], pa.binary()), pa.array([ids[j] for _, j in edges], pa.binary())], names=["a", "b"])

        for b in batches:
            for t, side, i, n, x in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if t != task:
                    yield from done()
                    task, ids, sizes, bits, sides = t, [], [], [], 0
                sides += side
                ids.append(i)
                sizes.append(n)
                bits.append(x)
        yield from done()

    dealt = rows.select("task", "side", "set_id", "n", "sketch").repartition(shuffle_partitions(large.sparkSession), "task").sortWithinPartitions("task", "side", "set_id")
    roots = components(dealt.mapInArrow(tidied(compare), "a binary, b binary"))
    dropped(groups)
    named = large.join(roots.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("g", F.xxhash64(F.coalesce("root", "set_id"))).drop("root", "size")
    named = checkpointed(named, frees=(roots,))
    sizes = checkpointed(named.groupBy("g").agg(F.count(F.lit(1)).alias("size")).withColumn("m", F.col("size")))
    return checkpointed(looked_up(named, sizes, "g", "m").where("size > 1"), frees=(named, sizes))


def _large_groups(held: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """(root, node) of the linked sets in groups of several blocks.

    Each block is compared within itself and with the first one of its group. What that leaves
    outside the group's largest component is then compared with every block."""
    to = F.when(F.col("block") == 0, F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array("block"))
    first = held.select("g", F.explode(to).alias("block"), "set_id", "data")
    links = checkpointed(_compared(first.withColumn("task", F.concat_ws(":", "g", "block")), words, num, den))
    edges = lambda x: x.select(F.col("root").alias("a"), F.col("node").alias("b"))
    roots = components(edges(links))
    named = held.join(roots.withColumnRenamed("node", "set_id"), "set_id", "left")
    named = checkpointed(named.withColumn("root", F.coalesce("root", "set_id")))
    counts = named.groupBy("g", "root").agg(F.count(F.lit(1)).alias("n"))
    most = counts.groupBy("g").agg(F.max(F.struct("n", "root")).alias("most")).select("g", F.col("most.root").alias("main"))
    rest = named.join(most, "g").where("root <> main")
    per = rest.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("strips"))
    strips = rest.join(per, "g").withColumn("strip", F.pmod(F.xxhash64(F.lit(3), "set_id"), F.col("strips")))
    left = strips.select("g", "strip", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "set_id", "data")
    right = named.join(per, "g").select("g", F.explode(F.sequence(F.lit(0).cast("long"), F.col("strips") - 1)).alias("strip"), "block", "set_id", "data")
    tasks = left.unionByName(right).withColumn("task", F.concat_ws(":", "g", "strip", "block"))
    more = checkpointed(_compared(tasks, words, num, den))
    dropped(named)
    if more.isEmpty():
        return roots.select("root", "node")
    out = components(edges(links.unionByName(more))).select("root", "node")
    dropped(links, more, roots)
    return out


def link_components(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """Each row's key, n_shingles and component_id, the smallest key that links reach.

    Two texts link where den * (shingles in both) >= num * (shingles in either). Texts with
    equal sets are one set throughout, so copies make no pairs. A null text, or one
    without words, has 0 shingles, links to nothing and is its own component, as is a null key.
    Rows with one key keep a row each. Other columns play no part."""
    docs = df.select(key, text)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        seen: set[bytes] = set()
        for b in batches:
            rows = []
            for t in b.column(1):
                t = t.as_py()
                own = shingles(t, words)
                i = set_id(own) if len(own) else None
                data = bits = None
                if i and i not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(i)
                    data, bits = pack.compress(t.encode("utf-8", "surrogatepass")), sketch(own)
                rows.append((len(own), i, i and int.from_bytes(i[:8], "big", signed=True), data, bits))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary())
            yield pa.record_batch([b.column(0), *(pa.array(x, k) for x, k in zip(columns, kinds, strict=True))], names=[key, "n_shingles", "set_id", "node", "data", "sketch"])

    # A text comes along about once for each task that holds it, and stands for all that have its set.
    kind = df.schema[key].dataType.simpleString()
    rows = checkpointed(docs.mapInArrow(tidied(read), f"`{key}` {kind}, n_shingles bigint, set_id binary, node bigint, data binary, sketch binary"))
    texts = rows.where("data is not null").select("node", "set_id", "data", F.col("n_shingles").alias("n"), "sketch")
    # What signatures() gives for n shingles, from above.
    expected = texts.agg(F.sum(F.col("n") + 200)).first()[0] or 0
    buckets = max(shuffle_partitions(df.sparkSession), int(expected) // BUCKET)
    groups = components(candidate_edges(texts, words, num, den, buckets))
    sizes = groups.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    sized = groups.join(sizes, "root").select("node", F.col("root").alias("g"), "size")
    # The groups grow with the input, so they are joined in one way at every size.
    held = texts.hint("merge").join(sized, "node").groupBy("set_id", "g", "size").agg(F.min("data").alias("data"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    held = checkpointed(held, frees=(groups,))
    rows = checkpointed(rows.select(key, "n_shingles", "set_id"), frees=(rows,))
    small, large = (held.where(F.col("size") <= BLOCK), held.where(F.col("size") > BLOCK))
    tables = [held]
    if not large.isEmpty():
        refined = _refined(large, num, den)
        tables.append(refined)
        small = small.unionByName(refined.where(F.col("size") <= BLOCK).select(*small.columns))
        large = refined.where(F.col("size") > BLOCK)
    # A group of one block is settled within its task; sets without links have no row.
    roots = checkpointed(_compared(small.withColumn("task", F.col("g").cast("string")), words, num, den))
    if not large.isEmpty():
        blocks = F.ceil(F.col("size") / BLOCK)
        large = large.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")))
        roots = checkpointed(roots.unionByName(_large_groups(large, words, num, den)), frees=(roots,))
    dropped(*tables)
    sets = rows.where("set_id is not null").groupBy("set_id").agg(F.min(key).alias("least"), F.count(F.lit(1)).alias("n"))
    sets = sets.join(roots.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    sets = checkpointed(sets, frees=(roots,))
    smallest = sets.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("m"))
    sets = looked_up(sets, checkpointed(smallest), "root", "m").select("set_id", "component_id", "n")
    out = looked_up(rows, checkpointed(sets), "set_id", "n").unionByName(rows.where("set_id is null").withColumn("component_id", F.lit(None).cast(kind)))
    return out.select(key, "n_shingles", F.coalesce("component_id", key).alias("component_id"))


def op3_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    """Every document's doc_id, n_shingles, component_id: 4-word shingles, similarity 0.85."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return link_components(docs)


OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), i AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM i JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * i >= 85 * (x.n + y.n - i)
), e AS (
  SELECT a, b FROM l UNION SELECT b, a FROM l
), r AS (
  SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(m.least, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS least FROM r GROUP BY a) m USING (doc_id)
"""
