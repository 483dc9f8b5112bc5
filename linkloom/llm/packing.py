"""Best-fit packing of token sequences by sum of squares.

Documents longer than a sequence are cut into full pieces after a first, shorter one. The
pieces are dealt at random into blocks, and within a block each piece goes where the
squared counts of open bins for each residual gap become smallest."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import checkpointed, tidied

#: Characters on which both tokenizer libraries' classes of letters, digits and white space agree.
SPACE = re.compile(r"\S(?= \S)")
PLAIN = re.compile(r"[\t-\r -\u024f\u2010-\u2027\u20ac]*").fullmatch


#: Characters of a text that the vocabulary file's library encodes at once, where single spaces let it be cut.
PART = 20_000


def _parts(text: str) -> Iterator[str]:
    """text in parts of about PART characters. It is cut before single spaces, where a word of the
    byte-level pattern always begins, so the ids of the parts are those of the whole."""
    start = 0
    while len(text) - start > PART:
        cut = SPACE.search(text, start + PART)
        if not cut:
            break
        yield text[start : cut.start() + 1]
        start = cut.start() + 1
    yield text[start:]


class Ids:
    """The ids of whole texts, as little-endian unsigned 32-bit integers.

    The vocabulary file's own library encodes; texts of plain characters go through a
    faster encoder that is built from the same vocabulary and gives the same ids. The
    string of a special token makes a text go through the first."""

    def __init__(self, tokenizer_json: str) -> None:
        import tiktoken

        self.json, self._tokenizer = tokenizer_json, None
        known = json.loads(tokenizer_json)
        self.special = [t["content"] for t in known.get("added_tokens", [])]
        self.fast = None
        # Only for byte-level vocabularies in order of merging, with the usual word pattern.
        vocab, pre = known["model"]["vocab"], known.get("pre_tokenizer") or {}
        if known["model"]["type"] == "BPE" and pre.get("type") == "ByteLevel" and not known.get("normalizer") and not pre.get("add_prefix_space"):
            shown = [b for b in range(256) if chr(b).isprintable() and b not in (32, 173)]
            byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
            ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in self.special}
            self.fast = tiktoken.Encoding("plain", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    @property
    def tokenizer(self):
        if self._tokenizer is None:
            from tokenizers import Tokenizer

            self._tokenizer = Tokenizer.from_str(self.json)
        return self._tokenizer

    def of(self, texts: list[str]) -> list[bytes]:
        out = []
        for t in texts:
            if self.fast and PLAIN(t) and not any(s in t for s in self.special):
                ids = np.array(self.fast.encode_ordinary(t), "<u4")
            else:
                parts = _parts(t) if self.fast else [t]
                ids = np.concatenate([np.array(self.tokenizer.encode(p, add_special_tokens=False).ids, "<u4") for p in parts])
            out.append(ids.tobytes())
        return out


#: Fixed value: the word pattern of the byte-level vocabularies.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_encoders: dict[int, Ids] = {}


def cut(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: full ones, after a first one with the rest."""
    first = n % most or most
    return [(0, min(first, n)), *((s, most) for s in range(first, n, most))]


def token_pieces(df: DataFrame, tokenizer_json: str, text: str = "text", key: str = "doc_id", most: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Each row's pieces: row (a number for the row), key, piece, start, length, ids_crc32 and,
    if asked for, ids. A row's ids are those of its whole text (null: none), then end_id."""
    spark = df.sparkSession
    held = spark.sparkContext.broadcast(tokenizer_json)  # one vocabulary file
    end = np.array([end_id], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = zlib.crc32(held.value.encode())
        ids_of = _encoders.get(token) or _encoders.setdefault(token, Ids(held.value))
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                b = batch.slice(at, 200)
                out: list[list] = [[] for _ in range(7)]
                for row, k, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), ids_of.of([t or "" for t in b.column(2).to_pylist()]), strict=True):
                    data += end
                    for i, (start, n) in enumerate(cut(len(data) // 4, most)):
                        part = data[4 * start : 4 * (start + n)]
                        for column, x in zip(out, (row, k, i, start, n, zlib.crc32(part), part if with_ids else None), strict=True):
                            column.append(x)
                arrays = [pa.array(out[0], pa.int64()), pa.array(out[1], b.schema.field(1).type), pa.array(out[2], pa.int32()), *(pa.array(x, pa.int64()) for x in out[3:6])]
                if with_ids:
                    arrays.append(pa.array([np.frombuffer(x, "<u4").astype("int32") for x in out[6]], pa.list_(pa.int32())))
                yield pa.record_batch(arrays, names=["row", key, "piece", "start", "length", "ids_crc32", *["ids"] * with_ids])

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.monotonically_increasing_id().alias("row"), key, text)
    return rows.mapInArrow(tidied(pieces), f"row bigint, {key} {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids)


def sum_of_squares(lengths: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and place of each piece, packed in the order given.

    open[g]: how many bins have the gap g. Moving a bin from gap g to g - n changes the sum
    of squares by 2 * (open[g - n] - open[g]) + 2, or less 2 * open[g] - 1 where it
    fills the bin; a new bin adds 2 * open[most - n] + 1. Ties go to the smallest gap."""
    open_ = np.zeros(most + 1, np.int64)
    bins: list[list[int]] = [[] for _ in range(most + 1)]
    number, place, made = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i, n in enumerate(lengths.tolist()):
        if n == most:
            number[i], place[i], made = made, 0, made + 1
            continue
        after = open_[: most - n + 1].copy()  # by the gap that stays
        cost = after - open_[n:] + 1.0
        cost[0] = 0.5 - open_[n]
        cost[open_[n:] == 0] = np.inf
        best = int(cost.argmin())
        if cost[best] <= after[most - n] + 0.5:
            gap = best + n
            b = bins[gap].pop()
            open_[gap] -= 1
        else:
            gap, b, made = most, made, made + 1
        number[i], place[i] = b, most - gap
        if gap > n:
            bins[gap - n].append(b)
            open_[gap - n] += 1
    return number, place


def pack(pieces: DataFrame, most: int = 2048, block: int = 20_000, seed: int = 5) -> DataFrame:
    """pieces (with row, piece, length) with sequence_id and offset.

    A block holds about `block` pieces, dealt by a seeded hash of the piece's row, so no group
    of copies or frequent key meets in one. Longer pieces are placed first; a block wastes
    at most a few open sequences. Sequences of different blocks have different numbers."""
    count = pieces.count()
    blocks = max(1, -(-count // block))
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "row", "piece"), F.lit(blocks)))

    def packed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "row", "piece"], ascending=[False, True, True], kind="stable")
        number, place = sum_of_squares(rows["length"].to_numpy(), most)
        rows = rows.assign(sequence_id=number * blocks + key[0], offset=place)
        return rows.drop(columns=["block"])

    schema = StructType([*pieces.schema.fields]).add("sequence_id", "long").add("offset", "long")
    return dealt.groupBy("block").applyInPandas(packed, schema)


def vocabulary() -> str:
    """The default vocabulary file's text."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return f.read()


def op5_packing(spark, sf_dir: str, tokenizer_json: str | None = None) -> DataFrame:
    """Every document's pieces with doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    pieces = checkpointed(token_pieces(docs, tokenizer_json or vocabulary()))
    return pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
