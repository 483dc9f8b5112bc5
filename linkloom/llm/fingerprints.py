"""Document fingerprints: a canonical exact digest.

A text is normalised (NFKC), case-folded and its white space folded, then hashed with
128-bit xxhash. Texts with equal digests are held against each other byte by byte, and a
digest that two different texts share is told apart by their SHA-256."""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, with_next


def canonical(text: str) -> bytes:
    folded = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return " ".join(folded.split()).encode("utf-8", "surrogatepass")


def digest(data: bytes, shared: frozenset[str] | None = frozenset()) -> str:
    """The fingerprint of a canonical text; shared: the digests that different texts have, None
    where all are to be told apart."""
    d = xxhash.xxh3_128_hexdigest(data)
    return f"{d}-{hashlib.sha256(data).hexdigest()}" if shared is None or d in shared else d


def shared_digests(df: DataFrame, text: str = "text") -> DataFrame:
    """The digests that canonical texts with different bytes share: column digest.

    The bytes travel compressed without loss by one setting, so they are equal where the
    texts are. Each task folds the copies it has first, so a large group of copies
    reaches no single task whole."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1, write_content_size=False)
        for b in batches:
            texts = [canonical(t or "") for t in b.column(0).to_pylist()]
            yield pa.record_batch(
                {"digest": pa.array([xxhash.xxh3_128_digest(t) for t in texts], pa.binary()), "data": pa.array([pack.compress(t) for t in texts], pa.binary())}
            )

    rows = df.select(text).mapInArrow(packed, "digest binary, data binary")
    seen = rows.groupBy("digest").agg(F.min("data").alias("least"), F.max("data").alias("most"))
    return seen.where("least <> most").select(F.lower(F.hex("digest")).alias("digest"))


#: Shared digests that are sent to all tasks. Texts of different bytes share a 128-bit digest about
#: never; if more do, every fingerprint carries both hashes, which tells all texts apart as well.
MOST_SHARED = 10_000


def known_shared(df: DataFrame, text: str = "text") -> frozenset[str] | None:
    found = [r[0] for r in shared_digests(df, text).take(MOST_SHARED + 1)]
    return frozenset(found) if len(found) <= MOST_SHARED else None


def fingerprint_documents(df: DataFrame, text: str = "text") -> DataFrame:
    """df with `fingerprint` (a column of that name is replaced).

    Texts that differ only in Unicode form, case or white space have equal fingerprints.
    A null text has the fingerprint of the empty text. Every row is kept; repeated rows have equal
    fingerprints; an empty table gives no rows."""
    shared = known_shared(df, text)

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([digest(canonical(t or ""), shared) for t in texts], dtype=object)

    return df.withColumn("fingerprint", of(F.col(text)))


def op6_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Every document's n_chars, edited_sha256, fingerprints and likenesses."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    shared = known_shared(docs)

    def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        part, text, data, print_ = None, "", b"", ""
        names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
        for b in batches:
            out = []
            for p, own, doc_id, packed_text in zip(*[b.column(i).to_pylist() for i in range(4)], strict=True):
                # The row before, in descending order of doc_id the next one.
                (before, data_before, print_before), same = (text, data, print_), part == p
                text = unpack.decompress(packed_text).decode()
                data = canonical(text)
                part, print_ = p, digest(data, shared)
                if not own:
                    continue
                if not same:  # the only document is its own next
                    before, data_before, print_before = text, data, print_
                n = len(text)
                cut = n // 3
                new = text[: n - cut] + before[:cut]
                new_data = canonical(new)
                new_print = digest(new_data, shared)
                # A digest that only the edited text shares is told apart as well.
                if new_data != data and new_print == print_:
                    new_print += "-" + hashlib.sha256(new_data).hexdigest()
                out.append((doc_id, n, hashlib.sha256(new.encode()).hexdigest(), print_, new_print, float(new_print == print_), float(print_before == print_)))
            columns = list(zip(*out, strict=True)) or [()] * 7
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            yield pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=list(names))

    dealt = with_next(docs, "doc_id", packed("text"), wrap=True).select("part", "own", "rank.doc_id", "payload")
    return dealt.mapInArrow(
        edited, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )
