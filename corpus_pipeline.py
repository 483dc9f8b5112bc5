"""The training-corpus pipeline: each stage works on all that the one before it kept.

language_id  texts in no known language go
line_dedup   passages that an earlier document has go, and documents left empty by that
near_dedup   of each group of near copies the document with the smallest doc_id stays
mixing       sources are repeated to the target weights; no document is lost
packing      the mix as token sequences

Other columns than those of documents are kept by all stages but the last, whatever their names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.common import checkpointed, dropped, unused
from linkloom.llm.jaccard import link_components
from linkloom.llm.language import identify, learn
from linkloom.llm.line_dedup import drop_repeated_lines
from linkloom.llm.mixing import mix, repeated
from linkloom.llm.packing import pack, token_pieces, vocabulary

#: Words in a shingle, and the similarity from which documents are near copies, in percent.
WORDS, SIMILAR = 5, 80
#: How often a source is taken at most.
REPETITION = 1.5


def _with_text(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without texts that are null or empty, have no letter, or are in no language that docs
    name: in scripts of none, or far from all that was learned. Mixes of known languages stay.

    Null keys and languages are no reason to go; repeated rows stay or go together; an empty table
    gives no rows. Texts of any length are read whole."""
    names = tuple(unused(docs, 4))
    named = identify(docs, learn(docs), with_known=True, names=names)
    return named.where(F.col(names[3])).select(*_columns(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with what stays of their texts; n_chars follows. A document of which nothing but
    white space stays goes, as earlier ones hold all of it; an untouched one never goes.

    Null texts stay; rows with one key and text are one document, left to the next stage; null
    keys come first; an empty table gives no rows."""
    lines, removed = unused(docs, 2)
    out = drop_repeated_lines(docs, lines=lines, removed=removed)
    out = out.where((F.col(removed) == 0) | F.col("text").rlike(r"\S"))
    return _with_text(out).select(*_columns(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, that with the smallest doc_id; null ids come first,
    and of equal ids a hash of the row decides, then its place. Repeated rows are copies too.

    Null and empty texts are copies of nothing and stay; an empty table gives no rows. docs
    has to replay in order, as tables do."""
    place, key = unused(docs, 2)
    numbered = docs.withColumn(place, F.monotonically_increasing_id())
    row = F.struct(F.col("doc_id").alias("d"), F.xxhash64(*_columns(docs)).alias("h"), F.col(place).alias("place"))
    found = link_components(numbered.select(row.alias(key), "text"), key=key, words=WORDS, num=SIMILAR)
    stays = found.select(F.col("component_id.place").alias(place)).distinct()
    return numbered.join(stays, place, "left_semi").select(*_columns(docs))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs, each as often as the mix of sources takes it: once or more.

    A null source is a source of its own; null and empty texts are taken with the whole rounds of
    their source; repeated rows are rows of their own; an empty table gives no rows."""
    names = tuple(unused(docs, 5))
    return repeated(mix(docs, max_repetition=REPETITION, names=names), names[2]).select(*_columns(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of docs and their places: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is the end id alone; repeated rows, also of one key or a null one, are packed
    each for itself; an empty table gives no rows. Long texts are cut into pieces, none is lost."""
    pieces = checkpointed(token_pieces(docs, vocabulary()))
    return pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]
#: No SQL expresses the search, alignment and packing stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, docs = docs, stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = checkpointed(docs)
            if name != STAGES[0][0]:
                dropped(before)
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
